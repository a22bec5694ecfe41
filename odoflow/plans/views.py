"""SQL access: models as temp views, and the cohort filter as bound-parameter SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odoflow.params import CohortFilter


def register_views(models: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """IO10: every model as a temp view, so the original SQL can run on ``spark.sql``."""
    names = []
    for name, df in models.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def cohort_filter_sql(
    spark: SparkSession,
    view: str,
    start: date | None = None,
    end: date | None = None,
    dow: Sequence[int] | None = None,
    tod: Sequence[int] | None = None,
    boro: Sequence[int] | None = None,
    sta: Sequence[str] | None = None,
) -> DataFrame:
    """FI5 in SQL: optional predicates joined with AND; values are bound
    parameters (never spliced into the text). An unset filter, or one with all
    values ticked, adds nothing."""
    conds, args = ["TRUE"], {}
    active = CohortFilter(*(tuple(v) if v else None for v in (dow, tod, boro, sta))).active()
    if start is not None:
        conds.append("date >= :start")
        args["start"] = start
    if end is not None:
        conds.append("date < :end")
        args["end"] = end
    for name, expr in (("dow", "dayofweek(date) - 1"), ("tod", "hour"), ("boro", "boro"), ("sta", "station")):
        if values := active.get(name):
            conds.append(f"array_contains(:{name}, {expr})")
            args[name] = F.array(*[F.lit(v) for v in values])
    query = f"""
        SELECT date, CAST(dayofweek(date) - 1 AS BIGINT) AS dow, hour, station, boro, entries, exits
        FROM {view}
        WHERE {' AND '.join(conds)}"""
    return spark.sql(query, args=args)
