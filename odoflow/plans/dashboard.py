"""One dashboard refresh: every panel's data from one filter specification.

The per-cohort daily table is the only intermediate that several panels
share; it is cached for the refresh (the temp tables of the original) and
released afterwards. Everything is small by then (cohort x day x station).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoflow.operators import cohorts as co
from odoflow.params import CohortFilter, CohortSpec


@contextmanager
def refresh(
    hourly: DataFrame,
    stations: DataFrame,
    cohorts: Sequence[CohortSpec],
    filt: CohortFilter | None = None,
    selected: str = "Selected",
    pandemic: str = "Pandemic",
    base: str = "2019",
    ma_rows: int = 7,
) -> Iterator[dict[str, DataFrame]]:
    """Yield the panel frames (kpi, by_date, by_dow, by_tod, by_station, names)."""
    tagged = co.tag_cohorts(hourly, cohorts, filt)
    daily = co.cohort_daily(tagged).cache()
    try:
        summary = co.cohort_summary(daily)
        order = co.label_order(F.col("when"), [base, selected, pandemic])
        yield {
            "kpi": co.kpi(summary, selected, pandemic, base),
            "by_date": co.moving_average(summary.filter(F.col("cohort") == selected), ma_rows).orderBy("date"),
            "by_dow": co.dow_profile(summary).orderBy(order, "dow"),
            "by_tod": co.tod_profile(tagged).orderBy(order, "hour"),
            "by_station": co.station_compare(daily, stations, selected, pandemic, base).orderBy("station"),
            "names": stations.select("pretty_name").distinct().orderBy("pretty_name"),
        }
    finally:
        daily.unpersist()
