"""First differences of both counters per series, and the anomaly rules.

``difference`` = LAG over (station, turnstile) ordered by time (counters as
tie-breakers, so equal timestamps still give one answer), computed with the
skew-safe chunked lag of ``series``. ``DiffPolicy`` selects one of the
reference's variants (dbt / script / pandas).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoflow.functions.columns import interval_hours, seconds_between
from odoflow.operators.series import CHUNK, series_lag
from odoflow.params import DBT_DIFF, DiffPolicy

DIFF_COLUMNS = [
    "date_time", "station", "turnstile", "entry_counter", "entries",
    "exit_counter", "exits", "seconds_diff", "hours_difference",
]


def with_raw_diffs(
    staged: DataFrame,
    keys: Sequence[str] = ("station", "turnstile"),
    ts: str = "date_time",
    chunk_days: int = 7,
    keep_chunk: bool = False,
) -> DataFrame:
    """Signed differences (NULL for the first reading) plus the time gap.

    Adds entries_raw, exits_raw (INT), seconds_diff and hours_difference
    (BIGINT); with ``keep_chunk`` also the internal ``_chunk`` id.
    """
    lagged = series_lag(
        staged,
        keys=keys,
        order=[ts, "entry_counter", "exit_counter"],
        cols=[ts, "entry_counter", "exit_counter"],
        prefix="prev_",
        chunk_days=chunk_days,
        keep_chunk=keep_chunk,
    )
    return lagged.select(
        *[F.col(c) for c in staged.columns],
        *([F.col(CHUNK)] if keep_chunk else []),
        (F.col("entry_counter") - F.col("prev_entry_counter")).alias("entries_raw"),
        (F.col("exit_counter") - F.col("prev_exit_counter")).alias("exits_raw"),
        seconds_between(F.col("prev_" + ts), F.col(ts)).alias("seconds_diff"),
        interval_hours(F.col("prev_" + ts), F.col(ts)).alias("hours_difference"),
    )


def _shape(x: Column, policy: DiffPolicy, cap: int | None) -> Column:
    if policy.first == "zero":
        x = F.coalesce(x, F.lit(0))
    if policy.negative == "abs":
        x = F.abs(x)
    elif policy.negative == "zero":
        x = F.when(x < 0, F.lit(0)).otherwise(x)
    if cap is not None and policy.cap_rule == "zero_above":
        x = F.when(x > cap, F.lit(0)).otherwise(x)
    return x


def _keep(x: Column, policy: DiffPolicy, cap: int | None) -> Column:
    """Row-keep predicate for one difference column (TRUE keeps)."""
    cond = F.lit(True)
    if policy.negative == "drop":
        cond = cond & ~F.coalesce(x < 0, F.lit(False))  # a NULL survives a DELETE
    if policy.seconds_per_count is not None:
        cond = cond & (x < F.col("seconds_diff") / F.lit(policy.seconds_per_count))
    if cap is not None:
        if policy.cap_rule == "keep_below":
            cond = cond & (x < F.lit(cap))
        elif policy.cap_rule == "keep_at_most":
            cond = cond & ~F.coalesce(x > cap, F.lit(False))
    return cond


def apply_policy(raw_diffs: DataFrame, policy: DiffPolicy = DBT_DIFF) -> DataFrame:
    """Shape the signed differences and filter rows according to ``policy``.

    The filter stays above the window (it must not be pushed below a LAG).
    Comparisons with NULL drop the row, as in SQL WHERE.
    """
    shaped = raw_diffs.withColumn("entries", _shape(F.col("entries_raw"), policy, policy.entry_cap)).withColumn(
        "exits", _shape(F.col("exits_raw"), policy, policy.exit_cap)
    )
    cond = F.lit(True)
    if policy.first == "drop":
        cond = cond & ~(F.col("entries").isNull() & F.col("exits").isNull())
    if policy.max_gap_s is not None:
        cond = cond & (F.col("seconds_diff") < F.lit(policy.max_gap_s))
    cond = cond & _keep(F.col("entries"), policy, policy.entry_cap) & _keep(F.col("exits"), policy, policy.exit_cap)
    extra = [CHUNK] if CHUNK in raw_diffs.columns else []
    return shaped.filter(F.coalesce(cond, F.lit(False))).select(*DIFF_COLUMNS, *extra)


def difference(
    staged: DataFrame,
    policy: DiffPolicy = DBT_DIFF,
    keys: Sequence[str] = ("station", "turnstile"),
    chunk_days: int = 7,
) -> DataFrame:
    """Q-DIFF: lagged differences with the anomaly filter of ``policy``."""
    return apply_policy(with_raw_diffs(staged, keys=keys, chunk_days=chunk_days), policy)
