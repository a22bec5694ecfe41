"""Q-TREND: daily totals (all, central area, weekday mornings) with trailing sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odoflow.functions.columns import weekday_monday0


def daily_totals(df: DataFrame, value: str = "entries", date_col: str = "date") -> DataFrame:
    """AG14/AG15: sum of ``value`` per date (one row per day)."""
    return df.groupBy(F.col(date_col).alias("date")).agg(F.sum(value).cast("long").alias(value))


def central_only(df: DataFrame, stations: Sequence[str], station_col: str = "station") -> DataFrame:
    """FI13: rows of a fixed list of stations (literal IN-list, pushed to the scan)."""
    return df.filter(F.col(station_col).isin(*stations))


def weekday_morning(df: DataFrame, ts_col: str = "date_time", before_hour: int = 12) -> DataFrame:
    """FI14: Monday-Friday readings before ``before_hour``."""
    return df.filter((weekday_monday0(ts_col) < 5) & (F.hour(ts_col) < before_hour))


def trailing_sum(daily: DataFrame, n: int, value: str = "entries", scale: float = 1e6, name: str = "rolling") -> DataFrame:
    """WN5: sum of the last ``n`` rows / n / scale; NULL until ``n`` rows exist.

    The window has no partition key, so it runs in one task: only valid on a
    frame already reduced to one row per day (bounded by the calendar).
    """
    w = Window.orderBy("date").rowsBetween(-(n - 1), 0)
    full = F.count(F.lit(1)).over(w) == n
    return daily.select("*", F.when(full, F.sum(value).over(w) / F.lit(n) / F.lit(scale)).alias(name))
