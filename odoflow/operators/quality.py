"""Data-quality checks as operators: each returns a (small) DataFrame report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(frames: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """DQ1: (table_name, column_name, null_count, rows) for every listed column.

    One aggregation per table (all its columns in one pass), stacked long.
    """
    out = None
    for name, (df, cols) in frames.items():
        agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
        stacked = agg.select(
            F.lit(name).alias("table_name"),
            F.explode(
                F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count")) for i, c in enumerate(cols)])
            ).alias("_s"),
            F.col("_rows").alias("rows"),
        ).select("table_name", "_s.column_name", "_s.null_count", "rows")
        out = stacked if out is None else out.unionByName(stacked)
    return out


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG13 / DQ2 / DQ4: key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def unique_check(df: DataFrame, key: str) -> DataFrame:
    """DQ2: one row (column_name, duplicates, nulls); passes when both are 0."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(key).alias("column_name"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("duplicates"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
    )


def conditional_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """AG11 / DQ5: many conditional counts in ONE pass, returned long (check, rows)."""
    agg = df.agg(*[F.count_if(cond).alias(f"_c{i}") for i, cond in enumerate(checks.values())])
    return agg.select(
        F.explode(
            F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"_c{i}").alias("rows")) for i, name in enumerate(checks)])
        ).alias("_s")
    ).select("_s.check", "_s.rows")


def row_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """DQ6 / IO15: (stage, rows) for several frames, stacked long (no cross join)."""
    out = None
    for name, df in stages.items():
        r = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
        out = r if out is None else out.unionByName(r)
    return out


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """AG18: fixed-width bins (width_bucket: 0 below lo, bins+1 at or above hi)."""
    b = F.width_bucket(F.col(col).cast("double"), F.lit(float(lo)), F.lit(float(hi)), F.lit(bins))
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(b.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "bucket",
            (F.lit(lo) + (F.col("bucket") - 1) * F.lit((hi - lo) / bins)).alias("bin_start"),
            "rows",
        )
    )


def adaptive_histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """AG18 (adaptive form): ``histogram_numeric`` bin centres and heights.

    One aggregate with a bounded state per task (``bins`` centroids), merged
    across tasks: approximate, for the shape of a distribution.
    """
    h = df.agg(F.histogram_numeric(F.col(col).cast("double"), F.lit(bins)).alias("h"))
    return h.select(F.explode("h").alias("b")).select(F.col("b.x").alias("center"), F.col("b.y").alias("height"))
