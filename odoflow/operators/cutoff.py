"""Per-series statistics and the anomaly cutoff (Q-EAVG / Q-XAVG / Q-CUT)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoflow.operators.series import CHUNK
from odoflow.params import V1_CUTOFF, CutoffRule


def cutoff_value(mean: Column, sd: Column, n: Column, rule: CutoffRule) -> Column:
    """mean + k*sd, replaced by ``floor`` when n <= min_n, undefined, < floor or > ceiling.

    ``isnan`` is paired with ``isNull``: Spark's isnan(NULL) is false.
    """
    c = mean + F.lit(rule.k) * sd
    bad = (n <= rule.min_n) | c.isNull() | F.isnan(c) | (c < rule.floor)
    if rule.ceiling is not None:
        bad = bad | (c > rule.ceiling)
    return F.when(bad, F.lit(float(rule.floor))).otherwise(c)


def series_stats(
    diffed: DataFrame,
    value: str = "entries",
    rule: CutoffRule = CutoffRule(),
    keys: Sequence[str] = ("station", "turnstile"),
    cutoff_name: str | None = None,
) -> DataFrame:
    """mean, sample sd, count of the positive ``value`` per series, and its cutoff.

    One aggregation; partial aggregates are combined map-side, so a series
    with a third of all rows costs one small state per task.
    """
    stats = (
        diffed.filter(F.col(value) > 0)
        .groupBy(*keys)
        .agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.count(F.lit(1)).alias("n"))
    )
    name = cutoff_name or f"{value}_cutoff"
    return stats.withColumn(name, cutoff_value(F.col("mean"), F.col("sd"), F.col("n"), rule))


def both_cutoffs(
    diffed: DataFrame,
    rule: CutoffRule = CutoffRule(),
    keys: Sequence[str] = ("station", "turnstile"),
) -> DataFrame:
    """entries_cutoff and exits_cutoff per series from ONE aggregation.

    Conditional aggregates over the positive values of each counter; a
    series with no positive value gets n = 0, hence the floor, exactly as a
    series missing from a per-counter statistics table.
    """
    aggs = []
    for v in ("entries", "exits"):
        pos = F.when(F.col(v) > 0, F.col(v))
        aggs += [F.avg(pos).alias(f"_m_{v}"), F.stddev_samp(pos).alias(f"_s_{v}"), F.count(pos).alias(f"_n_{v}")]
    stats = diffed.groupBy(*keys).agg(*aggs)
    return stats.select(
        *keys,
        *[cutoff_value(F.col(f"_m_{v}"), F.col(f"_s_{v}"), F.col(f"_n_{v}"), rule).alias(f"{v}_cutoff") for v in ("entries", "exits")],
    )


def apply_cutoffs(
    diffed: DataFrame,
    entry_stats: DataFrame | None,
    exit_stats: DataFrame | None,
    default: float = 2000.0,
    keys: Sequence[str] = ("station", "turnstile"),
) -> DataFrame:
    """Delete rows whose entries/exits exceed the series cutoff (``default`` when
    the series has no statistics, or when no table is given: the script
    variant never applied its exit cutoff). A NULL difference survives."""
    df = diffed
    for stats, value in ((entry_stats, "entries"), (exit_stats, "exits")):
        name = f"{value}_cutoff"
        if stats is None:
            df = df.withColumn(name, F.lit(default))
        else:
            df = df.join(stats.select(*keys, name), on=list(keys), how="left").withColumn(
                name, F.coalesce(F.col(name), F.lit(default))
            )
    keep = ~F.coalesce(F.col("entries") > F.col("entries_cutoff"), F.lit(False)) & ~F.coalesce(
        F.col("exits") > F.col("exits_cutoff"), F.lit(False)
    )
    return df.filter(keep).drop("entries_cutoff", "exits_cutoff")


def drop_all_zero(df: DataFrame, cols: Sequence[str] = ("entries", "exits")) -> DataFrame:
    """Delete rows where every column is 0 (NULLs survive, as with SQL DELETE)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) == 0)
    return df.filter(~F.coalesce(cond, F.lit(False)))


def cutoff_clean(
    diffed: DataFrame,
    rule: CutoffRule = V1_CUTOFF,
    exit_cutoff: str = "per_series",
    keys: Sequence[str] = ("station", "turnstile"),
) -> DataFrame:
    """Q-CUT: statistics on the positive differences, cutoff filter, all-zero rows dropped.

    exit_cutoff='per_series' applies the exit statistics (notebook);
    'default' reproduces the script, whose exit update never ran.
    """
    if exit_cutoff == "per_series":
        # both statistics in one pass: the diff feeds two consumers, not three
        stats = both_cutoffs(diffed, rule, keys)
    else:
        stats = series_stats(diffed, "entries", rule, keys).select(*keys, "entries_cutoff").withColumn(
            "exits_cutoff", F.lit(float(rule.floor))
        )
    on = list(keys)
    if CHUNK in diffed.columns:
        # Chunk-aligned join: the diff is already hash-partitioned on
        # (keys, _chunk) by its window, so the statistics are replicated to the
        # (series, chunk) pairs that exist (one small row each) and joined on
        # those keys - only the small side moves, even for a hot series.
        # Chunk ids are never NULL, so this is a plain equality that keeps the layout.
        pairs = diffed.select(*keys, CHUNK).distinct()
        aligned = pairs.join(stats, on=on, how="inner")
        cut = diffed.join(aligned, on=[*on, CHUNK], how="left").select(*diffed.columns, "entries_cutoff", "exits_cutoff")
    else:
        cut = diffed.join(stats, on=on, how="left")
    floor = F.lit(float(rule.floor))
    # The cutoff columns are INTEGER: the statistics are rounded (half to even) before they apply.
    cut = cut.withColumn("entries_cutoff", F.rint(F.coalesce("entries_cutoff", floor))).withColumn(
        "exits_cutoff", F.rint(F.coalesce("exits_cutoff", floor))
    )
    keep = ~F.coalesce(F.col("entries") > F.col("entries_cutoff"), F.lit(False)) & ~F.coalesce(
        F.col("exits") > F.col("exits_cutoff"), F.lit(False)
    )
    return drop_all_zero(cut.filter(keep).drop("entries_cutoff", "exits_cutoff", CHUNK))
