"""Cohort comparisons over the hourly facts (the dashboard's data logic).

All cohorts are evaluated in ONE scan: each hourly row is tagged with the
names of the cohorts whose date range (and optional filters) it satisfies,
exploded, and every later aggregate groups by ``cohort``. The reference
built three filtered copies; results are identical.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odoflow.functions.columns import dow_sunday0, format_percent, pct_change
from odoflow.params import CohortFilter, CohortSpec


def date_range(spec: CohortSpec, date_col: str = "date") -> Column:
    cond = F.lit(True)
    if spec.start is not None:
        cond = cond & (F.col(date_col) >= F.lit(spec.start))
    if spec.end is not None:
        cond = cond & (F.col(date_col) < F.lit(spec.end))
    return cond


def filter_predicate(filt: CohortFilter | None, date_col: str = "date") -> Column:
    """AND of the optional filters; an unset filter, or one with all values ticked, adds nothing."""
    cond = F.lit(True)
    columns = {"dow": dow_sunday0(date_col), "tod": F.col("hour"), "boro": F.col("boro"), "sta": F.col("station")}
    for name, values in (filt.active() if filt else {}).items():
        cond = cond & columns[name].isin(*values)
    return cond


def tag_cohorts(hourly: DataFrame, cohorts: Sequence[CohortSpec], filt: CohortFilter | None = None) -> DataFrame:
    """(cohort, date, dow, hour, station, boro, entries, exits) for every cohort a row belongs to.

    The union of the cohorts' date ranges is also applied as a plain filter
    so that it reaches the scan (partition pruning / row-group skipping).
    """
    any_range = F.lit(False)
    for c in cohorts:
        any_range = any_range | date_range(c)
    names = F.filter(
        F.array(*[F.when(date_range(c), F.lit(c.name)) for c in cohorts]), lambda x: x.isNotNull()
    )
    return hourly.filter(any_range & filter_predicate(filt)).select(
        F.explode(names).alias("cohort"),
        "date",
        dow_sunday0("date").cast("long").alias("dow"),
        "hour",
        "station",
        "boro",
        "entries",
        "exits",
    )


def cohort_daily(tagged: DataFrame) -> DataFrame:
    """AG5: per cohort, day and station."""
    return tagged.groupBy("cohort", "date", "dow", "station", "boro").agg(
        F.sum("entries").cast("long").alias("entries"), F.sum("exits").cast("long").alias("exits")
    )


def cohort_summary(daily: DataFrame) -> DataFrame:
    """AG6: per cohort and day, over all stations."""
    return daily.groupBy("cohort", "date", "dow").agg(
        F.sum("entries").cast("long").alias("entries"), F.sum("exits").cast("long").alias("exits")
    )


def kpi(summary: DataFrame, selected: str, pandemic: str, base: str) -> DataFrame:
    """AG7 + PR15: average daily entries per cohort and percent changes, one row."""

    def avg_of(name: str) -> Column:
        return F.avg(F.when(F.col("cohort") == name, F.col("entries")))

    s, p, b = avg_of(selected), avg_of(pandemic), avg_of(base)
    return summary.agg(
        s.alias("avg_selected"),
        p.alias("avg_pandemic"),
        b.alias("avg_base"),
        (pct_change(s, p) * 100).alias("pct_selected_vs_pandemic"),
        (pct_change(s, b) * 100).alias("pct_selected_vs_base"),
        (pct_change(p, b) * 100).alias("pct_pandemic_vs_base"),
    )


def moving_average(
    daily: DataFrame,
    n: int,
    cols: Sequence[str] = ("entries", "exits"),
    order: str = "date",
    partition: Sequence[str] = ("cohort",),
    suffix: str = "_ma",
) -> DataFrame:
    """WN4: trailing mean over ``n`` rows (not days); NULL until ``n`` rows exist.

    Input must already be reduced to one row per (partition, order) value:
    the window holds one partition per cohort.
    """
    n = max(int(n), 1)
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(-(n - 1), 0)
    full = F.count(F.lit(1)).over(w) == n
    return daily.select(
        "*", *[F.when(full, F.avg(c).over(w)).alias(c + suffix) for c in cols]
    )


def dow_profile(summary: DataFrame, label: str = "when") -> DataFrame:
    """AG8: per cohort and weekday: n days, mean daily entries/exits."""
    return summary.groupBy(F.col("cohort").alias(label), "dow").agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum("entries") / F.count(F.lit(1))).alias("entries"),
        (F.sum("exits") / F.count(F.lit(1))).alias("exits"),
    )


def tod_profile(tagged: DataFrame, label: str = "when") -> DataFrame:
    """AG9: (date, hour) sums first, then the mean over days per hour bucket."""
    per_day = tagged.groupBy("cohort", "date", "hour").agg(
        F.sum("entries").alias("entries"), F.sum("exits").alias("exits")
    )
    return per_day.groupBy(F.col("cohort").alias(label), "hour").agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum("entries") / F.count(F.lit(1))).alias("entries"),
        (F.sum("exits") / F.count(F.lit(1))).alias("exits"),
    )


PANELS = ("kpi", "by_date", "by_dow", "by_tod", "by_station")


def all_panels(tagged: DataFrame) -> DataFrame:
    """AG5-AG10 in one aggregation: (panel, cohort, key, n, entries, exits), means over the ``n`` days behind a row.

    GROUPING SETS over the tagged rows, so the facts are read and shuffled once for all panels. A group keeps the set
    of its days (``by_station``: of its days and boroughs, as the daily table has one row for each), which
    the calendar bounds. ``key`` is the date, weekday, hour or station as text, NULL for ``kpi``.
    """
    keys = {"by_date": "date", "by_dow": "dow", "by_tod": "hour", "by_station": "station"}
    sets = [["cohort"]] + [["cohort", c] for c in keys.values()]
    grouped = tagged.groupingSets([[F.col(c) for c in s] for s in sets], "cohort", *keys.values()).agg(
        F.sum("entries").alias("_e"), F.sum("exits").alias("_x"),
        F.size(F.collect_set("date")).alias("_days"),
        F.size(F.collect_set(F.struct(F.col("date").alias("d"), F.col("boro").alias("b")))).alias("_rows"),
        *[F.grouping(c).alias(f"_{c}") for c in keys.values()],
    )
    panel, key = F.lit("kpi"), F.lit(None).cast("string")
    for name, c in keys.items():
        panel = F.when(F.col(f"_{c}") == 0, name).otherwise(panel)
        key = F.when(F.col(f"_{c}") == 0, F.col(c).cast("string")).otherwise(key)
    n = F.when(F.col("_station") == 0, F.col("_rows")).otherwise(F.col("_days")).cast("long")
    return grouped.select(
        panel.alias("panel"), "cohort", key.alias("key"), n.alias("n"), (F.col("_e") / n).alias("entries"), (F.col("_x") / n).alias("exits")
    )


def label_order(label: Column, order: Sequence[str]) -> Column:
    """SO2: rank of a label in a fixed display order (unknown labels last)."""
    rank = F.lit(len(order) + 1)
    for i, name in reversed(list(enumerate(order, start=1))):
        rank = F.when(label == name, F.lit(i)).otherwise(rank)
    return rank


def union_labelled(frames: dict[str, DataFrame], label: str = "when") -> DataFrame:
    """SE1: UNION (distinct) of frames, each tagged with its label."""
    out = None
    for name, df in frames.items():
        tagged = df.select(F.lit(name).alias(label), "*")
        out = tagged if out is None else out.unionByName(tagged)
    return out.distinct()


def station_means(daily: DataFrame, cohorts: Sequence[str]) -> DataFrame:
    """AG10 for several cohorts in one aggregation (pivot on cohort).

    A station must have rows in every cohort (the reference inner-joins the
    per-cohort results); the pivot keeps it only if all counts are present.
    """
    piv = (
        daily.groupBy("station")
        .pivot("cohort", list(cohorts))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("entries").alias("e"), F.sum("exits").alias("x"))
    )
    present = F.lit(True)
    cols = [F.col("station")]
    for c in cohorts:
        present = present & F.col(f"`{c}_n`").isNotNull()
        cols += [
            (F.col(f"`{c}_e`") / F.col(f"`{c}_n`")).alias(f"{c}_entries"),
            (F.col(f"`{c}_x`") / F.col(f"`{c}_n`")).alias(f"{c}_exits"),
        ]
    return piv.filter(present).select(*cols)


def station_compare(
    daily: DataFrame, stations: DataFrame, selected: str, pandemic: str, base: str
) -> DataFrame:
    """JN6 + PR15: station list joined (inner) to each cohort's daily mean per station.

    Joined on the display name, so stations sharing a name (the unmapped
    '- ()') each receive the shared aggregate, as in the reference.
    """
    means = station_means(daily, [selected, pandemic, base])
    m = means.select(
        F.col("station").alias("_name"),
        F.col(f"`{selected}_entries`").alias("entries_selection"),
        F.col(f"`{selected}_exits`").alias("exits_selection"),
        F.col(f"`{pandemic}_entries`").alias("entries_pandemic"),
        F.col(f"`{pandemic}_exits`").alias("exits_pandemic"),
        F.col(f"`{base}_entries`").alias("entries_2019"),
        F.col(f"`{base}_exits`").alias("exits_2019"),
    )
    joined = stations.select("station", "pretty_name", "latitude", "longitude").join(
        m, F.col("pretty_name") == F.col("_name"), "inner"
    )
    return joined.select(
        "station",
        "pretty_name",
        "latitude",
        "longitude",
        "entries_selection",
        "exits_selection",
        "entries_pandemic",
        "exits_pandemic",
        "entries_2019",
        "exits_2019",
        pct_change("entries_selection", "entries_2019").alias("pct_v_2019"),
        pct_change("entries_selection", "entries_pandemic").alias("pct_v_pandemic"),
    )


def station_page(
    compare: DataFrame,
    page: int = 0,
    page_size: int = 15,
    sort_by: str = "entries_selection",
    descending: bool = True,
    name_filter: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """SO7: one sorted page of the station table with display formatting.

    The page is the feature (offset/limit on a sorted result, planned as a
    top-k); ties are broken by name and key for a stable page. ``where`` filters on any
    column of ``compare``. Entries are shown without decimals or separators.
    """
    df = compare if where is None else compare.filter(where)
    if name_filter:
        df = df.filter(F.col("pretty_name").contains(name_filter))
    key = F.col(sort_by).desc_nulls_last() if descending else F.col(sort_by).asc_nulls_last()
    ordered = df.orderBy(key, F.col("pretty_name").asc(), F.col("station").asc())
    return ordered.offset(page * page_size).limit(page_size).select(
        F.col("pretty_name").alias("station"),
        F.round("entries_selection", 0).cast("long").cast("string").alias("entries"),
        format_percent("pct_v_2019").alias("pct_v_2019"),
        format_percent("pct_v_pandemic").alias("pct_v_pandemic"),
    )
