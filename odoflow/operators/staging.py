"""Staging: typed timestamp, turnstile and station keys, exclusions, relabels, dedup.

Canonical form (``stage``) is the dbt model; ``stage_v1`` is the script /
notebook form, ``stage_pandas`` the pandas-notebook form.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoflow.functions.columns import concat_skip_nulls, sorted_letters
from odoflow.operators.labels import left_lookup, lookup, relabel
from odoflow.params import StagingRules

STAGED_COLUMNS = ["date_time", "turnstile", "station", "entry_counter", "exit_counter"]

# Division codes that get no suffix in the script variant / the pandas variant.
V1_PLAIN_DIVISIONS = ("RIT", "BMT", "IRT", "IND")
PANDAS_PLAIN_DIVISIONS = ("BMT", "IRT", "IND")


def reading_time(date_col: str = "DATE", time_col: str = "TIME") -> Column:
    """TIMESTAMP_NTZ from a DATE and an 'HH:mm:ss' string; fractions of a second are dropped."""
    parts = F.split(F.col(time_col), ":")
    d = F.col(date_col)
    return F.make_timestamp_ntz(
        F.year(d), F.month(d), F.dayofmonth(d),
        parts.getItem(0).cast("int"), parts.getItem(1).cast("int"),
        F.floor(parts.getItem(2).cast("double")).cast("int"),
    )


def turnstile_key() -> Column:
    return concat_skip_nulls(F.col("C/A"), F.lit(" "), F.col("UNIT"), F.lit(" "), F.col("SCP"))


def station_line_key() -> Column:
    return concat_skip_nulls(F.col("STATION"), F.lit("-"), F.col("LINENAME"))


def _row_filters(raw: DataFrame, rules: StagingRules) -> DataFrame:
    cond = F.col("DATE") >= F.lit(rules.start_date)
    if rules.exclude_divisions:
        cond = cond & ~F.col("DIVISION").isin(*rules.exclude_divisions)
    if rules.exclude_stations:
        cond = cond & ~F.col("STATION").isin(*rules.exclude_stations)
    if rules.drop_audit:
        cond = cond & (F.col("DESC") != F.lit(rules.audit_label))
    return raw.filter(cond)


def stage(
    raw: DataFrame,
    station_labels: DataFrame | Mapping[str, str] | None = None,
    division_labels: DataFrame | Mapping[str, str] | None = None,
    rules: StagingRules = StagingRules(),
) -> DataFrame:
    """Canonical staging (one shuffle: the DISTINCT, with map-side pre-dedup).

    station = COALESCE(label[STATION-LINENAME], STATION-LINENAME) || COALESCE(suffix[DIVISION], '').
    Labels are either Python mappings (literal maps) or DataFrames with columns
    (station_src, station_dest) / (division_src, division_dest).
    """
    df = _row_filters(raw, rules).withColumn("_sl", station_line_key())
    if isinstance(station_labels, DataFrame):
        df = left_lookup(df, station_labels, F.col("_sl"), "station_src", "station_dest", "_sdest")
    else:
        df = df.withColumn("_sdest", lookup(F.col("_sl"), station_labels or {}))
    if isinstance(division_labels, DataFrame):
        df = left_lookup(df, division_labels, F.col("DIVISION"), "division_src", "division_dest", "_ddest")
    else:
        df = df.withColumn("_ddest", lookup(F.col("DIVISION"), division_labels or {}))
    staged = df.select(
        reading_time().alias("date_time"),
        turnstile_key().alias("turnstile"),
        concat_skip_nulls(F.coalesce(F.col("_sdest"), F.col("_sl")), F.coalesce(F.col("_ddest"), F.lit(""))).alias(
            "station"
        ),
        F.col("ENTRY_COUNTER").alias("entry_counter"),
        F.col("EXIT_COUNTER").alias("exit_counter"),
    )
    return staged.distinct()


def stage_v1(
    raw: DataFrame,
    station_fixes: Mapping[str, str] | None = None,
    dedup: str = "derived",
    division_suffix: bool = True,
    audit_label: str = "RECOVR AUD",
    keep_null_desc: bool | None = None,
) -> DataFrame:
    """Script/notebook staging: drop audits, dedup, suffix non-core divisions, relabel.

    dedup='derived' de-duplicates the 7 derived columns (script); 'raw' all raw
    columns (notebook). The relabel is applied after the dedup, once.
    keep_null_desc: rows without a DESC stay (notebook, which deletes the audits)
    or go (script, which keeps the rows that differ from the label); None: as the
    variant named by ``dedup`` does.
    """
    if keep_null_desc is None:
        keep_null_desc = dedup == "raw"
    is_audit = F.col("DESC").eqNullSafe(F.lit(audit_label))
    base = raw.filter(~is_audit if keep_null_desc else F.col("DESC") != F.lit(audit_label))
    if dedup == "raw":
        base = base.distinct()
    df = base.select(
        turnstile_key().alias("turnstile"),
        station_line_key().alias("station"),
        F.col("DIVISION").alias("division"),
        F.col("DATE").alias("date"),
        reading_time().alias("date_time"),
        F.col("ENTRY_COUNTER").alias("entry_counter"),
        F.col("EXIT_COUNTER").alias("exit_counter"),
    )
    if dedup == "derived":
        df = df.distinct()
    station = F.col("station")
    if division_suffix:
        plain = F.col("division").isin(*V1_PLAIN_DIVISIONS)
        station = F.when(~plain, concat_skip_nulls(station, F.lit("-"), F.col("division"))).otherwise(station)
    return df.withColumn("station", relabel(station, station_fixes or {})).drop("division")


def stage_pandas(raw: DataFrame, audit_label: str = "RECOVR AUD") -> DataFrame:
    """pandas-notebook staging: full-row dedup, audits dropped, line letters sorted.

    station = STATION-sorted(LINENAME) plus -DIVISION unless BMT/IRT/IND
    (NULL-propagating '+' concatenation, as in pandas).
    """
    df = raw.dropDuplicates().filter(~F.col("DESC").eqNullSafe(F.lit(audit_label)))  # a missing DESC differs, as in pandas
    stationline = F.concat(F.col("STATION"), F.lit("-"), sorted_letters("LINENAME"))
    # a NULL division fails isin() and gets the (NULL) suffix, as pandas does
    stationline = F.when(F.col("DIVISION").isin(*PANDAS_PLAIN_DIVISIONS), stationline).otherwise(
        F.concat(stationline, F.lit("-"), F.col("DIVISION"))
    )
    return df.select(
        reading_time().alias("date_time"),
        stationline.alias("station"),
        turnstile_key().alias("turnstile"),
        F.col("ENTRY_COUNTER").alias("entry_counter"),
        F.col("EXIT_COUNTER").alias("exit_counter"),
    )
