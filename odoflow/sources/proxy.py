"""Proxy inputs derived from the driver's tables (see FIXTURES.md, part B).

The driver ships TPC-H-like tables, not turnstile files, so the readings are
derived from ``events`` (user -> turnstile, nation -> station, region ->
division / borough, running sums -> odometers with roll-over, 10 % of the
events repeated as duplicate readings, ``error`` events as recovered audits).
Everything is a lazy DataFrame over the parquet scans: its work grows with
the tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odoflow.operators.series import series_running_sum
from odoflow.params import CohortSpec
from odoflow.schemas import RAW_CSV_SCHEMA


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table, listed anew at each call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str, chunk_days: int = 7) -> DataFrame:
    """Odometer readings, one row per (possibly repeated) event.

    Columns: event_id, user_id, event_type, ts, ca, unit, scp, station,
    linename, division, entry_counter, exit_counter.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value", "props")
    # nation is a fixed 25-row dimension (TPC-H): a proven size bound for broadcast.
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    base = ev.join(F.broadcast(na), F.col("n_nationkey") == F.col("user_id") % 25).select(
        "event_id",
        "user_id",
        "event_type",
        "ts",
        "n_name",
        "n_regionkey",
        F.floor(F.col("value") * 40).cast("long").alias("entry_step"),
        (F.get_json_object("props", "$.k").cast("long") * 12).alias("exit_step"),
    )
    odo = series_running_sum(
        base, keys=["user_id"], order=["ts", "event_id"], cols=["entry_step", "exit_step"],
        prefix="cum_", chunk_days=chunk_days,
    )
    rows = odo.select(
        "event_id",
        "user_id",
        "event_type",
        "ts",
        F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("ca"),
        F.concat(F.lit("R"), (F.col("user_id") % 25).cast("string")).alias("unit"),
        F.concat(
            F.lit("00-0"),
            F.when(F.col("event_id") % 50 == 0, F.lit(9)).otherwise(F.col("user_id") % 4).cast("string"),
        ).alias("scp"),
        F.col("n_name").alias("station"),
        F.concat(F.lit("L"), (F.col("user_id") % 3).cast("string")).alias("linename"),
        F.when(F.col("n_regionkey") == 0, "SRT")
        .when(F.col("n_regionkey") == 1, "PTH")
        .otherwise("IND")
        .alias("division"),
        (F.col("cum_entry_step") % 60000).cast("int").alias("entry_counter"),
        (F.col("cum_exit_step") % 30000).cast("int").alias("exit_counter"),
        # every tenth event is delivered twice (a duplicate reading)
        F.explode(
            F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ).alias("_copy"),
    )
    return rows.drop("_copy")


def raw_from_readings(readings_df: DataFrame) -> DataFrame:
    """Map proxy readings onto the raw reading-file schema (``RAW_COLUMNS``)."""
    return readings_df.select(
        F.col("ca").alias("C/A"),
        F.col("unit").alias("UNIT"),
        F.col("scp").alias("SCP"),
        F.col("station").alias("STATION"),
        F.col("linename").alias("LINENAME"),
        F.col("division").alias("DIVISION"),
        F.to_date("ts").alias("DATE"),
        F.date_format("ts", "HH:mm:ss").alias("TIME"),
        F.when(F.col("event_type") == "error", F.lit("RECOVR AUD")).otherwise(F.lit("REGULAR")).alias("DESC"),
        F.col("entry_counter").alias("ENTRY_COUNTER"),
        F.col("exit_counter").alias("EXIT_COUNTER"),
    )


def reading_lines(raw_df: DataFrame, damage: bool = False) -> DataFrame:
    """(week, line): raw readings as text of the weekly files, without headers.

    With ``damage``, every reading whose entry counter divides by 41 arrives broken, in one of four ways: cut after the
    fifth field, an impossible date, an impossible time, a counter beyond 32 bits.
    """
    way = F.when(F.lit(damage) & (F.col("ENTRY_COUNTER") % 41 == 0), F.floor(F.col("EXIT_COUNTER") / 12) % 4)
    head = [F.col(c) for c in ("`C/A`", "UNIT", "SCP", "STATION", "LINENAME")]
    day = F.when(way == 1, "13/45/2024").otherwise(F.date_format("DATE", "MM/dd/yyyy"))
    time = F.when(way == 2, "25:61:00").otherwise(F.col("TIME"))
    entry = F.when(way == 3, "99999999999").otherwise(F.col("ENTRY_COUNTER").cast("string"))
    whole = F.concat_ws(",", *head, "DIVISION", day, time, "DESC", entry, F.col("EXIT_COUNTER").cast("string"))
    week = F.date_format(F.next_day("DATE", "Sat"), "yyMMdd")
    return raw_df.select(week.alias("week"), F.when(way == 0, F.concat_ws(",", *head)).otherwise(whole).alias("line"))


def header_lines(lines: DataFrame) -> DataFrame:
    """One header line per week, with the padding that the published files have."""
    titles = F.rpad(F.lit(",".join(f.name for f in RAW_CSV_SCHEMA)), 140, " ")
    return lines.select("week").distinct().select("week", titles.alias("line"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_readings(readings(spark, sf_dir))


def station_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension: three lines per nation, two nations left unmapped."""
    na = table(spark, sf_dir, "nation")
    lines = na.select("n_nationkey", "n_name", "n_regionkey", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("l"))
    return lines.filter(~F.col("n_nationkey").isin(12, 13)).select(
        F.concat(F.col("n_name"), F.lit("-L"), F.col("l").cast("string")).alias("station"),
        F.when(F.col("n_nationkey").isin(7, 14), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("STOP "), F.col("n_nationkey").cast("string")))
        .alias("stop_name"),
        F.concat(F.lit("L"), F.col("l").cast("string")).alias("daytime_routes"),
        F.col("n_regionkey").cast("string").alias("borough"),
        (F.lit(40.0) + F.col("n_nationkey") / 100.0).cast("double").alias("latitude"),
        (F.lit(-74.0) + F.col("n_nationkey") / 100.0).cast("double").alias("longitude"),
        F.when(F.col("n_nationkey") % 2 == 0, "Y").otherwise("N").alias("cbd"),
    )


def borough_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Borough dimension from ``region``: ASIA plays the borough split by cbd."""
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("borough"),
        F.when(F.col("r_name") == "ASIA", "Manhattan")
        .when(F.col("r_name") == "EUROPE", "Brooklyn")
        .when(F.col("r_name") == "MIDDLE EAST", "Queens")
        .otherwise(F.col("r_name"))
        .alias("borough_desc"),
    )


# Fixed values of the proxy (FIXTURES.md B): relabel seeds, exclusions, cohorts.
PROXY_STATION_LABELS: list[tuple[str, str]] = [
    ("NATION_7-L1", "NATION_8-L0"),
    ("NATION_2-L0", "NATION_3-L0"),
]
PROXY_DIVISION_LABELS: list[tuple[str, str]] = [("PTH", "-PATH"), ("SRT", "-SIR")]
PROXY_EXCLUDED_STATIONS: tuple[str, ...] = ("NATION_4", "NATION_9")
PROXY_START = date(2024, 1, 1)
# Central-area stations of the proxy (plays the role of the fixed CBD list).
PROXY_CENTRAL_STATIONS: tuple[str, ...] = (
    "NATION_2-L1", "NATION_2-L2", "NATION_3-L0", "NATION_8-L0", "NATION_8-L2",
    "NATION_14-L0", "NATION_14-L1", "NATION_22-L0", "NATION_22-L2", "NATION_24-L1",
)

# The same role under the names of the pandas staging (sorted line letters, division suffix).
PROXY_PANDAS_CENTRAL: tuple[str, ...] = (
    "NATION_0-2L-SRT", "NATION_1-1L-PTH", "NATION_2-1L", "NATION_2-2L", "NATION_3-0L",
    "NATION_8-0L", "NATION_8-2L", "NATION_14-0L", "NATION_14-1L", "NATION_22-0L",
)


PROXY_COHORTS: tuple[CohortSpec, ...] = (
    CohortSpec("2019", date(2024, 1, 1), date(2024, 1, 8)),
    CohortSpec("Pandemic", date(2024, 1, 8), date(2024, 1, 16)),
    CohortSpec("Selected", date(2024, 1, 12), date(2024, 2, 1)),
)
