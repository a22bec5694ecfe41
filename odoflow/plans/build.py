"""The weekly batch build (the model graph, in order), materialized as Parquet.

staging -> diff -> {entry stats, exit stats, station list} -> hourly facts.
Each model is written to the shared folder (``spark.checkpoint.dir`` or an
explicit root) and read back before the next model uses it: later stages read
only the columns they need, and a lost executor costs a re-read, not a
recomputation of the chain. Data-quality tests run on the written tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from odoflow.operators import quality as dq
from odoflow.operators.cutoff import series_stats
from odoflow.operators.diff import difference
from odoflow.operators.hourly import HOURLY_COLUMNS, hourly_clean
from odoflow.operators.staging import stage
from odoflow.operators.stations import station_list
from odoflow.params import DBT_CUTOFF, DBT_DIFF, CutoffRule, DiffPolicy, StagingRules
from odoflow.sources.files import scratch_path


def _write(
    df: DataFrame, path: str, partition_by: list[str] | None = None, counts: dict[str, Observation] | None = None
) -> DataFrame:
    if counts is not None:
        # DQ6 without an extra pass: the row count is a metric of the write itself
        name = path.rstrip("/").rsplit("/", 1)[-1]
        counts[name] = Observation(name)
        df = df.observe(counts[name], F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def build_models(
    spark: SparkSession,
    raw: DataFrame,
    station_map: DataFrame,
    borough_map: DataFrame,
    station_labels: DataFrame | Mapping[str, str] | None = None,
    division_labels: DataFrame | Mapping[str, str] | None = None,
    rules: StagingRules = StagingRules(),
    policy: DiffPolicy = DBT_DIFF,
    cutoff: CutoffRule = DBT_CUTOFF,
    start_date: date | None = None,
    root: str | None = None,
    chunk_days: int = 7,
    row_counts: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Run the build; return the materialized models (read back from Parquet).

    Pass a dict as ``row_counts`` to receive the rows written per model
    (collected as observed metrics of the writes).
    """
    root = (root or scratch_path(spark, "models")).rstrip("/")
    start = start_date or rules.start_date
    obs: dict[str, Observation] | None = {} if row_counts is not None else None
    staging = _write(stage(raw, station_labels, division_labels, rules), f"{root}/mta_staging", counts=obs)
    diff = _write(difference(staging, policy, chunk_days=chunk_days), f"{root}/mta_diff", counts=obs)
    entry_avg = _write(series_stats(diff, "entries", cutoff), f"{root}/entry_avg", counts=obs)
    exit_avg = _write(series_stats(diff, "exits", cutoff), f"{root}/exit_avg", counts=obs)
    stations = _write(station_list(diff, station_map, borough_map), f"{root}/station_list", counts=obs)
    # one folder per day: cohort date ranges become partition filters (directory pruning).
    # A day holds at most stations x 8 buckets rows, so repartition("date") is bounded.
    hourly = hourly_clean(diff, stations=stations, start_date=start)
    clean = _write(hourly.repartition("date"), f"{root}/mta_clean", ["date"], counts=obs).select(*HOURLY_COLUMNS)
    if obs is not None:
        row_counts.update({name: o.get["rows"] for name, o in obs.items()})
    return {
        "mta_staging": staging,
        "mta_diff": diff,
        "entry_avg": entry_avg,
        "exit_avg": exit_avg,
        "station_list": stations,
        "mta_clean": clean,
    }


def model_tests(models: Mapping[str, DataFrame]) -> DataFrame:
    """The declared column tests (not_null on clean station; unique + not_null
    on the station list key): one report row per test, ``failures`` = 0 passes."""
    nulls = dq.null_counts({"mta_clean": (models["mta_clean"], ["station"])})
    uniq = dq.unique_check(models["station_list"], "station")
    return nulls.select(
        F.concat(F.lit("not_null:"), "table_name", F.lit("."), "column_name").alias("test"), F.col("null_count").alias("failures")
    ).unionByName(
        uniq.select(F.lit("unique:station_list.station").alias("test"), (F.col("duplicates") + F.col("nulls")).alias("failures"))
    )
