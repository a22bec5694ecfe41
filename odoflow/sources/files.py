"""File sources and sinks: weekly reading CSVs, Parquet tables, catalog DDL.

One distributed scan reads every weekly file (no per-file driver loop);
provenance comes from the ``_metadata`` column.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odoflow.schemas import RAW_COLUMNS, RAW_CSV_SCHEMA
from odoflow.session import checkpoint_root

CSV_DATE_FORMAT = "MM/dd/yyyy"


def read_reading_files(
    spark: SparkSession,
    path: str,
    glob: str = "*.txt",
    with_source: bool = True,
    recursive: bool = True,
) -> DataFrame:
    """IO1/IO2/IO4/IO7/PR8/PR9: typed scan of all weekly files below ``path``.

    Explicit schema (no inference), header row per file (blank-padded header
    names are tolerated because the schema is enforced by position),
    ``FAILFAST`` so an over-range counter raises instead of turning NULL.
    The counters are renamed positionally to ENTRY_COUNTER / EXIT_COUNTER.
    """
    reader = (
        spark.read.schema(RAW_CSV_SCHEMA)
        .option("header", True)
        .option("dateFormat", CSV_DATE_FORMAT)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", recursive)
    )
    df = reader.csv(path)
    cols = [F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, RAW_COLUMNS)]
    if with_source:
        cols.append(F.col("_metadata.file_name").alias("source_file"))
    return df.select(*cols)


def clean_header_names(df: DataFrame) -> DataFrame:
    """PR9: strip blanks around column names (files with padded headers, read with inference)."""
    return df.toDF(*[c.strip() for c in df.columns])


def with_reading_time(df: DataFrame, name: str = "date_time") -> DataFrame:
    """IO3: DATE + TIME fused into one TIMESTAMP_NTZ column while reading."""
    from odoflow.operators.staging import reading_time

    return df.withColumn(name, reading_time())


def file_week(date_col: str = "DATE"):
    """Saturday that closes the week of a reading date (the weekly file's date)."""
    return F.next_day(F.col(date_col), "Sat")


def write_reading_files(raw: DataFrame, path: str, mode: str = "overwrite", max_records_per_file: int = 5_000_000) -> str:
    """Write raw readings as weekly CSV files (one folder per week, header in each file).

    No repartition by week: a week holding a large share of the rows would
    land in one task. Each task writes its own files into the week folders it
    touches, each file capped at ``max_records_per_file`` rows.
    """
    out = raw.withColumn("week", F.date_format(file_week(), "yyMMdd"))
    (
        out.write.mode(mode)
        .partitionBy("week")
        .option("header", True)
        .option("dateFormat", CSV_DATE_FORMAT)
        .option("maxRecordsPerFile", max_records_per_file)
        .csv(path)
    )
    return path


def write_lines(lines: DataFrame, path: str) -> str:
    """Text lines (week, line) as they are, a folder per week. Weeks that ``lines`` holds are replaced, others stay."""
    lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week").text(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint root (never a machine-local temp dir)."""
    return f"{checkpoint_root(spark).rstrip('/')}/odoflow/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, spark: SparkSession, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """IO9/IO13: write a stage as Parquet in the shared folder and read it back.

    Cuts the lineage (an executor loss re-reads the files instead of
    recomputing the chain) and lets later stages prune columns and rows.
    """
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def save_table(df: DataFrame, name: str, database: str | None = None, mode: str = "overwrite") -> None:
    """IO5/IO6/IO9: CREATE SCHEMA IF NOT EXISTS + (re)create a managed table."""
    spark = df.sparkSession
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        name = f"`{database}`.`{name}`"
    df.write.mode(mode).saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """IO18: DROP TABLE IF EXISTS."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """IO18: ALTER TABLE ... RENAME TO."""
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def describe(df: DataFrame) -> DataFrame:
    """IO19: (col_name, data_type) of a frame, like DESCRIBE."""
    spark = df.sparkSession
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields], "col_name string, data_type string")


def load_report(df: DataFrame) -> DataFrame:
    """IO15: one row with the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("rows"))
