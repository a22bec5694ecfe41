"""IO17: expected weekly files and which of them have not landed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def expected_saturdays(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per Saturday in [start, end] (the weekly publication days).

    A calendar is bounded by its two dates (52 rows a year), generated on the
    executors with ``sequence`` + ``explode``.
    """
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("day")
    )
    return days.filter(F.weekday("day") == 5).select(F.col("day").alias("file_date"))


def landed_weeks_from_names(files: DataFrame, name_col: str = "source_file", pattern: str = r"(\d{6})\.txt$") -> DataFrame:
    """File dates of landed files, from names like ``turnstile_240106.txt``."""
    code = F.regexp_extract(F.col(name_col), pattern, 1)
    return files.select(F.to_date(code, "yyMMdd").alias("file_date")).filter(F.col("file_date").isNotNull()).distinct()


def missing_files(expected: DataFrame, landed: DataFrame, prefix: str = "", suffix: str = ".txt") -> DataFrame:
    """Expected file dates with no landed file (left anti join), with the file name."""
    gone = expected.join(landed, on="file_date", how="left_anti")
    return gone.select(
        "file_date",
        F.concat(F.lit(prefix), F.date_format("file_date", "yyMMdd"), F.lit(suffix)).alias("file_name"),
    )
