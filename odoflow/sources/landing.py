"""The landing zone: bad lines kept apart, and which deliveries are new, changed or missing.

A *delivery* is the text that ``pattern`` captures in a file's path, the week of
``turnstile_240106.txt`` or of a folder ``week=240106`` of part files. Everything is kept per delivery.

Defined cases: blank lines are counted and skipped; a header is known by its first column names, so it may
stand anywhere (files pasted together) or be absent; a line that does not fit is a reject with a reason, never
an error or a row of NULLs; a path that the pattern does not match belongs to the delivery ''.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odoflow.schemas import RAW_COLUMNS, RAW_CSV_SCHEMA

FILE_NAME = r"(\d{6})\.txt$"
WEEK_FOLDER = r"week=(\d{6})"
KINDS = ("row", "reject", "header", "blank")
_FIELDS = len(RAW_CSV_SCHEMA)
_HEADER = r"(?i)^\s*c/a\s*,\s*unit\s*,\s*scp\s*,"
_TIME = r"^([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d(\.\d+)?$"
_DATE = "MM/dd/yyyy"


def _delivery(path: Column, pattern: str) -> Column:
    return F.regexp_extract(path, pattern, 1).alias("delivery")


def read_lines(spark: SparkSession, paths: str | Sequence[str], pattern: str = FILE_NAME, glob: str = "*.txt") -> DataFrame:
    """(delivery, file, line) of every text line, as it stands in the files."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(paths)
    path = F.col("_metadata.file_path")
    return text.select(_delivery(path, pattern), path.alias("file"), F.col("value").alias("line"))


def classify(lines: DataFrame) -> DataFrame:
    """Each line with its ``kind`` (row, reject, header, blank), the ``reason`` of a reject and the typed fields.

    The line is split by Spark's CSV parser into text fields; each is then cast on its own, so the reason names the
    first check that failed: fields (their number), date, time, counter (not an integer of 32 bits).
    """
    as_text = ", ".join(f"`{f.name}` string" for f in RAW_CSV_SCHEMA)
    parsed = F.from_csv("line", F.lit(f"{as_text}, _bad string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    df = lines.withColumn("_p", parsed)
    field = {f.name: F.trim(F.col(f"_p.`{f.name}`")) for f in RAW_CSV_SCHEMA}
    typed = {name: F.try_to_timestamp(x, F.lit(_DATE)).cast("date") if name == "DATE" else x for name, x in field.items()}
    typed |= {name: x.try_cast("int") for name, x in field.items() if name in ("ENTRIES", "EXITS")}
    bad = (
        F.when(F.col("_p._bad").isNotNull(), "fields")
        .when(typed["DATE"].isNull(), "date")
        .when(~F.coalesce(field["TIME"].rlike(_TIME), F.lit(False)), "time")
        .when(typed["ENTRIES"].isNull() | typed["EXITS"].isNull(), "counter")
    )
    kind = (
        F.when(F.trim("line") == "", "blank").when(F.col("line").rlike(_HEADER), "header").when(bad.isNotNull(), "reject").otherwise("row")
    )
    df = df.select("delivery", "file", "line", kind.alias("kind"), bad.alias("_bad"), *[x.alias(n) for (_, x), n in zip(typed.items(), RAW_COLUMNS)])
    ok = F.col("kind") == "row"
    return df.select(
        "delivery", "file", "kind",
        F.when(F.col("kind") == "reject", F.col("_bad")).alias("reason"),
        F.when(~ok, F.col("line")).alias("line"),
        *[F.when(ok, F.col(f"`{c}`")).alias(c) for c in RAW_COLUMNS],
    )


class LoadedLines:
    """One load: every line of the files parsed once and written once, a folder per kind below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def load(cls, lines: DataFrame, path: str, mode: str = "append") -> LoadedLines:
        classify(lines).write.mode(mode).partitionBy("kind").parquet(path)
        return cls(lines.sparkSession, path)

    def _all(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def rows(self) -> DataFrame:
        """The readings, in the schema of ``read_reading_files`` without the file name."""
        return self._all().where("kind = 'row'").select(*[f"`{c}`" for c in RAW_COLUMNS])

    def rejects(self) -> DataFrame:
        """The quarantine: (delivery, file, reason, line)."""
        return self._all().where("kind = 'reject'").select("delivery", "file", "reason", "line")

    def reconcile(self, lines: DataFrame) -> DataFrame:
        """Per delivery: text lines, counted anew in the files, against what was written of each kind. ``difference`` is 0
        where nothing was lost or loaded twice."""
        counted = lines.groupBy("delivery").agg(F.count(F.lit(1)).alias("lines"))
        written = self._all().groupBy("delivery").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in KINDS])
        both = counted.join(written, "delivery", "full")
        n = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("lines", *KINDS)}
        names = {"row": "rows", "reject": "rejects", "header": "headers", "blank": "blanks"}
        return both.select(
            "delivery", n["lines"].alias("lines"), *[n[k].alias(names[k]) for k in KINDS],
            reduce(lambda a, k: a - n[k], KINDS, n["lines"]).alias("difference"),
        )


class LandingManifest:
    """What each run found in the landing folder, one Parquet folder per run below ``path``.

    A run lists the files (names, sizes, times; no content), and reads only those deliveries whose listing differs from the last
    run's. Their content is summed up per delivery as the number of lines and the sum of the lines' 64-bit
    hashes, so it does not depend on the order of lines or on how they are dealt out to files.
    """

    STATE = "delivery string, files bigint, bytes bigint, modified timestamp, lines bigint, digest decimal(38,0)"

    def __init__(self, spark: SparkSession, path: str, pattern: str = FILE_NAME, glob: str = "*.txt"):
        self.spark, self.path, self.pattern, self.glob = spark, path.rstrip("/"), pattern, glob

    def _files(self, landing: str) -> DataFrame:
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", self.glob).load(landing)
        return listed.select(_delivery(F.col("path"), self.pattern), "path", "length", "modificationTime")

    def _state(self, run: int) -> DataFrame:
        if run == 0:
            return self.spark.createDataFrame([], self.STATE)
        return self.spark.read.schema(self.STATE).parquet(f"{self.path}/run={run:09d}")

    def last_run(self) -> int:
        """Number of the last whole run, 0 before the first. A run that was cut off left no ``_SUCCESS`` and does not count."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/run=*/_SUCCESS")
        found = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(hadoop) or []
        return max((int(f.getPath().getParent().getName().split("=")[1]) for f in found), default=0)

    def record(self, landing: str) -> int:
        """Look at the folder and write what is there now; the number of the run."""
        run = self.last_run()
        old = self._state(run)
        files = self._files(landing)
        now = files.groupBy("delivery").agg(
            F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified")
        )
        listing = ["delivery", "files", "bytes", "modified"]
        known = now.join(old, listing, "left_semi")
        # the paths to read: as many as a run's new files, and the listing above went through the driver already
        paths = [r.path for r in files.join(known, "delivery", "left_anti").select("path").toLocalIterator()]
        if paths:
            line = F.xxhash64("line").cast("decimal(38,0)")
            content = read_lines(self.spark, paths, self.pattern, self.glob).groupBy("delivery").agg(
                F.count(F.lit(1)).alias("lines"), F.sum(line).cast("decimal(38,0)").alias("digest")
            )
        else:
            content = self.spark.createDataFrame([], "delivery string, lines bigint, digest decimal(38,0)")
        kept = old.join(now, listing, "left_semi").select(*[c.split()[0] for c in self.STATE.split(", ")])
        fresh = now.join(known, "delivery", "left_anti").join(content, "delivery", "left").select(
            *listing, F.coalesce("lines", F.lit(0)).cast("long").alias("lines"), F.coalesce("digest", F.lit(0)).cast("decimal(38,0)").alias("digest")
        )
        kept.unionByName(fresh).write.mode("overwrite").parquet(f"{self.path}/run={run + 1:09d}")
        return run + 1

    def report(self, run: int | None = None, expected: DataFrame | None = None) -> DataFrame:
        """(delivery, status, rewritten, files, lines) of a run against the run before it.

        status: new, changed (other lines than before), same, gone (was there, is no more), and missing for the
        dates of ``expected`` (``file_date``) whose name yyMMdd neither run knows. ``rewritten``: same lines, other files.
        """
        run = self.last_run() if run is None else run
        now, old = self._state(run), self._state(max(run - 1, 0))
        was = old.select("delivery", *[F.col(c).alias(f"_{c}") for c in old.columns if c != "delivery"])
        both = now.join(was, "delivery", "full")
        same = (F.col("lines") == F.col("_lines")) & (F.col("digest") == F.col("_digest"))
        touched = ~((F.col("files") == F.col("_files")) & (F.col("bytes") == F.col("_bytes")) & (F.col("modified") == F.col("_modified")))
        status = F.when(F.col("_lines").isNull(), "new").when(F.col("lines").isNull(), "gone").when(same, "same").otherwise("changed")
        out = both.select(
            "delivery", status.alias("status"), F.coalesce(same & touched, F.lit(False)).alias("rewritten"),
            F.coalesce("files", F.lit(0)).cast("long").alias("files"), F.coalesce("lines", F.lit(0)).cast("long").alias("lines"),
        )
        if expected is None:
            return out
        weeks = expected.select(F.date_format("file_date", "yyMMdd").alias("delivery")).distinct()
        missing = weeks.join(both.select("delivery"), "delivery", "left_anti")
        none = F.lit(0).cast("long")
        return out.unionByName(
            missing.select("delivery", F.lit("missing").alias("status"), F.lit(False).alias("rewritten"), none.alias("files"), none.alias("lines"))
        )
