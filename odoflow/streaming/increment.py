"""Weekly increment: differences and cutoff statistics kept up to date without reading history again.

Readings arrive in any order: in order, late weeks, parts of a week, and files delivered twice.
A store keeps five Parquet tables below one folder, each partitioned by ``week`` (the Saturday
after a reading's day; readings without a time form a last week of their own, NO_TIME):

* ``staging``: the distinct readings. A run appends only rows that the weeks of its batch do not
  hold yet (anti-join against these weeks' partitions alone);
* ``body``: the signed differences of all readings but the first of each (series, week). Their
  predecessor stands in the same week, so another week's arrival never changes them;
* ``ends``: first and last reading of each (series, week), the state that crosses weeks;
* ``heads``: the difference of each first reading to the last one of the series' week before.
  A late week rewrites the heads of the weeks that follow it, one small row a series, no body;
* ``moments``: count, mean and sum of squared deviations (M2) of the positive differences of each
  (series, week). They merge by the pairwise formula, so a cutoff needs no reading again.

``update_hourly`` brings the station x day x 4-hour facts up to date, one folder a day: it rebuilds
the days of the changed weeks and the day before each (the midnight bucket counts for the previous
day) and leaves every other day's files alone.

Per run, the big tables are read and written for the batch's weeks only. ``ends`` is read whole:
one row a series and week. All writes overwrite whole week partitions from ``staging`` (dynamic
partition overwrite), so a run that failed half-way is repeated safely with the same batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odoflow.functions.columns import interval_hours, seconds_between
from odoflow.operators.cutoff import cutoff_value
from odoflow.operators.diff import apply_policy
from odoflow.operators.hourly import HOURLY_COLUMNS, hourly_from_buckets, reduce_to_buckets
from odoflow.operators.series import order_key, series_lag
from odoflow.params import DBT_CUTOFF, DBT_DIFF, CutoffRule, DiffPolicy

WEEK = "week"
NO_TIME = date(9999, 12, 25)
KEYS = ("station", "turnstile")
ORDER = ("date_time", "entry_counter", "exit_counter")
STAGED = ("date_time", "turnstile", "station", "entry_counter", "exit_counter")
RAW_DIFFS = (*STAGED, "entries_raw", "exits_raw", "seconds_diff", "hours_difference")


def week_of(ts: str = "date_time") -> Column:
    """The Saturday after the day of ``ts``; NO_TIME for NULL. Increases with the time."""
    return F.coalesce(F.next_day(F.to_date(ts), "Sat"), F.lit(NO_TIME))


def _differences() -> list[Column]:
    """Signed differences of a row to the reading in its ``prev_`` columns, in the shape of ``with_raw_diffs``."""
    return [
        (F.col("entry_counter") - F.col("prev_entry_counter")).alias("entries_raw"),
        (F.col("exit_counter") - F.col("prev_exit_counter")).alias("exits_raw"),
        seconds_between(F.col("prev_date_time"), F.col("date_time")).alias("seconds_diff"),
        interval_hours(F.col("prev_date_time"), F.col("date_time")).alias("hours_difference"),
    ]


def merge_moments(parts: Column) -> Column:
    """(n, mean, m2) of an array of (week, n, mean, m2), merged pairwise: no difference of large sums."""

    def merge(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        step = b["mean"] - a["mean"]
        share = b["n"] / F.when(n > 0, n).otherwise(F.lit(1))
        return F.struct(
            n.alias("n"), (a["mean"] + step * share).alias("mean"), (a["m2"] + b["m2"] + step * step * a["n"] * share).alias("m2")
        )

    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.reduce(parts, zero, merge)


class WeeklyStore:
    """The tables below ``root`` (a shared folder) and the run that brings them up to date."""

    def __init__(self, spark: SparkSession, root: str, policy: DiffPolicy = DBT_DIFF, files_per_week: int = 4) -> None:
        self.spark, self.root, self.policy, self.files_per_week = spark, root.rstrip("/"), policy, files_per_week

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, schema: StructType | str, weeks: Sequence[date] | None = None) -> DataFrame:
        """A table of the store, empty before the first run; only the partitions of ``weeks`` where these are given."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(name))
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(self._path(name))
        return df if weeks is None else df.where(F.col(WEEK).isin(list(weeks)))

    def _overwrite(self, df: DataFrame, name: str) -> None:
        # A bounded number of files a week and run, whatever the number of tasks.
        dealt = df.repartition(WEEK, F.pmod(F.xxhash64(*KEYS), F.lit(self.files_per_week)))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(WEEK).parquet(self._path(name))

    _STAGING = "date_time timestamp_ntz, turnstile string, station string, entry_counter int, exit_counter int, week date"
    _DIFFS = (
        "date_time timestamp_ntz, turnstile string, station string, entry_counter int, exit_counter int, "
        "entries_raw int, exits_raw int, seconds_diff long, hours_difference long, week date"
    )
    _ENDS = "station string, turnstile string, " + "".join(
        f"{e}_date_time timestamp_ntz, {e}_entry_counter int, {e}_exit_counter int, " for e in ("first", "last")
    ) + "week date"
    _MOMENTS = "station string, turnstile string, " + "".join(f"{v}_n long, {v}_mean double, {v}_m2 double, " for v in ("entries", "exits")) + "week date"

    # ---- one run

    def add(self, staged: DataFrame) -> list[date]:
        """Take the readings of one batch (STAGED columns); returns the weeks whose differences changed."""
        fresh = staged.select(*STAGED, week_of().alias(WEEK))
        weeks = sorted(r[0] for r in fresh.select(WEEK).distinct().collect())  # bounded by the calendar
        if not weeks:
            return []
        self._append(fresh, weeks)
        rows = self.read("staging", self._STAGING, weeks)
        self._write_body(rows)
        self._write_ends(rows)
        touched = self._write_heads(weeks)
        self._write_moments(touched)
        return touched

    def unseen(self, fresh: DataFrame, weeks: Sequence[date]) -> DataFrame:
        """The distinct rows of ``fresh`` that staging does not hold; reads the partitions of ``weeks`` only."""
        known = self.read("staging", self._STAGING, weeks).select(*[F.col(c).alias("known_" + c) for c in (*STAGED, WEEK)])
        same = F.col(WEEK) == F.col("known_" + WEEK)
        for c in STAGED:
            same = same & F.col(c).eqNullSafe(F.col("known_" + c))
        return fresh.distinct().join(known, same, "left_anti")

    def _append(self, fresh: DataFrame, weeks: Sequence[date]) -> None:
        dealt = self.unseen(fresh, weeks).repartition(WEEK, F.pmod(F.xxhash64(*KEYS), F.lit(self.files_per_week)))
        dealt.write.mode("append").partitionBy(WEEK).parquet(self._path("staging"))

    def _write_body(self, rows: DataFrame) -> None:
        lagged = series_lag(rows.withColumn("_one", F.lit(1)), [*KEYS, WEEK], list(ORDER), [*ORDER, "_one"])
        self._overwrite(lagged.where("prev__one is not null").select(*STAGED, *_differences(), WEEK), "body")

    def _write_ends(self, rows: DataFrame) -> None:
        key = order_key(ORDER, dict(rows.dtypes))
        ends = [pick(c, key).alias(f"{e}_{c}") for e, pick in (("first", F.min_by), ("last", F.max_by)) for c in ORDER]
        self._overwrite(rows.groupBy(*KEYS, WEEK).agg(*ends), "ends")

    def _write_heads(self, weeks: Sequence[date]) -> list[date]:
        before = Window.partitionBy(*KEYS).orderBy(WEEK)  # a series has one row a week: bounded by the calendar
        ends = self.read("ends", self._ENDS).withColumn("prev_week", F.lag(WEEK).over(before))
        ends = ends.select("*", *[F.lag("last_" + c).over(before).alias("prev_" + c) for c in ORDER])
        changed = ends.where(F.col(WEEK).isin(list(weeks)) | F.col("prev_week").isin(list(weeks)))
        touched = sorted(r[0] for r in changed.select(WEEK).distinct().collect())
        heads = ends.where(F.col(WEEK).isin(touched)).select(*KEYS, WEEK, *[F.col("first_" + c).alias(c) for c in ORDER], *["prev_" + c for c in ORDER])
        self._overwrite(heads.select(*STAGED, *_differences(), WEEK), "heads")
        return touched

    def _write_moments(self, weeks: Sequence[date]) -> None:
        diff = apply_policy(self.raw_diffs(weeks), self.policy).withColumn(WEEK, week_of())
        aggs = []
        for v in ("entries", "exits"):
            pos = F.when(F.col(v) > 0, F.col(v))
            aggs += [F.count(pos).alias(f"{v}_n"), F.avg(pos).alias(f"{v}_mean"), (F.var_pop(pos) * F.count(pos)).alias(f"{v}_m2")]
        # A row for every (series, week), so that no stale partition stays when a week has no difference left.
        none = [F.lit(None).cast("int").alias(v) for v in ("entries", "exits")]
        keys = self.read("ends", self._ENDS, weeks).select(*KEYS, WEEK, *none)
        rows = diff.select(*KEYS, WEEK, "entries", "exits").unionByName(keys)
        self._overwrite(rows.groupBy(*KEYS, WEEK).agg(*aggs).fillna(0), "moments")

    def update_hourly(self, weeks: Sequence[date], station_map: DataFrame, borough_map: DataFrame, start_date: date) -> list[date]:
        """Rebuild the facts of the days that the changed ``weeks`` (as ``add`` returns them) can alter; returns those days."""
        timed = [w for w in weeks if w != NO_TIME]
        days = sorted({w - timedelta(days=k) for w in timed for k in range(1, 9)})  # seven days of the week, and the one before
        if not days:
            return []
        around = sorted({w + timedelta(days=k) for w in timed for k in (-7, 0, 7)})
        diff = apply_policy(self.raw_diffs(around), self.policy)
        facts = hourly_from_buckets(reduce_to_buckets(diff), station_map=station_map, borough_map=borough_map, start_date=start_date)
        facts = facts.where(F.col("date").isin(days))
        facts.repartition("date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(self._path("hourly"))
        left = {r[0] for r in facts.select("date").distinct().collect()}  # at most eight days a changed week
        for day in days:
            if day not in left:  # no fact is left on this day: its folder, if any, goes
                path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._path('hourly')}/date={day}")
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return days

    # ---- results

    def hourly(self) -> DataFrame:
        return self.read("hourly", "hour int, station string, boro int, entries int, exits int, date date").select(*HOURLY_COLUMNS)

    def staging(self) -> DataFrame:
        return self.read("staging", self._STAGING).select(*STAGED)

    def raw_diffs(self, weeks: Sequence[date] | None = None) -> DataFrame:
        """As ``with_raw_diffs`` over all readings so far, or of ``weeks`` alone."""
        parts = [self.read(n, self._DIFFS, weeks).select(*RAW_DIFFS) for n in ("body", "heads")]
        return parts[0].unionByName(parts[1])

    def diff(self) -> DataFrame:
        return apply_policy(self.raw_diffs(), self.policy)

    def stats(self, value: str = "entries", rule: CutoffRule = DBT_CUTOFF) -> DataFrame:
        """As ``series_stats``: station, turnstile, mean, sd, n and the cutoff, merged from the weeks' moments."""
        part = F.struct(WEEK, *[F.col(f"{value}_{c}").alias(c) for c in ("n", "mean", "m2")])
        weeks = self.read("moments", self._MOMENTS).groupBy(*KEYS).agg(F.sort_array(F.collect_list(part)).alias("parts"))
        merged = weeks.select(*KEYS, merge_moments(F.col("parts")).alias("m")).where("m.n > 0")
        sd = F.when(F.col("m.n") > 1, F.sqrt(F.col("m.m2") / (F.col("m.n") - 1)))
        out = merged.select(*KEYS, F.col("m.mean").alias("mean"), sd.alias("sd"), F.col("m.n").alias("n"))
        return out.withColumn(f"{value}_cutoff", cutoff_value(F.col("mean"), F.col("sd"), F.col("n"), rule))
