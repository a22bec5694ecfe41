"""All stages of the computation as lazy chains of operators over the proxy inputs.

``Stages`` builds each stage once per instance (lazily); stages are plain
DataFrames, so Catalyst sees and optimizes the whole chain of a query.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odoflow.operators import cohorts as co
from odoflow.operators.cutoff import cutoff_clean, drop_all_zero, series_stats
from odoflow.operators.diff import apply_policy, difference, with_raw_diffs
from odoflow.operators.hourly import hourly_from_buckets, reduce_to_buckets
from odoflow.operators.staging import stage, stage_pandas, stage_v1
from odoflow.operators.stations import station_list
from odoflow.params import (
    DBT_CUTOFF, DBT_DIFF, NOTEBOOK_CUTOFF, PANDAS_DIFF, V1_CUTOFF, V1_DIFF, CohortFilter, StagingRules,
)
from odoflow.sources import proxy

# Fixed values of the proxy: the script variant's station fixes (plays the 15-entry dict).
PROXY_V1_FIXES: dict[str, str] = {
    "NATION_7-L1": "NATION_8-L0",
    "NATION_2-L0": "NATION_3-L0",
    "NATION_6-L2-PTH": "NATION_6-L1-PTH",
}
PROXY_RULES = StagingRules(
    start_date=proxy.PROXY_START, exclude_divisions=("SRT",), exclude_stations=proxy.PROXY_EXCLUDED_STATIONS
)
PROXY_FILTER = CohortFilter(dow=(1, 2, 3, 4, 5), tod=(8, 12, 16, 20), boro=(1, 2, 3))


class Stages:
    """All stages over one data folder. Each attribute is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str, chunk_days: int = 7):
        self.spark = spark
        self.sf_dir = sf_dir
        self.chunk_days = chunk_days

    # -- inputs ---------------------------------------------------------
    @cached_property
    def readings(self) -> DataFrame:
        return proxy.readings(self.spark, self.sf_dir, self.chunk_days)

    @cached_property
    def raw(self) -> DataFrame:
        return proxy.raw_from_readings(self.readings)

    # Seeds held as Python values have a known size: literal maps, no join.
    station_labels = dict(proxy.PROXY_STATION_LABELS)
    division_labels = dict(proxy.PROXY_DIVISION_LABELS)

    @cached_property
    def station_map(self) -> DataFrame:
        sm = proxy.station_map(self.spark, self.sf_dir)
        return sm.withColumn("latitude", F.round("latitude", 2)).withColumn("longitude", F.round("longitude", 2))

    @cached_property
    def borough_map(self) -> DataFrame:
        return proxy.borough_map(self.spark, self.sf_dir)

    # -- canonical (dbt) chain -------------------------------------------
    @cached_property
    def staging(self) -> DataFrame:
        return stage(self.raw, self.station_labels, self.division_labels, PROXY_RULES)

    @cached_property
    def diff_all(self) -> DataFrame:
        return with_raw_diffs(self.staging, chunk_days=self.chunk_days)

    @cached_property
    def diff(self) -> DataFrame:
        return apply_policy(self.diff_all, DBT_DIFF)

    @cached_property
    def buckets(self) -> DataFrame:
        """(date, 4-hour bucket, station) sums: shared by the facts and the station list."""
        return reduce_to_buckets(self.diff)

    @cached_property
    def station_list(self) -> DataFrame:
        return station_list(self.buckets, self.station_map, self.borough_map)

    def hourly(self, merge_midnight: bool = False) -> DataFrame:
        return hourly_from_buckets(
            self.buckets, station_map=self.station_map, borough_map=self.borough_map,
            start_date=proxy.PROXY_START, merge_midnight=merge_midnight,
        )

    @cached_property
    def hourly_clean(self) -> DataFrame:
        return self.hourly(False)

    def tagged(self, filt: CohortFilter | None = None) -> DataFrame:
        return co.tag_cohorts(self.hourly_clean, proxy.PROXY_COHORTS, filt)

    @cached_property
    def daily(self) -> DataFrame:
        return co.cohort_daily(self.tagged())

    @cached_property
    def summary(self) -> DataFrame:
        return co.cohort_summary(self.daily)

    def entry_stats(self) -> DataFrame:
        return series_stats(self.diff, "entries", DBT_CUTOFF)

    def exit_stats(self) -> DataFrame:
        return series_stats(self.diff, "exits", DBT_CUTOFF)

    # -- script / notebook chain -----------------------------------------
    @cached_property
    def v1_staging(self) -> DataFrame:
        return stage_v1(self.raw, PROXY_V1_FIXES)

    @cached_property
    def v1_diff(self) -> DataFrame:
        # keeps the chunk id, so the cutoff join reuses the window's partitioning
        raw_diffs = with_raw_diffs(self.v1_staging, chunk_days=self.chunk_days, keep_chunk=True)
        return apply_policy(raw_diffs, V1_DIFF).withColumn("date", F.to_date("date_time"))

    @cached_property
    def cutoff_filtered(self) -> DataFrame:
        return cutoff_clean(self.v1_diff, V1_CUTOFF, exit_cutoff="per_series")

    @cached_property
    def cutoff_script(self) -> DataFrame:
        """The script as it ran: its exit-cutoff update was never executed."""
        return cutoff_clean(self.v1_diff, V1_CUTOFF, exit_cutoff="default")

    @cached_property
    def nb_diff(self) -> DataFrame:
        staged = stage_v1(self.raw, PROXY_V1_FIXES, dedup="raw", division_suffix=False)
        raw_diffs = with_raw_diffs(staged, chunk_days=self.chunk_days, keep_chunk=True)
        return apply_policy(raw_diffs, V1_DIFF).withColumn("date", F.to_date("date_time"))

    @cached_property
    def cutoff_notebook(self) -> DataFrame:
        return cutoff_clean(self.nb_diff, NOTEBOOK_CUTOFF, exit_cutoff="per_series")

    # -- pandas chain ------------------------------------------------------
    @cached_property
    def pandas_diff(self) -> DataFrame:
        return drop_all_zero_positive(difference(stage_pandas(self.raw), PANDAS_DIFF, chunk_days=self.chunk_days))


def drop_all_zero_positive(df: DataFrame) -> DataFrame:
    """FI11 (pandas form): keep rows with entries > 0 or exits > 0."""
    return df.filter((F.col("entries") > 0) | (F.col("exits") > 0))


__all__ = ["Stages", "PROXY_FILTER", "PROXY_RULES", "PROXY_V1_FIXES", "drop_all_zero"]
