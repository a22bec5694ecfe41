"""Q-CLEAN: station x day x 4-hour roll-up of the differences."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoflow.functions.columns import hour_bucket
from odoflow.operators.stations import with_station_attributes

HOURLY_COLUMNS = ["date", "hour", "station", "boro", "entries", "exits"]


def reduce_to_buckets(diffed: DataFrame, width_hours: int = 4) -> DataFrame:
    """(date, hour bucket, station) sums of the differences.

    The partial aggregate runs inside the window stage of the diff, so this
    small result is what crosses the network. It carries every station of the
    diff, so the station list can be taken from it too. (In one lazy query
    Catalyst prunes the sums from the station branch, so the two branches
    share the exchange below the window but not the window itself; the
    weekly build materializes the diff, so there neither is recomputed.)
    """
    return diffed.groupBy(
        F.to_date("date_time").alias("date"),
        hour_bucket("date_time", width_hours).alias("hour"),
        "station",
    ).agg(F.sum("entries").alias("entries"), F.sum("exits").alias("exits"))


def hourly_from_buckets(
    pre: DataFrame,
    stations: DataFrame | None = None,
    station_map: DataFrame | None = None,
    borough_map: DataFrame | None = None,
    start_date: date = date(2019, 1, 1),
    merge_midnight: bool = False,
) -> DataFrame:
    """Name/borough the bucket sums and regroup them (see ``hourly_clean``)."""
    if stations is None:
        # A station's name and borough depend only on its own dimension rows,
        # so the reduced facts join the small dimensions directly: no
        # distinct-station pass and no shuffle of the facts by station.
        joined = with_station_attributes(pre, station_map, borough_map).withColumnRenamed("borough", "boro")
    else:
        names = stations.select(
            F.col("station").alias("_s_station"), F.col("pretty_name"), F.col("borough").alias("boro")
        )
        joined = pre.join(names, F.col("station") == F.col("_s_station"), "left")
    grouped = joined.groupBy("date", "hour", F.col("pretty_name").alias("station"), "boro").agg(
        F.sum("entries").alias("entries"), F.sum("exits").alias("exits")
    )
    kept = grouped.filter((F.col("entries") > 0) | (F.col("exits") > 0))
    midnight = F.col("hour") == 0
    moved = kept.select(
        F.when(midnight, F.date_sub("date", 1)).otherwise(F.col("date")).alias("date"),
        F.when(midnight, F.lit(24)).otherwise(F.col("hour")).cast("int").alias("hour"),
        "station",
        "boro",
        F.col("entries").cast("int").alias("entries"),
        F.col("exits").cast("int").alias("exits"),
    ).filter(F.col("date") >= F.lit(start_date))
    if merge_midnight:
        moved = moved.groupBy("date", "hour", "station", "boro").agg(
            F.sum("entries").cast("int").alias("entries"), F.sum("exits").cast("int").alias("exits")
        )
    return moved.select(*HOURLY_COLUMNS)


def hourly_clean(
    diffed: DataFrame,
    stations: DataFrame | None = None,
    station_map: DataFrame | None = None,
    borough_map: DataFrame | None = None,
    start_date: date = date(2019, 1, 1),
    merge_midnight: bool = False,
    width_hours: int = 4,
) -> DataFrame:
    """Sum entries/exits per (date, hour bucket, pretty station name, borough).

    Hour buckets are rounded half-up (22:00-23:59 -> 24, 00:00-01:59 -> 0);
    groups whose sums are both 0 are dropped; bucket 0 then becomes hour 24
    of the previous day, and days before ``start_date`` are dropped. With
    ``merge_midnight=False`` (the reference) a moved bucket is not merged
    with the hour-24 bucket of that day, so (date, 24, station) may repeat.

    Plan: the diff is first reduced to (date, bucket, station) - the partial
    aggregate runs in the window stage - and only that small result meets the
    station attributes (broadcast joins to the dimensions, or to a given
    materialized station list).
    """
    pre = reduce_to_buckets(diffed, width_hours)
    return hourly_from_buckets(pre, stations, station_map, borough_map, start_date, merge_midnight)
