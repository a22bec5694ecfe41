"""Station list (Q-STN): distinct stations of the diff, decorated from the
station and borough dimensions, with the borough coding rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoflow.functions.columns import concat_skip_nulls
from odoflow.params import BoroughRules

STATION_LIST_COLUMNS = ["station", "pretty_name", "latitude", "longitude", "borough_desc", "borough", "cbd"]


def borough_coding(desc, cbd, rules: BoroughRules = BoroughRules()):
    """(borough_desc, borough) after the ordered rewrites.

    1. cbd = 'Y' -> cbd_label (for any borough);
    2. desc = split_desc and cbd = 'N' -> above_label;
    3. code from the final description, else ``unmapped_code``.
    """
    d1 = F.when(cbd == "Y", F.lit(rules.cbd_label)).otherwise(desc)
    d2 = F.when((d1 == rules.split_desc) & (cbd == "N"), F.lit(rules.above_label)).otherwise(d1)
    code = F.lit(rules.unmapped_code)
    for label, value in reversed(list(rules.codes.items())):
        code = F.when(d2 == label, F.lit(value)).otherwise(code)
    return d2, code.cast("int")


def with_station_attributes(
    df: DataFrame,
    station_map: DataFrame,
    borough_map: DataFrame,
    rules: BoroughRules = BoroughRules(),
) -> DataFrame:
    """Add pretty_name, latitude, longitude, borough_desc, borough, cbd for ``df.station``.

    Two left joins to small dimensions (unique keys; Spark broadcasts them
    by their size, AQE re-checks at run time). pretty_name is
    stop_name || '-' || routes || ' (' || borough || ')' with NULLs skipped,
    so every unmapped station is named '- ()'.
    """
    sm = station_map.select(
        F.col("station").alias("_m_station"), "stop_name", "daytime_routes",
        F.col("borough").alias("_m_borough"), "latitude", "longitude", "cbd",
    )
    bm = borough_map.select(F.col("borough").alias("_b_borough"), F.col("borough_desc").alias("_b_desc"))
    joined = df.join(sm, F.col("station") == F.col("_m_station"), "left").join(
        bm, F.col("_m_borough") == F.col("_b_borough"), "left"
    )
    desc, code = borough_coding(F.col("_b_desc"), F.col("cbd"), rules)
    return joined.select(
        *[F.col(c) for c in df.columns],
        concat_skip_nulls(
            F.col("stop_name"), F.lit("-"), F.col("daytime_routes"), F.lit(" ("), F.col("_m_borough"), F.lit(")")
        ).alias("pretty_name"),
        "latitude",
        "longitude",
        desc.alias("borough_desc"),
        code.alias("borough"),
        "cbd",
    )


def station_list(
    stations: DataFrame,
    station_map: DataFrame,
    borough_map: DataFrame,
    rules: BoroughRules = BoroughRules(),
) -> DataFrame:
    """One row per distinct ``station`` of ``stations`` (usually the diff)."""
    distinct = stations.select("station").distinct()
    return with_station_attributes(distinct, station_map, borough_map, rules).select(*STATION_LIST_COLUMNS)
