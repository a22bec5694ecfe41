from datetime import datetime, timedelta

from pyspark.sql import functions as F

from odoflow.operators.diff import difference, with_raw_diffs
from odoflow.operators.staging import stage, stage_pandas, stage_v1
from odoflow.params import DBT_DIFF, PANDAS_DIFF, V1_DIFF, StagingRules
from tests.conftest import raw_rows


def R(ca="A1", station="S", line="L", div="IND", d="2024-01-02", t="04:00:00", desc="REGULAR", e=100, x=50, scp="00-00"):
    return (ca, "R1", scp, station, line, div, d, t, desc, e, x)


RULES = StagingRules(start_date=datetime(2024, 1, 1).date(), exclude_divisions=("SRT",), exclude_stations=("GONE",))


def test_staging_dedup_relabel_and_exclusions(spark):
    raw = raw_rows(
        spark,
        [
            R(),
            R(),  # exact duplicate
            R(desc="RECOVR AUD"),  # same reading as audit: one staged row (dbt keeps audits)
            R(line=None, t="08:00:00"),  # NULL line: concat skips it
            R(div="PTH", t="12:00:00"),
            R(div="SRT", t="16:00:00"),  # excluded division
            R(station="GONE", t="16:00:00"),  # excluded station
            R(div=None, t="16:00:00"),  # NULL division fails NOT IN
            R(d="2023-12-31"),  # before start
            R(station="OLD", line="X", t="20:00:00"),
        ],
    )
    out = stage(raw, {"OLD-X": "S-L", "S-L": "NEVER"}, {"PTH": "-PATH"}, RULES)
    got = sorted((r.station, r.date_time.hour) for r in out.collect())
    # relabel applied once: OLD-X -> S-L, and S-L -> NEVER for the original S-L rows
    assert got == [("NEVER", 4), ("NEVER-PATH", 12), ("S-", 8), ("S-L", 20)]


def test_stage_v1_and_pandas(spark):
    raw = raw_rows(spark, [R(line="QN1"), R(line="QN1", desc="RECOVR AUD", t="08:00:00"), R(line="QN1", div="PTH", t="09:00:00"), R(line="QN1", div=None, t="10:00:00")])
    v1 = {(r.station, r.date_time.hour) for r in stage_v1(raw, {"S-QN1-PTH": "P"}).collect()}
    assert v1 == {("S-QN1", 4), ("P", 9), ("S-QN1", 10)}
    pdv = {(r.station, r.date_time.hour) for r in stage_pandas(raw).collect()}
    assert pdv == {("S-1NQ", 4), ("S-1NQ-PTH", 9), (None, 10)}  # '+' concat propagates NULL


def _series(spark, rows):
    """rows: (seconds since 2024-01-02, entry_counter, exit_counter)"""
    base = datetime(2024, 1, 2)
    data = [(base + timedelta(seconds=s), "T", "S", e, x) for s, e, x in rows]
    return spark.createDataFrame(data, "date_time timestamp_ntz, turnstile string, station string, entry_counter int, exit_counter int")


def test_diff_rules_dbt(spark):
    st = _series(
        spark,
        [
            (0, 1000, 1000),  # first: no diff -> dropped
            (14400, 2000, 1500),  # normal: kept (1000, 500)
            (28800, 1000, 1600),  # reset: |-1000| kept (abs)
            (28800 + 345599, 1100, 1700),  # gap just under limit: kept
            (28800 + 2 * 345600 - 1, 1200, 1800),  # gap exactly 345600: dropped (strict <)
            (28800 + 2 * 345600 - 1 + 14398, 1200 + 7199, 1800),  # 7199 = seconds/2: dropped by rate rule (strict <)
            (28800 + 2 * 345600 - 1 + 30000, 1200 + 7199 + 7199, 1800),  # 7199 < 15001/2 and < 7200: kept
            (28800 + 2 * 345600 - 1 + 60000, 1200 + 7199 + 7199 + 7200, 1800),  # 7200 -> hard cap drops
            (28800 + 2 * 345600 - 1 + 60000, 1, 1),  # tie on time: ordered by counters, zero gap -> dropped
        ],
    )
    out = difference(st, DBT_DIFF, chunk_days=1).orderBy("date_time", "entry_counter").collect()
    kept = [(r.entries, r.exits, r.seconds_diff) for r in out]
    assert kept == [(1000, 500, 14400), (1000, 100, 14400), (100, 100, 345599), (7199, 0, 15602)]


def test_diff_rules_v1_and_pandas(spark):
    st = _series(spark, [(0, 100, 100), (3600, 50, 200), (7200, 8000, 300), (10800, 8100, 7600), (14400, 8100, 7600)])
    v1 = [(r.entries, r.exits) for r in difference(st, V1_DIFF).orderBy("date_time").collect()]
    # first row, negative entries and anything > 7200 deleted; all-zero kept here (dropped later)
    assert v1 == [(0, 0)]
    pdv = [(r.entries, r.exits) for r in difference(st, PANDAS_DIFF).orderBy("date_time").collect()]
    # first row 0; negative -> 0; > 2880 entries -> 0; > 7200 exits -> 0
    assert pdv == [(0, 0), (0, 100), (0, 100), (100, 0), (0, 0)]


def test_hours_difference(spark):
    st = _series(spark, [(0, 1, 1), (2 * 86400 + 5 * 3600 + 59 * 60, 2, 2)])
    r = with_raw_diffs(st).filter(F.col("seconds_diff").isNotNull()).collect()[0]
    assert r.hours_difference == 53 and r.seconds_diff == 2 * 86400 + 5 * 3600 + 59 * 60


def test_stage_with_seed_frames_equals_literal_maps(spark, tmp_path):
    from odoflow.schemas import DIVISION_LABEL_SCHEMA, STATION_LABEL_SCHEMA
    from odoflow.sources import seeds

    path = tmp_path / "station_label_override.csv"
    path.write_text("STATION_SRC,STATION_DEST\nOLD-X,S-L\n")
    slo = seeds.load_seed(spark, str(path), STATION_LABEL_SCHEMA)
    dlo = seeds.seed_frame(spark, [("PTH", "-PATH")], DIVISION_LABEL_SCHEMA)
    raw = raw_rows(spark, [R(), R(station="OLD", line="X", t="20:00:00"), R(div="PTH", t="12:00:00")])
    via_join = stage(raw, slo, dlo, RULES)
    via_map = stage(raw, {"OLD-X": "S-L"}, {"PTH": "-PATH"}, RULES)
    assert via_join.exceptAll(via_map).count() == 0 and via_map.exceptAll(via_join).count() == 0
    assert len(seeds.STATION_LABELS) == 24 and seeds.station_labels(spark).count() == 24


def test_stage_notebook_preset(spark):
    raw = raw_rows(spark, [R(), R(), R(div="PTH", t="09:00:00"), R(desc="RECOVR AUD", t="10:00:00")])
    nb = stage_v1(raw, {}, dedup="raw", division_suffix=False)
    assert sorted((r.station, r.date_time.hour) for r in nb.collect()) == [("S-L", 4), ("S-L", 9)]
