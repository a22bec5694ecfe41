from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from odoflow.operators.cutoff import cutoff_clean, drop_all_zero, series_stats
from odoflow.operators.hourly import hourly_clean
from odoflow.operators.stations import station_list
from odoflow.params import CutoffRule

SM_SCHEMA = "station string, stop_name string, daytime_routes string, borough string, latitude double, longitude double, cbd string"


def _stations(spark):
    sm = spark.createDataFrame(
        [
            ("M1", "Stop A", "AB", "M", 40.1, -74.1, "Y"),
            ("M2", "Stop B", "C", "M", 40.2, -74.2, "N"),
            ("B1", None, "D", "Bk", 40.3, -74.3, "Y"),  # cbd Y wins for any borough
            ("Q1", "Stop Q", "E", "Q", 40.4, -74.4, "N"),
            ("X1", "Stop X", "F", "Zz", 40.5, -74.5, None),
        ],
        SM_SCHEMA,
    )
    bm = spark.createDataFrame([("M", "Manhattan"), ("Bk", "Brooklyn"), ("Q", "Queens")], "borough string, borough_desc string")
    return sm, bm


def test_station_list_coding(spark):
    sm, bm = _stations(spark)
    st = spark.createDataFrame([(s,) for s in ["M1", "M2", "B1", "Q1", "X1", "U1", "U2"]], "station string")
    got = {r.station: (r.pretty_name, r.borough_desc, r.borough) for r in station_list(st, sm, bm).collect()}
    assert got["M1"] == ("Stop A-AB (M)", "Manhattan below 63 St", 1)
    assert got["M2"] == ("Stop B-C (M)", "Manhattan above 63 St", 2)
    assert got["B1"] == ("-D (Bk)", "Manhattan below 63 St", 1)
    assert got["Q1"] == ("Stop Q-E (Q)", "Queens", 4)
    assert got["X1"] == ("Stop X-F (Zz)", None, -1)
    assert got["U1"] == got["U2"] == ("- ()", None, -1)  # unmapped stations share one name


def _diffed(spark, rows):
    return spark.createDataFrame(
        [(datetime.fromisoformat(t), s, "T", e, x) for t, s, e, x in rows],
        "date_time timestamp_ntz, station string, turnstile string, entries int, exits int",
    )


def test_hourly_buckets_midnight_and_start(spark):
    sm, bm = _stations(spark)
    d = _diffed(
        spark,
        [
            ("2024-01-02 00:00:00", "M1", 1, 0),  # bucket 0 -> 2024-01-01 hour 24
            ("2024-01-02 01:59:00", "M1", 2, 0),  # bucket 0
            ("2024-01-02 02:00:00", "M1", 4, 0),  # bucket 4
            ("2024-01-01 21:59:00", "M1", 8, 0),  # bucket 20
            ("2024-01-01 22:00:00", "M1", 16, 0),  # bucket 24 of the same day
            ("2024-01-01 23:59:00", "M1", 32, 0),
            ("2024-01-01 00:30:00", "M1", 64, 0),  # moves to 2023-12-31: before start, dropped
            ("2024-01-02 12:00:00", "M2", 0, 0),  # all-zero group: dropped by HAVING
        ],
    )
    out = hourly_clean(d, station_map=sm, borough_map=bm, start_date=date(2024, 1, 1))
    got = sorted((str(r.date), r.hour, r.entries) for r in out.collect())
    # (2024-01-01, 24) appears twice: not merged (reference behaviour)
    assert got == [("2024-01-01", 20, 8), ("2024-01-01", 24, 3), ("2024-01-01", 24, 48), ("2024-01-02", 4, 4)]
    merged = hourly_clean(d, station_map=sm, borough_map=bm, start_date=date(2024, 1, 1), merge_midnight=True)
    assert sorted((str(r.date), r.hour, r.entries) for r in merged.collect()) == [
        ("2024-01-01", 20, 8), ("2024-01-01", 24, 51), ("2024-01-02", 4, 4)
    ]
    # totals do not depend on merging
    assert out.agg(F.sum("entries")).first()[0] == merged.agg(F.sum("entries")).first()[0]


def test_cutoff_rules(spark):
    base = datetime(2024, 1, 2)
    rows = []
    for name, n, val in (("one", 1, 500), ("twenty", 20, 3000), ("big", 21, None)):
        for i in range(n):
            v = val if val is not None else (1000 if i % 2 else 3000)
            rows.append((base + timedelta(hours=4 * i), name, "T", v, 0))
    rows.append((base, "zero", "T", 0, 0))
    d = spark.createDataFrame(rows, "date_time timestamp_ntz, station string, turnstile string, entries int, exits int")
    stats = {r.station: r for r in series_stats(d, "entries", CutoffRule(k=3.0)).collect()}
    assert stats["one"].sd is None and stats["one"].entries_cutoff == 2000.0  # n=1: sd NULL
    assert stats["twenty"].entries_cutoff == 2000.0  # n <= 20
    big = stats["big"]
    assert big.n == 21 and abs(big.entries_cutoff - (big.mean + 3 * big.sd)) < 1e-9 and big.entries_cutoff > 2000
    capped = series_stats(d, "entries", CutoffRule(k=3.0, ceiling=2500.0)).filter("station = 'big'").first()
    assert capped.entries_cutoff == 2000.0
    kept = cutoff_clean(d, CutoffRule(k=3.0))
    assert kept.filter("station = 'zero'").count() == 0  # all-zero row dropped
    assert kept.filter("station = 'twenty'").count() == 0  # 3000 > 2000 floor cutoff
    assert kept.filter("station = 'big'").count() == 21  # 3000 < mean + 3 sd (about 5000)


def test_drop_all_zero_keeps_nulls(spark):
    d = spark.createDataFrame([(0, 0), (None, 0), (1, 0)], "entries int, exits int")
    assert drop_all_zero(d).count() == 2


def test_cutoff_join_reuses_the_window_partitioning(spark):
    """With broadcasts off, the diff side of the cutoff join has no exchange of its own."""
    from odoflow.params import V1_CUTOFF
    from odoflow.plans.stages import Stages

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        df = cutoff_clean(Stages(spark, "/root/testdata/sf0.001").v1_diff, V1_CUTOFF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        i = next(n for n, line in enumerate(lines) if "SortMergeJoin" in line and "_chunk" in line)
        big_side = "\n".join(lines[i + 1 : i + 6])
        assert "Window" in big_side and "Exchange" not in big_side.split("Window")[0]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
