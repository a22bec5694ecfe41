"""The weekly increment equals the batch, in whatever order and parts the readings arrive."""

import glob
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from odoflow.operators.cutoff import series_stats
from odoflow.operators.diff import apply_policy, with_raw_diffs
from odoflow.params import DBT_CUTOFF, DBT_DIFF
from odoflow.sources.files import scratch_path
from odoflow.streaming.increment import NO_TIME, RAW_DIFFS, STAGED, WeeklyStore, week_of


@pytest.fixture(scope="module")
def staged(spark):
    """Five weeks of readings: a series that skips weeks, one that starts late, equal times, NULL times and counters."""
    rnd, rows = random.Random(3), []
    for s, weeks in (("a", (0, 1, 2, 3, 4)), ("b", (0, 3)), ("c", (2, 4)), (None, (1, 2))):
        counter = 0
        for w in weeks:
            t = datetime(2024, 1, 6) + timedelta(days=7 * w)
            for _ in range(30):
                t += timedelta(hours=rnd.choice([0, 4, 4, 5]))
                counter += rnd.randint(-3, 60)
                rows.append((t, "T1", s, counter, counter // 2))
    rows += [(None, "T1", "a", 5, 5), (None, "T1", "a", 9, 7), (None, "T1", "b", None, 7), (datetime(2024, 1, 20), "T1", "a", None, 3)]
    return spark.createDataFrame(rows, "date_time timestamp_ntz, turnstile string, station string, entry_counter int, exit_counter int").distinct()


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def check(store, staged):
    want = with_raw_diffs(staged).select(*RAW_DIFFS)
    assert same(store.raw_diffs(), want)
    for v in ("entries", "exits"):
        batch = {(r.station, r.turnstile): r for r in series_stats(apply_policy(want, DBT_DIFF), v, DBT_CUTOFF).collect()}
        merged = {(r.station, r.turnstile): r for r in store.stats(v).collect()}
        assert merged.keys() == batch.keys() and any(k[0] is None for k in merged)
        for k, r in merged.items():
            b = batch[k]
            assert r.n == b.n and r["mean"] == pytest.approx(b["mean"], rel=1e-9) and (r.sd == b.sd or r.sd == pytest.approx(b.sd, rel=1e-9))
            assert r[f"{v}_cutoff"] == pytest.approx(b[f"{v}_cutoff"], rel=1e-9)


def weeks_of(staged):
    return sorted(r[0] for r in staged.select(week_of()).distinct().collect())


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4, 5), (3, 5, 0, 4, 2, 1)])
def test_weeks_in_any_order_equal_one_batch(spark, staged, order):
    store, weeks = WeeklyStore(spark, scratch_path(spark, "store")), weeks_of(staged)
    assert weeks[-1] == NO_TIME and len(weeks) == 6
    for i in order:
        store.add(staged.where(week_of() == F.lit(weeks[i])))
    check(store, staged)


def test_parts_and_repeated_deliveries(spark, staged):
    store = WeeklyStore(spark, scratch_path(spark, "store"))
    store.add(staged.where(F.xxhash64(*STAGED) % 3 == 0))
    store.add(staged)
    assert store.add(staged.limit(0)) == []
    store.add(staged.unionByName(staged))
    assert same(store.staging(), staged)
    check(store, staged)


def test_a_late_week_rewrites_no_other_body(spark, staged):
    """Only the late week's body is written; of later weeks only the heads of series that follow."""
    store, weeks = WeeklyStore(spark, scratch_path(spark, "store")), weeks_of(staged)
    late = F.lit(weeks[1])
    store.add(staged.where(week_of() != late))
    files = lambda name: {f: os.path.getmtime(f) for f in glob.glob(f"{store.root.removeprefix('file:')}/{name}/*/*.parquet")}
    body = files("body")
    touched = store.add(staged.where(week_of() == late))
    assert touched == [weeks[1], weeks[2]]
    after = files("body")
    assert body.items() <= after.items() and all(str(weeks[1]) in f for f in after.keys() - body.keys())
    check(store, staged)


def test_only_the_weeks_of_the_batch_are_read(spark, staged):
    store, weeks = WeeklyStore(spark, scratch_path(spark, "store")), weeks_of(staged)
    store.add(staged)
    fresh = staged.where(week_of() == F.lit(weeks[2])).withColumn("week", week_of())
    plan = store.unseen(fresh, [weeks[2]])._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(week" in plan and str(weeks[2]) in plan
    assert store.unseen(fresh, [weeks[2]]).isEmpty()
    assert len(store.read("staging", store._STAGING, [weeks[2]]).inputFiles()) >= 1


def test_facts_after_a_late_week_equal_a_rebuild(spark):
    """Only the late week's days and the day before are written anew."""
    from odoflow.operators.hourly import hourly_clean
    from odoflow.plans.stages import Stages
    from odoflow.sources import proxy

    p = Stages(spark, "/root/testdata/sf0.001")
    staged, dims = p.staging, (p.station_map, p.borough_map)
    store, late = WeeklyStore(spark, scratch_path(spark, "store")), weeks_of(p.staging)[1]
    store.update_hourly(store.add(staged.where(week_of() != F.lit(late))), *dims, proxy.PROXY_START)
    folders = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{store.root.removeprefix('file:')}/hourly/*/*.parquet")}
    before = folders()
    days = store.update_hourly(store.add(staged.where(week_of() == F.lit(late))), *dims, proxy.PROXY_START)
    want = hourly_clean(apply_policy(with_raw_diffs(staged), DBT_DIFF), station_map=dims[0], borough_map=dims[1], start_date=proxy.PROXY_START)
    assert same(store.hourly(), want)
    kept = {f for f in before if not any(f"date={d}" in f for d in days)}
    after = folders()
    assert kept and all(after[f] == before[f] for f in kept) and len(days) < len(before)
