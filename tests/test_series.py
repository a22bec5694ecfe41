import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from odoflow.operators.series import series_lag, series_running_sum


def _frame(spark, seed=7):
    rnd = random.Random(seed)
    rows = []
    start = datetime(2024, 1, 1)
    # one hot series spanning many chunks (and long gaps), several small ones, ties on time
    for s, n in (("hot", 2000), ("a", 30), ("b", 5), ("c", 1)):
        t = start
        for i in range(n):
            t += timedelta(seconds=rnd.choice([0, 1, 3600, 4 * 3600, 9 * 86400]))
            rows.append((s, "T1", t, rnd.randint(-5, 10**6), rnd.randint(0, 10**6), rnd.randint(0, 50)))
    return spark.createDataFrame(rows, "station string, turnstile string, ts timestamp_ntz, e int, x int, v int").dropDuplicates()


def test_series_lag_equals_plain_window(spark):
    df = _frame(spark)
    w = Window.partitionBy("station", "turnstile").orderBy("ts", "e", "x")
    expect = df.select("*", *[F.lag(c).over(w).alias("prev_" + c) for c in ("ts", "e", "x")])
    for chunk_days, cap in ((1, 10**9), (7, 10**9), (30, 10**9), (30, 40), (7, 5)):
        got = series_lag(
            df, ["station", "turnstile"], ["ts", "e", "x"], ["ts", "e", "x"], chunk_days=chunk_days, max_rows_per_chunk=cap
        )
        assert got.exceptAll(expect).count() == 0
        assert expect.exceptAll(got).count() == 0


def test_series_running_sum_equals_plain_window(spark):
    # a deterministic unique tie-breaker: the row's own values hashed with its position in (e, x)
    df = _frame(spark).withColumn("id", F.xxhash64("ts", "e", "x")).withColumn("v", F.col("v").cast("long"))
    w = Window.partitionBy("station").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    expect = df.select("*", F.sum("v").over(w).alias("cum_v"))
    for cap in (10**9, 25):
        got = series_running_sum(df, ["station"], ["ts", "id"], ["v"], chunk_days=3, max_rows_per_chunk=cap)
        assert got.exceptAll(expect).count() == 0
        assert expect.exceptAll(got).count() == 0


def test_no_sort_aggregate_in_lag_plan(spark):
    df = _frame(spark)
    got = series_lag(df, ["station", "turnstile"], ["ts", "e", "x"], ["ts", "e", "x"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_series_is_spread_over_tasks(spark):
    """A series holding ~98% of the rows lands in many window tasks, not one."""
    df = _frame(spark)
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = series_lag(df, ["station", "turnstile"], ["ts", "e", "x"], ["ts", "e", "x"], chunk_days=7)
        per_task = got.filter("station = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        total = sum(r["count"] for r in per_task)
        assert len(per_task) >= 3 and max(r["count"] for r in per_task) < 0.6 * total
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)


def test_hot_chunk_is_split_by_row_count(spark):
    """All rows of one series inside ONE coarse chunk: the adaptive split still spreads them."""
    from datetime import datetime, timedelta

    rows = [("hot", "T", datetime(2024, 1, 1) + timedelta(seconds=17 * i), i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "station string, turnstile string, ts timestamp_ntz, e int, x int")
    w = Window.partitionBy("station", "turnstile").orderBy("ts", "e", "x")
    expect = df.select("*", *[F.lag(c).over(w).alias("prev_" + c) for c in ("ts", "e", "x")])
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = series_lag(df, ["station", "turnstile"], ["ts", "e", "x"], ["ts", "e", "x"], chunk_days=7, max_rows_per_chunk=300)
        assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
        per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) >= 3 and max(per_task) < 0.6 * 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)


def test_null_times_sort_last_like_the_sql_engine(spark):
    from datetime import datetime

    rows = [("s", "t", datetime(2024, 1, d), d, d) for d in (1, 9, 20)] + [("s", "t", None, 99, 98), ("s", "t", None, 97, 96)]
    df = spark.createDataFrame(rows, "station string, turnstile string, ts timestamp_ntz, e int, x int")
    w = Window.partitionBy("station", "turnstile").orderBy(*[F.col(c).asc_nulls_last() for c in ("ts", "e", "x")])
    expect = df.select("*", *[F.lag(c).over(w).alias("prev_" + c) for c in ("ts", "e", "x")])
    got = series_lag(df, ["station", "turnstile"], ["ts", "e", "x"], ["ts", "e", "x"], chunk_days=7)
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
    assert got.filter("ts is null and prev_e = 20").count() == 1  # first untimed reading follows the last timed one


def test_lag_takes_null_and_bigint_tie_breakers_at_chunk_borders(spark):
    rows = [("s", "2024-01-01", 10), ("s", "2024-01-02", None), ("s", "2024-01-12", 50), ("s", "2024-01-12", None)]
    for kind in ("int", "bigint"):
        df = spark.createDataFrame(rows, "k string, d string, e int").selectExpr("k", "cast(d as timestamp_ntz) as t", f"cast(e as {kind}) as e")
        got = {(str(r.t)[:10], r.e): (str(r.prev_t)[:10], r.prev_e) for r in series_lag(df, ["k"], ["t", "e"], ["t", "e"]).collect()}
        assert got["2024-01-12", 50] == ("2024-01-02", None)
        assert got["2024-01-12", None] == ("2024-01-12", 50)


def _chunk_sizes(df, order, limit):
    from odoflow.operators.series import CHUNK, with_chunks

    return [r["count"] for r in with_chunks(df, ["k"], order, 7, limit).groupBy("k", CHUNK).count().collect()]


def test_bursts_and_null_times_are_cut_by_rank(spark):
    """20,000 readings of one series within ten minutes, and 20,000 without a time: pieces of at most twice the limit,
    and the lag still equals the plain window."""
    start = datetime(2024, 1, 3)
    burst = spark.range(20_000).select(
        F.lit("a").alias("k"), F.expr("timestamp_ntz'2024-01-03 00:00:00' + make_dt_interval(0, 0, 0, (id * id) % 600)").alias("t"),
        (F.col("id") * 7).cast("int").alias("e"), (F.col("id") % 13).cast("int").alias("x"),
    )
    timeless = spark.range(20_000).select(
        F.lit("a").alias("k"), F.lit(None).cast("timestamp_ntz").alias("t"), (F.col("id") * 3).cast("int").alias("e"), F.lit(None).cast("int").alias("x")
    )
    few = spark.createDataFrame([("b", start, 1, 1), ("b", None, None, None), (None, start, 4, 4)], "k string, t timestamp_ntz, e int, x int")
    df = burst.unionByName(timeless).unionByName(few)
    limit = 1_000
    sizes = _chunk_sizes(df, ["t", "e", "x"], limit)
    assert sum(sizes) == df.count() and max(sizes) <= 2 * limit and len(sizes) <= 60
    w = Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_last() for c in ("t", "e", "x")])
    expect = df.select("*", *[F.lag(c).over(w).alias("prev_" + c) for c in ("t", "e", "x")])
    got = series_lag(df, ["k"], ["t", "e", "x"], ["t", "e", "x"], max_rows_per_chunk=limit)
    assert got.exceptAll(expect).isEmpty() and expect.exceptAll(got).isEmpty()


def test_one_instant_is_cut_on_the_tie_breaker(spark):
    """All rows of a series at one time: the leading bits of the first tie-breaker cut the chunk."""
    df = spark.range(8_000).select(F.lit("a").alias("k"), F.lit(datetime(2024, 1, 3)).cast("timestamp_ntz").alias("t"), (F.col("id") * 100_000).cast("int").alias("e"))
    sizes = _chunk_sizes(df, ["t", "e"], 500)
    assert sum(sizes) == 8_000 and max(sizes) <= 1_000


def test_chunk_ids_follow_the_row_order_and_are_never_null(spark):
    from odoflow.operators.series import CHUNK, with_chunks

    df = _frame(spark).unionByName(spark.createDataFrame([("hot", "T1", None, i, 1, 1) for i in range(300)], _frame(spark).schema))
    w = Window.partitionBy("station").orderBy(*[F.col(c).asc_nulls_last() for c in ("ts", "e", "x")])
    cut = with_chunks(df, ["station"], ["ts", "e", "x"], 7, 50)
    assert cut.where(F.col(CHUNK).isNull()).isEmpty()
    assert cut.withColumn("p", F.lag(CHUNK).over(w)).where(F.col("p") > F.col(CHUNK)).isEmpty()
