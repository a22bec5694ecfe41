from datetime import datetime

from pyspark.sql import functions as F

from odoflow.functions import columns as C


def one(df, expr):
    return df.select(expr.alias("v")).collect()[0]["v"]


def test_concat_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert one(df, C.concat_skip_nulls("x", F.lit("-"), "y", F.lit("-"), "z")) == "a--c"
    assert one(df, C.concat_skip_nulls("y")) == ""
    assert one(df, F.concat("x", "y")) is None  # the trap this helper exists for


def test_dow_and_weekday(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 7).date(),)], "d date")  # a Sunday
    assert one(df, C.dow_sunday0("d")) == 0
    assert one(df, C.weekday_monday0("d")) == 6


def test_sorted_letters(spark):
    df = spark.createDataFrame([("NQR456W",)], "s string")
    assert one(df, C.sorted_letters("s")) == "456NQRW"


def test_seconds_between_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert one(df, C.seconds_between("a", "b")) == 1  # date_diff('second') semantics, not whole seconds


def test_interval_hours(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 1, 3, 5, 59))], "a timestamp_ntz, b timestamp_ntz")
    assert one(df, C.interval_hours("a", "b")) == 53


def test_hour_bucket_matches_float_formula_on_every_minute(spark):
    rows = [(datetime(2024, 1, 1, h, m),) for h in range(24) for m in range(60)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = [r["b"] for r in df.select(C.hour_bucket("t").alias("b")).collect()]

    def ref(h, m):  # 4 * round((h + m / 60) / 4), half away from zero
        x = (h + m / 60) / 4
        return int(4 * int(x + 0.5))

    assert got == [ref(h, m) for h in range(24) for m in range(60)]
    assert ref(22, 0) == 24 and ref(1, 59) == 0 and ref(2, 0) == 4


def test_pct_change_and_formatting(spark):
    df = spark.createDataFrame([(110.0, 100.0, 0.0, -0.0004)], "a double, b double, z double, tiny double")
    assert abs(one(df, C.pct_change("a", "b")) - 0.1) < 1e-12
    assert one(df, C.pct_change("a", "z")) is None  # ANSI-safe: no division error
    assert one(df, C.format_percent("tiny")) == "0.0%"  # no "-0.0%"
    assert one(df, C.format_thousands(F.lit(1234567.0))) == "1,234,567"


def test_code_maps(spark):
    df = spark.createDataFrame([("Queens", 3)], "l string, c int")
    assert one(df, C.label_code(C.BOROUGH_CODES, "l")) == 4
    assert one(df, C.code_label(C.DOW_CODES, "c")) == "Wednesday"
    assert one(df, C.label_code(C.BOROUGH_CODES, F.lit("Nowhere"))) is None


def test_size_for_input(spark):
    from odoflow.session import size_for_input

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        # 100 TB on 1000 executors x 8 cores: about 400k partitions of 256 MB
        assert size_for_input(spark, 100 * 2**40, 8000) == 409600
        assert size_for_input(spark, 10 * 2**20, 8) == 16  # small input: two waves of the cores
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
