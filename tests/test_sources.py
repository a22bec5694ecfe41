import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from odoflow.operators import quality as dq
from odoflow.sources import calendar, files
from odoflow.streaming import ingest
from tests.conftest import raw_rows

HEADER = "C/A,UNIT,SCP,STATION,LINENAME,DIVISION,DATE,TIME,DESC,ENTRIES,EXITS                                                               \n"


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(HEADER)
        fh.writelines(lines)


def test_read_weekly_files_padded_header_and_provenance(spark, tmp_path):
    d = str(tmp_path / "landing")
    _write(d, "turnstile_240106.txt", ["A002,R051,02-00-00,59 ST,NQR456W,BMT,01/02/2024,03:00:00,REGULAR,7000000,2000000\n"])
    _write(d, "turnstile_240113.txt", ["A002,R051,02-00-00,59 ST,NQR456W,BMT,01/09/2024,07:00:00,RECOVR AUD,7000100,2000010\n"])
    _write(d, "notes.csv", ["ignored\n"])
    df = files.read_reading_files(spark, d)
    rows = sorted(df.collect(), key=lambda r: r.DATE)
    assert [r.DATE for r in rows] == [date(2024, 1, 2), date(2024, 1, 9)]
    assert rows[0].ENTRY_COUNTER == 7000000 and rows[0].source_file == "turnstile_240106.txt"
    landed = calendar.landed_weeks_from_names(df)
    missing = calendar.missing_files(calendar.expected_saturdays(spark, date(2024, 1, 1), date(2024, 1, 31)), landed, prefix="turnstile_")
    assert [r.file_name for r in missing.orderBy("file_date").collect()] == ["turnstile_240120.txt", "turnstile_240127.txt"]


def test_over_range_counter_fails_fast(spark, tmp_path):
    d = str(tmp_path / "bad")
    _write(d, "240106.txt", ["A,R,S,ST,L,BMT,01/02/2024,03:00:00,REGULAR,99999999999,1\n"])
    with pytest.raises(Exception):
        files.read_reading_files(spark, d).collect()


def test_roundtrip_and_reconciliation(spark):
    raw = raw_rows(spark, [("A", "R", "S", "ST", "L", "BMT", f"2024-01-0{i}", "04:00:00", "REGULAR", i, i) for i in range(1, 10)])
    path = files.scratch_path(spark, "t-roundtrip")
    files.write_reading_files(raw, path)
    back = files.read_reading_files(spark, path, glob="*.csv", with_source=False)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    fused = files.with_reading_time(back)
    assert fused.filter(F.hour("date_time") != 4).count() == 0
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
    files_n = text.select("_metadata.file_path").distinct().count()
    assert text.count() - files_n == raw.count()  # lines minus one header per file


def test_incremental_ingest_takes_only_new_files(spark):
    rows = [("A", "R", "S", "ST", "L", "BMT", f"2024-01-{d:02d}", "04:00:00", "REGULAR", d, d) for d in range(1, 21)]
    raw = raw_rows(spark, rows + rows[:3])  # three repeated readings: staging removes them, not the ingest
    landing, sink, ckpt = (files.scratch_path(spark, n) for n in ("t-land", "t-sink", "t-ckpt"))
    files.write_reading_files(raw.filter("DATE >= '2024-01-10'"), landing, mode="append")
    ingest.run_incremental(spark, landing, sink, ckpt)
    assert spark.read.parquet(sink).count() == 11
    ingest.run_incremental(spark, landing, sink, ckpt)  # rerun: nothing new
    assert spark.read.parquet(sink).count() == 11
    files.write_reading_files(raw.filter("DATE < '2024-01-10'"), landing, mode="append")  # late weeks
    ingest.run_incremental(spark, landing, sink, ckpt)
    assert spark.read.parquet(sink).count() == 23


def test_quality_reports(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], "k string, v int")
    nulls = {(r.column_name, r.null_count) for r in dq.null_counts({"t": (df, ["k", "v"])}).collect()}
    assert nulls == {("k", 1), ("v", 1)}
    u = dq.unique_check(df, "k").first()
    assert (u.duplicates, u.nulls) == (1, 1)
    assert [r.k for r in dq.duplicate_keys(df, ["k"]).collect()] == ["a"]
    h = {r.bucket: r.rows for r in dq.histogram(df, "v", 0, 4, 2).collect()}
    assert h == {1: 1, 2: 2}
    c = {r.check: r.rows for r in dq.conditional_counts(df, {"big": F.col("v") > 1, "nullk": F.col("k").isNull()}).collect()}
    assert c == {"big": 2, "nullk": 1}
    rc = {r.stage: r.rows for r in dq.row_counts({"all": df, "some": df.filter("v > 1")}).collect()}
    assert rc == {"all": 4, "some": 2}


def test_clean_header_names_and_adaptive_histogram(spark, tmp_path):
    d = str(tmp_path / "padded")
    _write(d, "240106.txt", ["A,R,S,ST,L,BMT,01/02/2024,03:00:00,REGULAR,1,2\n"])
    inferred = spark.read.option("header", True).csv(d + "/240106.txt")
    assert inferred.columns[-1] != "EXITS"  # the padded name as it comes
    assert files.clean_header_names(inferred).columns[-1] == "EXITS"
    df = spark.createDataFrame([(float(i % 10),) for i in range(1000)], "v double")
    h = dq.adaptive_histogram(df, "v", 5).collect()
    assert len(h) <= 5 and abs(sum(r.height for r in h) - 1000) < 1e-6


def test_dimension_csvs_by_name(spark, tmp_path):
    from odoflow.sources import seeds

    sm = tmp_path / "station_map.csv"
    sm.write_text(
        "Station,Complex,Stop_ID,Division,Line,Stop_Name,Borough,Daytime_Routes,Structure,Latitude,Longitude,North_Label,South_Label,CBD\n"
        "59 ST-456NQRW,613,R11,BMT,Broadway,Lexington Av/59 St,M,N R W,Subway,40.76,-73.97,Uptown,Downtown,Y\n"
    )
    bm = tmp_path / "borough_map.csv"
    bm.write_text("Borough,Borough_Desc\nM,Manhattan\n")
    row = seeds.load_station_map(spark, str(sm)).first()
    assert (row.station, row.stop_name, row.borough, row.latitude, row.cbd) == ("59 ST-456NQRW", "Lexington Av/59 St", "M", 40.76, "Y")
    assert seeds.load_borough_map(spark, str(bm)).first().borough_desc == "Manhattan"
