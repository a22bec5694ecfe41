"""Rejected lines, reconciliation and the landing manifest, on real files."""

import os
from datetime import date

import pytest

from odoflow.sources import calendar, files, landing

HEADER = "C/A,UNIT,SCP,STATION,LINENAME,DIVISION,DATE,TIME,DESC,ENTRIES,EXITS                    "
GOOD = "A002,R051,02-00-00,59 ST,NQR456W,BMT,01/02/2024,03:00:00,REGULAR,{n},20"
BAD = {
    "A002,R051,02-00-00,59 ST": "fields",
    GOOD.format(n=1) + ",extra": "fields",
    "A002,R051,02-00-00,59 ST,NQR456W,BMT,02/30/2024,03:00:00,REGULAR,1,20": "date",
    "A002,R051,02-00-00,59 ST,NQR456W,BMT,,03:00:00,REGULAR,1,20": "date",
    "A002,R051,02-00-00,59 ST,NQR456W,BMT,01/02/2024,24:00:00,REGULAR,1,20": "time",
    "A002,R051,02-00-00,59 ST,NQR456W,BMT,01/02/2024,,REGULAR,1,20": "time",
    "A002,R051,02-00-00,59 ST,NQR456W,BMT,01/02/2024,03:00:00,REGULAR,99999999999,20": "counter",
    "A002,R051,02-00-00,59 ST,NQR456W,BMT,01/02/2024,03:00:00,REGULAR,1,x": "counter",
}


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.writelines(x + "\n" for x in lines)


@pytest.fixture
def folder(tmp_path):
    d = str(tmp_path / "landing")
    _write(d, "turnstile_240106.txt", [HEADER, GOOD.format(n=1), *BAD, "", GOOD.format(n=2)])
    # two files pasted together, and a file without a header
    _write(d, "turnstile_240113.txt", [HEADER, GOOD.format(n=3), HEADER, "  " + GOOD.format(n=4).replace(",4,", ", 4 ,")])
    _write(d, "turnstile_240120.txt", [GOOD.format(n=5), GOOD.format(n=5)])
    return d


def test_every_line_is_a_row_a_reject_a_header_or_blank(spark, folder):
    lines = landing.read_lines(spark, folder)
    loaded = landing.LoadedLines.load(lines, files.scratch_path(spark, "t-loaded"))
    assert sorted(r.ENTRY_COUNTER for r in loaded.rows().collect()) == [1, 2, 3, 4, 5, 5]
    row = loaded.rows().where("ENTRY_COUNTER = 4").first()
    assert (row["C/A"], row.DATE, row.TIME, row.DESC) == ("A002", date(2024, 1, 2), "03:00:00", "REGULAR")
    assert {r.line: r.reason for r in loaded.rejects().collect()} == BAD
    got = {r.delivery: (r.lines, r.rows, r.rejects, r.headers, r.blanks, r.difference) for r in loaded.reconcile(lines).collect()}
    assert got == {"240106": (12, 2, 8, 1, 1, 0), "240113": (4, 2, 0, 2, 0, 0), "240120": (2, 2, 0, 0, 0, 0)}


def test_accepted_rows_equal_the_strict_reader_on_clean_files(spark, tmp_path):
    d = str(tmp_path / "clean")
    _write(d, "turnstile_240106.txt", [HEADER, *[GOOD.format(n=i) for i in range(50)]])
    loaded = landing.LoadedLines.load(landing.read_lines(spark, d), files.scratch_path(spark, "t-clean"))
    strict = files.read_reading_files(spark, d, with_source=False)
    assert loaded.rows().dtypes == strict.dtypes
    assert loaded.rows().exceptAll(strict).isEmpty() and strict.exceptAll(loaded.rows()).isEmpty()


def test_a_second_load_of_the_same_file_shows(spark, folder):
    lines = landing.read_lines(spark, folder)
    path = files.scratch_path(spark, "t-twice")
    landing.LoadedLines.load(lines, path)
    twice = landing.LoadedLines.load(lines.where("delivery = '240120'"), path)
    assert {r.delivery: r.difference for r in twice.reconcile(lines).collect()} == {"240106": 0, "240113": 0, "240120": -2}


def test_manifest_names_new_changed_rewritten_gone_and_missing_files(spark, folder):
    manifest = landing.LandingManifest(spark, files.scratch_path(spark, "t-manifest"))
    assert manifest.last_run() == 0
    first = manifest.record(folder)
    status = {r.delivery: (r.status, r.rewritten) for r in manifest.report(first).collect()}
    assert status == {w: ("new", False) for w in ("240106", "240113", "240120")}

    _write(folder, "turnstile_240113.txt", [HEADER, GOOD.format(n=3), GOOD.format(n=6)])  # one line exchanged
    _write(folder, "turnstile_240120.txt", [GOOD.format(n=5), GOOD.format(n=5), ""])
    _write(folder, "turnstile_240127.txt", [HEADER])
    second = manifest.record(folder)
    _write(folder, "turnstile_240120.txt", ["", GOOD.format(n=5), GOOD.format(n=5)])  # the same lines in another order
    os.utime(os.path.join(folder, "turnstile_240120.txt"), (2_000_000_000, 2_000_000_000))
    os.unlink(os.path.join(folder, "turnstile_240127.txt"))
    third = manifest.record(folder)
    assert (first, second, third) == (1, 2, 3)

    due = calendar.expected_saturdays(spark, date(2024, 1, 1), date(2024, 2, 3))
    got = {r.delivery: (r.status, r.rewritten, r.lines) for r in manifest.report(second, due).collect()}
    assert got == {
        "240106": ("same", False, 12), "240113": ("changed", False, 3), "240120": ("changed", False, 3),
        "240127": ("new", False, 1), "240203": ("missing", False, 0),
    }
    got = {r.delivery: (r.status, r.rewritten) for r in manifest.report().collect()}
    assert got == {"240106": ("same", False), "240113": ("same", False), "240120": ("same", True), "240127": ("gone", False)}


def test_manifest_reads_only_what_its_listing_shows_as_new(spark, folder, monkeypatch):
    manifest = landing.LandingManifest(spark, files.scratch_path(spark, "t-reads"))
    manifest.record(folder)
    _write(folder, "turnstile_240203.txt", [HEADER, GOOD.format(n=9)])
    read, real = [], landing.read_lines
    monkeypatch.setattr(landing, "read_lines", lambda spark, paths, *a: read.extend(paths) or real(spark, paths, *a))
    manifest.record(folder)
    assert [os.path.basename(p) for p in read] == ["turnstile_240203.txt"]
    read.clear()
    manifest.record(folder)
    assert read == []


def test_an_unfinished_run_does_not_count(spark, folder):
    manifest = landing.LandingManifest(spark, files.scratch_path(spark, "t-cut"))
    manifest.record(folder)
    os.makedirs(f"{manifest.path}/run=000000002")
    assert manifest.last_run() == 1
    assert manifest.record(folder) == 2
