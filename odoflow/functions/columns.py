"""Scalar expressions with the exact semantics the pipelines need.

Each helper documents the trap it covers: NULL-skipping concatenation,
Sunday-based weekday numbers, second-boundary differences, half-up hour
buckets and ANSI-safe ratios.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Dashboard code maps (label -> code), as used by the cohort filters.
BOROUGH_CODES: dict[str, int] = {
    "Manhattan below 63 St": 1,
    "Manhattan above 63 St": 2,
    "Brooklyn": 3,
    "Queens": 4,
    "Bronx": 5,
}
DOW_CODES: dict[str, int] = {
    "Sunday": 0,
    "Monday": 1,
    "Tuesday": 2,
    "Wednesday": 3,
    "Thursday": 4,
    "Friday": 5,
    "Saturday": 6,
}
TOD_CODES: dict[str, int] = {
    "4:00am": 4,
    "8:00am": 8,
    "12:00 noon": 12,
    "4:00pm": 16,
    "8:00pm": 20,
    "12:00 midnight": 24,
}



def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_skip_nulls(*cols: ColumnOrName) -> Column:
    """SQL-style CONCAT that skips NULL arguments (Spark ``concat`` returns NULL).

    All-NULL input gives the empty string. Non-string inputs are cast.
    """
    return F.concat_ws("", *[_col(c).cast("string") for c in cols])


def dow_sunday0(d: ColumnOrName) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6 (as ``date_part('dow')``)."""
    return F.dayofweek(_col(d)) - 1


def weekday_monday0(d: ColumnOrName) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6 (pandas ``.dt.weekday``)."""
    return F.weekday(_col(d))


def sorted_letters(s: ColumnOrName) -> Column:
    """The characters of a string in sorted order ('NQR456W' -> '456NQRW')."""
    return F.array_join(F.array_sort(F.split(_col(s), "")), "")


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ, free of any time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, _col(ts).cast("timestamp_ntz"))


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of second boundaries crossed from ``start`` to ``end``.

    This is ``date_diff('second', start, end)``: it differs from a count of
    whole elapsed seconds when the inputs carry fractions of a second.
    """
    return epoch_seconds(end) - epoch_seconds(start)


def interval_hours(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``day * 24 + hour`` of the interval ``end - start`` (BIGINT)."""
    iv = _col(end).cast("timestamp_ntz") - _col(start).cast("timestamp_ntz")
    return (F.extract(F.lit("DAY"), iv).cast("long") * 24 + F.extract(F.lit("HOUR"), iv).cast("long"))


def hour_bucket(ts: ColumnOrName, width_hours: int = 4) -> Column:
    """Hour of day rounded half-up to the nearest multiple of ``width_hours``.

    ``width * round((hour + minute / 60) / width)`` done in integer minutes,
    so 22:00 -> 24, 01:59 -> 0, 02:00 -> 4. Result 0..24 (INT).
    """
    minutes = F.hour(_col(ts)) * 60 + F.minute(_col(ts))
    span = width_hours * 60
    return (F.floor((minutes + span // 2) / span) * width_hours).cast("int")


def pct_change(value: ColumnOrName, base: ColumnOrName) -> Column:
    """``value / base - 1``; NULL when ``base`` is 0 or NULL (no ANSI error)."""
    return F.try_divide(_col(value).cast("double"), _col(base).cast("double")) - F.lit(1.0)


def format_thousands(x: ColumnOrName, decimals: int = 0) -> Column:
    """'1,234,568' style text."""
    return F.format_number(_col(x).cast("double"), decimals)


def format_percent(ratio: ColumnOrName, decimals: int = 1) -> Column:
    """A ratio as percent text, e.g. 0.1234 -> '12.3%'."""
    # + 0.0 turns a rounded -0.0 into 0.0
    return F.format_string(f"%.{decimals}f%%", F.round(_col(ratio) * 100, decimals) + F.lit(0.0))


def label_code(mapping: Mapping[str, int], label: ColumnOrName) -> Column:
    """Label -> code through a literal map (no join, stays in codegen)."""
    pairs = [x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), _col(label))


def code_label(mapping: Mapping[str, int], code: ColumnOrName) -> Column:
    """Code -> label through the inverted literal map."""
    pairs = [x for k, v in mapping.items() for x in (F.lit(v), F.lit(k))]
    return F.try_element_at(F.create_map(*pairs), _col(code))
