"""Column-level helpers: every function returns a native Spark ``Column``."""

from odoflow.functions.columns import (
    BOROUGH_CODES,
    DOW_CODES,
    TOD_CODES,
    code_label,
    concat_skip_nulls,
    dow_sunday0,
    epoch_seconds,
    format_percent,
    format_thousands,
    hour_bucket,
    interval_hours,
    label_code,
    pct_change,
    seconds_between,
    sorted_letters,
    weekday_monday0,
)

__all__ = [
    "BOROUGH_CODES", "DOW_CODES", "TOD_CODES", "code_label", "concat_skip_nulls", "dow_sunday0",
    "epoch_seconds", "format_percent", "format_thousands", "hour_bucket", "interval_hours",
    "label_code", "pct_change", "seconds_between", "sorted_letters", "weekday_monday0",
]
