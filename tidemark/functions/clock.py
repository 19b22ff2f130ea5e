"""Clock arithmetic: millisecond instants, ISO text, month and minute buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms(ts: Column) -> Column:
    """Whole milliseconds since the epoch, rounded down."""
    return F.unix_millis(ts.cast("timestamp"))


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def elapsed_ms(start: Column, end: Column) -> Column:
    """Difference of two clocks after both are cut to whole milliseconds."""
    return epoch_ms(end) - epoch_ms(start)


def truncate_ms(ts: Column) -> Column:
    return F.date_trunc("MILLISECOND", ts)


def start_of_minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def iso_ms(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def iso_us(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def now_ms() -> Column:
    return truncate_ms(F.current_timestamp())
