"""The lateness verdict of one event against the watermark at its arrival."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import LONG_MIN


def usable_watermark(watermark_ms: Column) -> Column:
    """NULL until a first watermark exists; the smallest long is the 'none yet' marker."""
    return F.when(watermark_ms > F.lit(LONG_MIN), watermark_ms)


def is_late(event_ms: Column, watermark_ms: Column) -> Column:
    return F.coalesce(event_ms <= usable_watermark(watermark_ms), F.lit(False))


def lateness_ms(event_ms: Column, watermark_ms: Column) -> Column:
    behind = usable_watermark(watermark_ms) - event_ms
    return F.greatest(F.coalesce(behind, F.lit(0)), F.lit(0)).cast("long")
