"""Text helpers for error details, previews and log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DETAIL = 256
PREVIEW_CHARS = 160

# Characters that end a line, and characters trimmed as blanks.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
OUTER_BLANKS = r"^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+$"
NOT_BLANK = r"[^\s\p{Z}\x1c-\x1f\x85]"


def strip(text: Column) -> Column:
    """Remove Unicode blanks from both ends."""
    return F.regexp_replace(text, OUTER_BLANKS, "")


def bounded_detail(text: Column, limit: int = MAX_DETAIL) -> Column:
    """One line of at most ``limit`` characters; longer text ends in three dots."""
    line = strip(F.regexp_replace(text, LINE_BREAK, " "))
    return F.when(F.length(line) > limit, F.concat(F.left(line, F.lit(limit - 3)), F.lit("..."))).otherwise(line)


def preview(text: Column, chars: int = PREVIEW_CHARS) -> Column:
    return F.left(text, F.lit(chars))


def last_savepoint_path(text: Column) -> Column:
    """The path named by the last completion notice in a text, without closing punctuation."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)Savepoint completed\.\s*Path:\s*(\S+)"), F.lit(1))
    return F.regexp_replace(F.try_element_at(found, F.lit(-1)), r"[.,;\"']+$", "")


def strict_flag(value: Column, name: str) -> Column:
    """Read the words true and false; any other text stops the query."""
    wrong = F.raise_error(F.lit(f"{name} must be exactly 'true' or 'false'"))
    return F.when(value == "true", F.lit(True)).when(value == "false", F.lit(False)).otherwise(wrong.cast("boolean"))
