"""Numeric predicates and the repeatable integer mixing used for sampling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2_147_483_647


def text_hash(value: Column) -> Column:
    """A number of 28 bits from a text, by MD5, which every engine has; NULL is taken for the empty text."""
    return F.conv(F.left(F.md5(F.coalesce(value, F.lit(""))), F.lit(7)), 16, 10).cast("long")


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def is_decimal_milestone(n: Column) -> Column:
    """True for 1, 10, 100, ..."""
    return (n >= 1) & n.cast("string").rlike("^10*$")


def mix(n: Column, salt: int) -> Column:
    """A repeatable number in [0, PRIME) from an integer, different for each salt.

    Two rounds of modular multiplication with a shift in between; plain BIGINT arithmetic, so any
    engine gives the same value and no row depends on another one.
    """
    seed = F.pmod(n + F.lit(salt * 7_919), F.lit(PRIME))
    first = F.pmod(seed * F.lit(48_271) + F.lit(salt + 1), F.lit(PRIME))
    folded = first.bitwiseXOR(F.shiftright(first, 15))
    return F.pmod(folded * F.lit(69_621) + F.lit(12_345), F.lit(PRIME))


def uniform(n: Column, salt: int) -> Column:
    """A repeatable fraction in [0, 1)."""
    return mix(n, salt) / F.lit(float(PRIME))


def pick(n: Column, salt: int, size: int) -> Column:
    """A repeatable index in [0, size)."""
    return F.pmod(mix(n, salt), F.lit(size))
