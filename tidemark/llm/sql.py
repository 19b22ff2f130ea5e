"""Pieces of SQL for the engine that checks the text queries and lacks some functions."""

from __future__ import annotations

#: A table ``crc_table`` with the 256 remainders ``t`` of the crc32 polynomial.
CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS c
    FROM range(0, 256) r(i)))"""


def crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes; the query must read ``crc_table``."""
    octets = f"list_transform(range(0, strlen({text})), lambda i: CAST('0x' || substr(hex({text}), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({octets}, lambda c, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


def lower(text: str) -> str:
    """A-Z in lower case, a null text empty."""
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
