"""SQL of DuckDB for what Spark has as a function."""

from __future__ import annotations


def crc32_sql(value: str) -> str:
    """Unsigned CRC-32 of a string of ASCII characters, bit by bit."""
    step = "lambda x, i: xor(x >> 1, (x & 1) * 3988292384)"
    byte = f"lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 1, 2, 3, 4, 5, 6, 7]), {step})"
    codes = f"list_transform(string_split({value}, ''), lambda s: CAST(ord(s) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), {byte}), 4294967295)"
