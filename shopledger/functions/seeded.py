"""Seeded choice: pseudo-random but repeatable on every engine, retry and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(*parts: Column | str) -> Column:
    """Hex md5 of the parts joined with ':'. Plain strings are taken as literals."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.md5(F.concat_ws(":", *cols))


def hex_number(hex_digest: Column, start: int, length: int) -> Column:
    """Hex digits [start, start+length) of a digest (1-based) as a bigint; length <= 15."""
    return F.conv(F.substring(hex_digest, start, length), 16, 10).cast("bigint")


def ordinal(n: int | Column, *parts: Column | str) -> Column:
    """A repeatable number in [0, n)."""
    return hex_number(digest(*parts), 1, 8) % (F.lit(n) if isinstance(n, int) else n)
