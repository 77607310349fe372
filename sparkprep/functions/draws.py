"""Seeded randomness as a function of the row key.

A draw depends on nothing but the seed and the key, so a result is the same
under any partitioning, task order or retry.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def draw_hex(seed: int, *keys: str | Column) -> Column:
    """The md5 of ``seed:key[:key...]`` in hex; sorting by it shuffles rows."""
    parts = [F.lit(str(seed))] + [_col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def draw_int(seed: int, *keys: str | Column) -> Column:
    """The first 32 bits of the draw as a BIGINT in [0, 2**32)."""
    return F.conv(F.substring(draw_hex(seed, *keys), 1, 8), 16, 10).cast("bigint")


def draw_unit(seed: int, *keys: str | Column) -> Column:
    """A uniform double in [0, 1)."""
    return draw_int(seed, *keys) / F.lit(4294967296.0)


def _col(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key
