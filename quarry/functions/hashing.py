"""Seeded, partition-independent pseudo-randomness.

Spark's ``rand(seed)`` depends on partitioning; Python's generator cannot be
replayed on executors. Every draw here is a pure function of (tag, seed, key,
draw index) through md5, so results are identical under any partitioning and
can be recomputed by the DuckDB oracle with the same expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(tag: str, seed: int, *keys) -> Column:
    """32 lowercase hex digits of md5('tag|seed|k1|k2..')."""
    parts = [F.lit(tag), F.lit(str(seed))] + [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def hex8_to_long(h: Column) -> Column:
    """First 8 hex digits of a hash as a BIGINT in [0, 2^32)."""
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def uniform_int(h: Column, lo: int, hi: int) -> Column:
    """Integer in [lo, hi] drawn from hash string ``h``."""
    return F.lit(lo) + F.pmod(hex8_to_long(h), F.lit(hi - lo + 1))
