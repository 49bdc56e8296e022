"""Deterministic hash keys: reproducible sampling and tie order.

md5 is a built-in in Spark and in common SQL engines, so a sample or an
order defined by it can be re-derived anywhere, and it is uniform, so
ranges of it split any group evenly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60  # 15 hex digits of md5 fit a signed bigint


def hash_hex(key: Column, seed: int | str = 42) -> Column:
    """md5 of '<seed>|<key>' as 32 hex digits."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def hash_key(key: Column, seed: int | str = 42) -> Column:
    """Uniform integer in [0, 2^60) from the first 15 hex digits."""
    return F.conv(F.substring(hash_hex(key, seed), 1, 15), 16, 10).cast("bigint")


def unit_score(key: Column, seed: int | str = 42) -> Column:
    """Deterministic pseudo score in {0, 0.001, ..., 0.999}: first 8 hex
    digits modulo 1000, over 1000 (ties on purpose)."""
    return (F.conv(F.substring(hash_hex(key, seed), 1, 8), 16, 10).cast("bigint") % 1000).cast("double") / 1000.0
