"""Seeded hash order, identical in Spark and in the SQL oracle.

``md5(seed || ':' || key)`` gives a uniform, reproducible order that any
engine can recompute; ties (impossible in practice) fall back to the key.
The first eight hex digits, read as an unsigned 32-bit integer, give a
uniform bucket used to split prefix sums into bounded pieces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hash_order(seed, key) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), _c(key).cast("string")))


def hash_bucket(hash_hex, bits: int) -> Column:
    """Top ``bits`` bits of the 32-bit prefix of an md5 hex string."""
    prefix = F.conv(F.substring(_c(hash_hex), 1, 8), 16, 10).cast("bigint")
    return F.shiftright(prefix, 32 - bits)
