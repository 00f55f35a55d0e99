"""Randomness as a function of the row key.

Every random choice in the package is an md5 of the key and a purpose, so it depends neither on
partitioning nor on task order, survives recomputation after a lost executor, and can be repeated
by any engine that has md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 12  # 48 bits: exact in a double


def keyed_hash(key: Column | str, *salt: object) -> Column:
    """Hex md5 of ``key`` and the salt values (literals or columns), joined by colons."""
    key = F.col(key) if isinstance(key, str) else key
    parts = [s.cast("string") if isinstance(s, Column) else F.lit(str(s)) for s in salt]
    return F.md5(F.concat_ws(":", key.cast("string"), *parts))


def unit_interval(hashed: Column | str) -> Column:
    """The hash as a number in [0, 1); it never decreases as the hash text grows."""
    hashed = F.col(hashed) if isinstance(hashed, str) else hashed
    number = F.conv(F.substring(hashed, 1, _HEX_DIGITS), 16, 10).cast("double")
    return number / F.lit(float(16**_HEX_DIGITS))
