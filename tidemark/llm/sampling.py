"""Bounded samples by a hash of the row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS = 1 << 30


def chance(seed: int, *columns: str) -> Column:
    """A fixed number in [0, 1) for each row, the same in every run."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(_STEPS)) / F.lit(float(_STEPS))


def fold(column: str, parts: int) -> Column:
    """crc32 of the column as text, modulo ``parts``; 0 for null."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts)), F.lit(0))
