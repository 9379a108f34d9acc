"""Reproducible random draws.

Every draw is an md5 of (seed, row id, ...), so it does not depend on partitioning, survives
recomputation after a lost executor, and can be checked in any other engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw_key(seed: int | str, *parts: Column) -> Column:
    """A hexadecimal key that orders rows (or array positions) at random."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def uniform(seed: int | str, *parts: Column) -> Column:
    """A number in [0, 1): the first 13 hex digits of the key."""
    digits = F.conv(F.substring(draw_key(seed, *parts), 1, 13), 16, 10)
    return digits.cast("bigint").cast("double") / F.lit(float(16**13))
