"""Whole-table positions and running totals without a single-task window.

``row_number()`` over an unpartitioned window moves the whole table into one task.  Here the
table is range-partitioned by the order instead; one summary row per range gives the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.plans.sequence import BLOCK, assign_blocks

# Rows per range; there are as many ranges as the table needs.
ROWS_PER_RANGE = 1_000_000
# Up to here ``orderBy().limit(n)`` (a per-task top n, merged on the driver) is the better plan.
MAX_TOP_N = 10_000


def _ranges(df: DataFrame, order: Sequence[str], rows_per_range: int | None) -> DataFrame:
    rows = df.count()
    ranges = -(-rows // (rows_per_range or ROWS_PER_RANGE))
    return assign_blocks(df, order, max(1, ranges))


def with_running_total(
    df: DataFrame,
    out: str,
    value: Column,
    order: Sequence[str],
    rows_per_range: int | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over all rows up to this one in ``order``.

    ``order`` must be unique over the table; end it with a tie-breaker.
    """
    ranged = _ranges(df, order, rows_per_range)
    upto = Window.partitionBy(BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = ranged.groupBy(BLOCK).agg(F.sum(value).alias("_sum"))
    # One row per million rows of the table: these may share a task.
    before = Window.partitionBy(F.lit(0)).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        BLOCK, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")
    )
    return (
        ranged.join(offsets, BLOCK)
        .withColumn(out, F.sum(value).over(upto) + F.col("_offset"))
        .drop(BLOCK, "_offset")
    )


def with_position(df: DataFrame, out: str, order: Sequence[str], rows_per_range: int | None = None):
    """Add the 1-based position of each row in ``order`` (which must be unique)."""
    return with_running_total(df, out, F.lit(1).cast("bigint"), order, rows_per_range)


def up_to(df: DataFrame, n: int, order: Sequence[str]) -> Column:
    """True for the first ``n`` rows of ``df`` in ``order`` (which must be unique).

    Only the order columns are sorted; the key found at position ``n`` then splits the table by
    a plain comparison, so its other columns are neither shuffled nor written.
    """
    if n < 1:
        return F.lit(False)
    placed = with_position(df.select(*order), "_pos", order)
    cut = placed.where(F.col("_pos") == n).select(F.struct(*order)).scalar()
    return F.coalesce(F.struct(*order) <= cut, F.lit(True))


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in ``order``; exact for any ``n``."""
    if n <= MAX_TOP_N:
        return df.orderBy(*order).limit(n)
    return df.where(up_to(df, n, order))
