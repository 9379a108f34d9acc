"""Ordered per-dialog operators that stay balanced when one dialog is huge.

A Spark window gives each partition key to one task.  That is right for a dialog typed by
people and wrong for one that holds a third of a table.  ``by_dialog`` therefore counts rows
per dialog first (a map-side combined aggregate over one column):

* dialogs of ordinary size run as plain windows, all sharing one hash exchange on the key;
* larger ones are range-partitioned by (key, order) into *blocks* of bounded size.  Their
  windows run per block, and what has to cross a block border (the previous row, a running
  total, the last n rows) is carried over by a summary that has one row per block.

The helpers below (``lag_one``, ``lead_one``, ``running_sum``, ``last_n``, ``key_min``) look for
the block column and pick the right form, so an operator is written once.  A frame that
carries blocks is settled after each operator, so that summaries read columns, not lineages.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.plans.scratch import settle
from parley.schema import DIALOG, TIME_ORDER

BLOCK = "_block"

# A key with more rows than this is split into blocks of about this many rows, whatever the table's
# size.  Summaries have a row per split key and block; they are joined without a forced broadcast,
# so neither their rows nor their bytes need a bound.
MAX_ROWS_PER_KEY = 2_000_000


def by_dialog(
    df: DataFrame,
    fn: Callable[[DataFrame], DataFrame],
    order: Sequence[str] = TIME_ORDER,
    key: str = DIALOG,
    max_rows: int | None = None,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Apply ``fn``, a chain of ordered operators, to every dialog of ``df``.

    ``sizes_from`` names a cheaper table to count, one that has at least the rows of ``df``: the
    table before some filter, for instance.
    """
    limit = max_rows or MAX_ROWS_PER_KEY
    sizes = (sizes_from if sizes_from is not None else df).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    largest = sizes.agg(F.max("_rows")).first()[0]
    if not largest or largest <= limit:
        return fn(df)
    large = settle(sizes.where(F.col("_rows") > limit), "large-keys")
    large_rows = large.agg(F.sum("_rows")).first()[0]
    # A null key is a key like any other.
    large_keys = large.select(F.col(key).alias("_large"))
    is_large = F.col(key).eqNullSafe(F.col("_large"))
    small_part = df.join(large_keys, is_large, "left_anti")
    large_part = assign_blocks(
        df.join(large_keys, is_large, "left_semi"), (key, *order), -(-large_rows // limit) + 1
    )
    return fn(small_part).unionByName(fn(large_part).drop(BLOCK))


def assign_blocks(df: DataFrame, order: Sequence[str], blocks: int) -> DataFrame:
    """Number contiguous, evenly filled ranges of ``df`` in ``order`` (which must be unique)."""
    ranged = df.repartitionByRange(int(blocks), *order).sortWithinPartitions(*order)
    return settle(ranged.withColumn(BLOCK, F.spark_partition_id()), "blocks")


def has_blocks(df: DataFrame) -> bool:
    return BLOCK in df.columns


def settle_blocks(df: DataFrame) -> DataFrame:
    """Settle a frame that carries blocks; leave a plain one lazy."""
    return settle(df, "blocks") if has_blocks(df) else df


def _row_window(df: DataFrame, order: Sequence[str], key: str):
    parts = [key, BLOCK] if has_blocks(df) else [key]
    return Window.partitionBy(*parts).orderBy(*order)


def _carry(df: DataFrame, summary: DataFrame, key: str) -> DataFrame:
    # One row per (split key, block).  Blocks are of even size, so the join has no hot key.
    named = summary.withColumnsRenamed({key: "_skey", BLOCK: "_sblock"})
    same = F.col(key).eqNullSafe(F.col("_skey")) & (F.col(BLOCK) == F.col("_sblock"))
    return df.join(named, same, "left").drop("_skey", "_sblock")


def _neighbour(df, out, value, order, key, previous: bool) -> DataFrame:
    window = _row_window(df, order, key)
    boxed = F.struct(value.alias("v"))
    near = (F.lag if previous else F.lead)(boxed).over(window)
    if not has_blocks(df):
        return df.withColumn(out, near["v"])
    edge = (F.max_by if previous else F.min_by)(boxed, F.struct(*order))
    across = Window.partitionBy(key).orderBy(BLOCK)
    summary = df.groupBy(key, BLOCK).agg(edge.alias("_edge"))
    summary = summary.select(
        key, BLOCK, (F.lag if previous else F.lead)("_edge").over(across).alias("_edge")
    )
    joined = _carry(df, summary, key)
    return joined.withColumn(out, F.coalesce(near, F.col("_edge"))["v"]).drop("_edge")


def lag_one(df: DataFrame, out: str, value: Column, order: Sequence[str] = TIME_ORDER, key: str = DIALOG):
    """Add ``value`` of the row before this one in its dialog."""
    return _neighbour(df, out, value, order, key, previous=True)


def lead_one(df: DataFrame, out: str, value: Column, order: Sequence[str] = TIME_ORDER, key: str = DIALOG):
    """Add ``value`` of the row after this one in its dialog."""
    return _neighbour(df, out, value, order, key, previous=False)


def running_sum(df: DataFrame, out: str, value: Column, order: Sequence[str] = TIME_ORDER, key: str = DIALOG):
    """Add the sum of ``value`` over the rows of the dialog up to and including this one."""
    upto = _row_window(df, order, key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = F.sum(value).over(upto)
    if not has_blocks(df):
        return df.withColumn(out, local)
    before = Window.partitionBy(key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    summary = df.groupBy(key, BLOCK).agg(F.sum(value).alias("_sum"))
    summary = summary.select(
        key, BLOCK, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")
    )
    return _carry(df, summary, key).withColumn(out, local + F.col("_offset")).drop("_offset")


def last_n(df: DataFrame, out: str, value: Column, n: int, order: Sequence[str] = TIME_ORDER, key: str = DIALOG):
    """Add ``value`` of the up to ``n`` rows before this one, oldest first, as an array."""
    window = _row_window(df, order, key)
    local = F.collect_list(value).over(window.rowsBetween(-n, -1))
    if not has_blocks(df):
        return df.withColumn(out, local)
    backwards = Window.partitionBy(key, BLOCK).orderBy(*[F.desc(c) for c in order])
    tail = df.select(key, BLOCK, F.struct(*order).alias("_at"), value.alias("_value"), *order)
    tail = tail.withColumn("_back", F.row_number().over(backwards)).where(F.col("_back") <= n)
    tail = tail.groupBy(key, BLOCK).agg(
        F.sort_array(F.collect_list(F.struct("_at", "_value")))["_value"].alias("_tail")
    )
    before = Window.partitionBy(key).orderBy(BLOCK).rowsBetween(-n, -1)
    tail = tail.select(key, BLOCK, F.flatten(F.collect_list("_tail").over(before)).alias("_tail"))
    # Cut to the last n before it travels to the rows of the block.
    tail = tail.withColumn("_tail", F.slice("_tail", F.greatest(F.size("_tail") - n + 1, F.lit(1)), F.lit(n)))
    rows = F.concat(F.coalesce(F.col("_tail"), F.array()), local)
    joined = _carry(df, tail, key).withColumn(out, rows).drop("_tail")
    start = F.greatest(F.size(out) - n + 1, F.lit(1))
    return joined.withColumn(out, F.slice(out, start, F.lit(n)))


def key_min(df: DataFrame, out: str, value: Column, order: Sequence[str] = TIME_ORDER, key: str = DIALOG):
    """Add the smallest ``value`` of the dialog, for a value that never falls in ``order``.

    That makes it a running minimum, which needs neither a second sort nor a buffered dialog.
    """
    if not has_blocks(df):
        upto = _row_window(df, order, key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.min(value).over(upto))
    lowest = df.groupBy(key, BLOCK).agg(F.min(value).alias("_low"))
    whole = Window.partitionBy(key)
    return _carry(df, lowest.select(key, BLOCK, F.min("_low").over(whole).alias(out)), key)
