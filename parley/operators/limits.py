"""Limits, samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.draws import draw_key, uniform
from parley.plans.ranking import first_rows, up_to, with_position, with_running_total
from parley.plans.sequence import by_dialog, running_sum
from parley.schema import DIALOG, SEQ, TIME_ORDER

# Up to here Spark cuts each task's share of a dialog to the limit before the shuffle.
GROUP_LIMIT = 1_000


def latest_per_dialog(df: DataFrame, n: int, max_rows: int | None = None) -> DataFrame:
    """The newest ``n`` messages of each dialog."""
    if n <= GROUP_LIMIT:
        newest = Window.partitionBy(DIALOG).orderBy(*[F.desc(c) for c in TIME_ORDER])
        return df.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= n).drop("_back")
    sizes = df.groupBy(DIALOG).agg(F.count(F.lit(1)).alias("_size"))
    placed = by_dialog(df, lambda part: running_sum(part, "_pos", F.lit(1).cast("bigint")), max_rows=max_rows)
    kept = placed.join(sizes, DIALOG).where(F.col("_pos") > F.col("_size") - n)
    return kept.drop("_pos", "_size")


def _dialogs(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per dialog: its size and the columns of its first row in ``order``."""
    first = F.min(F.struct(*order)).alias("_at")
    sizes = df.groupBy(DIALOG).agg(F.count(F.lit(1)).cast("bigint").alias("_size"), first)
    return sizes.select(DIALOG, "_size", *[F.col("_at")[c].alias(f"_o{i}") for i, c in enumerate(order)])


def limit_messages(df: DataFrame, limit: int, order: Sequence[str] = TIME_ORDER) -> DataFrame:
    """Whole dialogs, in the order of their first row, until ``limit`` rows are reached.

    The dialog that crosses the limit is kept.  No dialog is empty, so at most ``limit`` dialogs
    can be needed.
    """
    ranks = [f"_o{i}" for i in range(len(order))] + [DIALOG]
    nearest = first_rows(_dialogs(df, order), limit, ranks)
    summed = with_running_total(nearest, "_total", F.col("_size"), ranks)
    kept = summed.where(F.col("_total") - F.col("_size") < limit).select(DIALOG)
    return df.join(kept, DIALOG, "left_semi")


def limit_dialogs(df: DataFrame, n: int, order: Sequence[str] = TIME_ORDER) -> DataFrame:
    """The first ``n`` dialogs in the order of their first row."""
    ranks = [f"_o{i}" for i in range(len(order))] + [DIALOG]
    return df.join(first_rows(_dialogs(df, order), n, ranks).select(DIALOG), DIALOG, "left_semi")


def head_rows(df: DataFrame, n: int, order: Sequence[str] = (SEQ,)) -> DataFrame:
    return first_rows(df, n, order)


def sample_exact(df: DataFrame, n: int, ids: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` random rows without replacement; ``ids`` identify a row."""
    keyed = df.withColumn("_key", draw_key(f"{seed}-sample", *[F.col(c) for c in ids]))
    return first_rows(keyed, n, ("_key", *ids)).drop("_key")


def _cut(df: DataFrame, order: Sequence[str], fraction: float) -> DataFrame:
    train = up_to(df, int(df.count() * fraction), order)
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def with_ordered_split(df: DataFrame, order: Sequence[str], fraction: float = 0.9) -> DataFrame:
    """Add ``split``: ``train`` for the first floor(n * fraction) rows in ``order``, else ``test``."""
    return _cut(df, order, fraction)


def with_random_split(df: DataFrame, ids: Sequence[str], fraction: float = 0.9, seed: int = 42, exact: bool = False) -> DataFrame:
    """Add a random ``split`` that depends on the row's ids only.

    The default needs no shuffle and hits ``fraction`` in expectation; ``exact`` orders the rows
    by the draw and cuts at floor(n * fraction).
    """
    columns = [F.col(c) for c in ids]
    if not exact:
        train = uniform(f"{seed}-split", *columns) < fraction
        return df.withColumn("split", F.when(train, "train").otherwise("test"))
    keyed = df.withColumn("_key", draw_key(f"{seed}-split", *columns))
    return _cut(keyed, ("_key", *ids), fraction).drop("_key")


def _two(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(df.where(F.col("split") == part).drop("split") for part in ("train", "test"))


def split_ordered(df: DataFrame, order: Sequence[str], fraction: float = 0.9) -> tuple[DataFrame, DataFrame]:
    return _two(with_ordered_split(df, order, fraction))


def split_random(df: DataFrame, ids: Sequence[str], fraction: float = 0.9, seed: int = 42, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    return _two(with_random_split(df, ids, fraction, seed, exact))


def assign_chunks(df: DataFrame, chunks: int, order: Sequence[str]) -> DataFrame:
    """Add ``chunk`` (1-based): contiguous parts in ``order`` whose sizes differ by at most one.

    The first chunks are the longer ones; a row's chunk follows from its position.
    """
    if chunks < 1:
        raise ValueError("chunks must be at least 1")
    placed = with_position(df, "_pos", order)
    size, longer = divmod(df.count(), chunks)
    at = F.col("_pos") - 1
    within_longer = F.floor(at / (size + 1))
    after = longer + F.floor((at - longer * (size + 1)) / max(size, 1))
    chunk = F.when(at < longer * (size + 1), within_longer).otherwise(after) + 1
    return placed.withColumn("chunk", chunk.cast("bigint")).drop("_pos")
