"""Duplicate removal and first rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.schema import DIALOG, ELAPSED, SEQ, TIME_ORDER


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row in ``order`` of every group.

    An aggregate, not a window: each task sends one row per group it has seen, so a group that
    holds most of the table costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    first = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def dedup_questions(df: DataFrame) -> DataFrame:
    """Keep each question once: its first row by dialog and time."""
    return first_per_group(df, ["question"], (DIALOG, ELAPSED, SEQ))


def first_message_per_dialog(df: DataFrame) -> DataFrame:
    return first_per_group(df, [DIALOG], TIME_ORDER)
