"""Elapsed time, conversations by time gap, rolling context, dialog order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.dates import whole_seconds
from parley.plans.sequence import by_dialog, key_min, lag_one, last_n, running_sum, settle_blocks
from parley.schema import CONVERSATION, DATE, DIALOG, ELAPSED, NO_CONTEXT, SEQ, TIME_ORDER

# A pause longer than this starts a new conversation (seconds).
CONVERSATION_GAP = 21_600
CONTEXT_SIZE = 10

STYLES = ("tags", "plain", "chat")
PAIR_ORDER = (ELAPSED, SEQ)
# The same order where the pairs still carry their dates; it continues the order of the messages.
DATED_PAIR_ORDER = ("timestamp", SEQ)


def elapsed_part(df: DataFrame, date: str = DATE) -> DataFrame:
    """``with_elapsed`` for one part of ``by_dialog``."""
    df = key_min(df, "_first", F.col(date), (date, SEQ))
    return df.withColumn(ELAPSED, whole_seconds(F.col("_first"), F.col(date))).drop("_first")


def with_elapsed(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Add whole seconds since the first message of the dialog."""
    return by_dialog(df, elapsed_part, max_rows=max_rows)


def conversation_part(df: DataFrame, gap_seconds: int = CONVERSATION_GAP, order: Sequence[str] = PAIR_ORDER) -> DataFrame:
    """``sessionize`` for one part of ``by_dialog``; keeps the pause as ``_pause``."""
    df = lag_one(df, "_before", F.col(ELAPSED), order)
    df = df.withColumn("_pause", F.coalesce(F.col(ELAPSED) - F.col("_before"), F.lit(0))).drop("_before")
    df = settle_blocks(df)
    return settle_blocks(running_sum(df, CONVERSATION, (F.col("_pause") > gap_seconds).cast("bigint"), order))


def sessionize(df: DataFrame, gap_seconds: int = CONVERSATION_GAP, order: Sequence[str] = PAIR_ORDER, max_rows: int | None = None) -> DataFrame:
    """Number the conversations of each dialog from 0: a new one starts after a longer pause."""
    return by_dialog(df, lambda part: conversation_part(part, gap_seconds, order).drop("_pause"), order, max_rows=max_rows)


def render_pairs(pairs: Column, style: str) -> Column:
    """Text of an array of (q, a) structs, the oldest numbered 1."""
    if style == "plain":
        one = lambda p, i: F.concat(
            F.lit("Q"), (i + 1).cast("string"), F.lit(": "), p["q"], F.lit(". A"), (i + 1).cast("string"), F.lit(": "), p["a"], F.lit(" || ")
        )
    else:
        one = lambda p, i: F.concat(
            F.lit(" <Q"), (i + 1).cast("string"), F.lit("> "), p["q"], F.lit(" <A"), (i + 1).cast("string"), F.lit("> "), p["a"]
        )
    return F.array_join(F.transform(pairs, one), "" if style == "chat" else " ")


def context_part(
    df: DataFrame,
    size: int = CONTEXT_SIZE,
    style: str = "plain",
    scope: str = "session",
    gap_seconds: int = CONVERSATION_GAP,
    order: Sequence[str] = PAIR_ORDER,
) -> DataFrame:
    """``add_context`` for one part of ``by_dialog``."""
    df = conversation_part(df, gap_seconds, order)
    pair = F.struct(F.col("question").alias("q"), F.col("answer").alias("a"), F.col(CONVERSATION).alias("c"))
    df = last_n(df, "_pairs", pair, size, order)
    if scope == "session":
        # Conversations are contiguous, so the last pairs of the dialog hold the last pairs of
        # the conversation: one window serves both scopes.
        here = F.filter(F.col("_pairs"), lambda p: p["c"] == F.col(CONVERSATION))
        fresh = F.size(here) == 0
    else:
        here = F.col("_pairs")
        fresh = (F.size(here) == 0) | (F.col("_pause") > gap_seconds)
    text = F.when(fresh, F.lit(NO_CONTEXT)).otherwise(render_pairs(here, style))
    return settle_blocks(df.withColumn("context", text).drop("_pairs", "_pause"))


def add_context(
    df: DataFrame,
    size: int = CONTEXT_SIZE,
    style: str = "plain",
    scope: str = "session",
    gap_seconds: int = CONVERSATION_GAP,
    max_rows: int | None = None,
) -> DataFrame:
    """Add up to ``size`` previous question/answer pairs as text.

    ``scope="session"`` looks back inside the conversation only; ``scope="dialog"`` looks back
    over the whole dialog but leaves the row after a long pause without context.
    """
    if style not in STYLES or scope not in ("session", "dialog"):
        raise ValueError(f"unknown style {style!r} or scope {scope!r}")
    return by_dialog(df, lambda part: context_part(part, size, style, scope, gap_seconds), PAIR_ORDER, max_rows=max_rows)


def with_dialog_start(df: DataFrame) -> DataFrame:
    """Add the first date of each dialog as ``Date_first``."""
    starts = df.groupBy(DIALOG).agg(F.min(DATE).alias("Date_first"))
    return df.join(starts, DIALOG)


def order_dialogs_by_start(df: DataFrame) -> DataFrame:
    """Dialogs in the order of their first message, messages by time inside.

    The minimum is combined map-side and joined back, so a huge dialog is split by AQE rather
    than gathered by a window; the sort itself is a range partitioning over a unique order.
    """
    return with_dialog_start(df).orderBy("Date_first", DIALOG, *TIME_ORDER).drop("Date_first")
