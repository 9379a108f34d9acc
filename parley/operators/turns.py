"""From messages to turns, and from turns to question/answer rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import lower_first
from parley.plans.sequence import (
    BLOCK,
    by_dialog,
    has_blocks,
    lag_one,
    lead_one,
    running_sum,
    settle_blocks,
)
from parley.schema import DATE, DIALOG, ELAPSED, MESSAGE, MINE, SCAN_ORDER, SENDER, SEQ, TIME_ORDER

_RUN = "_run"

# How a message is folded before it is joined to the one it continues.
FOLDS = {
    "first": lower_first,
    "all": F.lower,
    "none": lambda text: text,
}


def _number_runs(df: DataFrame, run_key: Column, order: Sequence[str], key: str) -> DataFrame:
    """Number the runs of equal ``run_key`` inside each dialog, from 1."""
    df = lag_one(df, "_prev", F.struct(run_key.alias("k")), order, key)
    starts = F.col("_prev").isNull() | ~F.col("_prev")["k"].eqNullSafe(run_key)
    df = settle_blocks(df.withColumn("_start", starts.cast("bigint")).drop("_prev"))
    return running_sum(df, _RUN, F.col("_start"), order, key).drop("_start")


def _per_run(df: DataFrame, key: str, *aggs: Column) -> DataFrame:
    # A run takes the last block it reaches, which keeps runs and blocks in the same order.
    block = [F.max(BLOCK).alias(BLOCK)] if has_blocks(df) else []
    return df.groupBy(key, _RUN).agg(*aggs, *block)


def _coalesce_runs(df: DataFrame, case: str, order: str) -> DataFrame:
    runs = _number_runs(df, F.col(SENDER), SCAN_ORDER, DIALOG)
    first = F.min_by(F.struct(*[F.col(c) for c in df.columns if c not in (DIALOG, BLOCK)]), F.col(SEQ))
    merged = _per_run(
        runs,
        DIALOG,
        first.alias("_first"),
        F.sort_array(F.collect_list(F.struct(F.col(SEQ).alias("seq"), F.col(MESSAGE).alias("text")))).alias("_texts"),
    )
    texts = F.transform(F.col("_texts"), lambda t: t["text"])
    head, tail = F.get(texts, F.lit(0)), F.slice(texts, F.lit(2), F.greatest(F.size(texts) - 1, F.lit(0)))
    folded = F.transform(tail, FOLDS[case])
    ends_open = ~F.substring(head, -1, 1).isin(".", "!", "?")
    commas = F.when(ends_open, F.repeat(F.lit(","), F.size(tail))).otherwise("")
    if order == "newest_first":
        text = F.concat(F.array_join(F.concat(F.reverse(folded), F.array(head)), " "), commas)
    else:
        text = F.array_join(F.concat(F.array(F.concat(head, commas)), folded), " ")
    columns = [F.col(DIALOG)] + [
        text.alias(c) if c == MESSAGE else F.col("_first")[c].alias(c)
        for c in df.columns
        if c not in (DIALOG, BLOCK)
    ]
    return settle_blocks(merged.select(*columns, *([BLOCK] if has_blocks(merged) else [])))


def coalesce_bursts(df: DataFrame, case: str = "first", order: str = "newest_first", max_rows: int | None = None) -> DataFrame:
    """Join each run of messages of one sender, in scan order, into one row.

    The row keeps sender and date of the first message met.  Exports list the newest message
    first, so later ones are put in front; ``order="oldest_first"`` appends them instead.  For
    every message joined, a comma is set where the first one does not end a sentence.
    """
    if case not in FOLDS or order not in ("newest_first", "oldest_first"):
        raise ValueError(f"unknown case {case!r} or order {order!r}")
    spoken = df.where(F.col(MESSAGE) != "")
    return by_dialog(spoken, lambda part: _coalesce_runs(part, case, order), SCAN_ORDER, max_rows=max_rows)


def alternate_runs(df: DataFrame, key: str = DIALOG, order: Sequence[str] = TIME_ORDER) -> DataFrame:
    """``alternate_turns`` for one part of ``by_dialog``."""
    df = df.where(F.col(MESSAGE).isNotNull())
    side = F.when(F.col(MINE), F.lit(None)).otherwise(F.coalesce(F.col(SENDER), F.lit("")))
    runs = _number_runs(df, F.struct(F.col(MINE).alias("m"), side.alias("s")), order, key)
    rank = F.struct(*order)
    kept = [c for c in df.columns if c not in (key, BLOCK)]
    turns = _per_run(
        runs,
        key,
        F.max_by(F.struct(*kept), rank).alias("_last"),
        F.sort_array(F.collect_list(F.struct(rank.alias("at"), F.col(MESSAGE).alias("text")))).alias("_texts"),
    )
    # Newest text first.
    text = F.array_join(F.transform(F.reverse(F.col("_texts")), lambda t: t["text"]), " ")
    turns = turns.select(
        F.col(key),
        *[text.alias(c) if c == MESSAGE else F.col("_last")[c].alias(c) for c in kept],
        _RUN,
        *([BLOCK] if has_blocks(turns) else []),
    )
    turns = lead_one(settle_blocks(turns), "_next_mine", F.col(MINE), order, key)
    dropped = ~F.col(MINE) & F.coalesce(~F.col("_next_mine"), F.lit(False))
    leading = F.col(MINE) & (F.col(_RUN) == 1)
    return settle_blocks(turns.where(~dropped & ~leading).drop("_next_mine", _RUN))


def alternate_turns(df: DataFrame, scope: str = "dialog", max_rows: int | None = None) -> DataFrame:
    """Turn each dialog into other / me / other / me ... rows.

    Runs of one side are merged, newest text first, with the metadata of the newest row.  Of
    consecutive runs by different others only the last one stays, and a run of mine at the
    start has no question and goes.  ``scope="table"`` reads the whole table as one dialog,
    ordered by dialog and time.
    """
    if scope == "dialog":
        return by_dialog(df, alternate_runs, max_rows=max_rows)
    if scope != "table":
        raise ValueError("scope must be 'dialog' or 'table'")
    order = (DIALOG, *TIME_ORDER)
    whole = df.withColumn("_all", F.lit(0))
    merged = by_dialog(whole, lambda part: alternate_runs(part, "_all", order), order, "_all", max_rows)
    return merged.select(*df.columns)


def alternation_violations(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Rows that break the other / me / other / me ... order; none for a well-formed table."""
    def check(part):
        placed = running_sum(part, "position", F.lit(1).cast("bigint"))
        return placed.where(F.col(MINE) != (F.col("position") % 2 == 0))

    return by_dialog(df, check, max_rows=max_rows)


def check_alternation(df: DataFrame) -> DataFrame:
    """Return ``df``, or raise if any row breaks the alternation."""
    bad = alternation_violations(df).limit(5).collect()
    if bad:
        raise ValueError(f"rows out of turn, for example {bad}")
    return df


def assert_alternation(df: DataFrame) -> DataFrame:
    """``df``, one part of ``by_dialog``, whose job fails when it meets a row out of turn."""
    placed = running_sum(df, "_position", F.lit(1).cast("bigint"))
    wrong = F.col(MINE) != (F.col("_position") % 2 == 0)
    message = F.concat(F.lit("row out of turn in dialog "), F.coalesce(F.col(DIALOG), F.lit("null")))
    fine = F.when(wrong, F.raise_error(message).cast("boolean")).otherwise(True)
    return settle_blocks(placed.where(fine).drop("_position"))


def pair_runs(df: DataFrame) -> DataFrame:
    """``pair_turns`` for one part of ``by_dialog``."""
    df = lead_one(df, "_answer", F.struct(F.col(MESSAGE).alias("text"), F.col(MINE).alias("mine")))
    paired = df.where(~F.col(MINE) & F.coalesce(F.col("_answer")["mine"], F.lit(False)))
    extra = [c for c in (ELAPSED, BLOCK) if c in df.columns]
    pairs = paired.select(
        F.col(MESSAGE).alias("question"),
        F.col("_answer")["text"].alias("answer"),
        DIALOG,
        F.col(DATE).alias("timestamp"),
        MINE,
        SEQ,
        *extra,
    )
    return settle_blocks(pairs)


def pair_turns(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """One row per question that is followed by an answer; all metadata is the question's."""
    return by_dialog(df, pair_runs, max_rows=max_rows)
