"""The training table: from raw messages to question, answer and context."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators.context import (
    CONTEXT_SIZE,
    CONVERSATION_GAP,
    DATED_PAIR_ORDER,
    context_part,
    elapsed_part,
)
from parley.operators.dedup import dedup_questions
from parley.operators.filters import clean_messages, group_chats, normalize_messages, without_dialogs
from parley.operators.turns import alternate_runs, assert_alternation, pair_runs
from parley.plans.scratch import settle
from parley.plans.sequence import by_dialog
from parley.schema import DIALOG

CLEANING = ("full", "normalize", "none")


def pairs_with_context(
    messages: DataFrame,
    size: int = CONTEXT_SIZE,
    style: str = "plain",
    scope: str = "session",
    gap_seconds: int = CONVERSATION_GAP,
    lower_questions: bool = False,
    max_rows: int | None = None,
    sizes_from: DataFrame | None = None,
    select: Callable[[DataFrame], DataFrame] = lambda part: part,
    checked: bool = False,
) -> DataFrame:
    """Elapsed time, alternation, pairing and context in one pass over the dialogs.

    All steps work inside one dialog and share its hash exchange; whether a dialog is oversized
    is decided once, before them.  ``select`` drops rows first; a join on the dialog belongs
    there, after the oversized dialogs have been set apart.  ``checked`` makes the job fail if a row
    is out of turn after the alternation.
    """
    def per_dialog(part: DataFrame) -> DataFrame:
        part = select(part)
        turns = alternate_runs(elapsed_part(part))
        pairs = pair_runs(assert_alternation(turns) if checked else turns)
        if lower_questions:
            pairs = pairs.withColumn("question", F.lower("question"))
        return context_part(pairs, size, style, scope, gap_seconds, DATED_PAIR_ORDER)

    return by_dialog(messages, per_dialog, max_rows=max_rows, sizes_from=sizes_from)


def build_training_table(
    messages: DataFrame,
    cleaning: str = "full",
    sensitive: Sequence[str] = (),
    max_participants: int | None = 2,
    ignore: Sequence[str] = ("Meta AI",),
    max_rows: int | None = None,
    **context,
) -> DataFrame:
    """Clean, drop group chats, alternate, pair, add context, keep each question once.

    ``context`` goes to ``pairs_with_context``.  When group chats are dropped, the cleaned
    messages are read twice (for the participants and for the rows), so they are written once:
    cleaning is the dearest step, and the participants are a scan of two of its columns.
    """
    raw, select = messages, lambda part: part
    if cleaning == "full":
        messages = clean_messages(messages, sensitive=sensitive)
    elif cleaning == "normalize":
        messages = normalize_messages(messages)
    elif cleaning != "none":
        raise ValueError(f"cleaning must be one of {CLEANING}")
    if max_participants is not None:
        if cleaning != "none":
            messages = settle(messages, "cleaned")
        groups = group_chats(messages, max_participants, ignore)
        select = lambda part: without_dialogs(part, groups, ignore)
    pairs = pairs_with_context(messages, max_rows=max_rows, sizes_from=raw, select=select, **context)
    return dedup_questions(pairs).select("question", "answer", DIALOG, "timestamp", "context")
