"""Row filters and flags over the message table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.schema import DIALOG, MESSAGE, MINE, SENDER


def clean_messages(df: DataFrame, column: str = MESSAGE, sensitive: Sequence[str] = (), steps: str | Sequence[str] = "default", strict_emoji: bool = False) -> DataFrame:
    """Clean one text column and drop the rows that end up blank."""
    return rewrite_text(df, column, tx.clean_text(F.col(column), sensitive, steps, strict_emoji))


def normalize_messages(df: DataFrame, column: str = MESSAGE) -> DataFrame:
    """Normalize one text column and drop the rows that end up blank; nulls stay."""
    return rewrite_text(df, column, tx.normalize_text(F.col(column)))


def rewrite_text(df: DataFrame, column: str, text: Column) -> DataFrame:
    """Replace ``column`` by ``text`` without the rows where that is blank.

    A filter after a projection is pushed below it, and the text would be computed once for the
    test and once more for the result.  Exploding an array of at most one text computes it once.
    """
    kept = F.filter(F.array(text), lambda t: ~F.coalesce(tx.strip_text(t) == "", F.lit(False)))
    return df.withColumn(column, F.explode(kept))


def drop_blank(df: DataFrame, column: str = MESSAGE, exact: bool = False) -> DataFrame:
    """Drop rows whose text is blank; nulls stay.  ``exact`` drops only ``''`` and ``' '``."""
    value = F.col(column) if exact else tx.strip_text(F.col(column))
    return df.where(~F.coalesce(value.isin(" ", ""), F.lit(False)))


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns else None)


def with_sent_by_me(df: DataFrame, me) -> DataFrame:
    return df.withColumn(MINE, F.col(SENDER).eqNullSafe(F.lit(str(me))))


def dialog_size_ok(size: Column, min_messages: int | None, strict: bool) -> Column:
    """The dialog size test; no threshold keeps all.  ``strict`` asks for more than the minimum."""
    if not min_messages:
        return F.lit(True)
    return size > min_messages if strict else size >= min_messages


def filter_dialogs(df: DataFrame, min_messages: int | None = 50, strict: bool = True) -> DataFrame:
    """Keep the dialogs with enough messages.

    The kept ids come from a map-side combined count; the join is left to AQE, which broadcasts
    a small list and splits a dialog that is much larger than the others.
    """
    sizes = df.groupBy(DIALOG).agg(F.count(F.lit(1)).alias("_size"))
    small = sizes.where(~dialog_size_ok(F.col("_size"), min_messages, strict))
    return df.join(small.select(DIALOG), DIALOG, "left_anti")


def filter_entities(df: DataFrame, me, type_col: str = "entity_type", bot_col: str = "is_bot", id_col: str = "entity_id") -> DataFrame:
    """Keep rows whose dialog partner is a user, no bot, and not ``me``."""
    return df.where((F.col(type_col) == "User") & ~F.coalesce(F.col(bot_col), F.lit(False)) & (F.col(id_col) != F.lit(me)))


def dialog_participants(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Distinct senders per dialog; a null sender counts as one, ignored names do not.

    Counting (dialog, sender) pairs first keeps a dialog with very many senders out of any one
    task.
    """
    senders = df.select(DIALOG, SENDER)
    if ignore:
        senders = senders.where(~F.coalesce(F.col(SENDER).isin(list(ignore)), F.lit(False)))
    pairs = senders.distinct()
    return pairs.groupBy(DIALOG).agg(F.count(F.lit(1)).alias("participants"))


def group_chats(df: DataFrame, max_participants: int = 2, ignore: Sequence[str] = ("Meta AI",)) -> DataFrame:
    """Ids of the dialogs with more than ``max_participants`` senders."""
    return dialog_participants(df, ignore).where(F.col("participants") > max_participants).select(DIALOG)


def without_dialogs(df: DataFrame, dialogs: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Drop the listed dialogs, and every row of the ignored senders."""
    if ignore:
        df = df.where(~F.coalesce(F.col(SENDER).isin(list(ignore)), F.lit(False)))
    return df.join(dialogs, DIALOG, "left_anti")


def drop_group_chats(df: DataFrame, max_participants: int = 2, ignore: Sequence[str] = ("Meta AI",)) -> DataFrame:
    """Drop dialogs with too many senders, and every row of the ignored senders."""
    return without_dialogs(df, group_chats(df, max_participants, ignore), ignore)
