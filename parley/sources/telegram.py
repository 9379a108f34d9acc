"""Telegram: exported JSON documents and landed API rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.functions.dates import parse_iso
from parley.functions.text import digits_only, strip_text
from parley.operators.filters import dialog_size_ok, with_sent_by_me
from parley.operators.turns import coalesce_bursts
from parley.plans.scratch import settle
from parley.schema import DATE, DIALOG, MESSAGE, SENDER, SEQ
from parley.sources.files import file_ranks, json_documents
from parley.sources.json_ranges import ANY, json_elements

# ``text`` is a string, or a list when the message is formatted.
EXPORT_SCHEMA = """
chats STRUCT<list: ARRAY<STRUCT<
  type: STRING,
  messages: ARRAY<STRUCT<text: VARIANT, from_id: STRING, `from`: STRING, date: STRING>>
>>>
"""


def scan_telegram(
    spark: SparkSession,
    path: str,
    me=None,
    min_messages: int | None = 50,
    dialogs_limit: int | None = None,
    file_pattern: str | None = None,
    broken: str = "fail",
) -> DataFrame:
    """Message rows of the personal chats in one or more export documents.

    Size and type are tested on the chat list before anything is exploded.  Kept dialogs are
    numbered ``T_1, T_2, ...`` in list order; with several documents the number of the document
    in path order is added: ``T2_1``.  Formatted texts count as empty.
    """
    raw = json_documents(spark, path, EXPORT_SCHEMA, file_pattern, broken=broken)
    chats = F.col("chats.list")
    if dialogs_limit is not None:
        chats = F.slice(chats, F.lit(1), F.lit(dialogs_limit))
    kept = F.filter(
        chats,
        lambda c: (c["type"] == "personal_chat") & dialog_size_ok(F.size(c["messages"]), min_messages, strict=True),
    )
    chats = raw.select("_file", F.posexplode(kept).alias("n", "chat"))
    ranks = file_ranks(spark, path, file_pattern)
    number = (F.col("n") + 1).cast("string")
    if ranks.limit(2).count() > 1:
        chats = chats.join(ranks, "_file")
        dialog = F.concat(F.lit("T"), F.col("_rank").cast("string"), F.lit("_"), number)
    else:
        dialog = F.concat(F.lit("T_"), number)
    rows = chats.select(dialog.alias(DIALOG), F.posexplode("chat.messages").alias("at", "m"))
    out = _message_rows(rows, F.col("at"))
    return out if me is None else with_sent_by_me(out, me)


MESSAGE_JSON = "text VARIANT, from_id STRING, `from` STRING, date STRING"


def scan_large_telegram(
    spark: SparkSession, path: str, me=None, min_messages: int | None = 50, dialogs_limit: int | None = None, file_pattern: str | None = None
) -> DataFrame:
    """The rows of ``scan_telegram``, with every document cut into byte ranges that are parsed side by side.

    For exports whose single file is too large for one task.  No chat is ever one row: its messages
    are numbered and counted across the ranges.
    """
    found, heads = json_elements(spark, path, ("chats", "list", ANY, "messages", ANY), file_pattern)
    chats = heads.select("file", "outer", F.get_json_object("text", "$.type").alias("type"))
    if dialogs_limit is not None:
        chats = chats.where(F.col("outer") <= dialogs_limit)
    sizes = found.groupBy("file", "outer").agg(F.count(F.lit(1)).alias("n"))
    kept = chats.where(F.col("type") == "personal_chat").join(sizes, ["file", "outer"], "left")
    kept = kept.where(dialog_size_ok(F.coalesce("n", F.lit(0)), min_messages, strict=True))
    # One row a chat.
    kept = kept.withColumn("number", F.row_number().over(Window.partitionBy("file").orderBy("outer")))
    ranks = file_ranks(spark, path, file_pattern)
    number = F.col("number").cast("string")
    if ranks.limit(2).count() > 1:
        kept = kept.join(ranks, kept["file"] == ranks["_file"])
        dialog = F.concat(F.lit("T"), F.col("_rank").cast("string"), F.lit("_"), number)
    else:
        dialog = F.concat(F.lit("T_"), number)
    names = settle(kept.select("file", "outer", dialog.alias(DIALOG)), "dialogs")
    rows = found.join(names, ["file", "outer"]).select(DIALOG, "inner", F.from_json("text", MESSAGE_JSON, {"mode": "FAILFAST"}).alias("m"))
    out = _message_rows(rows, F.col("inner") - 1)
    return out if me is None else with_sent_by_me(out, me)


def _message_rows(rows: DataFrame, at) -> DataFrame:
    """Message rows from (dialog, ``m``); formatted texts count as empty."""
    sender = digits_only(F.coalesce(F.nullif(F.col("m.from_id"), F.lit("")), F.col("m.from")))
    text = F.when(F.schema_of_variant("m.text") == "STRING", F.try_variant_get("m.text", "$", "string"))
    return rows.select(
        DIALOG,
        F.coalesce(text, F.lit("")).alias(MESSAGE),
        sender.alias(SENDER),
        parse_iso(F.col("m.date")).alias(DATE),
        at.cast("bigint").alias(SEQ),
    )


def read_telegram(spark: SparkSession, path: str, me=None, case: str = "first", order: str = "newest_first", **scan) -> DataFrame:
    """``scan_telegram`` with the bursts of one sender joined.

    The documents are parsed once, into a columnar copy: joining looks at the dialog sizes first.
    """
    return coalesce_bursts(settle(scan_telegram(spark, path, me, **scan), "telegram"), case, order)


def from_landed_messages(df: DataFrame, me=None, case: str = "none", order: str = "newest_first") -> DataFrame:
    """API history that was landed as rows: trim texts, fall back to the peer as sender, join bursts.

    Expects ``dialog_id, message, from_id, peer_id, date, seq``.
    """
    sender = F.coalesce(F.col("from_id").cast("string"), F.col("peer_id").cast("string"))
    rows = df.select(
        F.col("dialog_id").cast("string").alias(DIALOG),
        strip_text(F.coalesce("message", F.lit(""))).alias(MESSAGE),
        sender.alias(SENDER),
        F.col("date").alias(DATE),
        F.col("seq").cast("bigint").alias(SEQ),
    )
    if me is not None:
        rows = with_sent_by_me(rows, me)
    return coalesce_bursts(rows, case, order)
