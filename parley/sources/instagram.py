"""Instagram: one JSON document per dialog, named ``message_1.json``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.dates import parse_millis
from parley.functions.text import fix_mojibake
from parley.operators.filters import dialog_size_ok, with_sent_by_me
from parley.operators.turns import coalesce_bursts
from parley.plans.scratch import settle
from parley.schema import DATE, DIALOG, MESSAGE, SENDER, SEQ
from parley.sources.files import file_ranks, json_documents

EXPORT_SCHEMA = "messages ARRAY<STRUCT<sender_name: STRING, timestamp_ms: BIGINT, content: STRING>>"
FILE_NAME = "message_1.json"


def scan_instagram(
    spark: SparkSession,
    path: str,
    me=None,
    min_messages: int | None = 50,
    dialogs_limit: int | None = None,
    file_name: str = FILE_NAME,
    dir_pattern: str | None = None,
    broken: str = "fail",
) -> DataFrame:
    """Message rows of all dialogs below ``path``, one file each.

    ``dir_pattern`` keeps the files below folders of that name, ``inbox$`` for instance.  Dialogs are
    numbered ``I_0, I_1, ...`` in path order over these files, before any dialog is dropped.
    """
    raw = json_documents(spark, path, EXPORT_SCHEMA, glob=file_name, dir_pattern=dir_pattern, broken=broken)
    ranks = file_ranks(spark, path, glob=file_name, dir_pattern=dir_pattern)
    large = raw.where(dialog_size_ok(F.size("messages"), min_messages, strict=False))
    named = large.join(ranks, "_file")
    if dialogs_limit is not None:
        named = named.where(F.col("_rank") <= dialogs_limit)
    dialog = F.concat(F.lit("I_"), (F.col("_rank") - 1).cast("string"))
    rows = named.select(dialog.alias(DIALOG), F.posexplode("messages").alias("at", "m"))
    out = rows.select(
        DIALOG,
        fix_mojibake(F.col("m.content")).alias(MESSAGE),
        F.col("m.sender_name").alias(SENDER),
        parse_millis(F.col("m.timestamp_ms")).alias(DATE),
        F.col("at").cast("bigint").alias(SEQ),
    )
    return out if me is None else with_sent_by_me(out, me)


def read_instagram(spark: SparkSession, path: str, me=None, case: str = "all", order: str = "newest_first", **scan) -> DataFrame:
    """``scan_instagram`` with the bursts of one sender joined.

    The documents are parsed once, into a columnar copy: joining looks at the dialog sizes first.
    """
    return coalesce_bursts(settle(scan_instagram(spark, path, me, **scan), "instagram"), case, order)
