"""The test tables seen as chat messages, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.plans.spread import spread
from parley.schema import DATE, DIALOG, MESSAGE, MINE, SENDER, SEQ


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose texts get per-row work: small unsplit files are dealt out to all cores."""
    return spread(table(spark, sf_dir, name))


def chat_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as dialogs with synthetic dates: an 8 h pause before every fourth turn."""
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    seconds = F.col("conv_id") * 86400 + F.col("turn") * 3600 + F.expr("turn div 4") * 7 * 3600
    date = F.timestamp_add("SECOND", seconds, start.cast("timestamp"))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias(DIALOG),
        F.col("text").alias(MESSAGE),
        F.col("role").alias(SENDER),
        date.alias(DATE),
        (F.col("role") == "assistant").alias(MINE),
        F.col("turn").alias(SEQ),
    )


def chat_events(spark: SparkSession, sf_dir: str, per_day: bool = False) -> DataFrame:
    """``events`` as dialogs, one per user or one per user and day."""
    dialog = F.col("user_id").cast("string")
    if per_day:
        dialog = F.concat_ws("-", dialog, F.date_format("ts", "yyyyMMdd"))
    return table(spark, sf_dir, "events").select(
        dialog.alias(DIALOG),
        F.concat_ws(" ", "event_type", F.round(F.col("value") * 100).cast("bigint").cast("string")).alias(MESSAGE),
        F.col("event_type").alias(SENDER),
        F.col("ts").cast("timestamp").alias(DATE),
        (F.col("event_type") == "purchase").alias(MINE),
        F.col("event_id").alias(SEQ),
    )


CHAT_CONV_SQL = """
chat_conv AS (
  SELECT CAST(conv_id AS VARCHAR) AS DialogID, text AS Message, role AS Sender,
         TIMESTAMP '2024-01-01' + to_seconds(conv_id * 86400 + turn * 3600 + (turn // 4) * 25200) AS Date,
         role = 'assistant' AS Sent_by_me, turn AS seq
  FROM conversations)"""

CHAT_EVENTS_SQL = """
chat_events AS (
  SELECT CAST(user_id AS VARCHAR) AS DialogID,
         event_type || ' ' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS Message,
         event_type AS Sender, ts AS Date, event_type = 'purchase' AS Sent_by_me, event_id AS seq
  FROM events)"""

CHAT_DAYS_SQL = """
chat_days AS (
  SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS DialogID,
         event_type || ' ' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS Message,
         event_type AS Sender, ts AS Date, event_type = 'purchase' AS Sent_by_me, event_id AS seq
  FROM events)"""
