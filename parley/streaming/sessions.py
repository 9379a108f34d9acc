"""Conversations on a live stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parley.operators.context import CONVERSATION_GAP
from parley.schema import DATE, DIALOG

FRAGMENT = f"{DIALOG} string, first_message timestamp, last_message timestamp, messages long"


def session_fragments(messages: DataFrame, gap_seconds: int = CONVERSATION_GAP) -> DataFrame:
    """The conversations inside ``messages``: dialog, first and last message, number of messages.

    Only a pause longer than ``gap_seconds`` separates, as in the batch operator.
    """
    window = F.session_window(DATE, f"{gap_seconds} seconds")
    found = messages.groupBy(DIALOG, window.alias("_w")).agg(F.count(F.lit(1)).alias("messages"), F.max(DATE).alias("last_message"))
    return found.select(F.col(DIALOG).cast("string").alias(DIALOG), F.col("_w.start").alias("first_message"), "last_message", "messages")


def stream_sessions(stream: DataFrame, target: str, checkpoint: str, gap_seconds: int = CONVERSATION_GAP) -> StreamingQuery:
    """Append the conversations of every micro-batch to ``target`` as fragments, and stop.

    A batch only knows its own messages, so a conversation may come in several fragments, in any
    order; ``read_sessions`` puts them together.  There is no watermark and nothing is late: the
    result does not depend on how files fall into batches.  A batch that is run again overwrites
    its own folder.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        session_fragments(batch, gap_seconds).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_fragments(fragments: DataFrame, gap_seconds: int = CONVERSATION_GAP) -> DataFrame:
    """Whole conversations from fragments, with ``closed``: whether the newest message of all is
    more than ``gap_seconds`` past the conversation's last one."""
    order = Window.partitionBy(DIALOG).orderBy("first_message", "last_message", "messages")
    reached = F.max("last_message").over(order.rowsBetween(Window.unboundedPreceding, -1))
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    marked = fragments.withColumn("_new", F.when(reached.isNull() | (F.col("first_message") > reached + gap), 1).otherwise(0))
    numbered = marked.withColumn("_n", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy(DIALOG, "_n").agg(
        F.min("first_message").alias("first_message"), F.max("last_message").alias("last_message"), F.sum("messages").alias("messages"))
    newest = fragments.agg(F.max("last_message")).scalar()
    return merged.drop("_n").withColumn("closed", F.col("last_message") + gap < newest)


def read_sessions(spark: SparkSession, target: str, gap_seconds: int = CONVERSATION_GAP) -> DataFrame:
    """The conversations so far: dialog, first and last message, messages, closed."""
    fragments = spark.read.schema(FRAGMENT + ", batch long").parquet(target).drop("batch")
    return merge_fragments(fragments, gap_seconds)


def closed_sessions(messages: DataFrame, gap_seconds: int = CONVERSATION_GAP, lateness_seconds: int = 0) -> DataFrame:
    """Conversations of a stream, each put out once, when it has ended.

    A conversation has ended when the watermark (the newest message so far, less
    ``lateness_seconds``) is past its last message by the gap.  Messages may come in any order inside
    that lateness; an older one is left out and counted (``late_messages``).  The state is one row
    per open conversation, kept by Spark's session windows and given up when it ends.
    """
    timed = messages.withWatermark(DATE, f"{lateness_seconds} seconds")
    return session_fragments(timed, gap_seconds)


def stream_closed_sessions(
    stream: DataFrame, target: str, checkpoint: str, gap_seconds: int = CONVERSATION_GAP, lateness_seconds: int = 0, **trigger
) -> StreamingQuery:
    """Append every conversation to ``target`` once, when it has ended; by default all that is there, then stop.

    Open conversations stay in the checkpoint and are put out by a later run.
    """
    writer = closed_sessions(stream, gap_seconds, lateness_seconds).writeStream.format("parquet").outputMode("append")
    return writer.option("path", target).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def late_messages(query: StreamingQuery) -> int:
    """Messages that ``query`` left out because they came later than the lateness allows.

    Counted per batch; Spark keeps the last hundred batches of a query (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    return sum(state.numRowsDroppedByWatermark for progress in query.recentProgress for state in progress.stateOperators)
