"""Resumable message history of an API, dialog by dialog.

What is to be fetched is a folder of tickets, each a dialog and the last message id that is already
there.  The tickets are read as a stream of files, so Spark's own checkpoint knows which of them
are done: a run that was killed goes on with the first batch of tickets that was not committed, and
the sink's commit log leaves out what a killed batch had half written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parley.streaming.ingest import ingest_incremental, message_stream

TICKET = "dialog_id string, after long"
LANDED = "dialog_id string, seq long, message string, from_id string, peer_id string, date timestamp"

#: (dialog, last known message id or None) to pages of rows shaped as ``LANDED`` without the dialog.
Fetch = Callable[[str, int | None], Iterable[list[tuple]]]


def write_tickets(dialogs: DataFrame, folder: str, dialogs_per_file: int = 1) -> None:
    """Add tickets for ``dialogs`` (dialog_id, after) to ``folder``; a file is what a run repeats at most."""
    tickets = dialogs.select(F.col("dialog_id").cast("string").alias("dialog_id"), F.col("after").cast("long").alias("after"))
    files = max(1, -(-tickets.count() // dialogs_per_file))
    tickets.repartition(files, "dialog_id").write.option("maxRecordsPerFile", dialogs_per_file).mode("append").parquet(folder)


def next_tickets(dialogs: DataFrame, landed: DataFrame) -> DataFrame:
    """Tickets for ``dialogs`` (dialog_id) that start behind the newest message of each in ``landed``."""
    newest = landed.groupBy("dialog_id").agg(F.max("seq").alias("after"))
    return dialogs.select(F.col("dialog_id").cast("string").alias("dialog_id")).distinct().join(newest, "dialog_id", "left")


def _fetched(fetch: Fetch):
    columns = ["dialog_id", "seq", "message", "from_id", "peer_id", "date"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for dialog, after in zip(part["dialog_id"], part["after"]):
                # A page at a time: a dialog of any length takes the memory of one page.
                for page in fetch(dialog, None if pd.isna(after) else int(after)):
                    yield pd.DataFrame([(dialog, *row) for row in page], columns=columns)

    return run


def history_stream(spark: SparkSession, folder: str, fetch: Fetch, files_per_batch: int = 8) -> DataFrame:
    """The messages behind the tickets in ``folder``, as rows for ``from_landed_messages``.

    ``fetch(dialog, after)`` gives pages of (seq, message, from_id, peer_id, date) with seq > after; it
    is pickled to the executors, and an error in it ends the run.
    """
    tickets = message_stream(spark, folder, TICKET, files_per_batch=files_per_batch)
    return tickets.mapInPandas(_fetched(fetch), LANDED)


def land_history(spark: SparkSession, folder: str, target: str, checkpoint: str, fetch: Fetch, files_per_batch: int = 8) -> StreamingQuery:
    """Fetch all open tickets of ``folder`` into ``target`` (parquet) and stop."""
    return ingest_incremental(history_stream(spark, folder, fetch, files_per_batch), target, checkpoint)
