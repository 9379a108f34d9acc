"""Rolling context per chat on a live stream."""

from __future__ import annotations

import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from parley.functions.prompts import labels_for
from parley.functions.text import normalize_text
from parley.streaming.ingest import ingest_incremental

HISTORY = 20
OUTPUT = "chat_id string, message_id long, message_time timestamp, question string, answer string, input_text string"


def _render(history: list[tuple[str, str]], empty: str) -> str:
    if not history:
        return f"[{empty}]: "
    return "".join(f" <Q{i}> {q} <A{i}> {a}" for i, (q, a) in enumerate(history, 1))


def _turns(stream: DataFrame) -> DataFrame:
    """Text messages with their chat, place and answer."""
    return stream.where(F.coalesce(F.col("message") != "", F.lit(False))).select(
        F.col("chat_id").cast("string").alias("chat_id"),
        F.col("message_id").cast("long").alias("message_id"),
        F.col("message_time").cast("timestamp").alias("message_time"),
        normalize_text(F.col("message")).alias("question"),
        "answer",
    )


def stream_context(
    stream: DataFrame,
    language: str = "uk",
    size: int = HISTORY,
    forget_after_seconds: int | None = None,
    evict_after_seconds: int | None = None,
) -> DataFrame:
    """For each text message its prompt with the last ``size`` turns of the chat as context.

    Expects ``chat_id, message_id, message_time, message, answer``; within a chat, messages are
    ordered by (message_time, message_id).  The state per chat is at most ``size`` turns.  A message
    that comes more than ``forget_after_seconds`` after the one before it starts without context:
    that is decided by the messages' own times, so every run gives the same rows and ends.
    ``evict_after_seconds`` drops the state of chats that have been silent that long by the clock; it
    is meant for streams that never end.  One micro-batch of one chat is sorted in a task, so the
    source has to bound its batches, for instance by ``maxFilesPerTrigger``.
    """
    labels = labels_for(language)

    def advance(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        history, last = [], None
        if state.exists:
            questions, answers, last = state.get
            history = list(zip(questions, answers))
        rows = pd.concat(list(batches)).sort_values(["message_time", "message_id"], kind="stable")
        prompts = []
        for question, answer, at in zip(rows["question"], rows["answer"], rows["message_time"]):
            if not pd.isna(at):
                now = int(at.value) // 1_000
                if forget_after_seconds and last is not None and now - last > forget_after_seconds * 1_000_000:
                    history = []
                last = now if last is None else max(last, now)
            context = _render(history, labels.no_context)
            prompts.append(f"[{labels.question}]:{question}\n[{labels.context}]: {context}\n")
            history = [*history, (question, answer)][-size:]
        state.update(([q for q, _ in history], [a for _, a in history], last))
        if evict_after_seconds:
            state.setTimeoutDuration(evict_after_seconds * 1_000)
        yield rows.assign(chat_id=key[0], input_text=prompts)[
            ["chat_id", "message_id", "message_time", "question", "answer", "input_text"]
        ]

    return _turns(stream).groupBy("chat_id").applyInPandasWithState(
        advance,
        outputStructType=OUTPUT,
        stateStructType="questions array<string>, answers array<string>, last_micros long",
        outputMode="append",
        timeoutConf=GroupStateTimeout.ProcessingTimeTimeout if evict_after_seconds else GroupStateTimeout.NoTimeout,
    )


# --- with a state that can be read back ------------------------------------------------------------

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of one chat that a task holds; beyond, sorted runs go to an unnamed file of the task.
SORT_ROWS = 50_000
TURN_STATE = "question string, answer string"
FIELDS = ["message_id", "message_time", "question", "answer"]


def _place(row: tuple) -> tuple:
    """Rows in order of time, then id; without a time last, without an id first."""
    message_id, at = row[0], row[1]
    late = pd.isna(at)
    return late, 0 if late else at.value, not pd.isna(message_id), 0 if pd.isna(message_id) else message_id


def sorted_rows(frames: Iterator[pd.DataFrame], limit: int = SORT_ROWS) -> Iterator[tuple]:
    """The rows of ``frames`` (``FIELDS``) in order, with about ``limit`` of them in memory."""
    held: list[tuple] = []
    runs = []

    def spill() -> None:
        file = tempfile.TemporaryFile()
        for at in range(0, len(held), 1_000):
            pickle.dump(held[at : at + 1_000], file)
        file.seek(0)
        runs.append(file)

    def read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    for frame in frames:
        for row in frame[FIELDS].itertuples(index=False, name=None):
            held.append(row)
            if len(held) >= limit:
                held.sort(key=_place)
                spill()
                held = []
    held.sort(key=_place)
    yield from heapq.merge(*[read(f) for f in runs], held, key=_place)


class ContextProcessor(StatefulProcessor):
    """Keeps the last turns of a chat in a list state and renders the prompt of every message."""

    def __init__(self, language: str, size: int, forget_after_seconds: int | None, evict_after_seconds: int | None, sort_rows: int) -> None:
        self.labels = labels_for(language)
        self.size = size
        self.forget = forget_after_seconds
        self.evict = evict_after_seconds
        self.sort_rows = sort_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        alive = {"ttlDurationMs": self.evict * 1_000} if self.evict else {}
        self.turns = handle.getListState("turns", TURN_STATE, **alive)
        self.last = handle.getValueState("last", "micros long", **alive)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        history = [(q, a) for q, a in self.turns.get()] if self.turns.exists() else []
        last = self.last.get()[0] if self.last.exists() else None
        out: list[tuple] = []
        for message_id, at, question, answer in sorted_rows(rows, self.sort_rows):
            if not pd.isna(at):
                now = int(at.value) // 1_000
                if self.forget and last is not None and now - last > self.forget * 1_000_000:
                    history = []
                last = now if last is None else max(last, now)
            context = _render(history, self.labels.no_context)
            out.append((key[0], message_id, at, question, answer, f"[{self.labels.question}]:{question}\n[{self.labels.context}]: {context}\n"))
            history = [*history, (question, answer)][-self.size :]
            if len(out) >= 1_000:
                yield self._frame(out)
                out = []
        if history:
            self.turns.put(history)
        else:
            self.turns.clear()
        if last is not None:
            self.last.update((last,))
        if out:
            yield self._frame(out)

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["chat_id", *FIELDS, "input_text"])

    def close(self) -> None:
        pass


def keep_context(
    stream: DataFrame,
    language: str = "uk",
    size: int = HISTORY,
    forget_after_seconds: int | None = None,
    evict_after_seconds: int | None = None,
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """The rows of ``stream_context``, with the turns of every chat in a list state.

    However many messages of one chat a micro-batch holds, a task keeps ``sort_rows`` of them in
    memory.  ``evict_after_seconds`` is a time to live: what a silent chat had is then gone.  The
    session has to use the RocksDB state store (``land_context`` sees to that).
    """
    processor = ContextProcessor(language, size, forget_after_seconds, evict_after_seconds, sort_rows)
    return _turns(stream).groupBy("chat_id").transformWithStateInPandas(
        processor, outputStructType=OUTPUT, outputMode="Append", timeMode="ProcessingTime" if evict_after_seconds else "None")


def land_context(stream: DataFrame, target: str, checkpoint: str, **settings) -> StreamingQuery:
    """Append the prompts of all messages that are there to ``target`` and stop; ``settings`` as in ``keep_context``."""
    conf = stream.sparkSession.conf
    before = conf.get(PROVIDER_KEY)
    conf.set(PROVIDER_KEY, PROVIDER)
    try:
        # A query keeps the settings it was started with.
        return ingest_incremental(keep_context(stream, **settings), target, checkpoint)
    finally:
        conf.set(PROVIDER_KEY, before)


def read_context_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(chat_id, question, answer) of the turns that the state in ``checkpoint`` holds."""
    rows = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "turns").load()
    return rows.select(F.col("key.chat_id").alias("chat_id"), F.col("list_element.question").alias("question"), F.col("list_element.answer").alias("answer"))
