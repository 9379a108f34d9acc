"""The live context with a list state."""

import random
from datetime import datetime, timedelta

import pandas as pd

from parley.streaming import ingest, live_context

START = datetime(2024, 1, 1)
SCHEMA = "chat_id string, message_id long, message_time timestamp, message string, answer string"


def test_sorted_rows_spill(monkeypatch):
    rnd = random.Random(3)
    rows = [(i, None if i % 50 == 0 else pd.Timestamp(START) + pd.Timedelta(seconds=rnd.randint(0, 40)), f"q{i}", None) for i in range(700)]
    rnd.shuffle(rows)
    frames = [pd.DataFrame(rows[i : i + 90], columns=live_context.FIELDS) for i in range(0, len(rows), 90)]
    for limit in (10, 64, 10_000):
        found = list(live_context.sorted_rows(iter(frames), limit))
        key = lambda r: (pd.isna(r[1]), 0 if pd.isna(r[1]) else r[1].value, r[0])
        assert [r[0] for r in found] == [r[0] for r in sorted(rows, key=key)]
    assert list(live_context.sorted_rows(iter([]))) == []


def run(spark, rows, source, target, progress, **settings):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    live_context.land_context(ingest.message_stream(spark, source, SCHEMA), target, progress, **settings).awaitTermination()
    return {(r.chat_id, r.message_id): r.input_text for r in spark.read.schema(live_context.OUTPUT).parquet(target).collect()}


def test_turns_go_on_in_the_next_run_and_can_be_read(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    at = lambda s: START + timedelta(seconds=s)
    before = spark.conf.get(live_context.PROVIDER_KEY)
    first = [("a", 2, at(20), "two", "B"), ("a", 1, at(10), "one", "A"), ("b", 1, at(0), "x", None), ("a", 9, at(5), "", "-"), ("a", 8, at(5), None, "-")]
    found = run(spark, first, source, target, progress, size=2, sort_rows=2)
    assert set(found) == {("a", 1), ("a", 2), ("b", 1)}
    assert " <Q1> one <A1> A" in found["a", 2] and "<Q1>" not in found["a", 1]
    found = run(spark, [("a", 3, at(30), "three", "C"), ("a", 4, at(40), "four", "D")], source, target, progress, size=2, sort_rows=2)
    assert " <Q1> one <A1> A <Q2> two <A2> B" in found["a", 3] and " <Q1> two <A1> B <Q2> three <A2> C" in found["a", 4]
    state = sorted((r.chat_id, r.question, r.answer) for r in live_context.read_context_state(spark, progress).collect())
    assert state == [("a", "four", "D"), ("a", "three", "C"), ("b", "x", None)]
    assert spark.conf.get(live_context.PROVIDER_KEY) == before


def test_same_rows_as_the_older_operator(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(f"c{rnd.randint(0, 2)}", i, START + timedelta(seconds=rnd.randint(0, 4000)), f"q{i}", f"a{i}") for i in range(150)]
    source, target, progress, other, steps = (str(tmp_path / n) for n in ("in", "out", "progress", "other", "steps"))
    found = run(spark, rows, source, target, progress, forget_after_seconds=100, sort_rows=7)
    stream = live_context.stream_context(ingest.message_stream(spark, source, SCHEMA), forget_after_seconds=100)
    ingest.ingest_incremental(stream, other, steps).awaitTermination()
    assert found == {(r.chat_id, r.message_id): r.input_text for r in spark.read.schema(live_context.OUTPUT).parquet(other).collect()}
