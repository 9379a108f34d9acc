import json
from collections import Counter
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from parley.catalog import source_queries
from parley.operators.context import sessionize, with_elapsed
from parley.plans import scratch
from parley.schema import MESSAGE_SCHEMA
from parley.sources import discord, files, instagram, telegram
from parley.streaming import ingest, live_context, sessions

START = datetime(2024, 1, 1)


def message(text, sender="user5", name="P", second=0):
    return {"text": text, "from_id": sender, "from": name, "date": (START + timedelta(seconds=second)).isoformat()}


def test_telegram_export(spark, tmp_path):
    chats = [
        {"type": "private_group", "messages": [message("no")] * 5},
        {"type": "personal_chat", "messages": [message("too few")] * 2},
        {"type": "personal_chat", "messages": [message("Hi"), message([{"type": "bold", "text": "x"}]), message("There"), message("Yes.", "user7"), message("", "user5"), message("anon", None, "9 lives")]},
    ]
    path = tmp_path / "result.json"
    path.write_text(json.dumps({"chats": {"list": chats}}, indent=1))
    scanned = telegram.scan_telegram(spark, str(path), me="7", min_messages=2)
    assert [(r.DialogID, r.Message, r.Sender, r.Sent_by_me) for r in scanned.orderBy("seq").collect()] == [
        ("T_1", "Hi", "5", False), ("T_1", "", "5", False), ("T_1", "There", "5", False), ("T_1", "Yes.", "7", True), ("T_1", "", "5", False), ("T_1", "anon", "9", False),
    ]
    merged = telegram.read_telegram(spark, str(tmp_path), me="7", min_messages=2, file_pattern="result")
    assert [(r.Message, r.seq) for r in merged.orderBy("seq").collect()] == [("there Hi,", 0), ("Yes.", 3), ("anon", 5)]
    assert telegram.scan_telegram(spark, str(path), min_messages=2, dialogs_limit=2).count() == 0
    assert telegram.scan_telegram(spark, str(tmp_path), file_pattern="other").count() == 0


def test_instagram_export(spark, tmp_path):
    def dialog(name, contents, file="message_1.json"):
        folder = tmp_path / "inbox" / name
        folder.mkdir(parents=True, exist_ok=True)
        rows = []
        for i, (sender, text) in enumerate(contents):
            row = {"sender_name": sender, "timestamp_ms": 1_700_000_000_000 + i}
            if text is not None:
                row["content"] = text.encode().decode("latin-1")
            rows.append(row)
        (folder / file).write_text(json.dumps({"messages": rows}))

    dialog("a", [("P", "x")])
    dialog("b", [("P", "Привіт"), ("P", "ДРУГЕ"), ("me", None)])
    dialog("b", [("P", "ignored")] * 9, "message_2.json")
    scanned = instagram.scan_instagram(spark, str(tmp_path), me="me", min_messages=3)
    assert [(r.DialogID, r.Message, r.Sent_by_me) for r in scanned.orderBy("seq").collect()] == [("I_1", "Привіт", False), ("I_1", "ДРУГЕ", False), ("I_1", None, True)]
    merged = instagram.read_instagram(spark, str(tmp_path), min_messages=3)
    assert [r.Message for r in merged.collect()] == ["друге Привіт,"]
    everything = instagram.scan_instagram(spark, str(tmp_path), min_messages=None, dialogs_limit=1)
    assert [r.DialogID for r in everything.collect()] == ["I_0"]


def test_discord_package(spark, tmp_path):
    for name, rows in [("c1", [("2024-01-01 10:00:00", "a"), ("2024-01-01 11:00:00", "b")]), ("c2", []), ("c3", [("2024-01-02 10:00:00", "c")])]:
        (tmp_path / name).mkdir()
        (tmp_path / name / "messages.json").write_text(json.dumps([{"Timestamp": t, "Contents": c} for t, c in rows], indent=2))
    got = discord.read_discord(spark, str(tmp_path)).orderBy("DialogID", "seq").collect()
    assert [(r.DialogID, r.Message, r.Date.hour) for r in got] == [("D_0", "a", 10), ("D_0", "b", 11), ("D_2", "c", 10)]
    assert discord.read_discord(spark, str(tmp_path), first_only=True).count() == 2


def test_derived_documents_are_dealt_out_by_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source_queries, "FILES_PER_TASK", 20, raising=False)
    rows = spark.range(200).select("id", F.concat(F.lit("d"), F.col("id")).alias("value"))
    path = tmp_path / "documents"
    source_queries._write_documents(rows.groupBy("id").agg(F.min("value").alias("value")), str(path), "id")
    names = [f.name for f in path.glob("id=*/part-*")]
    assert len(names) == 200 and max(Counter(n.split("-")[1] for n in names).values()) <= 40
    assert {(r.id, r.value) for r in spark.read.text(str(path)).collect()} == {(i, f"d{i}") for i in range(200)}


def test_save_modes_and_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("d", 'say "hi",\nyou', "A", START, True, 1), ("d", None, "B", START, False, 2)], MESSAGE_SCHEMA)
    path = str(tmp_path / "t.csv")
    files.save_dataset(df, path)
    assert sorted(map(tuple, files.read_messages_csv(spark, path).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    with pytest.raises(Exception):
        files.save_dataset(df, path)
    files.save_dataset(df.limit(1), path, "ignore")
    assert files.read_messages_csv(spark, path).count() == 2
    files.save_dataset(df.limit(1), path, "overwrite")
    assert files.read_messages_csv(spark, path).count() == 1


def test_refusal_pairs_are_cut_to_the_shorter_list(spark, tmp_path):
    from parley.operators.augmentation import read_refusal_pairs

    path = tmp_path / "r.json"
    path.write_text(json.dumps({"jailbreak_q": ["a", "b", "c"], "jailbreak_ans": ["x", "y"]}))
    assert [tuple(r) for r in read_refusal_pairs(spark, str(path)).collect()] == [("a", "x"), ("b", "y")]


def stub_session(master, **settings):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=SimpleNamespace(get=settings.get), sparkContext=context)


def test_scratch_folder_follows_the_session():
    shared = stub_session("spark://host", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch.scratch_root(shared) == "hdfs:///shared"
    assert scratch.scratch_path(shared, "x").startswith("hdfs:///shared/parley/app-spark://host/x-")
    with pytest.raises(RuntimeError):
        scratch.scratch_root(stub_session("spark://host"))
    local = stub_session("local[2]")
    assert scratch.scratch_root(local) == scratch.scratch_root(local)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_ingest_goes_on_where_it_stopped(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    spark.range(5).write.mode("append").parquet(source)
    stream = ingest.message_stream(spark, source, "id long")
    finish(ingest.ingest_incremental(stream, target, progress))
    spark.range(5, 9).write.mode("append").parquet(source)
    finish(ingest.ingest_incremental(stream, target, progress))
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(9))


def test_stream_sessions_equal_batch(spark, tmp_path):
    seconds = {"a": [0, 21600, 43201, 43301], "b": [5, 100_000], "z": [10**6]}
    data = [(d, START + timedelta(seconds=s), i) for d, times in seconds.items() for i, s in enumerate(times)]
    df = spark.createDataFrame(data, "DialogID string, Date timestamp, seq long")
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    df.write.parquet(source)
    finish(sessions.stream_sessions(ingest.message_stream(spark, source, df.schema), target, progress))
    live = {(r.DialogID, r.messages) for r in sessions.read_sessions(spark, target).collect()}
    batch = sessionize(with_elapsed(df)).groupBy("DialogID", "ConversationID").agg(F.count("*").alias("n"))
    assert live == {(r.DialogID, r.n) for r in batch.collect()}
    # Only the last session of all is still open.
    assert [r.DialogID for r in sessions.read_sessions(spark, target).where("NOT closed").collect()] == ["z"]


def test_sessions_do_not_depend_on_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    files_ = [[("late", 90_000), ("a", 30_000)], [("a", 0)], [("b", 10)], [("early", 5), ("a", 21_600)], [("b", 21_611), ("a", 60_000)]]
    schema = "DialogID string, Date timestamp, seq long"
    for n, rows in enumerate(files_):
        spark.createDataFrame([(d, START + timedelta(seconds=s), n) for d, s in rows], schema).coalesce(1).write.mode("append").parquet(source)
    tables = []
    for size in (1, 1_000):
        target, progress = str(tmp_path / f"out{size}"), str(tmp_path / f"progress{size}")
        finish(sessions.stream_sessions(ingest.message_stream(spark, source, schema, files_per_batch=size), target, progress))
        tables.append(sorted(map(tuple, sessions.read_sessions(spark, target).collect())))
    assert tables[0] == tables[1]
    assert {r[0] for r in tables[0]} == {"late", "a", "b", "early"} and sum(r[3] for r in tables[0]) == 8


def test_live_context_forgets_by_message_time(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "chat_id string, message_id long, message_time timestamp, message string, answer string"
    rows = [("x", i, START + timedelta(seconds=s), f"m{i}", "a") for i, s in enumerate([0, 100, 3_700, 7_301])]
    for row in rows:
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(source)
    stream = live_context.stream_context(ingest.message_stream(spark, source, schema), "en", forget_after_seconds=3600)
    finish(ingest.ingest_incremental(stream, target, progress))
    got = {r.message_id: "No context" in r.input_text for r in spark.read.parquet(target).collect()}
    assert got == {0: True, 1: False, 2: False, 3: True}


def test_broken_documents_fail_or_are_listed(spark, tmp_path):
    for name, text in (("a", '{"messages": [{"sender_name": "P", "timestamp_ms": 1, "content": "x"}]}'), ("b", '{"messages": [')):
        (tmp_path / name).mkdir()
        (tmp_path / name / "message_1.json").write_text(text)
    with pytest.raises(Exception):
        instagram.scan_instagram(spark, str(tmp_path), min_messages=None).collect()
    kept = instagram.scan_instagram(spark, str(tmp_path), min_messages=None, broken="skip")
    assert [(r.DialogID, r.Message) for r in kept.collect()] == [("I_0", "x")]
    listed = files.broken_documents(spark, str(tmp_path), instagram.EXPORT_SCHEMA, glob="message_1.json")
    assert [r.path.endswith("b/message_1.json") for r in listed.collect()] == [True]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "messages.json").write_text('[{"Timestamp": 1')
    with pytest.raises(Exception):
        discord.read_discord(spark, str(tmp_path)).collect()
    assert discord.read_discord(spark, str(tmp_path), broken="skip").count() == 0


def test_numbers_and_limits_count_matching_files_only(spark, tmp_path):
    for folder in ("archived_threads/a", "inbox/b", "inbox/c"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "message_1.json").write_text('{"messages": [{"sender_name": "P", "timestamp_ms": 1, "content": "x"}]}')
    got = instagram.scan_instagram(spark, str(tmp_path), min_messages=None, dir_pattern="inbox$")
    assert sorted(r.DialogID for r in got.collect()) == ["I_0", "I_1"]
    got = instagram.scan_instagram(spark, str(tmp_path), min_messages=None, dir_pattern="inbox$", dialogs_limit=1)
    assert [r.DialogID for r in got.collect()] == ["I_0"]
    export = tmp_path / "telegram"
    export.mkdir()
    (export / "result.json").write_text(json.dumps({"chats": {"list": [{"type": "personal_chat", "messages": [message("Hi")] * 2}]}}))
    (export / "settings.json").write_text("{}")
    got = telegram.scan_telegram(spark, str(export), min_messages=1, file_pattern="result")
    assert {r.DialogID for r in got.collect()} == {"T_1"}


def test_scratch_is_cleared(spark):
    import os

    path = scratch.settle(spark.range(3)).inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    scratch.clear_scratch(spark)
    assert not os.path.exists(path)


@pytest.mark.parametrize("forget", [None, 3600])
def test_live_context_carries_over_batches(spark, tmp_path, forget):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "chat_id string, message_id long, message_time timestamp, message string, answer string"

    def add(*rows):
        data = [(c, i, START + timedelta(seconds=i), m, f"a{i}") for c, i, m in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)

    add(("x", 2, " Two "), ("x", 1, "ONE"), ("y", 1, ""))
    stream = live_context.stream_context(ingest.message_stream(spark, source, schema), "en", size=2, forget_after_seconds=forget)
    finish(ingest.ingest_incremental(stream, target, progress))
    add(("x", 3, "three"), ("x", 4, "four"), ("y", 5, "five"))
    finish(ingest.ingest_incremental(stream, target, progress))
    got = {(r.chat_id, r.message_id): r.input_text for r in spark.read.parquet(target).collect()}
    assert got == {
        ("x", 1): "[Question]:one\n[Context]: [No context]: \n",
        ("x", 2): "[Question]:two\n[Context]:  <Q1> one <A1> a1\n",
        ("x", 3): "[Question]:three\n[Context]:  <Q1> one <A1> a1 <Q2> two <A2> a2\n",
        ("x", 4): "[Question]:four\n[Context]:  <Q1> two <A1> a2 <Q2> three <A2> a3\n",
        ("y", 5): "[Question]:five\n[Context]: [No context]: \n",
    }
