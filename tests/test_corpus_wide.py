"""Subwords, phrases, languages, closing sessions and resumable history against plain versions."""

import itertools
import random
import time
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.operators import language_model, phrases, subwords
from parley.operators.context import sessionize, with_elapsed
from parley.streaming import history, ingest, sessions

ODD = [None, "", " ", "word " * 3000, "Привіт, 👩‍👩‍👧 <|endoftext|>\n\t\u0000x", "é" * 50, "日本語", "a" * 5000]


# Subwords --------------------------------------------------------------------------------------


def test_subwords_come_back(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "id int, text string, _row string").repartition(3)
    coded = subwords.encode_subwords(df, {"text": ("ids", None)})
    assert coded.columns == ["id", "text", "_row", "ids"]
    back = {r.id: (r.ids, r.back) for r in subwords.decode_subwords(coded, "ids", "back").collect()}
    assert [back[i][1] for i in range(len(ODD))] == ["" if t is None else t for t in ODD]
    assert back[0][0] == [] and all(0 <= i < 50_257 for ids, _ in back.values() for i in ids)


def test_subword_features_are_cut_and_padded(spark):
    df = spark.createDataFrame([(1, "a b c " * 100, "yes"), (2, "hi", None)], "id int, input_text string, output_text string")
    rows = {r.id: r for r in subwords.training_features(df, ["id"], 16, 8, pad_id=7, ignore_padding=True).collect()}
    assert all(len(r.input_ids) == len(r.attention_mask) == 16 and len(r.labels) == 8 for r in rows.values())
    assert rows[1].attention_mask == [1] * 16 and rows[2].attention_mask == [1] + [0] * 15
    assert rows[2].input_ids[1:] == [7] * 15 and rows[2].labels == [subwords.IGNORED] * 8
    assert rows[1].labels[1:] == [subwords.IGNORED] * 7
    assert subwords.encode_subwords(df.limit(0), {"input_text": ("ids", 4)}).collect() == []


# Phrases ---------------------------------------------------------------------------------------


def occurrences(text, listed, whole):
    low = phrases.fold_case(text)
    out = []
    for phrase in {phrases.fold_case(p.strip()) for p in listed} - {""}:
        at = low.find(phrase)
        while at >= 0:
            end = at + len(phrase)
            open_left = at and phrases._is_word(text[at]) and phrases._is_word(text[at - 1])
            open_right = end < len(text) and phrases._is_word(text[end - 1]) and phrases._is_word(text[end])
            if not whole or not (open_left or open_right):
                out.append((at, end))
            at = low.find(phrase, at + 1)
    return out


def test_found_phrases_equal_a_naive_search():
    rnd = random.Random(4)
    for _ in range(300):
        listed = ["".join(rnd.choice("ab İ.") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(0, 8))]
        text = "".join(rnd.choice("abAB İ.") for _ in range(rnd.randint(0, 30)))
        import pickle

        automaton = pickle.loads(phrases.build_automaton([(p, "#") for p in listed]))
        for whole in (True, False):
            found = sorted((a, b) for a, b, _ in phrases.find_phrases(automaton, text, whole_words=whole))
            assert found == sorted(occurrences(text, listed, whole))


def covers(text, found):
    """All ways to take phrases that do not overlap."""
    for n in range(len(found) + 1):
        for chosen in itertools.combinations(sorted(found), n):
            if all(a[1] <= b[0] for a, b in itertools.pairwise(chosen)):
                yield chosen


def test_best_cover_equals_an_exhaustive_search():
    rnd = random.Random(9)
    for _ in range(300):
        text = "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 12)))
        spans = {tuple(sorted(rnd.sample(range(len(text) + 1), 2))) for _ in range(rnd.randint(0, 7))} if len(text) > 1 else set()
        found = [(a, b, f"[{a}-{b}]") for a, b in spans]
        key = lambda chosen: (len(text) - sum(b - a for a, b, _ in chosen), len(chosen))
        best = min(map(key, covers(text, found)))
        outcomes = set()
        for chosen in covers(text, found):
            if key(chosen) == best:
                out, at = [], 0
                for a, b, r in chosen:
                    out += [text[at:a], r]
                    at = b
                outcomes.add("".join([*out, text[at:]]))
        assert phrases.best_cover(text, found) in outcomes


def test_censor_and_translate(spark):
    df = spark.createDataFrame([(1, "The new York times, in new york"), (2, None), (3, ""), (4, "renew yorker")], "id int, text string")
    listed = spark.createDataFrame([("New York",), ("new york times",), (None,), (" ",), ("york",)], "phrase string")
    found = {r.id: r.text for r in phrases.censor_phrases(df, "text", listed, mark="#").collect()}
    assert found == {1: "The #, in #", 2: None, 3: "", 4: "renew yorker"}
    table = spark.createDataFrame([("a b", "AB"), ("b c d", "BCD"), ("a", "A"), ("b c d", "x")], "phrase string, replacement string")
    rows = spark.createDataFrame([("a b c d",), ("a b, a",)], "text string")
    # "a" with "b c d" covers more than "a b" does.
    assert [r.text for r in phrases.translate_phrases(rows, "text", table).collect()] == ["A BCD", "AB, A"]
    assert phrases.censor_phrases(df, "text", listed.limit(0)).where("id = 1").first().text == "The new York times, in new york"


def test_many_phrases_over_long_texts(spark):
    listed = spark.range(150_000).select(F.concat(F.lit("key "), F.col("id"), F.lit(" end")).alias("phrase"))
    text = " ".join(f"key {i * 7} end" for i in range(70_000))
    df = spark.createDataFrame([(text,), ("a" * 1_000_000,)], "text string")
    start = time.perf_counter()
    rows = [r.text for r in phrases.censor_phrases(df, "text", listed, mark="#").collect()]
    assert rows[0].count("#") == len([i for i in range(70_000) if i * 7 < 150_000]) and rows[1] == "a" * 1_000_000
    assert time.perf_counter() - start < 60


# Languages -------------------------------------------------------------------------------------


def plain_grams(text):
    """Hash values by the same arithmetic, character by character."""
    out, m, mask = [], 0x9E3779B97F4A7C15, (1 << 64) - 1
    for i in range(len(text)):
        h = 0
        for n in range(1, language_model.ORDERS + 1):
            if i + n > len(text):
                break
            h = ((h ^ ord(text[i + n - 1])) * m) & mask
            h ^= h >> 29
            gram = text[i : i + n]
            if (n == 1 and gram == " ") or (n == 2 and gram == "  "):
                continue
            out.append((((h + n) * m) & mask) >> 48)
    return out


def test_gram_buckets_equal_a_loop():
    texts = [" the cat ", " ", "  ", " é ", " ab ", " aaaa "]
    buckets, owners = language_model.gram_buckets(texts)
    for i, text in enumerate(texts):
        assert sorted(buckets[owners == i].tolist()) == sorted(plain_grams(text))


def test_identified_languages(spark):
    train = [("the cat and the dog sat on the mat", "en"), ("der hund und die katze sind auf der matte", "de"), ("le chat et le chien sont sur le tapis", "fr"), ("x", None)]
    model = language_model.train_languages(spark.createDataFrame(train * 20, "text string, lang string"), "text", "lang")
    rows = [("the dog and the cat",), ("die katze und der hund",), ("le chien et le chat",), (None,), ("123 !",), ("щщ ъъ",)]
    df = spark.createDataFrame(rows, "text string").withColumn("detected", F.lit("old"))
    found = [r.detected for r in language_model.identify_languages(df, "text", model, margin=0.2).collect()]
    assert found == ["en", "de", "fr", None, None, None]
    assert list(model) == ["de", "en", "fr"] and all(np.exp(v[v != 0]).sum() <= 1 for v in model.values())
    assert [r.detected for r in language_model.identify_languages(df, "text", {}).collect()] == [None] * 6


# Closing sessions ------------------------------------------------------------------------------

START = datetime(2024, 1, 1)


def write(spark, rows, path):
    spark.createDataFrame(rows, "DialogID string, Date timestamp, seq long").coalesce(1).write.mode("append").parquet(path)


def run(query):
    query.awaitTermination()
    return query


def test_sessions_close_once_in_any_order(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(f"d{rnd.randint(0, 4)}", START + timedelta(minutes=rnd.randint(0, 3000)), i) for i in range(300)]
    rows = [r for k, r in enumerate(rows) if r[:2] not in {x[:2] for x in rows[:k]}]
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for k in range(4):
        write(spark, rows[k::4], source)
    stream = ingest.message_stream(spark, source, "DialogID string, Date timestamp, seq long", files_per_batch=1)
    settings = {"gap_seconds": 3600, "lateness_seconds": 4 * 86_400}
    run(sessions.stream_closed_sessions(stream, target, progress, **settings))
    assert spark.read.schema(sessions.FRAGMENT).parquet(target).count() == 0  # all are within the lateness
    write(spark, [("clock", START + timedelta(days=30), -1)], source)
    query = run(sessions.stream_closed_sessions(stream, target, progress, **settings))
    assert sessions.late_messages(query) == 0
    batch = sessionize(with_elapsed(spark.createDataFrame(rows, "DialogID string, Date timestamp, seq long")), 3600)
    want = batch.groupBy("DialogID", "ConversationID").agg(F.min("Date").alias("a"), F.max("Date").alias("z"), F.count(F.lit(1)).alias("n"))
    got = [tuple(r) for r in spark.read.schema(sessions.FRAGMENT).parquet(target).collect()]
    assert sorted(got) == sorted((r.DialogID, r.a, r.z, r.n) for r in want.collect())
    # A message older than the lateness is counted and changes nothing.
    write(spark, [("d0", START, 999), ("clock", START + timedelta(days=31), -2)], source)
    query = run(sessions.stream_closed_sessions(stream, target, progress, **settings))
    assert sessions.late_messages(query) == 1
    again = [tuple(r) for r in spark.read.schema(sessions.FRAGMENT).parquet(target).collect()]
    assert [r for r in sorted(again) if r[0] != "clock"] == sorted(got)


# Resumable history -----------------------------------------------------------------------------


def api(folder, sizes, fail_at=None):
    """A fetch function over made-up dialogs; ``fail_at`` breaks off inside that dialog. Calls are noted as files."""

    def fetch(dialog, after):
        import pathlib
        import uuid

        (pathlib.Path(folder) / f"{dialog}-{uuid.uuid4().hex}").touch()
        first = 0 if after is None else after + 1
        for page in range(first, sizes[dialog], 10):
            if dialog == fail_at and page >= 20:
                raise ConnectionError("gone")
            yield [(i, f"m{i}", "me", dialog, START + timedelta(seconds=i)) for i in range(page, min(page + 10, sizes[dialog]))]

    return fetch


def test_history_goes_on_where_it_stopped(spark, tmp_path):
    sizes = {f"d{i}": 5 + 12 * i for i in range(6)}
    calls = tmp_path / "calls"
    calls.mkdir()
    tickets, target, progress = (str(tmp_path / n) for n in ("tickets", "landed", "progress"))
    dialogs = spark.createDataFrame([(d, None) for d in sizes], "dialog_id string, after long")
    history.write_tickets(dialogs, tickets)
    query = history.land_history(spark, tickets, target, progress, api(str(calls), sizes, fail_at="d3"), files_per_batch=1)
    with pytest.raises(Exception, match="gone"):
        query.awaitTermination()
    done = {p.name.split("-")[0] for p in calls.iterdir()} - {"d3"}
    before = len(list(calls.iterdir()))
    run(history.land_history(spark, tickets, target, progress, api(str(calls), sizes), files_per_batch=1))
    landed = spark.read.schema(history.LANDED).parquet(target)
    assert sorted((r.dialog_id, r.seq) for r in landed.collect()) == sorted((d, i) for d, n in sizes.items() for i in range(n))
    # Finished dialogs were not asked for again.
    again = [p.name.split("-")[0] for p in sorted(calls.iterdir(), key=lambda p: p.stat().st_mtime)[before:]]
    assert not done & set(again) and "d3" in again
    # New messages: tickets start behind what is there.
    grown = {d: n + 3 for d, n in sizes.items()} | {"new": 4}
    history.write_tickets(history.next_tickets(spark.createDataFrame([(d,) for d in grown], "dialog_id string"), landed), tickets, dialogs_per_file=3)
    run(history.land_history(spark, tickets, target, progress, api(str(calls), grown)))
    rows = spark.read.schema(history.LANDED).parquet(target).collect()
    assert sorted((r.dialog_id, r.seq) for r in rows) == sorted((d, i) for d, n in grown.items() for i in range(n))
