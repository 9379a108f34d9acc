"""Word lists and look-up tables: long lists, repeated keys, short tables."""

import pytest
from pyspark.sql import functions as F

from parley.functions import metrics, text
from parley.operators import augmentation, encoding, limits, turns
from parley.plans.sequence import by_dialog, key_min, lag_one, last_n, running_sum


def test_long_word_lists(spark):
    words = [f"Word{i}" for i in range(20_000)]
    df = spark.createDataFrame([("one word7 WORD19999 word20000",)], "t string")
    row = df.select(text.censor_words(F.col("t"), words).alias("c"), text.remove_stopwords(F.split("t", " "), words).alias("s")).first()
    assert row.c == f"one {text.CENSOR_MARK} {text.CENSOR_MARK} word20000" and row.s == ["one", "word20000"]


def test_repeated_keys_do_not_double_words(spark):
    df = spark.createDataFrame([(1, "run fast")], "id long, t string")
    lemmas = spark.createDataFrame([("run", "walk"), ("run", "go")], "form string, lemma string")
    assert [r.t for r in encoding.normalize_tokens(df, "t", lemmas, ["id"]).collect()] == ["go fast"]
    synonyms = spark.createDataFrame([("run", "walk"), ("run", "go"), ("fast", "quick")], "word string, synonym string")
    assert [r.t for r in augmentation.replace_synonyms(df, "t", synonyms, ["id"], share=1.0).collect()] == ["go quick"]


def test_refusal_pairs_need_as_many_rows(spark):
    df = spark.createDataFrame([("q", "a", "d", None)], "question string, answer string, DialogID string, timestamp timestamp")
    with pytest.raises(ValueError):
        augmentation.refusal_rows(df, [("x", "y"), ("z", "w")], ["question"])


def test_many_chunks(spark):
    df = spark.range(1_003)
    sizes = [r["count"] for r in limits.assign_chunks(df, 1_001, ("id",)).groupBy("chunk").count().orderBy("chunk").collect()]
    assert sizes == [2, 2] + [1] * 999
    assert limits.assign_chunks(spark.range(2), 5, ("id",)).agg(F.max("chunk")).first()[0] == 2


def test_shared_ngrams_count_repetition(spark):
    df = spark.createDataFrame([("a a b a", "a b a a a"), ("", "x"), (None, "x")], "t string, p string")
    rows = df.select(metrics._shared_ngrams(metrics.words(F.col("t")), metrics.words(F.col("p"))).alias("n")).collect()
    assert [r.n for r in rows] == [[4, 3, 1, 0], [0, 0, 0, 0], None]


def test_null_dialog_is_split_like_others(spark):
    rows = [(None if i % 3 else "d", i) for i in range(60)]
    df = spark.createDataFrame(rows, "DialogID string, seq long")
    def ordered(part):
        part = lag_one(part, "before", F.col("seq"), ("seq",))
        part = running_sum(part, "total", F.col("seq"), ("seq",))
        return last_n(key_min(part, "low", F.col("seq"), ("seq",)), "tail", F.col("seq"), 3, ("seq",))

    plain, split = (sorted(map(str, by_dialog(df, ordered, ("seq",), max_rows=n).collect())) for n in (1_000, 7))
    assert plain == split


def test_alternation_is_asserted_inside_the_job(spark):
    rows = [("d", "a", "P", i, mine, i) for i, mine in enumerate([False, True, True])]
    df = spark.createDataFrame(rows, "DialogID string, Message string, Sender string, Date long, Sent_by_me boolean, seq long")
    assert turns.assert_alternation(df.limit(2)).count() == 2
    with pytest.raises(Exception, match="out of turn"):
        turns.assert_alternation(df).collect()


def test_similar_words_meet_their_whole_bucket(spark):
    """600 vectors of one bucket, each with a near twin, and one vector that many words share."""
    rows = [(f"w{i:03d}{side}", [20_000 + 20 * i, 20_000 - 20 * i + side] + [1] * 62) for i in range(600) for side in (0, 1)]
    rows += [(f"same{i:03d}", [5] * 64) for i in range(300)]
    vectors = spark.createDataFrame(rows, "word string, vector array<bigint>")
    exact = {r.word: r.score for r in augmentation.nearest_words(vectors.where("word LIKE 'w%'")).collect()}
    for block_rows in (4096, 100):
        found = {r.word: (r.synonym, r.score) for r in augmentation.similar_words(vectors, block_rows=block_rows).collect()}
        assert len(found) == len(rows)
        assert sum(found[w][1] >= s - 1e-12 for w, s in exact.items()) >= 0.9 * len(exact)
        assert all(found[w][0] == w[:4] + "10"[int(w[4])] for w in exact)
        assert found["same299"] == ("same298", 1.0) and found["same000"] == ("same299", 1.0)
