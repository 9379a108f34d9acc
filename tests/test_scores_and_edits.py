import random
import struct
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parley.functions import metrics, variation
from parley.operators import augmentation, encoding, evaluation, language

TRUTH, PRED = "Це приклад тестового речення", "Це тестове речення для перевірки"


def test_worked_example(spark):
    df = spark.createDataFrame([(TRUTH, PRED)], "t string, p string")
    t, p = F.col("t"), F.col("p")
    got = df.select(
        metrics.cer(t, p).alias("cer"), metrics.wer(t, p).alias("wer"), metrics.jaccard(t, p).alias("jaccard"),
        metrics.vocab_recall(t, p).alias("recall"), metrics.rouge1(t, p).alias("rouge1"),
        metrics.rouge_l(t, p).alias("rouge_l"), metrics.bleu(t, p).alias("bleu"),
    ).first()
    assert got.cer == pytest.approx(24 / 28)
    assert got.wer == 1 and got.jaccard == pytest.approx(2 / 7) and got.recall == 0.5
    for rouge in (got.rouge1, got.rouge_l):
        assert rouge.precision == pytest.approx(0.4) and rouge.recall == 0.5 and rouge.f1 == pytest.approx(4 / 9)
    assert got.bleu == pytest.approx(0.063894, abs=1e-6)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_scores_against_brute_force(spark):
    rng = random.Random(5)
    data = [(" ".join(rng.choices("a bb ccc d е ї".split(), k=rng.randint(1, 12))), " ".join(rng.choices("a bb x d ї".split(), k=rng.randint(0, 12)))) for _ in range(150)]
    df = spark.createDataFrame(data, "t string, p string")
    rows = df.select("t", "p", metrics.wer(F.col("t"), F.col("p")).alias("wer"), metrics.rouge_l(F.col("t"), F.col("p")).alias("l"), metrics.rouge1(F.col("t"), F.col("p")).alias("u")).collect()
    for r in rows:
        t, p = r.t.split(), r.p.split()
        assert r.wer == pytest.approx(edits(t, p) / len(t))
        assert r.l.f1 == pytest.approx(2 * common(t, p) / (len(t) + len(p)))
        assert r.u.recall == pytest.approx((Counter(t) & Counter(p)).total() / len(t))


def test_empty_and_null_texts(spark):
    df = spark.createDataFrame([("", "a"), ("a", ""), (None, "a")], "y_true string, y_pred string")
    empty, silent, null = evaluation.score_pairs(df).collect()
    assert empty.wer is None and empty.cer is None and empty.bleu == 0
    assert silent.wer == 1 and silent.rouge1 == 0 and silent.bleu == 0
    assert null.wer is None and null.bleu is None


def test_lemmas_are_applied_before_scoring(spark):
    truths = spark.createDataFrame([(1, "коти сплять"), (2, "дім")], "id int, y_true string")
    preds = spark.createDataFrame([(1, "кіт спить"), (2, "дім")], "id int, y_pred string")
    lemmas = spark.createDataFrame([("коти", "кіт"), ("сплять", "спати"), ("спить", "спати")], "form string, lemma string")
    plain = evaluation.evaluate_pairs(preds, truths).first()
    assert plain.pairs == 2 and plain.wer == 0.5
    assert evaluation.evaluate_pairs(preds, truths, lemmas=lemmas).first().wer == 0


TEXTS = ["a, b,, c , d", "one two three", "word", "", "the of", "x x y z, q"]
STOP = ("the", "of")


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 10)], "id int, question string")


def edited(df, column):
    return [(r.question, r.out) for r in df.select("question", column.alias("out")).collect()]


def test_clause_shuffle_keeps_the_clauses(texts):
    for before, after in edited(texts, variation.shuffle_clauses(F.col("question"), 1, F.col("id"))):
        wanted = [c.strip() for c in before.replace(",,", ",").split(",") if c.strip()]
        assert Counter(after.split(", ") if after else []) == Counter(wanted)


def test_word_swap_changes_no_or_two_places(texts):
    for before, after in edited(texts, variation.swap_words(F.col("question"), 1, F.col("id"))):
        a, b = before.replace(",", " , ").split(), after.split()
        assert Counter(a) == Counter(b)
        assert sum(x != y for x, y in zip(a, b)) in (0, 2)


def test_word_removal_takes_one_token(texts):
    for before, after in edited(texts, variation.pop_word(F.col("question"), STOP, 1, F.col("id"))):
        a, b = before.replace(",", " , ").split(), after.split()
        if before in ("", "the of"):
            assert after == before
        else:
            gone = Counter(a) - Counter(b)
            assert gone.total() == 1 and not set(gone) & set(STOP)


def test_drawn_edits_follow_the_weights(spark):
    chosen = spark.range(4000).select(variation.choose_edits(3, F.col("id")).alias("e")).collect()
    sizes = Counter(len(r.e) for r in chosen)
    assert set(sizes) == {1, 2, 3, 4} and all(800 < n < 1200 for n in sizes.values())
    single = Counter(r.e[0] for r in chosen if len(r.e) == 1)
    assert 0.06 < single["translate"] / sizes[1] < 0.14
    assert all(r.e == [e for e in variation.EDITS if e in r.e] for r in chosen)


def test_augmentation_bounds(texts):
    rows = texts.where("question <> ''")
    out = augmentation.augment_questions(rows, ["id"], 3, stop_words=STOP)
    assert rows.count() <= out.count() <= 4 * rows.count()
    assert {r.question for r in rows.collect()} <= {r.question for r in out.collect()}
    again = augmentation.augment_questions(rows.repartition(5), ["id"], 3, stop_words=STOP)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def test_nearest_words_over_blocks(spark):
    rng = random.Random(1)
    vectors = [(f"w{i}", [rng.gauss(0, 1) for _ in range(8)]) for i in range(60)]
    df = spark.createDataFrame(vectors, "word string, vector array<double>")
    one = {tuple(r)[:2] for r in augmentation.nearest_words(df).collect()}
    many = {tuple(r)[:2] for r in augmentation.nearest_words(df, block_rows=7).collect()}
    assert len(one) == 60 and one == many


def test_encoding_is_padded_and_marks_unknown_words(spark):
    df = spark.createDataFrame([(1, "b a a", "x"), (2, "c", None)], "id int, q string, r string")
    vocab = encoding.build_vocab(df, ["q", "r"], max_size=2)
    assert [(r.token, r.id) for r in vocab.orderBy("id").collect()] == [("a", 2), ("b", 3)]
    rows = encoding.encode_fixed(df, ["id"], vocab, {"q": ("ids", 2), "r": ("labels", 3)}).orderBy("id").collect()
    assert [(r.ids, r.labels) for r in rows] == [([3, 2], [1, 0, 0]), ([1, 0], [0, 0, 0])]


def test_languages(spark):
    df = spark.createDataFrame([("The end of the day",), ("не на що",), ("zzz",)], "t string")
    got = [r.detected for r in language.with_detected_language(df, "t").collect()]
    assert got == ["en", "uk", None]
    known = spark.range(1).select(language.is_known_language(F.lit("UK")).alias("a"), language.is_known_language(F.lit("xx")).alias("b")).first()
    assert known.a and not known.b


def test_training_frame_labels(spark):
    df = spark.createDataFrame([("Time Gap",), ("x",)], "context string")
    assert [r[0] for r in encoding.localize_context(df, "en").collect()] == ["No context", "x"]
    with pytest.raises(ValueError):
        encoding.localize_context(df, "xx")


def test_nearest_words_over_packs(spark):
    """Ties, repeated words, nulls and vectors that are not finite, over packs of a few vectors."""
    rng = random.Random(2)
    rows = [(f"w{i:03d}", [float(rng.randint(-2, 2)) for _ in range(4)]) for i in range(150)] + [("w003", [9.0, 1.0, 0.0, 0.0])]
    odd = [("x", [1.0, float("nan"), 0.0, 0.0]), ("y", [1.0, None, 0.0, 0.0]), ("z", None), (None, [1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows + odd, "word string, vector array<double>")

    def cosine(a, b):
        norm = (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
        return sum(x * y for x, y in zip(a, b)) / norm if norm else 0.0

    expected = {}
    for word, vector in rows:
        best = max(((round(cosine(vector, v), 9), w) for w, v in rows if w != word))
        expected[word] = max(expected.get(word, (-2, "")), best)
    for pack_bytes, block_rows in ((2 << 20, 4_096), (16 * 20, 7), (16 * 4, 3)):
        got = augmentation.nearest_words(df, block_rows, pack_bytes).collect()
        assert len(got) == len(expected)
        assert all(round(r.score, 9) == expected[r.word][0] and r.synonym != r.word for r in got)
    assert augmentation.nearest_words(df.where("false")).collect() == []
    assert augmentation.nearest_words(df.where("word = 'w001'")).collect() == []


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [found.apply(i) for i in range(found.size())]
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


def test_nearest_words_move_vectors_in_proportion(spark):
    moved = []
    for rows in (600, 2_400):
        vector = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda k: F.rand(3) + F.hash("id", k) % 100)
        df = spark.range(rows).select(F.col("id").alias("word"), vector.alias("vector"))
        before = _shuffle_files(spark)
        assert augmentation.nearest_words(df, 50).count() == rows
        moved.append(sum(n for name, n in _shuffle_files(spark).items() if name not in before))
    assert moved[1] < 6 * moved[0]


def _shuffled_parts(spark):
    """Bytes of each partition that a map task wrote, for shuffles into several partitions."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    paths = [found.apply(i).getPath() for i in range(found.size())]
    parts = {}
    for path in paths:
        if path.endswith(".index") and "shuffle_" in path:
            with open(path, "rb") as file:
                offsets = [n for (n,) in struct.iter_unpack(">q", file.read())]
            if len(offsets) > 2:
                parts[path] = [b - a for a, b in zip(offsets, offsets[1:])]
    return parts


def test_frequent_tokens_of_a_large_vocabulary_meet_in_no_task(spark):
    vocab = spark.range(2, encoding.MAX_BROADCAST_ROWS + 40_002).select(F.concat(F.lit("w"), "id").alias("token"), "id")
    last = encoding.MAX_BROADCAST_ROWS + 40_001
    text = F.concat(F.repeat(F.lit("w7 "), 300), F.lit(f"w{last} w"), F.col("id").cast("string"), F.lit(" none"))
    df = spark.range(2, 2_002).select("id", text.alias("q"), F.when(F.col("id") % 2 == 0, "w9").alias("r"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    before = _shuffled_parts(spark)
    try:
        rows = encoding.encode_fixed(df, ["id"], vocab, {"q": ("ids", 304), "r": ("labels", 2)}).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(rows) == 2_000
    for r in rows:
        assert r.ids == [7] * 300 + [last, r.id, 1, 0] and r.labels == ([9, 0] if r.id % 2 == 0 else [0, 0])
    new = [p for path, p in _shuffled_parts(spark).items() if path not in before and sum(p) > 20_000]
    assert new and all(max(p) < 0.6 * sum(p) for p in new)


def test_frequent_forms_of_a_large_lookup(spark, monkeypatch):
    monkeypatch.setattr(encoding, "MAX_BROADCAST_ROWS", 3)
    monkeypatch.setattr(encoding, "FREQUENT_FORMS", 2)
    lookup = spark.createDataFrame([("a", "b"), ("a", "c"), ("d", "e"), ("f", "g"), ("h", "i"), ("k", None)], "form string, lemma string")
    df = spark.createDataFrame([(1, "a x a d"), (2, "x x h k"), (3, ""), (4, None), (5, "f")], "id int, t string")
    got = {r.id: r.t for r in encoding.normalize_tokens(df, "t", lookup, ["id"]).collect()}
    assert got == {1: "b x b e", 2: "x x i k", 3: "", 4: None, 5: "g"}
