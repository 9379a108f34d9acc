"""Stems learnt from a vocabulary, against a hand-made list, a plain version and awkward rows."""

import collections
import itertools

from pyspark.sql import functions as F

from parley.operators import evaluation, stems

# Hand-made: regular forms by base word.
BASES = """walk talk look jump help call open play turn start want need clean paint print press touch reach watch
climb knock enter offer order answer listen remember follow borrow laugh cough point count shout wait land""".split()
FORMS = {base: [base, f"{base}ed", f"{base}ing", f"{base}s" if base[-2:] not in ("ss", "ch") else f"{base}es"] for base in BASES}
# Words that have no other form here.
ALONE = "chair window mountain yellow because under silver garden pencil winter although bottle purple kitchen".split()


def table(spark, words, parts=3):
    return spark.createDataFrame([(w, n) for w, n in words], "word string, count bigint").repartition(parts)


def plain_endings(words):
    cuts = [(w[: len(w) - k], w[len(w) - k :]) for w in words if len(w) >= 4 for k in range(min(5, len(w) - 4) + 1)]
    goes_on = collections.defaultdict(set)
    for stem, ending in cuts:
        goes_on[stem].add(ending[:1])
    found = collections.defaultdict(list)
    for stem, ending in cuts:
        if len(goes_on[stem]) > 1:
            found[ending].append(stem)
    return {e: len(s) for e, s in found.items() if len(s) >= 5 and len({x[-1] for x in s}) >= 3}


def test_agrees_with_a_hand_made_list(spark):
    words = [w for forms in FORMS.values() for w in forms] + ALONE
    rows = stems.learn_stems(table(spark, [(w, 1) for w in words])).collect()
    lemma = {r.form: r.lemma for r in rows}
    right = sum(lemma.get(w, w) == base for base, forms in FORMS.items() for w in forms) + sum(lemma.get(w, w) == w for w in ALONE)
    assert right / len(words) >= 0.97
    base_of = {w: b for b, forms in FORMS.items() for w in forms}
    for a, b in itertools.combinations(words, 2):
        if lemma.get(a, a) == lemma.get(b, b):
            assert base_of.get(a, a) == base_of.get(b, b)  # nothing is merged that does not belong together


def test_endings_equal_a_plain_version(spark):
    words = sorted({w for forms in FORMS.values() for w in forms} | set(ALONE) | {"a", "of", "the"})
    cuts = stems.word_cuts(table(spark, [(w, 1) for w in words]))
    assert {r.ending: r.beginnings for r in stems.learn_endings(cuts).collect()} == plain_endings(words)


def test_order_of_rows_does_not_matter(spark):
    words = [(w, i % 3 + 1) for i, w in enumerate(w for forms in FORMS.values() for w in forms)]
    one = {tuple(r) for r in stems.learn_stems(table(spark, words, 1)).collect()}
    assert one == {tuple(r) for r in stems.learn_stems(table(spark, words[::-1], 4)).collect()}


def test_awkward_rows(spark):
    empty = spark.createDataFrame([], "text string")
    assert stems.stem_lemmas(empty, ["text"]).count() == 0
    rows = spark.createDataFrame([(None,), ("",), ("x1 12 --",), ("wörter Wörter wörterbuch",)], "text string")
    assert {(r.word, r["count"]) for r in stems.word_counts(rows, ["text"]).collect()} == {("wörter", 2), ("wörterbuch", 1)}
    assert stems.learn_stems(spark.createDataFrame([(None, 3)], "word string, count bigint")).count() == 0


def test_scores_with_learnt_lemmas(spark):
    lemmas = stems.learn_stems(table(spark, [(w, 1) for forms in FORMS.values() for w in forms])).select("form", "lemma")
    truths = spark.createDataFrame([(1, "they walked and talked"), (2, "she jumps")], "id int, y_true string")
    said = truths.select("id", F.when(F.col("id") == 1, "they walking and talks").otherwise("she jumping").alias("y_pred"))
    assert evaluation.evaluate_pairs(said, truths).first().wer > 0
    assert evaluation.evaluate_pairs(said, truths, lemmas=lemmas).first().wer == 0
