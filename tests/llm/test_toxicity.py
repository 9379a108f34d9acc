"""Restoring disguised words: shapes, an exhaustive search as reference, long texts, and a plain scorer."""

import itertools
import time

import numpy as np
import pyarrow as pa
import pytest

from parley.llm import linear, toxicity

WORDS = "such a stupid idiot moron you are the this is an what kind of person said that trash loser it in to be".split()


@pytest.fixture(scope="module")
def model():
    text = " ".join(WORDS * 50)
    (found,) = toxicity._trigrams(iter([pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])]))
    three = np.zeros(toxicity.LETTERS**3)
    three[found.column(0).to_numpy()] = found.column(1).to_numpy()
    three = three.reshape((toxicity.LETTERS,) * 3)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 0.5) / (one.sum() + 0.5 * toxicity.LETTERS)
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    return np.log((three + 5 * p2[None]) / (three.sum(2, keepdims=True) + 5))


@pytest.mark.parametrize(
    ("text", "word"),
    [("such a s t u p i d person", "stupid"), ('"i d i o t"', "idiot"), ("1 d 1 0 t", "idiot"), ("$ t u p i d", "stupid"), ("!diot", "idiot"), ("id.iot", "idiot"),
     ("mo-ron", "moron"), ("stuuuupid", "stupid"), ("st*pid", "stupid"), ("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("(l0$er)", "loser"), ("ïd1ot", "idiot"), ("a$$", "ass")],
)
def test_disguises(model, text, word):
    found = toxicity.Restorer(model)(text)
    assert word in found.split() and found.startswith(text[:2])


@pytest.mark.parametrize("text", ["", "plain words, nothing else.", "(in brackets) wow!", "1 2 3 4", "**bold**", "word***", "$5 and 10%", "a, b, c", " \n\n "])
def test_plain_texts_stay(model, text):
    assert toxicity.Restorer(model)(text) == text


def test_texts_do_not_mix(model):
    texts = [b"x", b"a", b"s t", b"", b"u", b"1d1ot", b"p i d"]
    together = toxicity.Restorer(model).restore_all(texts)
    assert together == [toxicity.Restorer(model).restore_all([t])[0] for t in texts]


def exhaustive(options, model):
    """Best score over all ways through a lattice."""
    best = -np.inf
    for choice in itertools.product(*options):
        a, b, score = 0, 0, 0.0
        for letter, cost in choice:
            score -= cost
            if letter > 0:
                score, a, b = score + model[a][b][letter], b, letter
            elif letter == toxicity.BORDER and b:
                score, a, b = score + model[a][b][0], b, 0
        best = max(best, score + (model[a][b][0] if b else 0.0))
    return best


def spelled_score(text, options, model):
    """Best score over the ways that spell ``text``."""
    best = -np.inf
    for choice in itertools.product(*options):
        a, b, score, out = 0, 0, 0.0, ""
        for letter, cost in choice:
            score -= cost
            if letter > 0:
                score, a, b, out = score + model[a][b][letter], b, letter, out + chr(96 + letter)
            elif letter == toxicity.BORDER and b:
                score, a, b, out = score + model[a][b][0], b, 0, out + " "
        if out == text:
            best = max(best, score + (model[a][b][0] if b else 0.0))
    return best


@pytest.mark.parametrize("span", ["1d10t", "i d i o t", "a s t", "st*p", "l0$er", "mo-ron", "oo1l|", "$.t-0"])
def test_search_equals_exhaustive(model, span):
    options, table = toxicity.lattice(span), model.tolist()
    found = toxicity.decode(options, table)
    assert spelled_score(found, options, table) == pytest.approx(exhaustive(options, table))


@pytest.mark.parametrize("text", ["ab" * 500_000, "a" * 1_000_000, "a1" * 250_000, "a*" * 100_000, "a.b" * 200_000])
def test_long_runs_are_linear(model, text):
    start = time.process_time()
    toxicity.Restorer(model)(text)
    assert time.process_time() - start < 10


def test_scores_equal_a_plain_scorer(spark, model):
    """The map over batches gives the logistic of the summed weights of a text's distinct indicators."""
    texts = ["you 1d10t", None, "", "a plain text", "s t u p i d " * 30, "a plain text"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rng = np.random.Generator(np.random.PCG64(2))
    at = np.arange(1 << linear.BITS, dtype=np.int32)
    weights = {"at": at, "w": rng.normal(size=len(at)), "slope": 0.7, "offset": -0.2}
    found = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, (model, weights)).collect()}
    restorer = toxicity.Restorer(model)
    for i, text in enumerate(texts):
        indicators, _ = toxicity.features([restorer(text or "").encode()])
        margin = 0.7 * weights["w"][np.unique(indicators)].sum() - 0.2
        assert found[i] == pytest.approx(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


def test_fit_on_few_labels_uses_rare_indicators():
    """Words of two rows count, however small the sample is."""
    rows = [np.array([1, 10 + i % 2]) for i in range(8)] + [np.array([1, 20 + i % 2]) for i in range(8)]
    found = linear.fit(rows, np.array([1] * 8 + [0] * 8), (8.0, 8.0))
    weight = dict(zip(found["at"].tolist(), found["w"].tolist()))
    assert weight[10] > 0 and weight[11] > 0 and weight[20] < 0 and weight[21] < 0 and abs(weight[1]) < 1e-9
