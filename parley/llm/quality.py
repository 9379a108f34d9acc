"""Text quality: a support vector machine on naive-Bayes-scaled n-gram indicators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import linear
from parley.llm.common import held_out
from parley.llm.wordhash import WHITESPACE, mix, word_table

THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
#: Borders of the buckets for shares of words with some trait.
SHARES = np.array([0.0, 0.01, 0.03, 0.1, 0.3, 0.6])


def _byte_classes() -> np.ndarray:
    """Bit per kind: lower 1, upper 2, digit 4, sentence mark 8, other ASCII mark 16, non-ASCII 32."""
    out = np.zeros(256, np.uint8)
    for c in range(256):
        ch = chr(c)
        out[c] = 32 if c > 127 else 1 if ch.islower() else 2 if ch.isupper() else 4 if ch.isdigit() else 8 if ch in ".,;:!?'\"()-" else 16
    return out


_CLASSES = _byte_classes()


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Indicators of each text: words, shapes of one to three words, and shares of word traits.

    The shape of a word: which kinds of characters it has, how long it is, whether it ends in a
    mark, and whether the word before was the same.
    """
    hashes, classes, lengths, last, bounds = word_table(texts, WHITESPACE, _CLASSES)
    rows = np.repeat(np.arange(len(texts)), np.diff(bounds))
    limit = np.uint64((1 << linear.BITS) - 1)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    size = np.searchsorted([2, 4, 8, 16], lengths, "right")
    shape = classes.astype(np.uint64) | (same.astype(np.uint64) << np.uint64(6)) | (size.astype(np.uint64) << np.uint64(7)) | (
        (last.astype(np.uint64) & np.uint64(24)) << np.uint64(7))
    found, owners = [mix(hashes) & limit], [rows]
    gram = mix(shape + np.uint64(1 << 20))
    found.append(gram & limit)
    owners.append(rows)
    for n in (1, 2):
        if len(hashes) <= n:
            break
        gram = mix(gram[:-1] * np.uint64(31) + shape[n:] + np.uint64(n))
        inside = rows[n:] == rows[:-n]
        found.append(gram[inside] & limit)
        owners.append(rows[n:][inside])
    counts = np.maximum(np.diff(bounds), 1)
    traits = [same, (classes & 3) == 2, (classes & 16) > 0, (classes & 4) > 0, (classes & 35) == 0, lengths > 20, (last & 8) > 0]
    # Distinct words a text: shares of repeated ones.
    for k, trait in enumerate(traits):
        share = np.bincount(rows[trait], minlength=len(texts)) / counts
        bucket = np.searchsorted(SHARES, share, "left").astype(np.uint64)
        found.append(mix(bucket + np.uint64((1 << 24) + (k << 8))) & limit)
        owners.append(np.arange(len(texts)))
    length = np.frompyfunc(int.bit_length, 1, 1)(np.diff(bounds)).astype(np.uint64)
    found.append(mix(length + np.uint64(1 << 28)) & limit)
    owners.append(np.arange(len(texts)))
    return np.concatenate(found).astype(np.int64), np.concatenate(owners)


def train_quality(docs: DataFrame, labels: DataFrame, per_class: int = linear.PER_CLASS) -> dict:
    """Model from the labelled rows outside the held-out part; ``labels``: doc_id, quality."""
    rows = labels.where(~held_out(F.col("doc_id"), FOLDS, HELD_OUT)).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").alias("label"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return linear.train(texts, rows, features, per_class)


def score_quality(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null text counts as empty; empty texts get the score of a text without words; repeated rows
    are scored one by one; without labels of both classes every text gets the share of label 1.
    An empty table gives no rows; further columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(linear.scorer(model, features, ["doc_id"]), "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score",
                         linear.predicted(F.col("score"), threshold).alias("predicted"))


def keep_quality(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that reach the threshold; all columns."""
    names = docs.columns
    boxed = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("_row"), F.col("text").cast("string").alias("text"))
    row = boxed.schema["_row"].dataType.simpleString()
    scored = boxed.mapInArrow(linear.scorer(model, features, ["_row"]), f"_row {row}, score double")
    return scored.where(F.col("score") >= threshold).select(*[F.col("_row").getField(c).alias(c) for c in names])
