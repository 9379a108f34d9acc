"""Text-similarity scores of a prediction against a truth, as column expressions.

Words are whitespace-separated.  Scores whose denominator is empty are null.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.binding import let
from parley.functions.edits import list_edits, text_edits

# Fixed value: numerator that smoothing gives an n-gram order without any match.
BLEU_EPSILON = 0.1
# What an unsmoothed order without a match counts: the smallest normal double.
SMALLEST_DOUBLE = 2.2250738585072014e-308


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top.cast("double") / bottom)


def cer(truth: Column, pred: Column) -> Column:
    """Character edits per character of the truth."""
    return _ratio(text_edits(truth, pred), F.char_length(truth))


def _as_characters(items: Column, alphabet: Column) -> Column:
    """Each item as one character, its position in ``alphabet`` moved to the astral planes."""
    codes = F.transform(
        items, lambda w: F.lpad(F.hex(F.lit(0x10000).cast("bigint") + F.array_position(alphabet, w)), 8, "0")
    )
    return F.decode(F.unhex(F.array_join(codes, "")), "UTF-32")


def wer(truth: Column, pred: Column) -> Column:
    """Word edits per word of the truth: for lists that are not long the built-in edit distance over one character per word."""
    t, p = words(truth), words(pred)
    edits = let(F.array_union(t, p), lambda abc: F.levenshtein(_as_characters(t, abc), _as_characters(p, abc)))
    return _ratio(list_edits(t, p, edits), F.size(t))


def jaccard(truth: Column, pred: Column) -> Column:
    """Shared words over all words, as sets."""
    t, p = words(truth), words(pred)
    return _ratio(F.size(F.array_intersect(t, p)), F.size(F.array_union(t, p)))


def vocab_recall(truth: Column, pred: Column) -> Column:
    """Share of the truth's vocabulary (lower-case words of two or more characters) in the prediction."""
    def vocabulary(text):
        return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}_]{2,}"), F.lit(0)))

    t = vocabulary(truth)
    return _ratio(F.size(F.array_intersect(t, vocabulary(pred))), F.size(t))


def _overlaps(a, b) -> list[int]:
    """n-grams in common, counted with repetition, for n = 1 to 4."""
    def grams(items, n):
        return Counter(zip(*[items[i:] for i in range(n)]))

    return [(grams(a, n) & grams(b, n)).total() for n in range(1, 5)]


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _shared_ngrams(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else _overlaps(list(x), list(y)) for x, y in zip(a, b)])


def _precision_recall_f1(hits: Column, truth_size: Column, pred_size: Column) -> Column:
    precision = F.when(pred_size > 0, hits / pred_size).otherwise(0.0)
    recall = F.when(truth_size > 0, hits / truth_size).otherwise(0.0)
    total = truth_size + pred_size
    return F.struct(
        precision.alias("precision"),
        recall.alias("recall"),
        F.when(total > 0, 2.0 * hits / total).otherwise(0.0).alias("f1"),
    )


def rouge1(truth: Column, pred: Column) -> Column:
    """Unigram overlap counted with repetition: struct of precision, recall, f1."""
    t, p = words(truth), words(pred)
    return _precision_recall_f1(F.get(_shared_ngrams(t, p), F.lit(0)), F.size(t), F.size(p))


def _lcs(a, b) -> int:
    """Length of the longest common subsequence, one bit per item of ``a``."""
    where: dict = {}
    for i, item in enumerate(a):
        where[item] = where.get(item, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for item in b:
        hit = open_bits & where.get(item, 0)
        open_bits = ((open_bits + hit) | (open_bits - hit)) & full
    return len(a) - open_bits.bit_count()


@F.pandas_udf(T.IntegerType())
def _lcs_words(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else _lcs(x, y) for x, y in zip(a, b)], dtype="Int32")


def rouge_l(truth: Column, pred: Column) -> Column:
    """Longest common word subsequence: struct of precision, recall, f1."""
    t, p = words(truth), words(pred)
    return _precision_recall_f1(_lcs_words(t, p), F.size(t), F.size(p))


def bleu(truth: Column, pred: Column, smooth: bool = True) -> Column:
    """Sentence BLEU over 1- to 4-grams.

    ``smooth`` counts an order without a match as ``BLEU_EPSILON`` matches; otherwise such an
    order counts as the smallest double, which makes the score all but zero.
    """
    t, p = words(truth), words(pred)
    hits = _shared_ngrams(t, p)

    def order_log(n: int, length: Column) -> Column:
        found, grams = F.get(hits, F.lit(n - 1)), F.greatest(length - (n - 1), F.lit(1))
        missing = F.lit(BLEU_EPSILON) / grams if smooth else F.lit(SMALLEST_DOUBLE)
        return F.log(F.when(found > 0, found / grams).otherwise(missing))

    truth_size, size = F.size(t), F.size(p)
    mean_log = (order_log(1, size) + order_log(2, size) + order_log(3, size) + order_log(4, size)) / 4
    shortfall = F.when(size > truth_size, 0.0).otherwise(1 - truth_size / F.greatest(size, F.lit(1)))
    score = F.exp(shortfall) * F.exp(mean_log)
    return F.when(F.get(hits, F.lit(0)) == 0, 0.0).when(hits.isNotNull(), score)
