"""Scoring predictions against truths, as one table and one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import metrics as m
from parley.operators.encoding import normalize_tokens
from parley.operators.limits import sample_exact

SCORES = ("bleu", "rouge1", "rouge_l", "wer", "cer", "jaccard")


def score_pairs(df: DataFrame, truth: str = "y_true", pred: str = "y_pred", variant: str = "f1") -> DataFrame:
    """Add the scores of each row.

    ``variant="f1"`` takes F1 overlaps, smoothed BLEU and word-set Jaccard; ``"precision"``
    takes overlap precision, unsmoothed BLEU and the share of the truth's vocabulary.
    """
    if variant not in ("f1", "precision"):
        raise ValueError("variant must be 'f1' or 'precision'")
    t, p = F.col(truth), F.col(pred)
    f1 = variant == "f1"
    return df.withColumns(
        {
            "bleu": m.bleu(t, p, smooth=f1),
            "rouge1": m.rouge1(t, p)[variant],
            "rouge_l": m.rouge_l(t, p)[variant],
            "wer": m.wer(t, p),
            "cer": m.cer(t, p),
            "jaccard": m.jaccard(t, p) if f1 else m.vocab_recall(t, p),
        }
    )


def evaluate_pairs(
    predictions: DataFrame,
    truths: DataFrame,
    ids: Sequence[str] = ("id",),
    samples: int | None = None,
    variant: str = "f1",
    seed: int = 42,
    lemmas: DataFrame | None = None,
) -> DataFrame:
    """Mean of every score over ``predictions`` joined to ``truths`` on ``ids``.

    ``samples`` scores exactly that many random pairs; without it all are scored.  ``lemmas``
    (form, lemma) is applied to both texts before scoring.
    """
    keys = list(ids)
    pairs = predictions.select(*keys, "y_pred").join(truths.select(*keys, "y_true"), keys)
    if samples is not None:
        pairs = sample_exact(pairs, samples, keys, seed)
    if lemmas is not None:
        for column in ("y_true", "y_pred"):
            pairs = normalize_tokens(pairs, column, lemmas, keys)
    scored = score_pairs(pairs, variant=variant)
    return scored.agg(F.count(F.lit(1)).alias("pairs"), *[F.avg(s).alias(s) for s in SCORES])
