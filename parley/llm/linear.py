"""Support vector machine on n-gram indicators scaled by class log-count ratios.

Every indicator is scaled by the log ratio of its smoothed shares in the two classes; a linear
hinge-loss model on the scaled indicators is then fitted by dual coordinate descent, and its margin
is turned into a probability by a logistic curve fitted on rows that the model has not seen.

The fit runs in one task on a bounded sample: at most ``per_class`` labelled documents per class,
those with the smallest hashes of their ids.  Scoring is a map over all documents.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import pieces

BITS = 18
PER_CLASS = 4_000
#: Indicators seen in fewer rows get no weight: one row says nothing about a class.
MIN_ROWS = 2
EPOCHS, COST = 30, 0.02

#: Features of a batch: texts -> (feature numbers below 2 ** BITS, text number of each).
Featurize = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def _distinct(features: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique((rows.astype(np.int64) << BITS) | features)
    return (keys & ((1 << BITS) - 1)).astype(np.int32), (keys >> BITS).astype(np.int64)


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dims: int, cost: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of the hinge-loss machine; ``rows``: (indices, values) each, ``cost``: per row."""
    w, alpha = np.zeros(dims), np.zeros(len(rows))
    norms = [float(v @ v) for _, v in rows]
    draw = np.random.Generator(np.random.PCG64(5))
    for _ in range(epochs):
        moved = 0.0
        for i in draw.permutation(len(rows)):
            at, v = rows[i]
            if not norms[i]:
                continue
            slope = y[i] * float(w[at] @ v) - 1
            new = min(max(alpha[i] - slope / norms[i], 0.0), cost[i])
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * y[i] * v
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w


def fit_curve(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the logistic curve through weighted (margin, label) points."""
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        e, h = weight * (p - y), np.maximum(weight * p * (1 - p), 1e-12)
        # A weak pull to slope 1 keeps separable margins finite.
        ga, gb = float(e @ margins) + 0.1 * (a - 1), float(e.sum()) + 0.1 * b
        haa, hab, hbb = float(h @ (margins * margins)) + 0.1, float(h @ margins), float(h.sum()) + 0.1
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db))
        a, b = a - da / size, b - db / size
        if abs(da) + abs(db) < 1e-7:
            break
    return max(a, 0.05), b


def fit(rows: list[np.ndarray], labels: np.ndarray, shares: tuple[float, float]) -> dict:
    """Model from indicator rows; ``shares``: how often labels 0 and 1 occur outside the sample."""
    y = np.where(labels == 1, 1.0, -1.0)
    n1, n0 = int((labels == 1).sum()), int((labels == 0).sum())
    if not n1 or not n0:
        return {"at": np.empty(0, np.int32), "w": np.empty(0), "slope": 1.0, "offset": np.log((n1 + 1) / (n0 + 1))}
    # Every fourth row of a class is kept for the curve and takes no part in counts or weights.
    fold = np.zeros(len(labels), bool)
    for k in (0, 1):
        fold[np.flatnonzero(labels == k)[3::4]] = True
    df = [np.zeros(1 << BITS), np.zeros(1 << BITS)]
    for at, label, kept in zip(rows, labels, fold):
        if not kept:
            df[label][at] += 1
    ratio = np.log((df[1] + 1) / (df[1] + 1).sum()) - np.log((df[0] + 1) / (df[0] + 1).sum())
    chosen = np.flatnonzero(df[0] + df[1] >= MIN_ROWS)
    ratio = ratio[chosen]
    number = np.full(1 << BITS, -1)
    number[chosen] = np.arange(len(chosen))
    # The last column is the bias.
    scaled = []
    for at in rows:
        at = number[at]
        at = at[at >= 0]
        scaled.append((np.append(at, len(chosen)), np.append(ratio[at], 1.0)))
    weight = np.where(labels == 1, shares[1] / n1, shares[0] / n0)
    weight = weight / weight.mean()
    train = np.flatnonzero(~fold)
    w = dual_descent([scaled[i] for i in train], y[train], len(chosen) + 1, np.full(len(train), COST))
    margins = np.array([w[scaled[i][0]] @ scaled[i][1] for i in np.flatnonzero(fold)])
    slope, offset = fit_curve(margins, (labels[fold] == 1).astype(float), weight[fold])
    return {"at": chosen.astype(np.int32), "w": w[:-1] * ratio, "slope": slope, "offset": offset + slope * w[-1]}


def _rows(featurize: Featurize):
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("features", pa.list_(pa.int32()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(parts):
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            at, row = _distinct(*featurize(texts))
            bounds = np.searchsorted(row, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(at))], schema=schema)

    return run


def _smallest(labels: DataFrame, rows: int, n: int) -> DataFrame:
    """The ``n`` of ``rows`` labels with the smallest hashes of their ids.

    A threshold leaves about twice ``n`` of them, so that hardly any rows go to the task that sorts.
    """
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    if rows > 2 * n + 1000:
        labels = labels.where(place < int((2 * n + 1000) / rows * 2**63))
    return labels.orderBy(place, "doc_id").limit(n)


def train(docs: DataFrame, labels: DataFrame, featurize: Featurize, per_class: int = PER_CLASS) -> dict:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1; other labels and null ids are left out)."""
    labels = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    shares = {r.label: r["n"] for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [_smallest(labels.where(F.col("label") == k), shares.get(k, 0), per_class) for k in (0, 1)]
    chosen = parts[0].unionByName(parts[1])  # at most 2 * per_class rows
    texts = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label")
    rows = texts.mapInArrow(_rows(featurize), "doc_id bigint, label int, features array<int>")
    sizes = (float(shares.get(0, 0)), float(shares.get(1, 0)))

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc_id", kind="stable").drop_duplicates("doc_id")
        order = np.random.Generator(np.random.PCG64(3)).permutation(len(frame))
        model = fit([np.asarray(frame.features.iloc[i], np.int64) for i in order], frame.label.to_numpy()[order], sizes)
        return pd.DataFrame({"model": [pickle.dumps(model)]})

    found = rows.withColumn("sample", F.lit(0)).groupBy("sample").applyInPandas(fitted, "model binary").first()
    return pickle.loads(bytes(found.model)) if found else {"at": np.empty(0, np.int32), "w": np.empty(0), "slope": 1.0, "offset": 0.0}


def scorer(model: dict, featurize: Featurize, columns: list[str]):
    """A map over batches with a column text: ``columns`` and the score."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, used = np.zeros(1 << BITS), np.zeros(1 << BITS, bool)
        weights[model["at"]], used[model["at"]] = model["w"], True
        for part in pieces(parts):
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            margins = np.zeros(len(texts))
            # A few megabytes at a time keep the feature arrays small.
            first = 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and (last == first or size + len(texts[last]) <= 1 << 21):
                    size += len(texts[last])
                    last += 1
                at, row = featurize(texts[first:last])
                keep = used[at]
                at, row = _distinct(at[keep], row[keep])
                margins[first:last] = np.bincount(row, weights[at], minlength=last - first)
                first = last
            score = 1 / (1 + np.exp(-np.clip(model["slope"] * margins + model["offset"], -35, 35)))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], pa.array(score)], names=[*columns, "score"])

    return run


def predicted(score: Column, threshold: float) -> Column:
    return (score >= threshold).cast("int")
