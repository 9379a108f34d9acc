"""Language identification by character n-grams, trained on any labelled table.

Letters in lower case, everything else one blank; runs of one to four characters are hashed to
``BUCKETS`` numbers.  Training is one aggregate over (label, bucket); the model is a multinomial with
smoothed log shares and has a fixed size per language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
ORDERS = 4
SMOOTHING = 0.1
#: Mean log ratio per n-gram between the best and the second language, below which it is unknown.
MARGIN = 0.02
#: Languages a model may have; with ``BUCKETS`` that bounds its size.
MAX_LANGUAGES = 1_000
#: Characters that are looked at together.
CHUNK = 1 << 18

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _normalized(text: Column) -> Column:
    """Letters in lower case; whatever is between them, and both ends, as a blank."""
    inner = F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{M}]+", " ")
    return F.concat(F.lit(" "), F.trim(inner), F.lit(" "))


def gram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, text number of each) of all n-grams of normalized texts; a blank text has none."""
    owners, found = [], []
    codes = np.frombuffer("\0".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    row = np.cumsum(codes == 0)
    grams = np.zeros(len(codes), np.uint64)
    blank = codes == 32
    for n in range(1, ORDERS + 1):
        if len(codes) < n:
            break
        grams = (grams[: len(codes) - n + 1] ^ codes[n - 1 :]) * _MIX
        grams ^= grams >> np.uint64(29)
        inside = (row[n - 1 :] == row[: len(codes) - n + 1]) & (codes[: len(codes) - n + 1] != 0)
        # A blank alone, or two, tell nothing.
        inside &= ~blank[: len(codes) - n + 1] | (n > 1)
        if n == 2:
            inside &= ~(blank[:-1] & blank[1:])
        found.append((((grams + np.uint64(n)) * _MIX) >> np.uint64(48))[inside])
        owners.append(row[: len(codes) - n + 1][inside])
    return np.concatenate(found).astype(np.int64), np.concatenate(owners)


def _chunks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    first, size, texts = 0, 0, []
    for i in range(len(column)):
        text = column[i].as_py()
        if texts and size + len(text) > CHUNK:
            yield first, texts
            first, size, texts = i, 0, []
        texts.append(text)
        size += len(text)
    if texts:
        yield first, texts


def _counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, bucket, n) of a partition."""
    for part in parts:
        labels = np.array(part.column("label").to_pylist(), object)
        counts: dict[str, np.ndarray] = {}
        for first, texts in _chunks(part.column("text")):
            buckets, owners = gram_buckets(texts)
            mine = labels[first : first + len(texts)]
            for label in set(mine.tolist()):
                counts.setdefault(label, np.zeros(BUCKETS, np.int64))
                counts[label] += np.bincount(buckets[(mine == label)[owners]], minlength=BUCKETS)
        for label, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["label", "bucket", "n"])


def train_languages(df: DataFrame, text: str, label: str) -> dict[str, np.ndarray]:
    """Log shares of the n-gram buckets per label; rows without a label are left out."""
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), _normalized(F.col(text)).alias("text"))
    found = rows.mapInArrow(_counts, "label string, bucket int, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    # A fixed number of rows per language, whatever the table.
    labels = [r.label for r in found.select("label").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(labels) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = {name: np.zeros(BUCKETS) for name in sorted(labels)}
    for row in found.groupBy("label").agg(F.collect_list(F.struct("bucket", "n")).alias("cells")).collect():
        at = np.array([c.bucket for c in row.cells])
        counts[row.label][at] = [c.n for c in row.cells]
    seen = sum(counts.values(), np.zeros(BUCKETS)) > 0
    # What no language has ever shown tells nothing about any.
    return {name: np.where(seen, np.log((n + SMOOTHING) / (n.sum() + SMOOTHING * BUCKETS)), 0.0).astype(np.float32) for name, n in counts.items()}


def identify_languages(df: DataFrame, text: str, model: dict[str, np.ndarray], out: str = "detected", margin: float = MARGIN) -> DataFrame:
    """Add ``out``, the likeliest language of each text.

    Null where the text has no letters or only runs of them that were never seen, where the best two are closer than ``margin`` per n-gram, or
    where the model has no language.  On a tie the alphabetically first name wins (with a margin of 0).
    """
    names = sorted(model)
    shares = df.sparkSession.sparkContext.broadcast(np.stack([model[n] for n in names]) if names else np.zeros((0, BUCKETS), np.float32))
    columns = df.columns
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), _normalized(F.col(f"`{text}`")).alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shares.value
        known = (table != 0).any(0)
        for part in parts:
            for first, texts in _chunks(part.column("text")):
                buckets, owners = gram_buckets(texts)
                buckets, owners = buckets[known[buckets]], owners[known[buckets]]
                n = np.bincount(owners, minlength=len(texts))
                scores = np.stack([np.bincount(owners, weights=row[buckets], minlength=len(texts)) for row in table]) if names else np.zeros((1, len(texts)))
                best = scores.argmax(0)
                ranked = np.sort(scores, 0)
                ahead = (ranked[-1] - ranked[-2]) / np.maximum(n, 1) if len(names) > 1 else np.full(len(texts), np.inf)
                sure = (n > 0) & (ahead >= margin) & bool(names)
                codes = [names[b] if ok else None for b, ok in zip(best.tolist(), sure.tolist())]
                yield pa.RecordBatch.from_arrays([part.column("_row").slice(first, len(texts)), pa.array(codes, pa.string())], names=["_row", "_code"])

    shape = rows.schema["_row"].dataType.simpleString()
    found = rows.mapInArrow(run, f"_row {shape}, _code string")
    return found.select(*[F.col("_row").getField(c).alias(c) for c in columns if c != out], F.col("_code").alias(out))
