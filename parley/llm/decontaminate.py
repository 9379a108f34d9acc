"""Benchmark passages in documents: a prefix-filtered join of shingle sets.

An item's text is cut into windows of ``window`` consecutive words.  A window, seen as the set of
its word shingles, is contained in a document only if every one of its shingles is, so one of them
is a sufficient prefix: the rarest.  Rarity is the number of occurrences of each benchmark
shingle in all documents (one pass, summed by key).

The join then probes each document position with the prefix tokens only.  A hit of the token that
stands at offset o of a window puts the window's start at p - o; the positional and length bounds
(start not before the first word, end not after the last one) come next, and then the window's
words are compared, text by text.

The probe side is an index of distinct windows.  It is broadcast in chunks of at most
``CHUNK_WINDOWS`` windows; a larger benchmark takes several passes over the documents, each adding
its hits to the row, so no side is ever unbounded in memory and no document is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import pieces
from parley.llm.wordhash import NOT_ALNUM, batches, mix
from parley.plans.ranking import with_position
from parley.plans.scratch import settle

WINDOW = 10
SHINGLE_WORDS = 5
CHUNK_WINDOWS = 200_000

_CLEAN = bytes(32 if c in NOT_ALNUM else c for c in range(256))


def split_words(text: bytes | None) -> list[bytes]:
    """Words (ASCII letters and digits and all non-ASCII characters) with A-Z in lower case."""
    return [w for w in (text or b"").lower().translate(_CLEAN).split(b" ") if w]


def _shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hash of the ``words`` words from each position on (at the end: of too few, see callers)."""
    out = np.full(len(hashes), words, np.uint64)
    for k in range(words):
        out[: len(hashes) - k] = mix(out[: len(hashes) - k] + hashes[k:])
    return out


def _windows(window: int, shingle: int):
    """Items to windows: item_id, words (joined), n, tokens (shingle hashes by offset)."""
    schema = pa.schema([("item_id", pa.string()), ("words", pa.binary()), ("n", pa.int32()), ("tokens", pa.list_(pa.int64()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(parts):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            ids = part.column("item_id").to_pylist()
            for first, hashes, bounds in batches(texts, NOT_ALNUM):
                rows = []
                for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
                    n = min(window, int(hi - lo))
                    if not n:
                        continue
                    words = split_words(texts[first + i])
                    k = min(shingle, n)
                    tokens = _shingles(hashes[lo:hi], k).view(np.int64)
                    for at in range(len(words) - n + 1):
                        rows.append((ids[first + i], b" ".join(words[at : at + n]), n, tokens[at : at + n - k + 1].tolist()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


class _Tokens:
    """Sorted token hashes with a bit table in front: one look-up per position for most words."""

    def __init__(self, values: np.ndarray):
        self.sorted = np.unique(values)
        self.bits = max(16, int(len(self.sorted)).bit_length() + 5)
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self._slot(self.sorted)] = True

    def _slot(self, values: np.ndarray) -> np.ndarray:
        return (values >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``values``, index of the token found there)."""
        at = np.flatnonzero(self.table[self._slot(values)])
        where = np.searchsorted(self.sorted, values[at])
        ok = where < len(self.sorted)
        ok[ok] = self.sorted[where[ok]] == values[at][ok]
        return at[ok], where[ok]


def _count(tokens_by_length: dict[int, np.ndarray]):
    """Occurrences of benchmark shingles in the documents of a partition."""
    schema = pa.schema([("k", pa.int32()), ("token", pa.int64()), ("n", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {k: _Tokens(v.view(np.uint64)) for k, v in tokens_by_length.items()}
        seen = {k: np.zeros(len(t.sorted), np.int64) for k, t in index.items()}
        for part in pieces(parts):
            for _, hashes, _ in batches(part.column("text").cast(pa.binary()).to_pylist(), NOT_ALNUM):
                for k, tokens in index.items():
                    _, which = tokens.find(_shingles(hashes, k))
                    seen[k] += np.bincount(which, minlength=len(seen[k]))
        for k, counts in seen.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(index[k].sorted[at].view(np.int64)), pa.array(counts[at])], schema=schema)

    return run


def _probe(index: dict[int, dict[int, list[tuple[int, int, int]]]], texts_of: list[bytes]):
    """Add the hits of one chunk of windows to every document.

    ``index``: shingle length -> prefix token -> (offset, words of the window, number in ``texts_of``).
    Hits are pairs (start, end) of word positions in ``hits`` and window texts in ``found``.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = {k: (_Tokens(np.array(list(v), np.int64).view(np.uint64)), v) for k, v in index.items()}
        for part in pieces(parts):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            n_words = np.zeros(len(texts), np.int64)
            hits, found = part.column("hits").to_pylist(), part.column("found").to_pylist()
            for first, hashes, bounds in batches(texts, NOT_ALNUM):
                n_words[first : first + len(bounds) - 1] = np.diff(bounds)
                candidates: dict[int, list[tuple[int, int, int]]] = {}
                for k, (tokens, windows) in lookup.items():
                    at, which = tokens.find(_shingles(hashes, k))
                    docs = np.searchsorted(bounds, at, "right") - 1
                    values = tokens.sorted[which].view(np.int64)
                    for p, doc, value in zip(at.tolist(), docs.tolist(), values.tolist()):
                        p -= int(bounds[doc])
                        size = int(bounds[doc + 1] - bounds[doc])
                        for offset, n, number in windows[value]:
                            if 0 <= p - offset and p - offset + n <= size:
                                candidates.setdefault(doc, []).append((p - offset, n, number))
                for doc, spans in candidates.items():
                    words = split_words(texts[first + doc])
                    for start, n, number in spans:
                        if b" ".join(words[start : start + n]) == texts_of[number]:
                            hits[first + doc].append(start)
                            hits[first + doc].append(start + n)
                            found[first + doc].append(texts_of[number])
                for doc in candidates:
                    # Keep the row small: merge touching spans, and each window once.
                    spans = sorted(zip(hits[first + doc][::2], hits[first + doc][1::2]))
                    merged: list[int] = []
                    for lo, hi in spans:
                        if merged and lo <= merged[-1]:
                            merged[-1] = max(merged[-1], hi)
                        else:
                            merged += [lo, hi]
                    hits[first + doc] = merged
                    found[first + doc] = sorted(set(found[first + doc]))
            fixed = {"n_words": pa.array(n_words), "hits": pa.array(hits, pa.list_(pa.int64())), "found": pa.array(found, pa.list_(pa.binary()))}
            yield pa.RecordBatch.from_arrays([fixed.get(c, part.column(c)) for c in part.schema.names], names=part.schema.names)

    return run


def match_windows(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle_words: int = SHINGLE_WORDS,
                  chunk_windows: int = CHUNK_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """(docs with n_words, hits, found; windows with item_id, words).

    ``docs`` needs a column text; its other columns are kept, so give them names that do not clash
    with these three.
    """
    wanted = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    windows = settle(wanted.mapInArrow(_windows(window, shingle_words), "item_id string, words binary, n int, tokens array<bigint>").distinct(), "windows")
    distinct = settle(with_position(windows.select("words", "n", "tokens").dropDuplicates(["words"]), "number", ["words"]), "distinct-windows")
    chunks = -(-(distinct.agg(F.max("number")).first()[0] or 0) // chunk_windows)
    state = docs.select("*", F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<bigint>").alias("hits"), F.array().cast("array<binary>").alias("found"))
    schema = state.schema
    for chunk in range(max(1, chunks)):
        rows = distinct.where((F.col("number") - 1).between(chunk * chunk_windows, (chunk + 1) * chunk_windows - 1)).collect()
        lengths: dict[int, set[int]] = {}
        for row in rows:
            lengths.setdefault(min(shingle_words, row.n), set()).update(row.tokens)
        by_length = {k: np.array(sorted(v), np.int64) for k, v in lengths.items()}
        seen: dict[tuple[int, int], int] = {}
        if rows:
            counts = docs.select("text").mapInArrow(_count(by_length), "k int, token bigint, n bigint")
            # At most one row for each shingle of the chunk.
            seen = {(r.k, r.token): r.n for r in counts.groupBy("k", "token").agg(F.sum("n").alias("n")).collect()}
        index: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
        texts_of: list[bytes] = []
        for row in rows:
            k = min(shingle_words, row.n)
            # The rarest shingle; a window with a shingle that occurs nowhere cannot occur.
            count, offset = min((seen.get((k, t), 0), o) for o, t in enumerate(row.tokens))
            if count:
                index.setdefault(k, {}).setdefault(row.tokens[offset], []).append((offset, row.n, len(texts_of)))
                texts_of.append(bytes(row.words))
        state = state.mapInArrow(_probe(index, texts_of), schema)
        if chunks > 1:  # one chunk's index at a time
            state = settle(state, "probed")
    return state, windows.select("item_id", "words")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle_words: int = SHINGLE_WORDS,
                  chunk_windows: int = CHUNK_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``.

    Null or wordless text has no words and no hits; a null or wordless item has no window; items
    with the same text all count; a null item id counts in n_hit but is no item.  Repeated rows
    are judged one by one, an empty table gives no rows, an empty benchmark no hits; further
    columns are not looked at.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    state, windows = match_windows(rows, items, window, shingle_words, chunk_windows)
    state = settle(state.select("doc_id", "n_words", "found", F.monotonically_increasing_id().alias("_at"), _covered().alias("n_hit")), "hits")
    ids = state.where(F.size("found") > 0).select("_at", F.explode("found").alias("words")).join(windows, "words")
    ids = ids.where("item_id IS NOT NULL").select("_at", "item_id").distinct().groupBy("_at").agg(F.sort_array(F.collect_list("item_id")).alias("ids"))
    joined = state.drop("found").join(ids, "_at", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))
    return joined.select(
        "doc_id", "n_words", "n_hit", F.size("ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _covered():
    """Words inside the merged spans: the ends minus the starts."""
    signed = F.transform("hits", lambda v, i: F.when(i % 2 == 1, v).otherwise(-v))
    return F.aggregate(signed, F.lit(0).cast("bigint"), lambda n, v: n + v)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item; all columns."""
    names = docs.columns
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("_row"), F.col("text").cast("string").alias("text"))
    state, _ = match_windows(rows, items, window, shingle_words)
    return state.where(F.size("hits") == 0).select(*[F.col("_row").getField(c).alias(c) for c in names])
