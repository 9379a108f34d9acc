"""Repeated line runs across documents, by prefix doubling over line-id sequences.

A document is a sequence of line ids.  Prefix doubling ranks all suffixes by their first 1, 2, 4, ...
lines: the pair of ranks at a line and 2 ** k lines further on is sorted (range partitions, distinct
pairs only) and its place is the next rank.  Suffixes with a rank of their own drop out at once, so
only repeated text goes on.  Two ranks name a run of any length; suffixes that share a run are an
interval of the suffix array whose longest common prefix covers it.

A run counts if it has ``min_words`` words.  It is enough to look at the shortest such run from each
line on, and the shortest one up to each line: a longer repeated run [a, b] is made up of these, since
every line t in it lies in the shortest run from a on, or else in the shortest one that ends in t.
All copies of a run but the first, in order of doc_id, are deleted; adjacent deletions join up to
the maximal repeated runs.

Work is bounded by repeated lines.  A line that a third of all documents share is one row in every
table of distinct pairs, and its positions meet that row in a join that Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import pieces
from parley.plans.ranking import with_position
from parley.plans.scratch import settle

MIN_WORDS = 50


def shortest_runs(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines in the shortest run with ``min_words`` words from, and up to, each line; 0 for none."""
    n = len(words)
    total = np.concatenate([[0], np.cumsum(words)])
    end = np.searchsorted(total, total[:-1] + min_words, "left")
    forward = np.where(end <= n, end - np.arange(n), 0)
    start = np.searchsorted(total, total[1:] - min_words, "right") - 1
    backward = np.where(total[1:] >= min_words, np.arange(n) + 1 - start, 0)
    return forward, backward


def _positions(min_words: int):
    schema = pa.schema([("at", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
                        ("forward", pa.int64()), ("backward", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(parts):
            columns: list[list] = [[] for _ in range(7)]
            for at, doc_id, text in zip(part.column("at").to_pylist(), part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                if text is None:
                    continue
                lines = text.split(b"\n")
                ids = np.frombuffer(b"".join(xxhash.xxh3_128_digest(line) for line in lines), np.int64).reshape(-1, 2)
                forward, backward = shortest_runs(np.array([len(line.split()) for line in lines], np.int64), min_words)
                n = len(lines)
                for column, values in zip(columns, (np.full(n, at), [doc_id] * n, np.arange(n), ids[:, 0], ids[:, 1], forward, backward)):
                    column.append(pa.array(values, pa.int64()))
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], schema=schema)

    return run


def _ranked(keyed: DataFrame, keys: list[str], out: str) -> DataFrame:
    """(keys, rank) of the keys that occur more than once; ranks in the order of the keys."""
    again = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*keys)
    return with_position(again, out, keys)


def repeated_runs(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(at, start, length) of later copies of runs; ``rows``: at (unique), doc_id, text."""
    lines = settle(rows.mapInArrow(_positions(min_words), "at bigint, doc_id bigint, pos bigint, h1 bigint, h2 bigint, forward bigint, backward bigint"), "lines")
    placed = settle(lines.join(_ranked(lines, ["h1", "h2"], "rank"), ["h1", "h2"]).drop("h1", "h2"), "placed")
    ahead = placed.where("forward > 0").select("at", "doc_id", F.col("pos").alias("start"), F.col("forward").alias("length"))
    back = placed.where("backward > 0").select("at", "doc_id", (F.col("pos") - F.col("backward") + 1).alias("start"), F.col("backward").alias("length"))
    runs = settle(ahead.unionByName(back).distinct(), "runs")
    longest = runs.agg(F.max("length")).first()[0] or 0
    ranks, step, found = placed.select("at", "pos", "rank"), 1, None
    while step <= longest:
        # Runs of step to 2 * step - 1 lines: named by the ranks of their first and last ``step`` lines.
        named = runs.where((F.col("length") >= step) & (F.col("length") < 2 * step))
        named = named.join(ranks.select("at", F.col("pos").alias("start"), F.col("rank").alias("head")), ["at", "start"])
        named = named.withColumn("_last", F.col("start") + F.col("length") - step)
        named = settle(named.join(ranks.select("at", F.col("pos").alias("_last"), F.col("rank").alias("tail")), ["at", "_last"]), "named")
        place = F.struct("doc_id", "at", "start")
        first = named.groupBy("length", "head", "tail").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        later = named.join(first, ["length", "head", "tail"]).where(place != F.col("first")).select("at", "start", "length")
        found = later if found is None else found.unionByName(later)
        step *= 2
        if step > longest:
            break
        half = step // 2
        ahead = ranks.select("at", (F.col("pos") - half).alias("pos"), F.col("rank").alias("next"))
        pairs = settle(ranks.join(ahead, ["at", "pos"]), "pairs")
        ranks = settle(pairs.join(_ranked(pairs, ["rank", "next"], "_new"), ["rank", "next"]).select("at", "pos", F.col("_new").alias("rank")), "ranks")
    return found if found is not None else runs.select("at", "start", "length").limit(0)


def _without(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their spans of lines taken out of the text."""
    for part in pieces(parts):
        texts, n_lines, n_removed = [], [], []
        for text, starts, lengths in zip(*(part.column(c).to_pylist() for c in ("text", "starts", "lengths"))):
            lines = text.split("\n") if text is not None else []
            gone = np.zeros(len(lines), bool)
            for start, length in zip(starts or (), lengths or ()):
                gone[start : start + length] = True
            texts.append("\n".join(line for line, g in zip(lines, gone) if not g) if gone.any() else text)
            n_lines.append(len(lines))
            n_removed.append(int(gone.sum()))
        yield pa.RecordBatch.from_arrays(
            [part.column("_row"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())],
            names=["_row", "_text", "_n_lines", "_n_removed"])


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``_row`` (all columns of ``docs``), ``_text`` without later copies, ``_n_lines``, ``_n_removed``.

    Lines are split at line feeds and compared byte by byte.  Null text has no lines and stays null;
    an empty text is one empty line.  Of repeated rows, and of rows with a null id (these come
    first), the one read first keeps its lines.  An empty table gives no rows; clashing column
    names do no harm.  ``docs`` has to be read in the same partitions when it is computed again,
    as a table scan is.
    """
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    rows = docs.select(row.alias("_row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("at"))
    spans = repeated_runs(rows.select("at", "doc_id", "text"), min_words)
    spans = spans.distinct().groupBy("at").agg(F.collect_list(F.struct("start", "length")).alias("s"))
    spans = spans.select("at", F.col("s.start").alias("starts"), F.col("s.length").alias("lengths"))
    joined = rows.join(spans, "at", "left").select("_row", "text", "starts", "lengths")
    shape = joined.schema["_row"].dataType.simpleString()
    return joined.mapInArrow(_without, f"_row {shape}, _text string, _n_lines bigint, _n_removed bigint")


def line_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed and the SHA-256 of the text that is left, per row of ``docs``."""
    return dedup_lines(docs, min_words).select(F.col("_row.doc_id").alias("doc_id"), F.col("_n_lines").alias("n_lines"),
                                               F.col("_n_removed").alias("n_removed"), F.sha2("_text", 256).alias("text_sha256"))


def keep_first_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without later copies of runs; documents that have no words left go.  All columns."""
    out = dedup_lines(docs, min_words)
    left = (F.col("_n_removed") == 0) | F.col("_text").rlike(r"[^\x20\x09-\x0D]")
    return out.where(left).select(*[(F.col("_text") if c == "text" else F.col("_row").getField(c)).alias(c) for c in docs.columns])
