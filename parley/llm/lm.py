"""Scoring texts with a bigram language model held in Elias-Fano tries.

The model is a hierarchical Dirichlet one.  A word w after p has probability
(c(p w) + MU * P(w)) / (c(p) + MU), where P is the discounted share of w and the discounted mass of
all words goes to the class of unknown words.  So a text's score is a sum of terms that need
c(p w), c(w) and P(w), and of terms that need c(p): every term belongs to one word.

1. Words are counted (combined per partition, then by key).
2. Every occurrence (document, word, word before) goes to the shard of its word; a word with more
   than a shard's worth of occurrences is spread over several by the word before, and its count
   travels with the job (there are at most occurrences / SHARD_TOKENS such words).
3. A shard builds the trie of its words from the training occurrences: words, running totals,
   pointers, contexts and pairs as monotone sequences, one byte per quantised mass, in a
   memory-mapped file.  Then it looks all its occurrences up and answers with one number per
   document.  Training and queries share this exchange; nothing holds the whole model.
4. Answers are added per batch of documents.

Words travel as 64-bit hashes; the commonest ones as two bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import held_out
from parley.llm.elias_fano import Trie, mapped
from parley.llm.wordhash import batches
from parley.plans.scratch import settle

FOLDS, HELD_OUT = 10, 0
BASE_SMOOTHING = 0.1
MU = 1000.0
SHARD_TOKENS = 1_000_000
#: Words with a code of two bytes.
CODES = 65_535
#: Tokens of a batch of documents.
BATCH_TOKENS = 1_000_000
#: Bytes of text whose words are hashed together; its pairs make the rows that are shuffled.
SEGMENT = 1 << 21
#: Distinct words that a partition counts before it hands them on.
FLUSH = 1_000_000

END, START = np.uint64(1), np.uint64(2)


def _count_words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and ends in the texts of a partition: training counts and all occurrences."""
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64()), ("uses", pa.int64())])
    words, n, uses, pending = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), []

    def merged():
        nonlocal words, n, uses, pending
        every = np.concatenate([words, *(p[0] for p in pending)])
        counts = np.concatenate([n, *(p[1] for p in pending)]), np.concatenate([uses, *(p[2] for p in pending)])
        words, where = np.unique(every, return_inverse=True)
        n, uses = (np.bincount(where, c, minlength=len(words)).astype(np.int64) for c in counts)
        pending = []

    def out():
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n), pa.array(uses)], schema=schema)

    for part in parts:
        held = part.column("held").to_numpy(zero_copy_only=False)
        for first, hashes, bounds in batches(part.column("text").cast(pa.binary()).to_pylist(), segment=SEGMENT):
            train = ~held[first : first + len(bounds) - 1]
            found, where = np.unique(hashes, return_inverse=True)
            weight = np.repeat(train, np.diff(bounds)).astype(np.float64)
            counts = np.bincount(where, weight, minlength=len(found)).astype(np.int64)
            pending.append((np.append(found, END), np.append(counts, int(train.sum())), np.append(np.bincount(where, minlength=len(found)), len(train))))
            if sum(len(p[0]) for p in pending) > FLUSH:
                merged()
                if len(words) > FLUSH:
                    yield out()
                    words, n, uses = words[:0], n[:0], uses[:0]
    if pending:
        merged()
    if len(words):
        yield out()


def _spread(words: np.ndarray, before: np.ndarray, hot: np.ndarray, parts: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each occurrence; ``hot``: sorted words that take several (``parts``) shards."""
    place = words.copy()
    if len(hot):
        at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        is_hot = np.flatnonzero(hot[at] == words)
        share = (before[is_hot] >> np.uint64(20)) % parts[at[is_hot]].astype(np.uint64)
        place[is_hot] += share * np.uint64(0x9E3779B97F4A7C15)
    return ((place >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def _pack(words: np.ndarray, before: np.ndarray, docs: np.ndarray, common: np.ndarray) -> bytes:
    """Occurrences sorted by word: runs of words, coded words before, document numbers."""
    order = np.argsort(words, kind="stable")
    words, before, docs = words[order], before[order], docs[order]
    starts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    lengths = np.diff(starts, append=len(words)).astype(np.uint32)
    codes = np.full(len(before), CODES, np.uint16)
    rare = np.ones(len(before), bool)
    if len(common):
        at = np.minimum(np.searchsorted(common, before), len(common) - 1)
        rare = common[at] != before
        codes[~rare] = at[~rare]
    head = np.array([len(words), len(starts), int(rare.sum())], np.int64)
    return b"".join(x.tobytes() for x in (head, words[starts], lengths, codes, before[rare], docs.astype(np.uint32)))


def _unpack(data: bytes, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, runs, rares = np.frombuffer(data, np.int64, 3).tolist()
    at = 24
    words = np.frombuffer(data, np.uint64, runs, at)
    lengths = np.frombuffer(data, np.uint32, runs, at := at + 8 * runs)
    codes = np.frombuffer(data, np.uint16, n, at := at + 4 * runs)
    rest = np.frombuffer(data, np.uint64, rares, at := at + 2 * n)
    docs = np.frombuffer(data, np.uint32, n, at + 8 * rares)
    rare = codes == CODES
    before = np.empty(n, np.uint64)
    before[rare] = rest
    if len(common):
        before[~rare] = common[codes[~rare]]
    return np.repeat(words, lengths), before, docs


def _deal(stats: dict):
    """Occurrences of a partition by shard, and one row per batch with its documents."""
    schema = pa.schema([("shard", pa.int64()), ("batch", pa.int64()), ("docs", pa.int32()), ("data", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, hot_parts, common, shards = (stats[k] for k in ("hot", "hot_parts", "common", "shards"))
        task, number = TaskContext.get().partitionId(), 0
        held_ids, held_flags, held_words, held_before, held_docs, size = [], [], [], [], [], 0

        def emit():
            nonlocal number, held_ids, held_flags, held_words, held_before, held_docs, size
            words, before, docs = np.concatenate(held_words), np.concatenate(held_before), np.concatenate(held_docs)
            flags = np.concatenate(held_flags)
            batch = (task << 32) | number
            shard = _spread(words, before, hot, hot_parts, shards)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            rows = []
            train = flags[docs]
            docs = docs * 2 + train  # the last bit: learn from it
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                at = order[cuts[k] : cuts[k + 1]]
                rows.append((k, batch, len(flags), _pack(words[at], before[at], docs[at], common)))
            ids = pa.chunked_array(held_ids).combine_chunks()
            n_tokens = np.bincount(docs >> 1, minlength=len(flags))
            table = pa.RecordBatch.from_arrays([ids, pa.array(~flags), pa.array(n_tokens)], names=["doc_id", "held", "n_tokens"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_batch(table)
            rows.append((-1 - batch % shards, batch, len(flags), sink.getvalue().to_pybytes()))
            number += 1
            held_ids, held_flags, held_words, held_before, held_docs, size = [], [], [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        docs_so_far = 0
        for part in parts:
            ids, held = part.column("doc_id"), part.column("held").to_numpy(zero_copy_only=False)
            for first, hashes, bounds in batches(part.column("text").cast(pa.binary()).to_pylist(), segment=SEGMENT):
                n = len(bounds) - 1
                counts = np.diff(bounds)
                ends = bounds[1:] + np.arange(n)  # where each text's end goes
                words = np.empty(len(hashes) + n, np.uint64)
                is_end = np.zeros(len(words), bool)
                is_end[ends] = True
                words[~is_end], words[is_end] = hashes, END
                before = np.concatenate([[START], words[:-1]])
                before[before == END] = START
                held_ids.append(ids.slice(first, n))
                held_flags.append(~held[first : first + n])
                held_words.append(words)
                held_before.append(before)
                held_docs.append(np.repeat(np.arange(docs_so_far, docs_so_far + n), counts + 1))
                docs_so_far += n
                size += len(words)
                if size >= BATCH_TOKENS:
                    yield emit()
                    docs_so_far = 0
        if held_ids:
            yield emit()

    return run


def build_trie(words: np.ndarray, before: np.ndarray, counts_of_hot: dict[int, int], stats: dict) -> Trie:
    """Trie of training occurrences (``words``, ``before``); counts of words in several shards are given."""
    contexts, context_of = np.unique(before, return_inverse=True)
    kinds, word_of = np.unique(words, return_inverse=True)
    pairs, n = np.unique(word_of.astype(np.int64) * max(1, len(contexts)) + context_of, return_counts=True)
    counts = np.bincount(word_of, minlength=len(kinds))
    for word, count in counts_of_hot.items():
        at = np.searchsorted(kinds, np.uint64(word))
        if at < len(kinds) and kinds[at] == np.uint64(word):
            counts[at] = count
    word_of, context_of = pairs // max(1, len(contexts)), pairs % max(1, len(contexts))
    share = (counts - stats["discount"]) / stats["n"]
    return Trie.build(kinds, counts, contexts, word_of, context_of, np.log10(n + MU * share[word_of]))


def _narrow(values: np.ndarray) -> np.ndarray:
    """Non-negative integers in as few bytes as hold them."""
    most = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


def _pack_sums(docs: np.ndarray, base: np.ndarray, score: np.ndarray, known: np.ndarray) -> bytes:
    parts = [base, score.astype(np.float32), _narrow(docs), _narrow(known)]
    return np.array([len(docs), parts[2].itemsize, parts[3].itemsize], np.int64).tobytes() + b"".join(p.tobytes() for p in parts)


def _unpack_sums(data: bytes) -> list[np.ndarray]:
    n, *widths = np.frombuffer(data, np.int64, 3).tolist()
    out, at = [], 24
    for dtype in ("f8", "f4", *(f"u{w}" for w in widths)):
        out.append(np.frombuffer(data, dtype, n, at))
        at += out[-1].nbytes
    return out


def _answer(stats: dict):
    """Build a shard's trie, then look its occurrences up: sums per document, batch by batch."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        passed = frame.shard < 0
        rows = frame[~passed].copy(deep=False)
        out = [(b, n, "docs", d) for b, n, d in zip(frame.batch[passed], frame.docs[passed], frame.data[passed])]
        if len(rows):
            unpacked = [_unpack(d, stats["common"]) for d in rows.data]
            words, before, docs = (np.concatenate(x) for x in zip(*unpacked))
            cuts = np.cumsum([0] + [len(u[0]) for u in unpacked])
            del unpacked, rows["data"]
            train = (docs & 1).astype(bool)
            trie = mapped(build_trie(words[train], before[train], stats["hot_counts"], stats).to_bytes())
            del train
            kinds, word_of = np.unique(words, return_inverse=True)
            at, known = trie.find_words(kinds)
            counts = np.zeros(len(kinds), np.int64)
            counts[known] = trie.counts(at[known])
            for word, count in stats["hot_counts"].items():  # a hot word may have no training pair here
                k = np.searchsorted(kinds, np.uint64(word))
                if k < len(kinds) and kinds[k] == np.uint64(word):
                    counts[k] = count
            contexts, context_of = np.unique(before, return_inverse=True)
            where, seen = trie.find_contexts(contexts)
            n, v, d = stats["n"], stats["v"], stats["discount"]
            share = np.where(counts > 0, (counts - d) / max(n, 1), d * v / n if n and v else 1.0)
            mass = np.log10(MU * share)[word_of]
            both = np.flatnonzero(known[word_of] & seen[context_of])
            found = trie.pair_mass(at[word_of[both]], where[context_of[both]])
            mass[both] = np.where(np.isnan(found), mass[both], found)
            # The word is also the context of what follows; an end is of nothing.
            following = np.where(kinds == END, 0.0, np.log10(counts + MU))
            score = mass - following[word_of]
            base = np.log10(counts + BASE_SMOOTHING)[word_of]
            is_known = (counts > 0)[word_of]
            for i, (batch, size) in enumerate(zip(rows.batch, rows.docs)):
                part = slice(cuts[i], cuts[i + 1])
                some, doc = np.unique(docs[part] >> 1, return_inverse=True)
                sums = [np.bincount(doc, w[part], minlength=len(some)) for w in (base, score, is_known)]
                out.append((batch, size, "sums", _pack_sums(some, *sums)))
        return pd.DataFrame(out, columns=["batch", "docs", "kind", "data"])

    return run


def _add(stats: dict):
    """All answers of one batch of documents."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        size = int(frame.docs.iloc[0])
        base, score, known = np.zeros(size), np.zeros(size), np.zeros(size, np.int64)
        for data in frame.data[frame.kind == "sums"]:
            part_base, part_score, at, part_known = _unpack_sums(data)
            base[at] += part_base
            score[at] += part_score
            known[at] += part_known
        with pa.ipc.open_stream(frame.data[frame.kind == "docs"].iloc[0]) as reader:
            docs = reader.read_pandas()
        total = np.log10(stats["n"] + BASE_SMOOTHING * (stats["v"] + 1))
        return pd.DataFrame({
            "doc_id": docs.doc_id, "held_out": docs.held, "n_tokens": docs.n_tokens, "n_known": known, "train_tokens": stats["n"],
            "base_score": base - docs.n_tokens * total, "score": score - np.log10(stats["train_docs"] + MU)})

    return run


def model_stats(rows: DataFrame, shard_tokens: int = SHARD_TOKENS) -> dict:
    """What all shards share: totals, discount, common words, words with several shards."""
    counted = settle(rows.select("text", "held").mapInArrow(_count_words, "word bigint, n bigint, uses bigint")
                     .groupBy("word").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses")), "words")
    total = counted.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v"), F.count_if(F.col("n") == 1).alias("ones"),
                        F.count_if(F.col("n") == 2).alias("twos"), F.sum("uses").alias("uses")).first()
    uses = total.uses or 0
    # Common words: the lowest of these thresholds that no more than CODES words reach.  At most
    # CODES words can make up 1 / CODES of all uses each, so the first one always serves.
    thresholds = [max(1, -(-uses // (CODES << k))) for k in range(12)]
    reach = counted.agg(*[F.count_if(F.col("uses") >= t).alias(f"t{k}") for k, t in enumerate(thresholds)]).first()
    threshold = min(t for t, n in zip(thresholds, reach) if n <= CODES)
    common = [r.word for r in counted.where(F.col("uses") >= threshold).select("word").collect()]
    # At most uses / (shard_tokens / 2) words.
    hot = counted.where(F.col("uses") > shard_tokens // 2).collect()
    ends = counted.where(F.col("word") == int(END)).first()
    discount = total.ones / (total.ones + 2 * total.twos) if total.ones else 0.5
    hot.sort(key=lambda r: r.word % 2**64)
    return {
        "n": total.n or 0, "v": total.v or 0, "train_docs": ends.n if ends else 0, "discount": min(max(discount, 0.1), 0.9),
        "shards": max(1, -(-uses // shard_tokens)), "common": np.sort(np.array(common, np.int64).view(np.uint64)),
        "hot": np.array([r.word for r in hot], np.int64).view(np.uint64),
        "hot_parts": np.array([-(-2 * r.uses // shard_tokens) for r in hot], np.int64),
        "hot_counts": {int(np.int64(r.word).view(np.uint64)): r.n for r in hot},
    }


def score_texts(docs: DataFrame, folds: int = FOLDS, fold: int = HELD_OUT, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    The model learns from all rows but the held-out ones (crc32 of the id modulo ``folds`` is
    ``fold``).  Null text counts as empty, that is as one end; a null id is never held out;
    repeated rows are learned from and scored one by one; with no training text every word is
    unknown.  An empty table gives no rows; further columns are not looked at.  ``docs`` has to
    give the same batches when it is computed again, as a table scan does.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       held_out(F.col("doc_id"), folds, fold).alias("held"))
    stats = model_stats(rows, shard_tokens)
    dealt = rows.mapInArrow(_deal(stats), "shard bigint, batch bigint, docs int, data binary")
    dealt = dealt.withColumn("task", F.when(F.col("shard") < 0, -1 - F.col("shard")).otherwise(F.col("shard")))
    answers = dealt.groupBy("task").applyInPandas(_answer_task(stats), "batch bigint, docs int, kind string, data binary")
    return answers.groupBy("batch").applyInPandas(
        _add(stats), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def _answer_task(stats: dict):
    answer = _answer(stats)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return answer(frame.drop(columns="task"))

    return run
