"""Which tokens of two tokenizers cover the same bytes, and how often over a corpus.

A text is encoded by both tokenizers; where an A and a B token share a byte, they are linked.  A
pair of ids counts once per document that holds it linked.  Counting all pairs is done outside
memory:

* A *run* is what one task finds in about ``RUN_BYTES`` of text: its (A id, B id, document, times)
  records, sorted.  A run is cut by a digit of the A id into ``RADIX`` parts; each part is written
  as zstd frames, the pairs apart from the documents that hold them.
* The frames of the pairs are merged by a heap over the last pair of each open frame, ``FAN`` runs at
  a time, then ``FAN`` merged runs, until one is left per digit.  Only open frames are in memory.  A
  pair that every document holds is one entry a run, so no key is hot.
* The merged runs are in the order of A's ids: the last merge knows a pair's own count and, when
  its A id ends, the highest count of that id.
* For each digit and group of runs, the counts stream along the runs in the same order; what they add
  to each document goes back to its run, one row a digit, and is summed there.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.plans.scratch import settle

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
RUN_BYTES = 1 << 21
RUN_DOCS = 4096
#: Bytes of text that the tokenizers get at once.
CALL_BYTES = 1 << 17
RADIX = 16
FAN = 32
#: Pairs in a frame.
FRAME = 1 << 13

_COLUMNS = ("n_a", "n_b", "n_groups", "n_links")


def _byte_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: visible Latin-1 stands for itself, the rest from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


#: How byte-level vocabularies of this kind cut a text before merging (fixed value).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs that the quick encoder of A is not given: it needs a stack, or squared time, for them.
_LONG_RUN = re.compile(r"(?<!\S)\S{400}|(?<!\s)\s{400}")


def quick_encoder(a_json: bytes):
    """The same encoder as a table of ranks, or None where the file is of another kind.

    Needs merges in the order of the ids they make, and the usual split.  Several times faster.
    """
    import tiktoken

    parts = json.loads(a_json)
    vocab, merges = parts["model"].get("vocab"), parts["model"].get("merges")
    split = parts.get("pre_tokenizer") or {}
    usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
    if parts["model"].get("type") != "BPE" or not usual or parts.get("normalizer") or parts["model"].get("ignore_merges"):
        return None
    joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
    alphabet = _byte_alphabet()
    first = len(alphabet)
    if [vocab.get(j) for j in joined] != list(range(first, first + len(joined))) or any(c not in vocab or vocab[c] >= first for c in alphabet):
        return None
    ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if i < first + len(joined)}
    return tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class Pair:
    """Both tokenizers, and the bytes behind each of their ids."""

    def __init__(self, a_json: bytes, b_model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json.decode())
        self.a.encode_special_tokens = True
        self.quick = quick_encoder(a_json)
        alphabet = _byte_alphabet()
        self.n_a = 1 + max(self.a.get_vocab(with_added_tokens=True).values())
        self.a_bytes = [b""] * self.n_a
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            known = all(c in alphabet for c in token)
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.n_b = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        # Decimal ids with what follows them: more of the same side, or the other side.
        self.words = [f"{i}{end}" for n, ends in ((self.n_a, ",|"), (self.n_b, ",;")) for i in range(n) for end in ends]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """A's ids.  The quick encoder gets Latin-1 texts, whose classes of characters no engine disputes."""
        out: list[list[int]] = [[] for _ in texts]
        slow = []
        for i, text in enumerate(texts):
            if self.quick and _is_latin(text) and not _LONG_RUN.search(text):
                out[i] = self.quick.encode_ordinary(text)
            elif text:
                slow.append(i)
        for i, found in zip(slow, self.a.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False)):
            out[i] = found.ids
        return out

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of each text on both sides; none for a text that either side does not give back."""
        found = list(zip(self.encode_a([f" {t}" if t else "" for t in texts]), self.b.encode([t or "" for t in texts], num_threads=1)))
        for i, (text, (a, b)) in enumerate(zip(texts, found)):
            want = f" {text}".encode() if text else None
            if want is None or b"".join(map(self.a_bytes.__getitem__, a)) != want or b"".join(map(self.b_bytes.__getitem__, b)) != want:
                found[i] = ([], [])
        return found


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays of one length as a zstd frame, byte planes together."""
    planes = [np.ascontiguousarray(np.asarray(a, "<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(frame: bytes, arrays: int) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), np.uint8).reshape(arrays, 8, -1)
    return [np.ascontiguousarray(data[i].T).view("<i8").reshape(-1) for i in range(arrays)]


def pair_frames(pairs: np.ndarray, *values: np.ndarray) -> list[bytes]:
    """Sorted pairs with their values, cut into frames; pairs as differences."""
    return [pack(np.diff(pairs[i : i + FRAME], prepend=0), *[v[i : i + FRAME] for v in values]) for i in range(0, len(pairs), FRAME)]


def read_frame(frame: bytes, arrays: int) -> list[np.ndarray]:
    pairs, *values = unpack(frame, arrays)
    return [np.cumsum(pairs), *values]


def merge_runs(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, counts) over all runs, in order, a frame of every run in memory at a time."""
    opened = [iter(run) for run in runs]
    held: dict[int, list[np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def open_next(i: int) -> None:
        frame = next(opened[i], None)
        held.pop(i, None)
        if frame is not None:
            held[i] = read_frame(frame, 2)
            heapq.heappush(heap, (int(held[i][0][-1]), i))

    for i in range(len(runs)):
        open_next(i)
    while heap:
        # Up to the smallest last pair of an open frame, no closed frame can add anything.
        bound, i = heapq.heappop(heap)
        pairs, counts = [], []
        for j, (p, c) in held.items():
            cut = int(np.searchsorted(p, bound, "right"))
            if cut:
                pairs.append(p[:cut])
                counts.append(c[:cut])
                held[j] = [p[cut:], c[cut:]]
        together = np.concatenate(pairs)
        order = np.argsort(together, kind="stable")
        together = together[order]
        first = np.flatnonzero(np.diff(together, prepend=-1))
        yield together[first], np.add.reduceat(np.concatenate(counts)[order], first)
        # Other frames may end at the same pair: they are empty now and open their next one when popped.
        while True:
            open_next(i)
            if not heap or len(held[heap[0][1]][0]):
                break
            _, i = heapq.heappop(heap)


def with_highest(merged: Iterator[tuple[np.ndarray, np.ndarray]], n_b: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Add to merged pairs the highest count of their A id; the last id of a block waits for the next one."""
    pairs, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for more, n in merged:
        pairs, counts = np.concatenate([pairs, more]), np.concatenate([counts, n])
        cut = int(np.searchsorted(pairs, pairs[-1] // n_b * n_b))
        if cut:
            yield _highest(pairs[:cut], counts[:cut], n_b)
            pairs, counts = pairs[cut:], counts[cut:]
    if len(pairs):
        yield _highest(pairs, counts, n_b)


def _highest(pairs: np.ndarray, counts: np.ndarray, n_b: int):
    first = np.flatnonzero(np.diff(pairs // n_b, prepend=-1))
    sizes = np.diff(first, append=len(pairs))
    return pairs, counts, np.repeat(np.maximum.reduceat(counts, first), sizes)


def _among(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which sorted ``values`` are among the sorted ``others``."""
    place = np.searchsorted(others, values)
    return others[np.minimum(place, len(others) - 1)] == values if len(others) else np.zeros(len(values), bool)


class _Run:
    """What one task has found since its last run was written."""

    def __init__(self, pair: Pair) -> None:
        self.pair = pair
        self.rows: list = []
        self.ids: list[tuple[list[int], list[int]]] = []
        self.size = 0

    def add(self, rows: list, texts: list[str | None]) -> None:
        self.rows += rows
        self.ids += self.pair.encode(texts)
        self.size += sum(len(t or "") for t in texts)

    def full(self) -> bool:
        return self.size >= RUN_BYTES or len(self.rows) >= RUN_DOCS

    def records(self) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray]:
        """(counts per document, hashes of their groups, sorted record keys, times of each)."""
        n, pair = len(self.rows), self.pair
        a_docs, b_docs = (np.repeat(np.arange(n), [len(x[side]) for x in self.ids]) for side in (0, 1))
        a, b = (np.fromiter(chain.from_iterable(x[side] for x in self.ids), np.int64) for side in (0, 1))
        counts = {"n_a": np.bincount(a_docs, minlength=n), "n_b": np.bincount(b_docs, minlength=n)}
        # Both sides cover the same bytes, document by document.
        a_ends, b_ends = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
        last_a, last_b = _among(a_ends, b_ends), _among(b_ends, a_ends)
        cuts = np.concatenate([a_ends, b_ends[~last_b]])
        cuts.sort()
        at_a, at_b = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        docs = a_docs[at_a] if len(cuts) else cuts
        counts["n_links"] = np.bincount(docs, minlength=n)
        counts["n_groups"] = np.bincount(a_docs[last_a], minlength=n)
        # A group's A tokens stand before its B tokens.
        group_a, group_b = (np.cumsum(last) - last for last in (last_a, last_b))
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 2 * a + last_a
        code[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = 2 * (pair.n_a + b) + last_b
        borders = np.concatenate([[0], np.cumsum(counts["n_a"] + counts["n_b"])])
        hashes = []
        for start, end in pairwise(borders.tolist()):
            joined = "".join(map(pair.words.__getitem__, code[start:end].tolist()))[:-1]
            hashes.append(hashlib.sha256(joined.encode()).hexdigest() if joined else "")
        keys = (a[at_a] * pair.n_b + b[at_b]) * n + docs if len(cuts) else cuts
        keys.sort()
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return counts, hashes, keys[first], np.diff(first, append=len(keys))

    def write(self, run: int, radix: int) -> pa.RecordBatch:
        counts, hashes, keys, times = self.records()
        n = len(self.rows)
        pairs, docs = keys // max(n, 1), keys % max(n, 1)
        digits = pairs // self.pair.n_b % radix
        digest = pa.RecordBatch.from_arrays([pa.array(self.rows, pa.int64()), *[pa.array(counts[c], pa.int64()) for c in _COLUMNS], pa.array(hashes)],
                                            names=["doc_id", *_COLUMNS, "groups_sha256"])
        rows = [(run, -1, n, [], digest.serialize().to_pybytes())]
        for digit in np.unique(digits).tolist():
            of = digits == digit
            first = np.flatnonzero(np.diff(pairs[of], prepend=-1))
            distinct, holders = pairs[of][first], np.diff(first, append=int(of.sum()))
            rows.append((run, digit, n, pair_frames(distinct, holders), pack(docs[of], times[of])))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RUN_TYPES)], names=["run", "digit", "n", "pairs", "docs"])


_RUN_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.binary())
_RUN = "run bigint, digit int, n int, pairs array<binary>, docs binary"
_DIGEST = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COLUMNS], ("groups_sha256", pa.string())])


def _runs(files, radix: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*files.value)
        number = TaskContext.get().partitionId() << 32
        current = _Run(pair)
        for part in parts:
            ids, texts = part.column("doc_id").to_pylist(), part.column("text")
            start, size, call = 0, 0, []
            for i in range(len(ids) + 1):
                text = texts[i].as_py() if i < len(ids) else None
                if call and (i == len(ids) or size + len(text or "") > CALL_BYTES or len(current.rows) + len(call) >= RUN_DOCS):
                    current.add(ids[start:i], call)
                    start, size, call = i, 0, []
                    if current.full():
                        yield current.write(number, radix)
                        number, current = number + 1, _Run(pair)
                if i < len(ids):
                    call.append(text)
                    size += len(text or "")
        if current.rows:
            yield current.write(number, radix)

    return run


def _merged(frames: list[list[bytes]], n_b: int | None) -> list[bytes]:
    """Frames of the merge of some runs; with the highest counts if ``n_b`` is given (the last merge)."""
    merged = merge_runs(frames)
    blocks = with_highest(merged, n_b) if n_b else merged
    out, waiting, rows = [], [], 0
    for block in blocks:
        waiting.append(block)
        rows += len(block[0])
        if rows >= FRAME:
            out += pair_frames(*map(np.concatenate, zip(*waiting)))
            waiting, rows = [], 0
    return out + (pair_frames(*map(np.concatenate, zip(*waiting))) if waiting else [])


def _merge(n_b: int | None):
    def merge(table: pa.Table) -> pa.Table:
        frames = _merged([run for run in table.column("pairs").to_pylist() if run], n_b)
        return pa.table({"digit": table.column("digit")[:1], "part": table.column("part")[:1], "pairs": pa.array([frames], pa.list_(pa.binary()))})

    return merge


def count_pairs(runs: DataFrame, n_runs: int, n_b: int, fan: int = FAN) -> DataFrame:
    """(digit, pairs): frames of (pair, documents, highest of its A id) over all ``runs``."""
    current = runs.where(F.col("digit") >= 0).select("digit", F.xxhash64("run").alias("part"), "pairs")
    groups = n_runs
    while True:
        groups = -(-groups // fan)
        last = n_b if groups <= 1 else None
        current = current.withColumn("part", F.pmod("part", F.lit(max(groups, 1))))
        current = current.groupBy("digit", "part").applyInArrow(_merge(last), "digit int, part bigint, pairs array<binary>")
        if last:
            return current.select("digit", "pairs")


def _contributions(key: tuple, table: pa.Table) -> pa.Table:
    """What the pairs of one digit add to the documents of a group of runs."""
    rows = table.select(["run", "n", "pairs", "docs"]).to_pylist()
    counts = next(r["pairs"] for r in rows if r["run"] is None)
    known = [np.concatenate(c) for c in zip(*(read_frame(f, 3) for f in counts))]
    out = []
    for row in rows:
        if row["run"] is None:
            continue
        pairs, holders = (np.concatenate(c) for c in zip(*(read_frame(f, 2) for f in row["pairs"])))
        docs, times = unpack(row["docs"], 2)
        place = np.repeat(np.searchsorted(known[0], pairs), holders)
        count, best = known[1][place], known[1][place] == known[2][place]
        totals, bests = np.zeros(row["n"], np.int64), np.zeros(row["n"], np.int64)
        np.add.at(totals, docs, count * times)
        np.add.at(bests, docs, best * times)
        out.append((row["run"], pack(bests, totals)))
    return pa.table([pa.array([r for r, _ in out], pa.int64()), pa.array([f for _, f in out], pa.binary())], names=["run", "docs"])


def _summed(table: pa.Table) -> pa.Table:
    """The documents of one run with the sums over all digits."""
    digits, docs = table.column("digit").to_pylist(), table.column("docs")
    digest = pa.ipc.read_record_batch(pa.py_buffer(docs[digits.index(-1)].as_py()), _DIGEST)
    totals = np.zeros((2, digest.num_rows), np.int64)
    for i, digit in enumerate(digits):
        if digit != -1:
            totals += np.stack(unpack(docs[i].as_py(), 2))
    found = pa.Table.from_batches([digest])
    return found.append_column("n_best", pa.array(totals[0])).append_column("count_sum", pa.array(totals[1]))


def align_tokens(docs: DataFrame, a_path: str = f"{TOKENIZERS}/{A_FILE}", b_path: str = f"{TOKENIZERS}/{B_FILE}", radix: int = RADIX, fan: int = FAN) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``.

    ``a_path`` is a byte-level vocabulary, ``b_path`` one of pieces with byte fallback; both are read
    by the driver and sent to the tasks (a few megabytes, whatever the corpus).  A text that is null
    or empty, or that one side does not give back byte by byte, has no tokens.  Repeated rows count
    as documents of their own, rows without an id too; an empty table gives no rows; further
    columns are not looked at.  A single text is handled whole, in one run.
    """
    spark = docs.sparkSession
    with open(a_path, "rb") as a_file, open(b_path, "rb") as b_file:
        contents = (a_file.read(), b_file.read())
    files = spark.sparkContext.broadcast(contents)
    n_b = Pair(*contents).n_b
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Written once: run numbers must not change, and the texts are encoded a single time.
    runs = settle(rows.mapInArrow(_runs(files, radix), _RUN), "runs")
    n_runs = runs.where(F.col("digit") == -1).count()
    groups = max(1, -(-n_runs // fan))
    counts = settle(count_pairs(runs, n_runs, n_b, fan), "pair-counts")
    spread = counts.select(F.lit(None).cast("bigint").alias("run"), "digit", F.lit(0).alias("n"), "pairs", F.lit(None).cast("binary").alias("docs"),
                           F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("part"))
    parts = runs.where(F.col("digit") >= 0).withColumn("part", F.pmod(F.xxhash64("run"), F.lit(groups)))
    # A group without runs of some digit gets its counts only, and gives no rows.
    added = parts.unionByName(spread).groupBy("digit", "part").applyInArrow(_contributions, "run bigint, docs binary")
    back = runs.where(F.col("digit") == -1).select("run", "digit", "docs").unionByName(added.select("run", F.lit(0).alias("digit"), "docs"))
    shape = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in _COLUMNS) + ", groups_sha256 string, n_best bigint, count_sum bigint"
    return back.groupBy("run").applyInArrow(_summed, shape)
