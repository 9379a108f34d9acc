"""Elias-Fano sequences and a two-level n-gram trie over them, in one memory-mappable buffer."""

from __future__ import annotations

import io
import mmap
import tempfile

import numpy as np


class Monotone:
    """A non-decreasing sequence of integers below ``universe``: low bits apart, high bits in unary.

    n elements take about n * (2 + log2(universe / n)) bits.  ``successor`` finds the first element
    at or above a value: the zeros of the unary part bound the elements with the same high bits,
    among which the low bits decide.
    """

    def __init__(self, low_bits: int, lows: np.ndarray, highs: np.ndarray, n: int):
        self.low_bits, self.lows, self.highs, self.n = low_bits, lows, highs, n
        self._bounds: np.ndarray | None = None

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> Monotone:
        values = np.asarray(values, np.uint64)
        n = len(values)
        low_bits = max(0, (int(universe) // max(1, n)).bit_length() - 1)
        shift = np.uint64(low_bits)
        high = (values >> shift).astype(np.int64)
        bits = np.zeros(n + int(high[-1] if n else 0) + 2, np.uint8)
        bits[high + np.arange(n)] = 1
        width = -(-low_bits // 8)
        lows = values & np.uint64((1 << low_bits) - 1)
        packed = lows.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width] if n else np.empty((0, width), np.uint8)
        return cls(low_bits, np.ascontiguousarray(packed), np.packbits(bits), n)

    def _low(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), 8), np.uint8)
        out[:, : self.lows.shape[1]] = self.lows[at]
        return out.view("<u8").ravel()

    def bounds(self) -> np.ndarray:
        """Number of elements whose high part is below 0, 1, 2, ..."""
        if self._bounds is None:
            zeros = np.flatnonzero(np.unpackbits(self.highs) == 0)
            self._bounds = np.minimum(np.concatenate([[0], zeros - np.arange(len(zeros))]), self.n)
        return self._bounds

    def access(self, at: np.ndarray) -> np.ndarray:
        """Elements number ``at``."""
        high = np.searchsorted(self.bounds(), at, "right") - 1
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self._low(at)

    def successor(self, values: np.ndarray, lo: np.ndarray | int = 0, hi: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(number, whether it is equal) of the first element >= each value, searched within [lo, hi)."""
        values = np.asarray(values, np.uint64)
        bounds, shift = self.bounds(), np.uint64(self.low_bits)
        high = np.minimum(values >> shift, np.uint64(len(bounds) - 2)).astype(np.int64)
        beyond = (values >> shift) > np.uint64(len(bounds) - 2)
        at, end = bounds[high].copy(), bounds[high + 1]
        at[beyond] = end[beyond] = self.n
        at = np.maximum(at, lo)
        if hi is not None:
            end = np.minimum(end, hi)
        low = values & np.uint64((1 << self.low_bits) - 1)
        last = end.copy()
        open_ = np.flatnonzero(at < end)
        while len(open_):
            middle = (at[open_] + end[open_]) >> 1
            below = self._low(middle) < low[open_]
            at[open_[below]] = middle[below] + 1
            end[open_[~below]] = middle[~below]
            open_ = open_[at[open_] < end[open_]]
        equal = at < last
        equal[equal] = self._low(at[equal]) == low[equal]
        return at, equal

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.low_bits, self.n, self.lows.shape[1], len(self.highs)], np.int64), self.lows, self.highs]


class Trie:
    """Words, the words before them, and how often: a shard of a bigram model.

    Level 1: sorted word hashes; running totals of their counts (exact, monotone).
    Level 2: for each word, the numbers of the words seen before it.  A monotone pointer per word
    bounds its range; numbers are shifted by the word's place, so that the whole level is one
    monotone sequence, and a search looks for the number relative to its context's range.
    Each pair has one byte: the quantised logarithm of its smoothed mass, by a codebook whose bins
    are of equal population or of equal width.
    """

    NAMES = ("words", "totals", "pointers", "contexts", "pairs")

    def __init__(self, levels: dict[str, Monotone], codes: np.ndarray, book: np.ndarray):
        self.levels, self.codes, self.book = levels, codes, book

    @classmethod
    def build(cls, words: np.ndarray, counts: np.ndarray, contexts: np.ndarray, word_of: np.ndarray, context_of: np.ndarray, mass: np.ndarray) -> Trie:
        """``words``, ``contexts``: sorted hashes; pair i is (``word_of``, ``context_of``), sorted; ``mass``: its log."""
        wide, n = 1 << 64, max(1, len(contexts))
        pointers = np.searchsorted(word_of, np.arange(len(words) + 1))
        pairs = word_of.astype(np.uint64) * np.uint64(n) + context_of.astype(np.uint64)
        order = np.sort(mass)
        edges = order[(np.arange(129) * (len(order) - 1)) // 128] if len(order) else np.zeros(2)
        # Half of the bins hold as many pairs each, half are as wide each: frequent pairs are few.
        edges = np.unique(np.concatenate([edges, np.linspace(edges[0], edges[-1], 128)]))
        codes = np.minimum(np.searchsorted(edges, mass, "right") - 1, max(0, len(edges) - 2)) if len(mass) else np.empty(0, np.int64)
        bins = max(1, len(edges) - 1)
        book = np.bincount(codes, mass, minlength=bins) / np.maximum(np.bincount(codes, minlength=bins), 1)
        levels = {
            "words": Monotone.encode(words, wide), "totals": Monotone.encode(np.cumsum(counts), int(counts.sum()) + 1),
            "pointers": Monotone.encode(pointers, len(pairs) + 1), "contexts": Monotone.encode(contexts, wide),
            "pairs": Monotone.encode(pairs, len(words) * n + 1),
        }
        return cls(levels, codes.astype(np.uint8), book)

    def counts(self, at: np.ndarray) -> np.ndarray:
        """Counts of the words number ``at``."""
        totals = self.levels["totals"]
        before = np.where(at > 0, totals.access(np.maximum(at - 1, 0)), np.uint64(0))
        return (totals.access(at) - before).astype(np.int64)

    def find_words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.levels["words"].successor(hashes)

    def find_contexts(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.levels["contexts"].successor(hashes)

    def pair_mass(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Log mass of (word number, context number) pairs; NaN for pairs without one."""
        lo, hi = (self.levels["pointers"].access(word + k).astype(np.int64) for k in (0, 1))
        n = np.uint64(max(1, self.levels["contexts"].n))
        at, equal = self.levels["pairs"].successor(word.astype(np.uint64) * n + context.astype(np.uint64), lo, hi)
        out = np.full(len(word), np.nan)
        out[equal] = self.book[self.codes[at[equal]]]
        return out

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        for part in [p for name in self.NAMES for p in self.levels[name].parts()] + [np.array([len(self.codes), len(self.book)], np.int64), self.codes, self.book]:
            data = np.ascontiguousarray(part).tobytes()
            out.write(data + bytes(-len(data) % 8))
        return out.getvalue()

    @classmethod
    def from_buffer(cls, buffer) -> Trie:
        """A trie over ``buffer`` (bytes or a memory map); nothing is copied."""
        at = 0

        def take(dtype, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(buffer, dtype, n, at)
            at += -(-out.nbytes // 8) * 8
            return out

        levels = {}
        for name in cls.NAMES:
            low_bits, n, width, size = take(np.int64, 4).tolist()
            levels[name] = Monotone(low_bits, take(np.uint8, n * width).reshape(n, width), take(np.uint8, size), n)
        pairs, bins = take(np.int64, 2).tolist()
        return cls(levels, take(np.uint8, pairs), take(np.float64, bins))


def mapped(data: bytes) -> Trie:
    """A trie whose levels lie in a memory-mapped file that goes with the mapping."""
    if not data:
        raise ValueError("an empty buffer is no trie")
    with tempfile.TemporaryFile() as file:
        file.write(data)
        file.flush()
        return Trie.from_buffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
