"""64-bit hashes of all words of a batch of texts, by whole-array arithmetic.

A word is a run of bytes that ``separators`` does not list.  Its hash is a sum of random values
per byte times powers of an odd number (modulo 2**64), mixed at the end; texts go through in
segments cut between words, so that memory stays bounded however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SEGMENT = 1 << 18

_BYTES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

WHITESPACE = bytes([32, 9, 10, 11, 12, 13])
NOT_ALNUM = bytes(c for c in range(128) if not chr(c).isalnum())


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(30))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _segment(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words in ``data``."""
    where = np.flatnonzero(is_word[data])
    if not len(where):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.flatnonzero(np.diff(where, prepend=-2) != 1)
    lengths = np.diff(first, append=len(where))
    powers = _powers(int(lengths.max()))
    place = np.arange(len(where)) - np.repeat(first, lengths)
    values = np.add.reduceat(_BYTES[data[where]] * powers[place], first)
    return mix(values + lengths.astype(np.uint64)), where[first]


def hash_words(texts: list[bytes], separators: bytes = WHITESPACE, fold: bool = True, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the words of text ``i``, A-Z lower-cased if ``fold``, are ``hashes[bounds[i]:bounds[i + 1]]``."""
    is_word = np.ones(256, bool)
    is_word[list(separators)] = False
    counts, found = [], []
    for text in texts:
        # Cut long texts between words only.
        n, at = 0, 0
        text = text.lower() if fold else text
        while at < len(text):
            end = at + segment
            if end < len(text):
                while end < len(text) and is_word[text[end]]:
                    end += 1
            h, _ = _segment(np.frombuffer(text, np.uint8, min(end, len(text)) - at, at), is_word)
            found.append(h)
            n += len(h)
            at = end
        counts.append(n)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(counts, out=bounds[1:])
    return (np.concatenate(found) if found else np.empty(0, np.uint64)), bounds


def batches(texts: list[bytes | None], separators: bytes = WHITESPACE, fold: bool = True, segment: int = SEGMENT) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first, hashes, bounds) for runs of texts of about one segment; a null text has no words."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last] or b"") <= segment):
            size += len(texts[last] or b"")
            last += 1
        part = [t or b"" for t in texts[first:last]]
        if size > segment:
            yield first, *hash_words(part, separators, fold, segment)
        else:
            # Together: a separator between texts keeps their words apart.
            joined = b" ".join(part)
            joined = joined.lower() if fold else joined
            is_word = np.ones(256, bool)
            is_word[list(separators)] = False
            hashes, starts = _segment(np.frombuffer(joined, np.uint8), is_word)
            ends = np.cumsum([len(p) + 1 for p in part])
            yield first, hashes, np.concatenate([[0], np.searchsorted(starts, ends)])
        first = last


def word_table(texts: list[bytes], separators: bytes, classes: np.ndarray):
    """(hashes, class bits, lengths, class of the last byte, bounds) of all words, case kept out of the hash."""
    joined = b" ".join(texts)
    data = np.frombuffer(joined, np.uint8)
    is_word = np.ones(256, bool)
    is_word[list(separators)] = False
    hashes, starts = _segment(np.frombuffer(joined.lower(), np.uint8), is_word)
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
    where = np.flatnonzero(is_word[data])
    first = np.flatnonzero(np.diff(where, prepend=-2) != 1)
    lengths = np.diff(first, append=len(where))
    if not len(first):
        return hashes, np.empty(0, np.uint8), lengths, np.empty(0, np.uint8), bounds
    kinds = classes[data[where]]
    return hashes, np.bitwise_or.reduceat(kinds, first), lengths, kinds[first + lengths - 1], bounds


def prefix_hashes(texts: list[bytes], separators: bytes, prefixes: tuple[int, ...]):
    """([hashes of words, then of their first n bytes for each n], bounds)."""
    joined = b" ".join(texts).lower()
    data = np.frombuffer(joined, np.uint8)
    is_word = np.ones(256, bool)
    is_word[list(separators)] = False
    where = np.flatnonzero(is_word[data])
    ends = np.cumsum([len(t) + 1 for t in texts])
    if not len(where):
        return [np.empty(0, np.uint64)] * (1 + len(prefixes)), np.zeros(len(texts) + 1, np.int64)
    first = np.flatnonzero(np.diff(where, prepend=-2) != 1)
    lengths = np.diff(first, append=len(where))
    bounds = np.concatenate([[0], np.searchsorted(where[first], ends)])
    place = np.arange(len(where)) - np.repeat(first, lengths)
    values = _BYTES[data[where]] * _powers(int(lengths.max()))[place]
    out = [mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))]
    for n in prefixes:
        part = np.add.reduceat(np.where(place < n, values, np.uint64(0)), first)
        out.append(mix(part + np.uint64(1 << 40) + np.uint64(n)))
    return out, bounds
