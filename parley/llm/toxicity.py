"""Toxicity of texts, scored after noisy-channel restoration of disguised words.

Writers disguise words by look-alike characters (1d10t, $tup!d), masks (st*pid), spacing (i d i o t),
splits (id.iot) and stretching (stuuupid).  Spans that look like that are found in one pass over
arrays of character classes and decoded: a lattice offers for each observed character the letters it
may stand for, nothing where a separator or a repetition can be dropped, and the border of a word
where a separator may end one.  A Viterbi search picks the letters that are most likely under a
character trigram model, less what each substitution costs.  The trigrams are counted over all
texts.  Restored texts are then scored by a linear model on words and word beginnings (``linear``).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import linear
from parley.llm.common import held_out, pieces
from parley.llm.wordhash import NOT_ALNUM, prefix_hashes

THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
PREFIXES = (3, 4, 5, 6)
#: Letters of the character model: 0 is the border of a word, 1 to 26 are a to z, 27 is any other.
LETTERS = 28
MEMO = 100_000

# Look-alike characters, masks and separators.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "¡": "i"}
MASKS = "*#%"
SEPARATORS = " ._-*~"
COST_LOOK, COST_MASK, COST_DROP, COST_STRETCH = 0.4, 1.5, 0.2, 0.3

MAX_MASKS = 4
#: Longer tokens are decoded in pieces of so many characters, each going on from the best end before it.
WINDOW = 64

_LETTER, _LOOK, _MASK, _JOIN, _BLANK, _OTHER = range(6)
_BEYOND = re.compile("€|¡".encode())


def _classes() -> np.ndarray:
    out = np.full(256, _OTHER, np.uint8)
    for c in range(256):
        ch = chr(c)
        if c > 127 or ch.isalpha():
            out[c] = _LETTER
        elif ch in LOOKS_LIKE:
            out[c] = _LOOK
        elif ch in MASKS:
            out[c] = _MASK
        elif ch in "._-~":
            out[c] = _JOIN
        elif ch in " \t\n\r\x0b\x0c":
            out[c] = _BLANK
    return out


_CLASS = _classes()


def _inside(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many ``flags`` are set in the stretch from each start to the next."""
    return np.add.reduceat(flags.astype(np.int64), starts)


def suspects(data: bytes) -> list[tuple[int, int, bool]]:
    """(start, end, spaced) of the spans that may be disguised words, in order; linear in the text.

    A token (no blank, quote or bracket inside) is one if it has a letter and a look-alike before
    its last letter, a mask between letters, a tail of one or two ``$@`` or one ``*``, a joiner between letters, or a
    letter three times in a row.  Three or more tokens of one character each, no further apart than
    two blanks, are one span if there is a letter among them.
    """
    codes = np.frombuffer(data, np.uint8)
    kind = _CLASS[codes]
    for found in _BEYOND.finditer(data):
        kind[found.start() : found.end()] = _LOOK
    solid = kind < _BLANK
    others = np.cumsum(np.concatenate([[0], kind == _OTHER]))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]])))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return []
    near = np.concatenate([[_BLANK], kind, [_BLANK]])
    before, after = near[:-2], near[2:]
    word = kind <= _MASK
    # An opening bracket before a word and an exclamation mark behind one are what they are.
    plain = ((codes == ord("(")) & (before > _MASK)) | ((codes == ord("!")) & (after > _MASK))
    look = (kind <= _MASK) & (kind > _LETTER) & ~plain
    letter = kind == _LETTER
    token = np.cumsum(np.concatenate([[0], np.diff(solid.astype(np.int8)) > 0])) - (0 if solid[0] else 1)
    first_letter, last_letter = np.full(len(starts), len(codes), np.int64), np.full(len(starts), -1, np.int64)
    where = np.flatnonzero(letter)
    last_letter[token[where]] = where  # the last one stays
    first_letter[token[where[::-1]]] = where[::-1]
    where = np.flatnonzero(look)
    of = token[where]
    inner = np.zeros(len(codes), bool)
    inner[where[(where < last_letter[of]) & ((kind[where] == _LOOK) | (where > first_letter[of]))]] = True
    inner |= (kind == _JOIN) & (before == _LETTER) & (after == _LETTER)
    low = codes | 32
    if len(codes) > 2:
        inner[2:] |= letter[2:] & (codes[2:] < 128) & (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2])
    tail = np.isin(codes, np.frombuffer(b"$@", np.uint8))
    core_end = last_letter + 1
    tails = np.where(last_letter >= 0, np.minimum(ends - core_end, 3), 3)
    short_tail = (tails > 0) & (tails < 3) & (last_letter >= starts)
    star = (tails == 1) & short_tail
    star[star] = codes[core_end[star]] == ord("*")
    short_tail[short_tail] = tail[core_end[short_tail]] & tail[ends[short_tail] - 1]
    short_tail |= star
    chosen = (last_letter >= 0) & ((_inside(inner, starts) > 0) | short_tail)
    # Runs of tokens of one character.
    single = (ends - starts == 1) & (word[starts] | (kind[starts] == _JOIN))
    glued = np.concatenate([[False], single[1:] & single[:-1] & (starts[1:] - ends[:-1] <= 2) & (others[starts[1:]] == others[ends[:-1]])])
    first = np.flatnonzero(single & ~glued)
    length = np.diff(np.flatnonzero(np.concatenate([~glued, [True]])))[np.searchsorted(np.flatnonzero(~glued), first)]
    out = []
    for i, n in zip(first.tolist(), length.tolist()):
        at = starts[i : i + n]
        if n >= 3 and letter[at].any() and word[at].sum() >= 3:
            out.append((int(starts[i]), int(ends[i + n - 1]), True))
    first_word = np.flatnonzero(word)
    for i in np.flatnonzero(chosen & (ends - starts > 1)).tolist():
        # From the first character that may be a letter on.
        start = int(first_word[np.searchsorted(first_word, starts[i])])
        start += int(bool(plain[start]))
        out.append((start, int(ends[i]) if short_tail[i] else int(core_end[i]), False))
    return sorted(out)


def _codes() -> np.ndarray:
    out = np.zeros(256, np.int64)
    for c in range(256):
        ch = chr(c).lower()
        out[c] = ord(ch) - 96 if c < 128 and ch.isalpha() else 27 if c > 127 or ch.isdigit() else 0
    return out


_CODE = _codes()


def _trigrams(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of letter trigrams of a partition."""
    counts = np.zeros(LETTERS**3, np.int64)
    for part in pieces(parts):
        for text in part.column("text").cast(pa.binary()).to_pylist():
            for at in range(0, len(text or b""), 1 << 21):
                c = np.concatenate([[0], _CODE[np.frombuffer(text[at : at + (1 << 21)], np.uint8)], [0]])
                # Runs of borders count once.
                c = c[np.concatenate([[True], (c[1:] > 0) | (c[:-1] > 0)])]
                if len(c) > 2:
                    counts += np.bincount(c[:-2] * LETTERS**2 + c[1:-1] * LETTERS + c[2:], minlength=LETTERS**3)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["gram", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities [a, b, c] of letter c after a, b; trigrams, bigrams and letters interpolated."""
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_trigrams, "gram int, n bigint")
    counts = np.zeros(LETTERS**3)
    # At most LETTERS ** 3 rows.
    for row in rows.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row.gram] = row["n"]
    three = counts.reshape(LETTERS, LETTERS, LETTERS)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 0.5) / (one.sum() + 0.5 * LETTERS)
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    return np.log((three + 5 * p2[None]) / (three.sum(2, keepdims=True) + 5))


#: Options of the lattice that are no letters.
DROP, BORDER = 0, -1


def lattice(span: str) -> list[list[tuple[int, float]]]:
    """For each character the letters (1 to 26) it may stand for, or DROP or BORDER, and what that costs."""
    out = []
    # A mask may be any letter; so many of them say nothing.
    masked = sum(c.isalpha() for c in span) > 1 and sum(c in MASKS for c in span) <= MAX_MASKS
    for i, c in enumerate(span):
        low = c.lower()
        if not "a" <= low <= "z":
            # Letters with marks read as the letter below.
            base = unicodedata.normalize("NFD", low)[:1]
            low = base if "a" <= base <= "z" else low
        options: dict[int, float] = {}
        if len(low) == 1 and "a" <= low <= "z":
            options[ord(low) - 96] = 0.0
            if i and span[i - 1].lower() == low:
                options[DROP] = COST_STRETCH  # a stretched letter may be dropped
        for letter in LOOKS_LIKE.get(c, ""):
            options[ord(letter) - 96] = COST_LOOK
        if c in MASKS and masked:
            for k in range(1, 27):
                options.setdefault(k, COST_MASK)
        if c in SEPARATORS or not options:
            options[DROP] = COST_DROP
            options[BORDER] = 0.0
        out.append(list(options.items()))
    return out


State = dict[tuple[int, int], tuple[float, tuple | None]]


def _step(states: State, options: list[tuple[int, float]], model: list) -> State:
    """All states (last two letters; 0: border) after one more character, each with its best way there."""
    following: State = {}
    for (a, b), (score, way) in states.items():
        row = model[a][b]
        for letter, cost in options:
            if letter > 0:
                key, value = (b, letter), (score + row[letter] - cost, (way, letter))
            elif letter == BORDER and b:
                key, value = (b, 0), (score + row[0] - cost, (way, 0))
            else:
                key, value = (a, b), (score - cost, way)
            known = following.get(key)
            if known is None or value[0] > known[0]:
                following[key] = value
    return following


def _spelled(way: tuple | None) -> str:
    out = []
    while way is not None:
        way, letter = way
        out.append(chr(96 + letter) if letter else " ")
    return "".join(reversed(out))


def decode(options: list[list[tuple[int, float]]], model: list) -> str:
    """The most likely letters through a lattice (Viterbi over pairs of letters); blanks are borders."""
    states: State = {(0, 0): (0.0, None)}
    done = []
    for at, choice in enumerate(options, 1):
        states = _step(states, choice, model)
        if at % WINDOW == 0 and at < len(options):
            key, (_, way) = max(states.items(), key=lambda s: s[1][0])
            done.append(_spelled(way))
            states = {key: (0.0, None)}
    _, way = max(((score + (model[a][b][0] if b else 0.0), way) for (a, b), (score, way) in states.items()), key=lambda s: s[0])
    return "".join([*done, _spelled(way)])


_REPEATS = re.compile(r"(.)\1{2,}", re.DOTALL)


def restore(span: str, model: list, spaced: bool = False) -> str:
    """What ``span`` may say.  A spaced one is also read with its first or last letter as a word of its own."""
    # More than two of a letter tell no more than two.
    span = _REPEATS.sub(r"\1\1", span)
    options = lattice(span)
    found = [decode(options, model)]
    if spaced:
        gaps = [i for i, c in enumerate(span) if c in SEPARATORS]
        for gap in (gaps[0], gaps[-1]):
            found.append(decode([*options[:gap], [(BORDER, 0.0)], *options[gap + 1 :]], model))
    return " ".join(dict.fromkeys(found))


class Restorer:
    """Texts with suspect spans restored; the same span is decoded once."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.memo: dict[bytes, bytes] = {}

    def _span(self, span: bytes, spaced: bool) -> bytes:
        found = self.memo.get(span)
        if found is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            found = self.memo[span] = restore(span.decode("utf-8", "replace"), self.model, spaced).encode()
        return found

    def restore_all(self, texts: list[bytes]) -> list[bytes]:
        """Each text with the restored form behind every suspect span; plain words with a digit lose nothing."""
        gap = b"\n\n\n"
        data = gap.join(texts)
        ends = np.cumsum([len(t) + len(gap) for t in texts])
        parts: list[list[bytes]] = [[] for _ in texts]
        spans = suspects(data)
        owners = np.searchsorted(ends, [s for s, _, _ in spans], "right").tolist()
        at = [0, *ends[:-1].tolist()]
        for owner, (start, end, spaced) in zip(owners, spans):
            parts[owner] += [data[at[owner] : end], b" ", self._span(data[start:end], spaced), b" "]
            at[owner] = end
        return [b"".join([*part, data[a : e - len(gap)]]) for part, a, e in zip(parts, at, ends.tolist())]

    def __call__(self, text: str) -> str:
        return self.restore_all([text.encode()])[0].decode("utf-8", "replace")


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Indicators of words and of their first bytes."""
    hashes, bounds = prefix_hashes(texts, NOT_ALNUM, PREFIXES)
    rows = np.repeat(np.arange(len(texts)), np.diff(bounds))
    limit = np.uint64((1 << linear.BITS) - 1)
    return np.concatenate([h & limit for h in hashes]).astype(np.int64), np.tile(rows, len(hashes))


def _restored(model: np.ndarray):
    def featurize(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return features(restorer.restore_all(texts))

    restorer = Restorer(model)
    return featurize


def train_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = linear.PER_CLASS):
    """(character model, linear model); ``labels``: doc_id, toxic; held-out rows are not used."""
    rows = labels.where(~held_out(F.col("doc_id"), FOLDS, HELD_OUT)).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").alias("label"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chars = character_model(texts)
    return chars, linear.train(texts, rows, _restored(chars), per_class)


def score_toxicity(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null text counts as empty; empty texts get the score of a text without words; repeated rows
    are scored one by one; without labels of both classes every text gets the share of label 1.
    An empty table gives no rows; further columns are not looked at.
    """
    chars, weights = model
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(linear.scorer(weights, _restored(chars), ["doc_id"]), "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score",
                         linear.predicted(F.col("score"), threshold).alias("predicted"))
