"""Quality rules as a short-circuit cascade.

A rule looks at the texts of a batch and names those that fail.  On a sample every rule is run on
every text: that gives its cost (seconds) and which texts it rejects.  The cascade then takes, one
after the other, the rule that rejects most of what is still left per cost.  Over the whole table each rule only sees the texts that all rules before it passed.
The order decides how long it takes and which rule is named for a rejected text, never whether
the text is kept.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.wordhash import WHITESPACE, batches, mix

SYMBOLS = b"#*$%&|<>"
#: Rows of the sample that the order is estimated on, about.
SAMPLE_ROWS = 2_000
MIN_WORDS = 50
#: Bytes of text that are looked at together.
CHUNK = 1 << 19

_CONTINUATION = bytes(range(0x80, 0xC0))
_ASCII_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))

Texts = Sequence[bytes]


def word_counts(texts: Texts) -> np.ndarray:
    """Words of each text."""
    return np.array([len(t.split()) for t in texts], np.int64)


def word_characters(texts: Texts) -> np.ndarray:
    """Code points inside words."""
    drop = WHITESPACE + _CONTINUATION
    return np.array([len(t.translate(None, drop)) for t in texts], np.int64)


def symbol_counts(texts: Texts) -> np.ndarray:
    return np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)


def _lines(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line and not line.isspace()]


def repeated_lines(texts: Texts) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lines = [_lines(t) for t in texts]
    return np.array([len(found) - len(set(found)) for found in lines], np.int64)


def repeated_words(texts: Texts) -> np.ndarray:
    """Words in windows of three words that occur twice or more in their text."""
    out = np.zeros(len(texts), np.int64)
    for first, hashes, bounds in batches(list(texts), fold=False):
        n = len(hashes) - 2
        if n < 1:
            continue
        rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        grams = mix(mix(hashes[:-2] + np.uint64(1)) + hashes[1:-1])
        grams = mix(mix(grams + np.uint64(2)) + hashes[2:])
        # Windows across two texts are nobody's; the text's number makes equal windows of two texts differ.
        inside = np.flatnonzero(rows[2:] == rows[:-2])
        keys = mix(grams[inside] + mix(rows[inside].astype(np.uint64) + np.uint64(3)))
        order = np.argsort(keys)
        again = np.zeros(len(keys), bool)
        equal = keys[order[1:]] == keys[order[:-1]]
        again[order[1:][equal]] = True
        again[order[:-1][equal]] = True
        hit = np.zeros(len(hashes), bool)
        for k in range(3):
            hit[inside[again] + k] = True
        out[first : first + len(bounds) - 1] = np.bincount(rows[hit], minlength=len(bounds) - 1)
    return out


def _longest_words(texts: Texts) -> np.ndarray:
    return np.array([max(map(len, t.split()), default=0) for t in texts], np.int64)


def _letters(texts: Texts) -> np.ndarray:
    """Bytes of letters: ASCII letters and whatever is beyond ASCII."""
    beyond = bytes(range(0x80, 0x100))
    return np.array([len(t) - len(t.translate(None, _ASCII_LETTERS + beyond)) for t in texts], np.int64)


def _visible(texts: Texts) -> np.ndarray:
    return np.array([len(t.translate(None, WHITESPACE)) for t in texts], np.int64)


def _symbol_share(texts: Texts) -> np.ndarray:
    return 10 * symbol_counts(texts) > word_counts(texts)


def _word_length(texts: Texts) -> np.ndarray:
    words, characters = word_counts(texts), word_characters(texts)
    return (characters < 3 * words) | (characters > 10 * words)


def _line_share(texts: Texts) -> np.ndarray:
    lines = [_lines(t) for t in texts]
    return np.array([2 * (len(found) - len(set(found))) > len(found) for found in lines], bool)


@dataclass(frozen=True)
class Rule:
    """``fails`` maps texts to a boolean array: True where a text is to be rejected."""

    name: str
    fails: Callable[[Texts], np.ndarray]


RULES = (
    Rule("symbols", _symbol_share),
    Rule("word length", _word_length),
    Rule("repeated lines", _line_share),
    Rule("letters", lambda texts: 2 * _letters(texts) < _visible(texts)),
    Rule("long word", lambda texts: _longest_words(texts) > 1000),
)


#: With the rules that the digest judges by itself.
GENERAL_RULES = (
    Rule("few words", lambda texts: word_counts(texts) < MIN_WORDS),
    Rule("repeated words", lambda texts: 100 * repeated_words(texts) > 50 * word_counts(texts)),
    *RULES,
)


def cascade(texts: Texts, rules: Sequence[Rule], passed: np.ndarray | None = None) -> np.ndarray:
    """Number of the first rule that each text fails, -1 if none; texts outside ``passed`` get -2."""
    verdict = np.full(len(texts), -1, np.int32)
    if passed is not None:
        verdict[~passed] = -2
    for number, rule in enumerate(rules):
        left = np.flatnonzero(verdict == -1)
        if not len(left):
            break
        failed = rule.fails([texts[i] for i in left])
        verdict[left[failed]] = number
    return verdict


def _chunks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``CHUNK`` bytes (or one longer text); null counts as empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    first, size, found = 0, 0, []
    for i in range(len(column)):
        text = column[i].as_py() or b""
        if found and size + len(text) > CHUNK:
            yield first, found
            first, size, found = i, 0, []
        found.append(text)
        size += len(text)
    if found:
        yield first, found


def _trial(rules: Sequence[Rule]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, patterns, size = np.zeros(len(rules)), {}, 0
        for part in parts:
            for _, texts in _chunks(part.column("text")):
                bits = np.zeros(len(texts), np.int64)
                for number, rule in enumerate(rules):
                    start = time.perf_counter()
                    failed = rule.fails(texts)
                    spent[number] += time.perf_counter() - start
                    bits |= failed.astype(np.int64) << number
                size += sum(map(len, texts))
                for bit, n in zip(*np.unique(bits, return_counts=True)):
                    patterns[int(bit)] = patterns.get(int(bit), 0) + int(n)
        rows = [(None, i, float(s), size) for i, s in enumerate(spent)] + [(b, None, float(n), 0) for b, n in patterns.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.int64()))],
                                         names=["pattern", "rule", "value", "size"])

    return run


def order_rules(cost: Sequence[float], patterns: dict[int, float]) -> list[int]:
    """Rules by rejections per cost, each among the texts that the rules before it left over.

    ``patterns``: number of sampled texts per set of failed rules (bit i: rule i).  Rules that
    reject nothing more come last, cheapest first; ties go to the earlier rule.
    """
    left, order = dict(patterns), []
    rest = list(range(len(cost)))
    while rest:
        gain = {r: sum(n for bits, n in left.items() if bits >> r & 1) for r in rest}
        best = max(rest, key=lambda r: (gain[r] / max(cost[r], 1e-12), -cost[r], -r))
        order.append(best)
        rest.remove(best)
        left = {bits: n for bits, n in left.items() if not bits >> best & 1}
    return order


def plan_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """``rules`` in the order that rejects most per cost, estimated on a sample of ``docs``.

    The sample has about ``sample_rows`` rows however large the table is.  Without rows the order
    stays as given.
    """
    rows = docs.count()
    texts = docs.select(F.col("text").cast("string").alias("text"))
    if rows > sample_rows:
        texts = texts.sample(sample_rows / rows, seed=7)
    trial = texts.mapInArrow(_trial(rules), "pattern bigint, rule bigint, value double, size bigint")
    # At most a row per rule and one per set of failed rules.
    found = trial.groupBy("pattern", "rule").agg(F.sum("value").alias("value")).collect()
    cost = {r.rule: r.value for r in found if r.rule is not None}
    patterns = {r.pattern: r.value for r in found if r.pattern is not None}
    if not patterns:
        return tuple(rules)
    return tuple(rules[i] for i in order_rules([cost.get(i, 0.0) for i in range(len(rules))], patterns))


def apply_rules(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """``docs`` with ``failed_rule``, the first of ``rules`` that a text fails, null if it passes all.

    None plans a cascade of ``GENERAL_RULES`` for the table.  Null text counts as empty.  Rows are judged one by one; an empty table gives no rows.  A column
    that is already called ``failed_rule`` is replaced.
    """
    rules = tuple(rules) if rules is not None else plan_cascade(docs, GENERAL_RULES)
    names = [rule.name for rule in rules]
    kept = [c for c in docs.columns if c != "failed_rule"]
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in kept]).alias("_row"), F.col("text").cast("string").alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, texts in _chunks(part.column("text")):
                verdict = cascade(texts, rules)
                failed = pa.array([names[v] if v >= 0 else None for v in verdict], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("_row").slice(first, len(texts)), failed], names=["_row", "failed_rule"])

    shape = row.schema["_row"].dataType.simpleString()
    judged = row.mapInArrow(run, f"_row {shape}, failed_rule string")
    return judged.select(*[F.col("_row").getField(c).alias(c) for c in kept], "failed_rule")


_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_digest(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """doc_id, counts of words, characters, symbols, repeated lines and words, base_failed, kept.

    ``rules`` is the cascade for texts that pass the two base rules; None plans one.  Null text has
    no words and fails like an empty one.  Repeated rows are judged one by one, rows without an id
    too; an empty table gives no rows; further columns are not looked at.
    """
    chain = tuple(rules) if rules is not None else plan_cascade(docs)
    counts = (word_counts, word_characters, symbol_counts, repeated_lines, repeated_words)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, texts in _chunks(part.column("text")):
                found = [count(texts) for count in counts]
                failed = (found[0] < MIN_WORDS) | (100 * found[4] > 50 * found[0])
                kept = cascade(texts, chain, ~failed) == -1
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").slice(first, len(texts)), *[pa.array(f, pa.int64()) for f in found], pa.array(failed), pa.array(kept)],
                    names=["doc_id", *_COLUMNS, "base_failed", "kept"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id bigint, {', '.join(f'{c} bigint' for c in _COLUMNS)}, base_failed boolean, kept boolean")
