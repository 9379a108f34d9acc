"""Phrases inside texts: block lists and phrase tables of any length, found in one pass.

The phrases become an Aho-Corasick automaton, built once by the driver and sent to the tasks; a text
is run through it character by character, however many phrases there are.  A phrase may hold blanks
and marks; ``whole_words`` wants no letter or digit to go on at its ends.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.text import CENSOR_MARK

#: The automaton goes to every task, so the list has a bound; a longer one is an error.
MAX_PHRASES = 2_000_000

#: (text, found) -> text; ``found``: (start, end, replacement) of all phrases in the text.
Rewrite = Callable[[str, list[tuple[int, int, str]]], str]


def fold_case(text: str) -> str:
    """``text`` in lower case, character by character, so that places stay the same."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def build_automaton(phrases: list[tuple[str, str]], ignore_case: bool = True) -> bytes:
    """Pickled automaton of (phrase, replacement); blank phrases are left out, of equal ones the first replacement stays."""
    automaton = ahocorasick.Automaton()
    for phrase, replacement in sorted((fold_case(p.strip()) if ignore_case else p.strip(), r) for p, r in phrases):
        if phrase and phrase not in automaton:
            automaton.add_word(phrase, (len(phrase), replacement))
    if len(automaton):
        automaton.make_automaton()
    return pickle.dumps(automaton)


def _is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def find_phrases(automaton, text: str, ignore_case: bool = True, whole_words: bool = True) -> list[tuple[int, int, str]]:
    """(start, end, replacement) of every occurrence, by end."""
    if not len(automaton) or not text:
        return []
    out = []
    for last, (length, replacement) in automaton.iter(fold_case(text) if ignore_case else text):
        start, end = last + 1 - length, last + 1
        if whole_words:
            if start and _is_word(text[start]) and _is_word(text[start - 1]):
                continue
            if end < len(text) and _is_word(text[last]) and _is_word(text[end]):
                continue
        out.append((start, end, replacement))
    return out


def leftmost_longest(text: str, found: list[tuple[int, int, str]]) -> str:
    """Replace from left to right, at each place the longest phrase."""
    out, at = [], 0
    for start, end, replacement in sorted(found, key=lambda f: (f[0], -f[1])):
        if start >= at:
            out += [text[at:start], replacement]
            at = end
    return "".join([*out, text[at:]])


def best_cover(text: str, found: list[tuple[int, int, str]]) -> str:
    """Replace the phrases that together cover most characters; then the fewest, then the longest first.

    Dynamic programming from the end of the text over the places where a phrase starts.
    """
    by_start: dict[int, list[tuple[int, int, str]]] = {}
    for span in found:
        by_start.setdefault(span[0], []).append(span)
    starts = sorted(by_start, reverse=True)
    # From a start on: (characters left out, phrases), and the phrase taken there (None: go on).
    best: dict[int, tuple[tuple[int, int], tuple[int, int, str] | None, int]] = {}
    ordered: list[int] = []

    def after(place: int) -> tuple[tuple[int, int], int]:
        """Cost from ``place`` on, and the start it goes on from (the text's length: none)."""
        lo, hi = 0, len(ordered)
        while lo < hi:  # ``ordered`` falls
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if ordered[mid] >= place else (lo, mid)
        if not lo:
            return (len(text) - place, 0), len(text)
        following = ordered[lo - 1]
        (left, n), _, _ = best[following]
        return (left + following - place, n), following

    for start in starts:
        (left, n), following = after(start + 1)
        choice, taken, to = (left + 1, n), None, following
        for span in sorted(by_start[start], key=lambda f: f[1]):
            (left, n), following = after(span[1])
            if (left, n + 1) <= choice:  # the longer phrase on a tie
                choice, taken, to = (left, n + 1), span, following
        best[start] = (choice, taken, to)
        ordered.append(start)
    out, at = [], 0
    place = starts[-1] if starts else len(text)
    while place < len(text):
        _, taken, following = best[place]
        if taken:
            out += [text[at : taken[0]], taken[2]]
            at = taken[1]
        place = following
    return "".join([*out, text[at:]])


def _rewritten(df: DataFrame, column: str, phrases: DataFrame, rewrite: Rewrite, ignore_case: bool, whole_words: bool) -> DataFrame:
    rows = phrases.where("phrase IS NOT NULL").limit(MAX_PHRASES + 1).collect()
    if len(rows) > MAX_PHRASES:
        raise ValueError(f"more than {MAX_PHRASES} phrases")
    automaton = df.sparkSession.sparkContext.broadcast(build_automaton([(r.phrase, r.replacement or "") for r in rows], ignore_case))
    names = df.columns
    boxed = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(f"`{column}`").cast("string").alias("_text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pickle.loads(automaton.value)
        for part in parts:
            texts = [None if t is None else rewrite(t, find_phrases(found, t, ignore_case, whole_words)) for t in part.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(texts, pa.string())], names=["_row", "_text"])

    shape = boxed.schema["_row"].dataType.simpleString()
    return boxed.mapInArrow(run, f"_row {shape}, _text string").select(
        *[(F.col("_text") if c == column else F.col("_row").getField(c)).alias(c) for c in names])


def censor_phrases(df: DataFrame, column: str, phrases: DataFrame, mark: str = CENSOR_MARK, ignore_case: bool = True, whole_words: bool = True) -> DataFrame:
    """Put ``mark`` for every listed phrase (column phrase); leftmost first, there the longest.  Null texts stay null."""
    listed = phrases.select(F.col("phrase").cast("string").alias("phrase"), F.lit(mark).alias("replacement"))
    return _rewritten(df, column, listed, leftmost_longest, ignore_case, whole_words)


def translate_phrases(df: DataFrame, column: str, table: DataFrame, ignore_case: bool = True, whole_words: bool = True) -> DataFrame:
    """Replace phrases by a table (phrase, replacement) so that most of each text is covered.

    Of coverings that leave equally much as it is, the one with the fewest phrases is taken, then
    the one whose phrases are longer from the left on.  A phrase that is listed several times takes
    its first replacement in alphabetical order.
    """
    rows = table.select(F.col("phrase").cast("string").alias("phrase"), F.col("replacement").cast("string").alias("replacement"))
    return _rewritten(df, column, rows, best_cover, ignore_case, whole_words)
