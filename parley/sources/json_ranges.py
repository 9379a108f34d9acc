"""Large JSON documents read by many tasks: the elements of a list, whatever the size of its file.

Spark's text reader cuts a file into byte ranges and, told that lines end with ``}``, gives each range
whole records.  What a range has to know about everything before it is little: whether it starts
inside a string, and which lists and objects are open there.

1. The parity of the unescaped quotes of every range tells where strings are open (JVM only).
2. Every range reports which containers it closes and leaves open; per file, one small row a range,
   these are chained up.
3. Every range now cuts out its elements.  An element that crosses a border comes in pieces, which
   are put together by its number; all others go straight through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.plans.scratch import settle

# A key and the container behind it; a whole string; a string that goes on in the next record; a bracket.
_TOKEN = re.compile(r'"((?:[^"\\]|\\.)*)"\s*:\s*([{\[])|"(?:[^"\\]|\\.)*"|(")|([{}\[\]])', re.DOTALL)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"(?:\s*:\s*([{\[]))?', re.DOTALL)
ANY = "*"
#: Rows that a task puts out together.
BATCH = 2_000
#: What is known of the ranges is broadcast, a few hundred bytes each: so many are allowed in one call
#: (50 TB at 128 MB a range).
MAX_RANGES = 400_000


def _tokens(text: str, in_string: bool) -> Iterator[tuple[str, str | None, int]]:
    """(bracket, key, end) of the brackets outside strings; last ('"', None, end) if a string is left open."""
    at = 0
    if in_string:
        end = _STRING_END.match(text)
        if not end:
            yield '"', None, len(text)
            return
        at = end.end()
        if end[1]:
            yield end[1], None, at  # the key began in another record: it matches nothing
    for match in _TOKEN.finditer(text, at):
        key, opened, cut, bracket = match.groups()
        if opened:
            yield opened, key, match.end()
        elif bracket:
            yield bracket, ANY, match.end()
        elif cut:
            yield '"', None, len(text)
            return


def _ranges(spark: SparkSession, path: str, file_pattern: str | None) -> DataFrame:
    """(file, block, text): records in their order inside each range."""
    rows = spark.read.option("recursiveFileLookup", True).option("lineSep", "}").text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.concat("value", F.lit("}")).alias("text"))
    return rows.where(F.regexp_extract("file", r"[^/]*$", 0).rlike(f"^(?:{file_pattern})")) if file_pattern else rows


def _each_range(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """(whether a new range starts, row) over the rows of a task."""
    now = None
    for part in parts:
        for row in part.to_pylist():
            key = (row["file"], row["block"])
            yield key != now, row
            now = key


def _shape(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range the containers closed (those open before it) and left open, as "{key" or "[key"."""
    out: list[list] = []
    string = False
    for fresh, row in _each_range(parts):
        if fresh:
            out.append([row["file"], row["block"], 0, []])
            string = row["in_string"]
        opened = out[-1][3]
        for kind, key, _ in (found := list(_tokens(row["text"], string))):
            if kind in "{[":
                opened.append(kind + (key if key is not None else "\0"))
            elif kind in "}]":
                if opened:
                    opened.pop()
                else:
                    out[-1][2] += 1
        string = bool(found) and found[-1][0] == '"'
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string())))], names=["file", "block", "closed", "opened"])


def _chained(group: pd.DataFrame) -> pd.DataFrame:
    """The containers open at the start of each range of one file."""
    group = group.sort_values("block")
    stack: list[str] = []
    before = []
    for closed, opened in zip(group["closed"], group["opened"]):
        before.append(list(stack))
        # The last record may carry one bracket too many: the separator that was put behind it.
        stack = stack[: max(0, len(stack) - closed)] + list(opened)
    if stack:
        raise ValueError(f"{group['file'].iloc[0]} is no complete JSON document")
    return pd.DataFrame({"file": group["file"], "block": group["block"], "open": before})


class _Cutter:
    """Cuts one range into elements; ``target``: keys from the root to the elements, ANY for a list's."""

    def __init__(self, target: Sequence[str], opened: Sequence[str]) -> None:
        self.target = list(target)
        self.outer = next((i + 1 for i, k in enumerate(self.target[:-1]) if k == ANY), None)
        self.fits: list[bool] = []
        for entry in opened:
            self._push(entry[1:])
        self.n_outer = self.n_inner = 0
        self.piece = 0
        self.buffer: list[str] = []
        self.head: list[str] = []
        self.rows: list[tuple] = []
        self.cut = self._inside(len(self.target))
        #: Starts of elements in the outer element that the range begins in.
        self.first_inner = 0

    def _push(self, key: str | None) -> bool:
        depth = len(self.fits)
        fits = depth == 0 or (self.fits[-1] and depth <= len(self.target) and self.target[depth - 1] == key)
        self.fits.append(fits)
        return fits and depth > 0

    def _inside(self, depth: int) -> bool:
        return len(self.fits) > depth and self.fits[depth]

    def _emit(self, kind: str, text: str) -> None:
        self.rows.append((kind, self.n_outer, self.n_inner, self.piece, text))
        self.piece += 1

    def record(self, text: str, tokens: list[tuple[str, str | None, int]]) -> None:
        start = 0
        for kind, key, end in tokens:
            if kind == '"':
                break
            if kind in "{[":
                started = self._push(None if key is None else key)
                depth = len(self.fits) - 1
                if started and depth == len(self.target):
                    self.n_inner += 1
                    start, self.cut = end - 1, False
                    self.buffer = []
                elif started and depth == self.outer:
                    if not self.n_outer:
                        self.first_inner = self.n_inner
                    self.n_outer += 1
                    self.n_inner = 0
                    start = end - 1
                elif started and self.outer and depth == len(self.target) - 1:
                    self.head.append(text[start:end])
                    self._emit("head", "".join(self.head))
                    self.head = []
            elif self.fits:
                depth = len(self.fits) - 1
                fits = self.fits.pop()
                if fits and depth == len(self.target):
                    self.buffer.append(text[start:end])
                    self._emit("piece" if self.cut else "whole", "".join(self.buffer))
                    self.buffer, self.cut, start = [], False, end
                elif fits and self.outer and depth == len(self.target) - 1:
                    start = end - 1
                elif fits and depth == self.outer:
                    self.head.append(text[start:end])
                    self._emit("head", "".join(self.head))
                    self.head, start = [], end
        # What goes on behind the record.
        if self._inside(len(self.target)):
            self.buffer.append(text[start:])
        elif self.outer and self._inside(self.outer) and not self._inside(len(self.target) - 1):
            self.head.append(text[start:])

    def finish(self) -> None:
        if self.buffer:
            self._emit("piece", "".join(self.buffer))
        if self.head:
            self._emit("head", "".join(self.head))
        if not self.n_outer:
            self.first_inner = self.n_inner
        self.rows.append(("end", self.n_outer, self.n_inner, self.first_inner, ""))


_CUT = "file string, block long, kind string, outer long, inner long, piece long, text string"


def _elements(target: Sequence[str]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, now, string = None, None, False

        def batch() -> pa.RecordBatch:
            rows, cutter.rows = cutter.rows, []
            columns = [pa.array([now[0]] * len(rows)), pa.array([now[1]] * len(rows)), *[pa.array(c) for c in zip(*rows)]]
            return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _CUT.split(", ")])

        for fresh, row in _each_range(parts):
            if fresh:
                if cutter:
                    cutter.finish()
                    yield batch()
                cutter, now, string = _Cutter(target, row["open"]), (row["file"], row["block"]), row["in_string"]
            tokens = list(_tokens(row["text"], string))
            cutter.record(row["text"], tokens)
            string = bool(tokens) and tokens[-1][0] == '"'
            if len(cutter.rows) >= BATCH:
                yield batch()
        if cutter:
            cutter.finish()
            yield batch()

    return run


def _numbered(group: pd.DataFrame) -> pd.DataFrame:
    """Per range of one file: outer elements before it, and elements of the open outer one before it."""
    group = group.sort_values("block")
    outers, inners, total, carried = [], [], 0, 0
    for n_outer, n_inner, first in zip(group["outer"], group["inner"], group["piece"]):
        outers.append(total)
        inners.append(carried)
        total += n_outer
        carried = n_inner if n_outer else carried + first
    return pd.DataFrame({"file": group["file"], "block": group["block"], "outer_before": outers, "inner_before": inners})


def json_elements(spark: SparkSession, path: str, target: Sequence[str], file_pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Elements of a list inside the JSON documents below ``path``, and what stands around them.

    ``target`` are the keys from the root to the elements, ``ANY`` for a list's: ``("chats", "list", ANY,
    "messages", ANY)``.  Only elements that are objects count.  The first result has a row per
    element: file, outer (number of the enclosing element, from 1; 0 if there is none), inner
    (its own number there, from 1) and text (JSON).  The second has the enclosing elements with
    their lists left empty: file, outer, text.  A document that ends too early is an error; an
    empty file has no elements.  A single element has to fit in a row, a file in nothing.
    """
    ranges = _ranges(spark, path, file_pattern)
    marks = F.length(F.regexp_replace(F.regexp_replace("text", r"(?s)\\.", ""), '[^"]', ""))
    quotes = settle(ranges.groupBy("file", "block").agg((F.sum(marks) % 2).alias("odd")), "quotes")
    if quotes.limit(MAX_RANGES + 1).count() > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} ranges: read the files in several calls, or in larger ranges")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range, a hundred megabytes each: a file's rows may share a task.
    strings = quotes.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("in_string"))
    strings = settle(strings, "strings")

    def beside(small: DataFrame) -> DataFrame:
        # Broadcast, so that the records stay in the order of their file: a row a range, and few bytes.
        return ranges.join(F.broadcast(small), ["file", "block"])

    shapes = beside(strings).mapInArrow(_shape, "file string, block long, closed long, opened array<string>")
    opened = shapes.groupBy("file").applyInPandas(_chained, "file string, block long, open array<string>")
    starts = settle(opened.join(strings, ["file", "block"]), "range-starts")
    cut = settle(beside(starts).select("file", "block", "in_string", "open", "text").mapInArrow(_elements(target), _CUT), "elements")
    places = cut.where("kind = 'end'").groupBy("file").applyInPandas(_numbered, "file string, block long, outer_before long, inner_before long")
    rows = cut.where("kind <> 'end'").join(places, ["file", "block"]).select(
        "file", "block", "kind", "piece", "text",
        (F.col("outer") + F.col("outer_before")).alias("outer"),
        F.when(F.col("outer") == 0, F.col("inner") + F.col("inner_before")).otherwise(F.col("inner")).alias("inner"))
    rows = settle(rows, "numbered")
    whole = rows.where("kind = 'whole'").select("file", "outer", "inner", "text")

    def joined(pieces: DataFrame, *keys: str) -> DataFrame:
        parts = F.sort_array(F.collect_list(F.struct("block", "piece", "text")))["text"]
        return pieces.groupBy("file", *keys).agg(F.array_join(parts, "").alias("text"))

    elements = whole.unionByName(joined(rows.where("kind = 'piece'"), "outer", "inner"))
    return elements, joined(rows.where("kind = 'head'"), "outer")
