"""Edit distance of texts and word lists of any length.

The built-in ``levenshtein`` fills a table of one cell per pair of characters: two texts of 100 KB
need ten billion steps in one row.  Pairs above ``SHORT_CELLS`` cells go to Arrow batches instead,
where a column of that table is held as two whole numbers, one bit for each row, and a step costs
one machine operation for many rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pairs with at most this many cells stay with the built-in function.
SHORT_CELLS = 1 << 20
#: Items of the first sequence that are worked on together; bounds the memory for their bit masks.
BLOCK_ITEMS = 8_192


def distance(a: Sequence, b: Sequence, at_most: int | None = None) -> int:
    """Edits (insert, delete, replace) between two sequences; -1 if more than ``at_most``.

    Rows of the table are worked off in blocks.  Between blocks only the steps along the border row
    are kept: +1, 0 or -1 for each item of ``b``.  A border row also bounds the result from below,
    so that unlike pairs stop early.
    """
    if at_most is not None and abs(len(a) - len(b)) > at_most:
        return -1
    same = 0
    while same < min(len(a), len(b)) and a[same] == b[same]:
        same += 1
    a, b = a[same:], b[same:]
    same = 0
    while same < min(len(a), len(b)) and a[-1 - same] == b[-1 - same]:
        same += 1
    a, b = a[: len(a) - same], b[: len(b) - same]
    steps, n = [1] * len(b), len(b)
    for start in range(0, len(a), BLOCK_ITEMS):
        block = a[start : start + BLOCK_ITEMS]
        steps = _border(block, b, steps)
        below = len(a) - start - len(block)
        if at_most is not None:
            row = accumulate(steps, initial=start + len(block))
            if min(v + abs(below - (n - j)) for j, v in enumerate(row)) > at_most:
                return -1
    total = len(a) + sum(steps)
    return -1 if at_most is not None and total > at_most else total


def _border(block: Sequence, b: Sequence, above: list[int]) -> list[int]:
    """Steps along the last row of ``block``, given those along the row above it."""
    where: dict = {}
    for i, item in enumerate(block):
        where[item] = where.get(item, 0) | (1 << i)
    last, full = len(block) - 1, (1 << len(block)) - 1
    # Bits of the rows where the table rises, or falls, from the row above in the current column.
    rise, fall, out = full, 0, []
    for item, step in zip(b, above):
        equal = where.get(item, 0)
        vertical = equal | fall
        if step < 0:
            equal |= 1
        level = (((equal & rise) + rise) ^ rise) | equal
        right_up, right_down = fall | (full & ~(level | rise)), rise & level
        out.append((right_up >> last & 1) - (right_down >> last & 1))
        right_up, right_down = right_up << 1 | (step > 0), right_down << 1 | (step < 0)
        rise = full & (right_down | ~(vertical | right_up))
        fall = full & right_up & vertical
    return out


def _long(at_most: int | None):
    @F.pandas_udf(T.IntegerType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        # Lists arrive as arrays of numpy; their items are compared as plain texts.
        plain = lambda x: x if isinstance(x, str) else x.tolist()
        found = [None if x is None or y is None else distance(plain(x), plain(y), at_most) for x, y in zip(a, b)]
        return pd.Series(found, dtype="Int32")

    return run


def text_edits(a: Column, b: Column, at_most: int | None = None, short_cells: int | None = None) -> Column:
    """Character edits between two texts; null if one is null, -1 if more than ``at_most``."""
    limit = SHORT_CELLS if short_cells is None else short_cells
    long = F.char_length(a).cast("bigint") * F.char_length(b) > limit
    dear = _long(at_most)(F.when(long, a), F.when(long, b))
    return F.when(long, dear).otherwise(F.levenshtein(a, b, at_most))


def list_edits(a: Column, b: Column, short: Column, short_cells: int | None = None) -> Column:
    """Edits between two lists; ``short`` is the column that gives them for lists of few items."""
    limit = SHORT_CELLS if short_cells is None else short_cells
    long = F.size(a).cast("bigint") * F.size(b) > limit
    dear = _long(None)(F.when(long, a), F.when(long, b))
    return F.when(long, dear).otherwise(short)
