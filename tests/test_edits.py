"""Edit distances of long texts and lists, against the built-in function and a plain table."""

import random
import time

import pytest
from pyspark.sql import functions as F

from parley.functions import edits, metrics


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@pytest.mark.parametrize("block", [1, 3, 64, 8_192])
def test_distance_equals_a_plain_table(monkeypatch, block):
    monkeypatch.setattr(edits, "BLOCK_ITEMS", block)
    draw = random.Random(block)
    for _ in range(300):
        a, b = ("".join(draw.choice("abé𝄞") for _ in range(draw.randrange(40))) for _ in range(2))
        want = plain(a, b)
        assert edits.distance(a, b) == edits.distance(list(a), list(b)) == want
        for bound in (0, want - 1, want, want + 3):
            if bound >= 0:
                assert edits.distance(a, b, bound) == (want if want <= bound else -1)


def test_long_and_short_pairs_agree(spark):
    draw = random.Random(7)
    rows = [("".join(draw.choice("ab cdé ") for _ in range(draw.randrange(60))), "".join(draw.choice("ab cd𝄞 ") for _ in range(60))) for _ in range(60)]
    rows += [("", ""), ("", "a b"), (None, "a"), ("a", None), ("a b c", "a b c")]
    df = spark.createDataFrame(rows, "t string, p string")
    t, p = F.col("t"), F.col("p")
    tw, pw = metrics.words(t), metrics.words(p)
    out = df.select(
        F.levenshtein(t, p).alias("a"), edits.text_edits(t, p, short_cells=-1).alias("b"), edits.text_edits(t, p, 20, -1).alias("c"),
        F.levenshtein(t, p, 20).alias("d"), (metrics.wer(t, p) * F.size(tw)).alias("e"),
        edits.list_edits(tw, pw, F.lit(-9), -1).alias("f")).collect()
    for row in out:
        assert row.a == row.b and row.c == row.d
        assert row.e is None or round(row.e) == row.f


def test_texts_of_100_kb_take_seconds(spark):
    draw = random.Random(3)
    text = "".join(draw.choice("abcdefgh ") for _ in range(100_000))
    other = "".join(draw.choice("abcdefgh ") for _ in range(100_000))
    near = "x" + text[:40_000] + "yy" + text[40_010:] + "z"
    start = time.perf_counter()
    rows = spark.createDataFrame([(0, near), (1, other)], "id int, p string").withColumn("t", F.lit(text))
    got = {r.id: r.d for r in rows.select("id", edits.text_edits(F.col("t"), F.col("p")).alias("d")).collect()}
    assert got[0] <= 12 and 40_000 < got[1] < 80_000
    assert edits.distance(text, other, 500) == -1
    assert time.perf_counter() - start < 60
