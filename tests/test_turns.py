"""Sequence operators against worked examples and a small sequential model.

Every case runs twice: with plain windows, and with a row limit so low that each dialog is split
into blocks.
"""

import random
from datetime import datetime, timedelta

import pytest

from parley.operators import context as cx
from parley.operators import turns as tn
from parley.schema import MESSAGE_SCHEMA

START = datetime(2024, 1, 1)
LIMITS = [None, 2]


def messages(spark, rows):
    """rows: (dialog, sender, text[, second]); seq is the position, 'me' is mine."""
    data = []
    for i, row in enumerate(rows):
        second = row[3] if len(row) > 3 else i
        data.append((row[0], row[2], row[1], START + timedelta(seconds=second), row[1] == "me", i))
    return spark.createDataFrame(data, MESSAGE_SCHEMA)


def in_order(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("DialogID", "seq").collect()]


@pytest.mark.parametrize("limit", LIMITS)
def test_bursts_worked_example(spark, limit):
    df = messages(spark, [("d", "A", "ok"), ("d", "A", "Fine."), ("d", "A", "Hello there"), ("d", "B", "Yes?"), ("d", "B", ""), ("d", "B", "Why")])
    out = tn.coalesce_bursts(df, "first", max_rows=limit)
    assert in_order(out, "Sender", "Message", "seq") == [("A", "hello there fine. ok,,", 0), ("B", "why Yes?", 3)]
    oldest = tn.coalesce_bursts(df, "none", "oldest_first", max_rows=limit)
    assert in_order(oldest, "Message") == [("ok,, Fine. Hello there",), ("Yes? Why",)]


@pytest.mark.parametrize("limit", LIMITS)
def test_alternation_and_pairs_worked_example(spark, limit):
    rows = [("d", s, t) for s, t in [("me", "x"), ("P", "a"), ("P", "b"), ("me", "c"), ("me", "d"), ("P", "e"), ("Q", "f"), ("me", "g"), ("P", "h")]]
    turns = tn.alternate_turns(messages(spark, rows), max_rows=limit)
    assert in_order(turns, "Sender", "Message", "seq") == [("P", "b a", 2), ("me", "d c", 4), ("Q", "f", 6), ("me", "g", 7), ("P", "h", 8)]
    assert tn.alternation_violations(turns, max_rows=limit).count() == 0
    assert in_order(tn.pair_turns(turns, max_rows=limit), "question", "answer") == [("b a", "d c"), ("f", "g")]


def model_bursts(rows, fold):
    out = []
    for i, (dialog, sender, text) in enumerate(rows):
        if not text:
            continue
        last = next((o for o in reversed(out) if o[0] == dialog), None)
        if last and last[1] == sender:
            old = last[2] if last[2][-1] in ".!?" else last[2] + ","
            last[2] = fold(text) + " " + old
        else:
            out.append([dialog, sender, text, i])
    return sorted(map(tuple, out))


def model_turns(rows):
    """rows of one dialog in order -> alternating (sender, text, seq)."""
    runs = []
    for i, (_, sender, text) in enumerate(rows):
        if runs and runs[-1][0] == sender:
            runs[-1][1], runs[-1][2] = text + " " + runs[-1][1], i
        else:
            runs.append([sender, text, i])
    if runs and runs[0][0] == "me":
        runs = runs[1:]
    return [tuple(r) for r, n in zip(runs, runs[1:] + [None]) if r[0] == "me" or n is None or n[0] == "me"]


def random_rows(seed, dialogs=6, length=25):
    rng = random.Random(seed)
    rows = []
    for d in range(dialogs):
        senders = rng.choice([["me"], ["P"], ["me", "P"], ["me", "P", "Q"]])
        for _ in range(rng.randint(1, length)):
            rows.append((f"d{d}", rng.choice(senders), rng.choice(["Aa", "bb.", "Cc!", "dd", "", "é"])))
    return rows


@pytest.mark.parametrize("limit", [None, 3])
def test_random_dialogs_against_model(spark, limit):
    rows = random_rows(7)
    df = messages(spark, rows)
    bursts = tn.coalesce_bursts(df, "first", max_rows=limit)
    got = sorted(in_order(bursts, "DialogID", "Sender", "Message", "seq"))
    assert got == model_bursts(rows, lambda t: t[0].lower() + t[1:])

    expected = []
    for d in sorted({r[0] for r in rows}):
        mine = [(i, r) for i, r in enumerate(rows) if r[0] == d]
        expected += [(d, s, t, mine[i][0]) for s, t, i in model_turns([r for _, r in mine])]
    turns = tn.alternate_turns(df, max_rows=limit)
    assert in_order(turns, "DialogID", "Sender", "Message", "seq") == expected
    assert tn.alternation_violations(turns, max_rows=limit).count() == 0


def test_table_scope_merges_across_dialogs(spark):
    df = messages(spark, [("a", "P", "1"), ("a", "me", "2"), ("b", "me", "3"), ("b", "P", "4"), ("b", "me", "5")])
    for limit in LIMITS:
        out = tn.alternate_turns(df, scope="table", max_rows=limit)
        assert in_order(out, "DialogID", "Message") == [("a", "1"), ("b", "3 2"), ("b", "4"), ("b", "5")]


def qa(spark, seconds, dialog="d"):
    data = [(f"q{i}", f"a{i}", dialog, s, i) for i, s in enumerate(seconds)]
    return spark.createDataFrame(data, "question string, answer string, DialogID string, time_diff_seconds long, seq long")


@pytest.mark.parametrize("limit", LIMITS)
def test_context_worked_example(spark, limit):
    pairs = qa(spark, [0, 100, 21700, 43301, 43311])
    assert in_order(cx.sessionize(pairs, max_rows=limit), "ConversationID") == [(0,), (0,), (0,), (1,), (1,)]
    tags = cx.add_context(pairs, 2, "tags", "dialog", max_rows=limit)
    assert in_order(tags, "context") == [
        ("Time Gap",),
        (" <Q1> q0 <A1> a0",),
        (" <Q1> q0 <A1> a0  <Q2> q1 <A2> a1",),
        ("Time Gap",),
        (" <Q1> q2 <A1> a2  <Q2> q3 <A2> a3",),
    ]
    plain = cx.add_context(pairs, 2, "plain", "session", max_rows=limit)
    assert in_order(plain, "context") == [
        ("Time Gap",),
        ("Q1: q0. A1: a0 || ",),
        ("Q1: q0. A1: a0 ||  Q2: q1. A2: a1 || ",),
        ("Time Gap",),
        ("Q1: q3. A1: a3 || ",),
    ]


def test_context_of_split_dialogs_equals_plain(spark):
    rng = random.Random(3)
    parts = None
    for d in range(4):
        t, seconds = 0, []
        for _ in range(rng.randint(1, 40)):
            t += rng.choice([0, 10, 21600, 21601])
            seconds.append(t)
        part = qa(spark, seconds, f"d{d}")
        parts = part if parts is None else parts.unionByName(part)
    for style, scope in [("tags", "dialog"), ("plain", "session"), ("chat", "dialog")]:
        plain = cx.add_context(parts, 5, style, scope)
        split = cx.add_context(parts, 5, style, scope, max_rows=3)
        columns = ("DialogID", "seq", "ConversationID", "context")
        assert in_order(plain, *columns) == in_order(split, *columns)


@pytest.mark.parametrize("limit", LIMITS)
def test_elapsed_is_whole_seconds_since_first_message(spark, limit):
    df = messages(spark, [("a", "P", "x", 5), ("a", "P", "y", 65.9), ("b", "P", "z", 9)])
    assert in_order(cx.with_elapsed(df, max_rows=limit), "time_diff_seconds") == [(0,), (60,), (0,)]
