"""The stages of the pipeline, one after the other, each against a plain version on its own input."""

import collections
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parent.parent.parent))

import corpus_pipeline  # noqa: E402
import plain  # noqa: E402

from parley.llm import line_dedup, near_dedup  # noqa: E402
from parley.llm.quality import score_quality, train_quality  # noqa: E402


def counted(rows):
    return collections.Counter(rows)


@pytest.fixture(scope="module")
def steps(spark, corpus):
    """name -> (rows that a stage got, rows that it gave), all columns, as dictionaries."""
    from parley.llm.common import table
    from parley.plans.scratch import settle

    docs = table(spark, str(corpus), "documents")
    found, rows = {}, [r.asDict() for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, str(corpus)), name)
        got = [r.asDict() for r in docs.collect()]
        found[name] = (rows, got, docs.columns)
        rows = got
    return found


def whole(rows):
    return counted(tuple(sorted((k, repr(v)) for k, v in r.items())) for r in rows)


def test_order_and_columns(steps, spark, corpus):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "mixing"]
    columns = spark.read.parquet(f"{corpus}/documents.parquet").columns
    assert all(steps[name][2] == columns for name in list(steps)[:-1])


def test_quality_keeps_what_the_scores_accept(steps, spark, corpus):
    before, after, _ = steps["quality"]
    docs, labels = (spark.read.parquet(f"{corpus}/{n}.parquet") for n in ("documents", "labels"))
    # Rows are told apart by id and text: equal rows have equal scores.
    scores = score_quality(docs.select("doc_id", "text"), train_quality(docs, labels)).collect()
    good = {r.doc_id for r in scores if r.predicted == 1}
    assert whole(after) == whole([r for r in before if r["doc_id"] in good])
    assert len(after) > 0.7 * len(before)


def test_line_dedup_takes_later_copies_out(steps):
    before, after, _ = steps["line_dedup"]
    want = plain.dedup_lines([(r["doc_id"], r["text"]) for r in before], line_dedup.MIN_WORDS)
    left = [(r, text) for r, (_, gone, text) in zip(before, want) if not gone or plain.words(text)]
    key = lambda r, text: (r["doc_id"], text, r["source"])
    assert counted(key(r, r["text"]) for r in after) == counted(key(r, t) for r, t in left)


def test_near_dedup_keeps_one_row_a_group(steps):
    before, after, _ = steps["near_dedup"]
    group = plain.near_components([(k, r["text"]) for k, r in enumerate(before)], 5)
    kept = whole(after)
    members = collections.defaultdict(list)
    for k, row in enumerate(before):
        members[group[k]].append(row)
    for rows in members.values():
        if len(rows) == 1 or not plain.words(rows[0]["text"]):
            continue
        smallest = min(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
        found = [r for r in after if r["doc_id"] == smallest["doc_id"] and any(r["text"] == x["text"] for x in rows)]
        assert len(found) == 1
    assert len(after) == sum(1 if plain.words(rows[0]["text"]) else len(rows) for rows in members.values())
    assert not kept - whole(before)


def test_decontamination_drops_documents_with_windows(steps, corpus):
    import pyarrow.parquet as pq

    before, after, _ = steps["decontamination"]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(corpus / "benchmark.parquet").to_pylist()]
    hit = [h for *_, h in plain.contamination([(r["doc_id"], r["text"]) for r in before], items)]
    assert whole(after) == whole([r for r, h in zip(before, hit) if not h])
    assert any(hit)


def test_mixing_reaches_the_targets(steps):
    before, after, _ = steps["mixing"]
    sizes, largest, taken = (collections.Counter() for _ in range(3))
    for r in before:
        n = len(plain.words(r["text"]))
        sizes[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    for r in after:
        taken[r["source"]] += len(plain.words(r["text"]))
    want = plain.targets(sizes)
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in sizes)
    strip = lambda r: (r["doc_id"], r["text"], r["source"])
    copies, given = counted(map(strip, after)), counted(map(strip, before))
    assert all(k in given and n <= 3 * given[k] for k, n in copies.items())


def test_run_is_the_chain(steps, spark, corpus):
    assert whole(r.asDict() for r in corpus_pipeline.run(spark, str(corpus)).collect()) == whole(steps["mixing"][1])


def test_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, str(empty)).collect() == []


A = "one two three four five six seven eight nine ten"
B = "a quite different text that shares nothing with the other one at all"


def test_six_rows_keep_two(spark):
    """Copies without an id and copies that share one: a row of each text stays."""
    rows = [(None, A), (None, A), (None, A), (5, A), (7, B), (7, B)]
    for seed in range(3):
        shuffled = random.Random(seed).sample(rows, len(rows))
        table = spark.createDataFrame([(i, t, "x") for i, t in shuffled], "doc_id bigint, text string, _row string").repartition(3)
        found = near_dedup.keep_representatives(table, 5)
        assert found.columns == ["doc_id", "text", "_row"]
        assert sorted((r.doc_id, r.text) for r in found.collect()) == [(5, A), (7, B)]


def test_links_do_not_depend_on_the_order(spark):
    """One id with two texts, and a near copy of the second: one component whatever comes first."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, A), (1, long), (2, long + " end"), (3, None), (None, A), (1, ""), (None, "alone and without an id")]
    for seed in range(4):
        shuffled = random.Random(seed).sample(rows, len(rows))
        table = spark.createDataFrame(shuffled, "doc_id bigint, text string").repartition(2)
        found = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(table, 2).collect())
        assert found == [("1", 0, 1, True), ("1", 9, 1, True), ("1", 59, 1, True), ("2", 60, 1, False), ("3", 0, 3, True), ("None", 4, None, True), ("None", 9, 1, False)]


def test_rows_without_ids_only(spark):
    table = spark.createDataFrame([(None, A)] * 4 + [(None, A + " tail")] + [(None, None), (None, " "), (None, B)], "doc_id bigint, text string")
    assert len(near_dedup.keep_representatives(table, 2).collect()) == 4


def test_mixed_buckets_meet_in_blocks(spark, monkeypatch):
    """Buckets cut into blocks of a few signatures lose no link."""
    monkeypatch.setattr(near_dedup, "BLOCK_SIGNATURES", 3)
    base = [f"common{i}" for i in range(40)]
    rows = [(k * 10 + j, " ".join([*base, *(f"f{k}x{i}" for i in range(6)), f"v{j}"])) for k in range(6) for j in range(4)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table, 2).collect()}
    assert found == plain.near_components(rows, 2)
