from datetime import datetime, timedelta

from pyspark.sql import functions as F

from parley.operators import dedup, filters, limits, profile
from parley.plans import ranking
from parley.schema import MESSAGE_SCHEMA

START = datetime(2024, 1, 1)


def rows(spark, pairs):
    data = [(d, f"m{i}", s, START + timedelta(seconds=i), False, i) for i, (d, s) in enumerate(pairs)]
    return spark.createDataFrame(data, MESSAGE_SCHEMA)


def test_group_chats_worked_example(spark):
    df = rows(spark, [("d1", "A"), ("d1", "B"), ("d2", "A"), ("d2", "B"), ("d2", "C"), ("d3", "A"), ("d3", "B"), ("d3", "Meta AI"), ("d4", "A"), ("d4", None), ("d4", "B")])
    kept = filters.drop_group_chats(df)
    assert sorted((r.DialogID, r.Sender) for r in kept.collect()) == [("d1", "A"), ("d1", "B"), ("d3", "A"), ("d3", "B")]


def test_row_budget_keeps_the_crossing_dialog(spark):
    df = rows(spark, [(d, "A") for d, n in [("a", 3), ("b", 1), ("c", 4), ("d", 2)] for _ in range(n)])
    assert {r[0] for r in limits.limit_messages(df, 5).select("DialogID").collect()} == {"a", "b", "c"}
    assert {r[0] for r in limits.limit_dialogs(df, 2).select("DialogID").collect()} == {"a", "b"}


def test_latest_per_dialog_by_both_plans(spark, monkeypatch):
    df = rows(spark, [("a", "A")] * 7 + [("b", "A")] * 2)
    expected = [("a", 5), ("a", 6), ("b", 7), ("b", 8)]
    def got():
        return sorted((r.DialogID, r.seq) for r in limits.latest_per_dialog(df, 2, max_rows=3).collect())
    assert got() == expected
    monkeypatch.setattr(limits, "GROUP_LIMIT", 1)
    assert got() == expected


def test_dialog_size_filter_strictness(spark):
    df = rows(spark, [("a", "A")] * 3 + [("b", "A")] * 2)
    assert {r.DialogID for r in filters.filter_dialogs(df, 2).collect()} == {"a"}
    assert {r.DialogID for r in filters.filter_dialogs(df, 2, strict=False).collect()} == {"a", "b"}
    assert filters.filter_dialogs(df, None).count() == 5


def test_positions_over_many_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("g"))
    placed = ranking.with_position(df, "p", ("g", "k"), rows_per_range=50)
    found = [r.p for r in placed.orderBy("g", "k").collect()]
    assert found == list(range(1, 1001))
    total = ranking.with_running_total(df, "t", F.col("g"), ("k",), rows_per_range=50).agg(F.max("t")).first()[0]
    assert total == sum(i % 3 for i in range(1000))


def test_first_rows_beyond_the_top_n_plan(spark, monkeypatch):
    df = spark.range(200)
    monkeypatch.setattr(ranking, "MAX_TOP_N", 10)
    assert sorted(r.id for r in ranking.first_rows(df, 50, ("id",)).collect()) == list(range(50))


def test_splits_are_disjoint_complete_and_repeatable(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    train, test = limits.split_ordered(df, ["k"], 0.9)
    assert sorted(r.k for r in train.collect()) == list(range(450)) and test.count() == 50
    for exact in (False, True):
        train, test = limits.split_random(df, ["k"], 0.9, exact=exact)
        ids = {r.k for r in train.collect()}, {r.k for r in test.collect()}
        assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == 500
        again, _ = limits.split_random(df.repartition(7), ["k"], 0.9, exact=exact)
        assert {r.k for r in again.collect()} == ids[0]
    assert limits.split_random(df, ["k"], exact=True)[0].count() == 450
    assert limits.sample_exact(df, 37, ["k"]).distinct().count() == 37


def test_chunks_differ_by_at_most_one(spark):
    df = spark.range(103).withColumnRenamed("id", "k")
    sizes = limits.assign_chunks(df, 10, ["k"]).groupBy("chunk").count().orderBy("chunk").collect()
    assert [r["count"] for r in sizes] == [11, 11, 11] + [10] * 7
    few = limits.assign_chunks(df.limit(3), 5, ["k"]).select("chunk").distinct().count()
    assert few == 3


def test_first_question_wins(spark):
    df = spark.createDataFrame([("q", "b", 1, 1), ("q", "a", 9, 2), ("q", "a", 3, 5), ("r", "z", 0, 0)], "question string, DialogID string, time_diff_seconds long, seq long")
    kept = {tuple(r) for r in dedup.dedup_questions(df).collect()}
    assert kept == {("q", "a", 3, 5), ("r", "z", 0, 0)}


def test_profiles_of_an_empty_table(spark):
    empty = rows(spark, [("a", "A")]).limit(0)
    assert profile.duplicate_count(empty).first()[0] == 0
    assert profile.null_count(empty).first()[0] == 0
    assert profile.text_profile(empty).first()["rows"] == 0
