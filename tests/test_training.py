import random
from datetime import datetime, timedelta

import pytest

from parley.plans.training import build_training_table
from parley.schema import MESSAGE_SCHEMA

START = datetime(2024, 1, 1)


def chat(spark, seed, dialogs=5, length=60):
    rng = random.Random(seed)
    data, second = [], 0
    for d in range(dialogs):
        others = rng.choice([["P"], ["P", "Meta AI"], ["P", "Q", "R"]])
        for i in range(rng.randint(1, length)):
            second += rng.choice([0, 30, 25_000])
            sender = rng.choice(["me", *others])
            text = rng.choice(["привіт", "як справи?", "ok latin", "", "добре, дякую", "номер 5"]) + f" {i % 9}"
            data.append((f"d{d}", text, sender, START + timedelta(seconds=second), sender == "me", i))
    # One dialog holds about a third of all rows.
    hot = [("hot", f"слово {i % 7}", rng.choice(["me", "P"]), START + timedelta(seconds=i * rng.choice([1, 5])), False, i) for i in range(len(data) // 2)]
    hot = [(d, t, s, when, s == "me", i) for d, t, s, when, _, i in hot]
    return spark.createDataFrame(data + hot, MESSAGE_SCHEMA)


@pytest.mark.parametrize("options", [dict(cleaning="full", style="plain", scope="session"), dict(cleaning="normalize", style="tags", scope="dialog", size=3, lower_questions=True)])
def test_oversized_dialogs_give_the_same_table(spark, options):
    messages = chat(spark, 11)
    plain = build_training_table(messages, **options)
    split = build_training_table(messages, max_rows=10, **options)
    rows = sorted(map(tuple, plain.collect()))
    assert rows and rows == sorted(map(tuple, split.collect()))
    questions = [r[0] for r in rows]
    assert len(questions) == len(set(questions))


def test_group_chats_are_left_out_and_ignored_senders_dropped(spark):
    data = [(d, t, s, START + timedelta(seconds=i), s == "me", i) for i, (d, s, t) in enumerate([
        ("g", "P", "раз"), ("g", "me", "два"), ("g", "Q", "три"), ("d", "P", "питання"), ("d", "Meta AI", "шум"), ("d", "me", "відповідь")])]
    table = build_training_table(spark.createDataFrame(data, MESSAGE_SCHEMA))
    assert [(r.question, r.answer, r.context) for r in table.collect()] == [("питання", "відповідь", "Time Gap")]
    assert table.columns == ["question", "answer", "DialogID", "timestamp", "context"]
