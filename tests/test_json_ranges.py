"""Documents cut into small byte ranges against a plain parse."""

import json
import random
from datetime import datetime, timedelta

import pytest

from parley.sources import telegram
from parley.sources.json_ranges import ANY, json_elements

START = datetime(2024, 1, 1)
NASTY = ['plain', 'a } b', '{"type": "x"}', 'quote " and \\ back', '\\" } ] [ {', '}}}', 'Привіт } 👩', '', 'line\nbreak }\t', '"messages": [', 'x' * 300, '\\', '"}']


@pytest.fixture(params=[150, 2000])
def small_ranges(spark, request):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield request.param
    for key, value in old.items():
        spark.conf.set(key, value)


def export(rnd, chats):
    def message(i):
        text = rnd.choice(NASTY) if rnd.random() < 0.8 else [{"type": "bold", "text": "}"}, "x"]
        return {"id": i, "text": text, "from_id": rnd.choice(["user1", "user2", None]), "from": "n 3", "date": (START + timedelta(seconds=i)).isoformat(), "extra": {"a": [1, {"b": "}"}]}}

    out = []
    for c in range(chats):
        chat = {"name": rnd.choice(NASTY), "type": rnd.choice(["personal_chat", "personal_chat", "private_group"]), "id": c}
        chat["messages"] = [message(i) for i in range(rnd.choice([0, 1, 3, 12, 30]))]
        if rnd.random() < 0.4:
            chat["after"] = {"messages": [{"text": "not one"}]}
        out.append(chat)
    # The same keys elsewhere are no messages.
    return {"about": "}{", "left_chats": {"list": [{"type": "personal_chat", "messages": [message(0)] * 5}]}, "chats": {"about": "x", "list": out}, "messages": [{"z": 1}]}


def test_large_export_equals_the_plain_scan(spark, tmp_path, small_ranges):
    rnd = random.Random(small_ranges)
    (tmp_path / "one.json").write_text(json.dumps(export(rnd, 3), indent=1, ensure_ascii=False))
    (tmp_path / "two.json").write_text(json.dumps(export(rnd, 4)) + "\n")
    (tmp_path / "other.txt").write_text("no json")
    for settings in ({"min_messages": 2, "me": "1"}, {"min_messages": None, "dialogs_limit": 4}):
        settings["file_pattern"] = r".*\.json$"
        want = telegram.scan_telegram(spark, str(tmp_path), **settings)
        found = telegram.scan_large_telegram(spark, str(tmp_path), **settings)
        assert found.columns == want.columns
        key = lambda r: tuple(map(repr, r))
        assert sorted(found.collect(), key=key) == sorted(want.collect(), key=key)


@pytest.mark.parametrize("target", [("messages", ANY), (ANY,), ("a", ANY, "b", ANY)])
def test_elements_equal_a_parse(spark, tmp_path, small_ranges, target):
    rnd = random.Random(7)
    items = [{"k": i, "s": rnd.choice(NASTY), "deep": [{"k": "no"}] * rnd.randint(0, 2)} for i in range(30)]
    document = {(ANY,): items, ("messages", ANY): {"title": "}", "messages": items, "more": [{"k": 1}]}}.get(
        target, {"a": [{"b": items[:10], "n": 1}, {"n": 2}, {"n": 3, "b": []}, {"b": items[10:], "n": "}"}], "b": [{"k": 1}]})
    (tmp_path / "x.json").write_text(json.dumps(document, indent=2))
    elements, heads = json_elements(spark, str(tmp_path), target)
    found = sorted((r.outer, r.inner, r.text) for r in elements.collect())
    assert [json.loads(t) for *_, t in found] == items
    if target[0] == "a":
        assert [(o, i) for o, i, _ in found] == [(1, k) for k in range(1, 11)] + [(4, k) for k in range(1, 21)]
        around = [json.loads(t) for _, t in sorted((r.outer, r.text) for r in heads.collect())]
        assert around == [{"b": [], "n": 1}, {"n": 2}, {"n": 3, "b": []}, {"b": [], "n": "}"}]
    else:
        assert [(o, i) for o, i, _ in found] == [(0, k) for k in range(1, 31)] and heads.count() == 0


def test_a_document_that_ends_early_is_an_error(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"messages": [{"a": 1}, {"a": ')
    with pytest.raises(Exception, match="no complete JSON"):
        json_elements(spark, str(tmp_path), ("messages", ANY))[0].collect()


def test_empty_file(spark, tmp_path):
    (tmp_path / "x.json").write_text("")
    assert json_elements(spark, str(tmp_path), ("messages", ANY))[0].collect() == []
