import re

import pytest
from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.operators import filters

SAMPLES = [
    "Привіт user123@x.com див https://a.b/c <b>ok</b> @олег 😀",
    "plain words, école 漢字 한글 a1b2 snake_case",
    "a b c\n\td  e",
    "<p>one</p>\n<br\n/> <i>two",
    "x 👨‍👩‍👧 y ☀️ z 🇺🇦",
    "http://x https://y.z?q=1#f httpnot",
    "",
    "  ",
]


def apply(spark, fn, values=SAMPLES):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


@pytest.mark.parametrize(
    "fn, pattern, by",
    [
        (tx.redact_urls, r"http\S+", "redacted"),
        (tx.redact_mentions, r"@\w+", "/mention"),
        (tx.redact_emails, r"\S+@\S+", "/email"),
        (tx.remove_latin_words, r"\b[a-zA-Z]+\b", ""),
        (tx.strip_html_tags, r"<.*?>", ""),
    ],
)
def test_patterns_follow_python(spark, fn, pattern, by):
    assert apply(spark, fn) == [re.sub(pattern, by, s) for s in SAMPLES]


def test_whitespace_follows_python(spark):
    assert apply(spark, tx.collapse_whitespace) == [" ".join(s.split()) for s in SAMPLES]
    assert apply(spark, tx.normalize_text) == [" ".join(s.lower().split()) for s in SAMPLES]
    assert apply(spark, tx.strip_text) == [s.strip() for s in SAMPLES]


def test_emoji_runs_become_one_space(spark):
    listed = "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in tx.EMOJI_RANGES) + "]+"
    assert apply(spark, tx.remove_emojis) == [re.sub(listed, " ", s) for s in SAMPLES]
    strict = apply(spark, lambda t: tx.remove_emojis(t, strict=True), ["漢字 ☀️ 한글"])
    assert strict == ["漢字   한글"]


def test_cleaning_chain_worked_example(spark):
    cleaned = apply(spark, lambda t: tx.clean_text(t), SAMPLES[:1] + [None])
    assert cleaned == ["Привіт /email див : / / . / /mention  ", " "]
    first = apply(spark, lambda t: tx.clean_text(t, steps="redact_first"), SAMPLES[:1])
    assert first == ["Привіт /email див redacted /mention  "]
    chosen = apply(spark, lambda t: tx.clean_text(t, steps=["tags", "mentions"]), ["<b>ok</b> @олег"])
    assert chosen == ["ok /mention"]


def test_censor_compares_in_lower_case_and_ignores_blanks_in_the_list(spark):
    out = apply(spark, lambda t: tx.censor_words(t, [" Key", "таємно", ""]), ["The KEY, Таємно! keys"])
    assert out == ["The CENSORED , CENSORED ! keys"]
    assert apply(spark, lambda t: tx.censor_words(t, ["mention"]), ["/mention mention"]) == ["/mention CENSORED"]


def test_mojibake_is_undone_and_wide_text_kept(spark):
    garbled = "Привіт, é".encode().decode("latin-1")
    assert apply(spark, tx.fix_mojibake, [garbled, "Привіт", "plain", None]) == ["Привіт, é", "Привіт", "plain", None]


def test_small_helpers(spark):
    assert apply(spark, tx.squeeze_commas, [",,,", "a,,b"]) == [",,", "a,b"]
    assert apply(spark, tx.split_clauses, [" a, ,b\n,,c "]) == [["a", "b", "c"]]
    assert apply(spark, tx.length_band, ["x" * 15, "x" * 16, "x" * 512, "x" * 513]) == [None, "x" * 16, "x" * 512, None]
    assert apply(spark, tx.lower_first, ["ÉTé", "a", ""]) == ["éTé", "a", ""]
    assert apply(spark, tx.digits_only, ["user12a3"]) == ["123"]
    assert apply(spark, tx.remove_punctuation, ["a.b,c!_d—e"]) == ["abcd—e"]


def test_clean_messages_drops_blank_rows(spark):
    df = spark.createDataFrame([("only latin",), (None,), ("слово",), ("😀",)], "Message string")
    assert [r[0] for r in filters.clean_messages(df).collect()] == ["слово"]
    blanks = spark.createDataFrame([("",), (" ",), ("  ",), (None,), ("x",)], "Message string")
    assert filters.drop_blank(blanks).count() == 2
    assert filters.drop_blank(blanks, exact=True).count() == 3
