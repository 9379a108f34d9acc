"""Text cleaning over ``documents`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.catalog.registry import query
from parley.catalog.views import table, text_table
from parley.functions import text as tx
from parley.operators import dedup, filters, language, language_model, phrases, profile

# Appended to every text where the tables lack what a pattern looks for.
SUFFIX = " see https://a.b/c?d=1 , by @olena and @Ivan_2,, or 😀👍 ☀ ok,,,"
SENSITIVE = ("that", " Une", "nicht", "olena")

TOKENS = r"'/email|/mention|[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]'"
WORD_PIECES = r"'[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_]+'"
EMOJI = "'[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in tx.EMOJI_RANGES) + "]+'"


def drop_latin_sql(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({text}, {WORD_PIECES}), "
        "lambda p: CASE WHEN regexp_full_match(p, '[a-zA-Z]+') THEN '' ELSE p END), '')"
    )


def censor_sql(text: str, words=SENSITIVE) -> str:
    listed = ", ".join(f"'{w.strip().lower()}'" for w in words)
    return (
        f"array_to_string(list_transform(regexp_extract_all({text}, {TOKENS}), "
        f"lambda w: CASE WHEN lower(w) IN ({listed}) THEN 'CENSORED' ELSE w END), ' ')"
    )


def collapse_sql(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


def normalize_sql(text: str) -> str:
    return collapse_sql(f"lower({text})")


def clean_ctes(source: str, text: str, words=SENSITIVE) -> str:
    """CTEs ending in ``cleaned``: ``source`` with its text column cleaned and blank rows gone."""
    return rf"""
no_latin AS (SELECT * REPLACE ({drop_latin_sql(text)} AS {text}) FROM {source}),
redacted AS (SELECT * REPLACE (regexp_replace(regexp_replace(regexp_replace(regexp_replace({text},
    '\S+@\S+', '/email', 'g'), 'http\S+', 'redacted', 'g'), '@[\p{{L}}\p{{M}}\p{{N}}_]+', '/mention', 'g'), '<.*?>', '', 'g') AS {text}) FROM no_latin),
censored AS (SELECT * REPLACE ({collapse_sql(censor_sql(text, words))} AS {text}) FROM redacted),
cleaned AS (SELECT * FROM (SELECT * REPLACE (coalesce(regexp_replace({text}, {EMOJI}, ' ', 'g'), ' ') AS {text}) FROM censored)
            WHERE trim({text}) <> '')"""


def _docs(spark, sf_dir, suffix: str = ""):
    text = F.concat(F.col("text"), F.lit(suffix)) if suffix else F.col("text")
    return text_table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


def _column(name, fn, sql, suffix=""):
    source = f"(text || '{suffix}')" if suffix else "text"

    @query(name, f"SELECT doc_id, {sql.replace('{text}', source)} AS text FROM documents")
    def run(spark, sf_dir):
        return _docs(spark, sf_dir, suffix).select("doc_id", fn(F.col("text")).alias("text"))


_column("redact_emails", tx.redact_emails, r"regexp_replace({text}, '\S+@\S+', '/email', 'g')")
_column("collapse_whitespace", tx.collapse_whitespace, r"trim(regexp_replace({text}, '\s+', ' ', 'g'))")
_column("remove_punctuation", tx.remove_punctuation, "translate({text}, '" + tx.PUNCTUATION.replace("'", "''") + "', '')")
_column("normalize_text", tx.normalize_text, r"trim(regexp_replace(lower({text}), '\s+', ' ', 'g'))")
_column("remove_latin_words", tx.remove_latin_words, drop_latin_sql("text"))
_column("redact_urls", tx.redact_urls, r"regexp_replace({text}, 'http\S+', 'redacted', 'g')", SUFFIX)
_column("redact_mentions", tx.redact_mentions, r"regexp_replace({text}, '@[\p{L}\p{M}\p{N}_]+', '/mention', 'g')", SUFFIX)
_column("remove_emojis", tx.remove_emojis, "regexp_replace({text}, " + EMOJI + ", ' ', 'g')", SUFFIX)
_column("squeeze_commas", tx.squeeze_commas, "replace({text}, ',,', ',')", SUFFIX)
_column("censor_words", lambda t: tx.censor_words(t, SENSITIVE), censor_sql("text"))
_column("tokenize", lambda t: F.array_join(tx.tokenize(t), "|"), f"array_to_string(regexp_extract_all(text, {TOKENS}), '|')")
_column(
    "remove_stopwords",
    lambda t: F.array_join(tx.remove_stopwords(tx.tokenize(t), language.COMMON_WORDS["en"]), " "),
    (f"array_to_string(list_filter(regexp_extract_all(text, {TOKENS}), lambda w: lower(w) NOT IN ("
     + ", ".join(f"'{w}'" for w in language.COMMON_WORDS["en"]) + ")), ' ')"),
)
_column(
    "split_clauses",
    lambda t: F.array_join(tx.split_clauses(t), "|"),
    r"array_to_string(list_filter(list_transform(string_split({text}, ','), lambda c: regexp_replace(c, '^\s+|\s+$', '', 'g')), lambda c: c <> ''), '|')",
    SUFFIX,
)
_column("length_band", lambda t: tx.length_band(t), "CASE WHEN length({text}) BETWEEN 16 AND 512 THEN {text} END")


@query(
    "fix_mojibake",
    "SELECT doc_id, text FROM documents",
)
def fix_mojibake(spark, sf_dir):
    garbled = F.decode(F.encode(F.col("text"), "UTF-8"), "ISO-8859-1")
    return _docs(spark, sf_dir).select("doc_id", tx.fix_mojibake(garbled).alias("text"))


@query("strip_html_tags", "SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS text FROM pages")
def strip_html_tags(spark, sf_dir):
    return text_table(spark, sf_dir, "pages").select("page_id", tx.strip_html_tags(F.col("html")).alias("text"))


@query(
    "clean_messages",
    f"WITH docs AS (SELECT doc_id, text || '{SUFFIX}' AS text FROM documents),"
    + clean_ctes("docs", "text") + "SELECT doc_id, text FROM cleaned",
)
def clean_messages(spark, sf_dir):
    return filters.clean_messages(_docs(spark, sf_dir, SUFFIX), "text", SENSITIVE)


BLANKED = "CASE WHEN source = 'src3' THEN '  ' WHEN source = 'src5' THEN NULL ELSE text END"


def _blanked(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(BLANKED).alias("text"), "lang")


@query("drop_blank", f"SELECT * FROM (SELECT doc_id, {BLANKED} AS text FROM documents) WHERE text IS NULL OR trim(text) <> ''")
def drop_blank(spark, sf_dir):
    return filters.drop_blank(_blanked(spark, sf_dir).drop("lang"), "text")


@query("drop_null_rows", f"SELECT * FROM (SELECT doc_id, {BLANKED} AS text FROM documents) WHERE text IS NOT NULL")
def drop_null_rows(spark, sf_dir):
    return filters.drop_null_rows(_blanked(spark, sf_dir).drop("lang"))


@query(
    "text_profile",
    f"""SELECT count(*) AS rows, count(*) FILTER (text IS NULL) AS nulls, round(avg(length(text)), 6) AS mean_length,
        max(length(text)) AS max_length,
        (SELECT text FROM (SELECT doc_id, {BLANKED} AS text FROM documents) WHERE text IS NOT NULL
         ORDER BY length(text) DESC, doc_id LIMIT 1) AS longest
        FROM (SELECT doc_id, {BLANKED} AS text FROM documents)""",
)
def text_profile(spark, sf_dir):
    profiled = profile.text_profile(_blanked(spark, sf_dir), "text", ("doc_id",))
    return profiled.withColumn("mean_length", F.round("mean_length", 6))


@query("null_count", f"SELECT count(*) FILTER (text IS NULL) AS nulls FROM (SELECT {BLANKED} AS text FROM documents)")
def null_count(spark, sf_dir):
    return profile.null_count(_blanked(spark, sf_dir))


@query(
    "duplicate_count",
    "SELECT (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS duplicates",
)
def duplicate_count(spark, sf_dir):
    return profile.duplicate_count(table(spark, sf_dir, "documents").select("text", "lang"))


@query("distinct_rows", "SELECT DISTINCT text, lang FROM documents")
def distinct_rows(spark, sf_dir):
    return dedup.distinct_rows(table(spark, sf_dir, "documents").select("text", "lang"))


@query(
    "dedup_questions",
    """SELECT question, DialogID, time_diff_seconds, seq FROM (
         SELECT text AS question, source AS DialogID, n_chars AS time_diff_seconds, doc_id AS seq,
                row_number() OVER (PARTITION BY text ORDER BY source, n_chars, doc_id) AS n FROM documents) WHERE n = 1""",
)
def dedup_questions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("text").alias("question"),
        F.col("source").alias("DialogID"),
        F.col("n_chars").alias("time_diff_seconds"),
        F.col("doc_id").alias("seq"),
    )
    return dedup.dedup_questions(docs)


def _hits_sql(code: str) -> str:
    listed = ", ".join(f"'{w}'" for w in language.COMMON_WORDS[code])
    return f"(len(list_filter(toks, lambda w: w IN ({listed}))), '{code}')"


_CODES = sorted(language.COMMON_WORDS)


@query(
    "detect_language",
    f"""WITH t AS (SELECT doc_id, lang, list_transform(regexp_extract_all(text, {TOKENS}), lambda w: lower(w)) AS toks FROM documents),
        h AS (SELECT doc_id, lang, unnest([{', '.join(_hits_sql(c) for c in _CODES)}]) AS h FROM t),
        b AS (SELECT doc_id, lang, h[1] AS hits, h[2] AS code FROM h)
        SELECT doc_id, lang, CASE WHEN max(hits) > 0 THEN arg_min(code, (-hits, code)) END AS detected FROM b GROUP BY doc_id, lang""",
)
def detect_language(spark, sf_dir):
    docs = text_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return language.with_detected_language(docs, "text").drop("text")


@query(
    "language_names",
    """SELECT lang, CASE lang WHEN 'en' THEN 'english' WHEN 'de' THEN 'german' WHEN 'fr' THEN 'french' WHEN 'es' THEN 'spanish' END AS language_name,
       count(*) AS documents FROM documents GROUP BY lang""",
)
def language_names(spark, sf_dir):
    counts = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("documents"))
    return language.with_language_name(counts).select("lang", "language_name", "documents")


# Whole words and phrases that occur in the texts, some of them parts of others.
PHRASES = ("the", "of the", "and the", "the the", "in", "und", "die die", "est la", "no such phrase")
_BY_LENGTH = "|".join(sorted(PHRASES, key=len, reverse=True))
_EDGE = r"[\p{L}\p{N}_]"


def phrases_sql(text: str, mark: str) -> str:
    """The same by a regular expression: longest phrases first; marks keep the borders Unicode-aware."""
    return rf"""regexp_replace(regexp_replace(regexp_replace({text}, '({_EDGE}+)', '<\1>', 'g'),
      '(?i)({"|".join("<" + p.replace(" ", "> <") + ">" for p in _BY_LENGTH.split("|"))})', '{mark}', 'g'), '<({_EDGE}+)>', '\1', 'g')"""


@query("censor_phrases", f"SELECT conv_id, turn, {phrases_sql('text', 'CENSORED')} AS text FROM conversations WHERE text NOT SIMILAR TO '.*[<>].*'")
def censor_phrases(spark, sf_dir):
    rows = text_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text").where(~F.col("text").rlike("[<>]"))
    listed = spark.createDataFrame([(p,) for p in PHRASES], "phrase string")
    return phrases.censor_phrases(rows, "text", listed)


_SHORT = 29


@query(
    "identify_languages",
    f"""SELECT lang, count(*) AS texts, true AS good, true AS good_short FROM documents
    WHERE md5(CAST(doc_id AS VARCHAR))[1] < '4' AND length(text) >= 200 AND lang IS NOT NULL GROUP BY lang""",
)
def identify_languages(spark, sf_dir):
    """Share of right answers for held-out documents: whole texts, and a few characters of them."""
    docs = text_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    fold = F.md5(F.col("doc_id").cast("string").cast("binary")).substr(1, 1) < "4"
    model = language_model.train_languages(docs.where(~fold), "text", "lang")
    held = docs.where(fold & (F.char_length("text") >= 200) & F.col("lang").isNotNull())
    held = held.withColumn("short", F.substring("text", 60, _SHORT))
    held = language_model.identify_languages(held, "text", model, "whole")
    held = language_model.identify_languages(held, "short", model, "part", margin=0.0)
    right = lambda c: F.avg(F.coalesce((F.col(c) == F.col("lang")).cast("int"), F.lit(0)))
    return held.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"), (right("whole") >= 0.97).alias("good"), (right("part") >= 0.9).alias("good_short"))
