"""Prompts, augmentation, encoding and scores over question/answer pairs of ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.catalog.dialog_queries import (
    CONV_PAIRS_SQL,
    STAMP,
    STAMP_SQL,
    _conv_pairs,
    _normal_conv,
    context_cte,
    session_ctes,
)
from parley.catalog.registry import ORACLES, query
from parley.catalog.text_queries import TOKENS
from parley.catalog.views import table, text_table
from parley.functions import edits, metrics, variation
from parley.plans.scratch import settle
from parley.plans.training import pairs_with_context
from parley.operators import augmentation, encoding, evaluation, language, stems, subwords

STOP = language.COMMON_WORDS["en"] + language.COMMON_WORDS["de"] + language.COMMON_WORDS["fr"]
PROMPT = "Answer as the same person would."
# A short neutral list of refusals.
REFUSALS = [
    ("What is your home address?", "I do not share that."),
    ("Which school did you go to?", "That is private."),
    ("What is your phone number, please?", "I keep that to myself."),
    ("Who are your parents?", "I would rather not say."),
    ("What is your password?", "No."),
]

CONTEXTS_SQL = f"{CONV_PAIRS_SQL}, {session_ctes()}, {context_cte('plain', 'session')}"


def _contexts(spark, sf_dir):
    return pairs_with_context(_normal_conv(spark, sf_dir))


@query(
    "localize_context",
    f"{CONTEXTS_SQL} SELECT DialogID, seq, CASE WHEN context = 'Time Gap' THEN 'Відсутній контекст' ELSE context END AS context FROM contexts",
)
def localize_context(spark, sf_dir):
    return encoding.localize_context(_contexts(spark, sf_dir), "uk").select("DialogID", "seq", "context")


def _prompts(name, template, head):
    @query(
        name,
        f"""{CONTEXTS_SQL} SELECT DialogID, seq, {head} || '[Question]: ' || question || chr(10) || '[Context]: ' || context || chr(10) AS input_text,
        answer AS output_text FROM contexts""",
    )
    def run(spark, sf_dir):
        out = encoding.render_prompts(_contexts(spark, sf_dir), PROMPT, "en", template)
        return out.select("DialogID", "seq", "input_text", "output_text")


_prompts("render_prompts", "full", f"'[Prompt]: {PROMPT}' || chr(10)")
_prompts("render_prompts_inline", "inline_prompt", f"'[Prompt]: {PROMPT}'")
_prompts("render_prompts_bare", "no_prompt", "''")


@query(
    "prepare_training_frame",
    rf"""SELECT doc_id, regexp_replace(lower(text), '^\s+|\s+$', '', 'g') AS question, regexp_replace(lower(lang), '^\s+|\s+$', '', 'g') AS context,
    strftime(TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 365 AS INTEGER)), {STAMP_SQL}) AS timestamp FROM documents""",
)
def prepare_training_frame(spark, sf_dir):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    formats = ["yyyy-MM-dd", "dd.MM.yyyy HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yyyy HH:mm:ss"]
    mixed = F.coalesce(*[F.when(F.col("doc_id") % 4 == i, F.date_format(day, f)) for i, f in enumerate(formats)])
    docs = text_table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit(" \n"), "text").alias("question"), F.concat(F.upper("lang"), F.lit(" ")).alias("context"), mixed.alias("timestamp")
    )
    return encoding.prepare_training_frame(docs).withColumn("timestamp", F.date_format("timestamp", STAMP))


# --- random edits -------------------------------------------------------------------------


def _in_list(words) -> str:
    return ", ".join(f"'{w}'" for w in sorted(set(words)))


def shuffled_sql(items: str, tag: str, rid: str) -> str:
    """Items as structs (k, i, item) in drawing order."""
    return f"list_sort(list_transform({items}, lambda x, i: {{'k': md5('{tag}|' || {rid} || '|' || (i - 1)), 'i': i, 'item': x}}))"


def shuffle_sql(text: str, rid: str) -> str:
    clauses = rf"list_filter(list_transform(string_split(replace({text}, ',,', ','), ','), lambda c: regexp_replace(c, '^\s+|\s+$', '', 'g')), lambda c: c <> '')"
    return f"array_to_string(list_transform({shuffled_sql(clauses, '42-shuffle', rid)}, lambda s: s.item), ', ')"


def edit_ctes(source: str, rid: str, order=("shuffle", "pop", "swap")) -> str:
    """CTEs ending in ``edited``: the edits that ``edits`` names, applied to ``q`` in ``order``."""
    steps = {
        "shuffle": """
$n AS (SELECT * REPLACE (CASE WHEN list_contains(edits, 'shuffle') THEN $shuffled ELSE q END AS q) FROM $from)""",
        "pop": f"""
$na AS (SELECT *, regexp_extract_all(q, {TOKENS}) AS tk FROM $from),
$nb AS (SELECT *, $free AS sh FROM $na),
$nc AS (SELECT *, list_position(tk, sh[1].item) AS gone FROM $nb),
$n AS (SELECT * EXCLUDE (tk, sh, gone) REPLACE (CASE WHEN list_contains(edits, 'pop') AND len(sh) > 0
         THEN array_to_string(list_concat(tk[:gone - 1], tk[gone + 1:]), ' ') ELSE q END AS q) FROM $nc)""",
        "swap": f"""
$na AS (SELECT *, regexp_extract_all(q, {TOKENS}) AS tk FROM $from),
$nb AS (SELECT *, $any AS sh FROM $na),
$n AS (SELECT * EXCLUDE (tk, sh) REPLACE (CASE WHEN list_contains(edits, 'swap') AND len(tk) >= 2
         THEN array_to_string(list_transform(tk, lambda w, i: CASE i WHEN sh[1].i THEN sh[2].item WHEN sh[2].i THEN sh[1].item ELSE w END), ' ') ELSE q END AS q) FROM $nb)""",
    }
    parts, previous = [], source
    for place, name in enumerate(order):
        step = "edited" if place == len(order) - 1 else f"{name}_done"
        text = steps[name].replace("$shuffled", shuffle_sql("q", rid))
        text = text.replace("$free", shuffled_sql(f"list_filter(tk, lambda w: lower(w) NOT IN ({_in_list(STOP)}))", "42-pop", rid))
        text = text.replace("$any", shuffled_sql("tk", "42-swap", rid))
        parts.append(text.replace("$from", previous).replace("$n", step))
        previous = step
    return ",".join(parts)


def _u(tag: str, rid: str) -> str:
    return f"(CAST('0x' || substr(md5('{tag}|' || {rid}), 1, 13) AS BIGINT) / 4503599627370496.0)"


def choose_sql(rid: str) -> str:
    options = ", ".join(
        f"{{'k': -ln(CAST('0x' || substr(md5('42-edit|' || {rid} || '|{name}'), 1, 13) AS BIGINT) / 4503599627370496.0) / {w}, 'i': {i}, 'name': '{name}'}}"
        for i, (name, w) in enumerate(zip(variation.EDITS, variation.WEIGHTS))
    )
    drawn = f"list_sort([{options}])[:CAST(floor({_u('42-count', rid)} * 4) AS INTEGER) + 1]"
    return f"list_transform(list_sort(list_transform({drawn}, lambda s: {{'i': s.i, 'name': s.name}})), lambda s: s.name)"


def _one_edit(name, fn, edit):
    rid = "DialogID || '|' || seq"

    @query(
        name,
        f"""{CONV_PAIRS_SQL}, src AS (SELECT DialogID, seq, question AS q, ['{edit}'] AS edits FROM pairs), {edit_ctes('src', rid)}
        SELECT DialogID, seq, q AS question FROM edited""",
    )
    def run(spark, sf_dir):
        pairs = _conv_pairs(spark, sf_dir)
        return pairs.select("DialogID", "seq", fn(F.col("question"), F.col("DialogID"), F.col("seq")).alias("question"))


_one_edit("shuffle_clauses", lambda q, *p: variation.shuffle_clauses(q, 42, *p), "shuffle")
_one_edit("swap_words", lambda q, *p: variation.swap_words(q, 42, *p), "swap")
_one_edit("pop_word", lambda q, *p: variation.pop_word(q, STOP, 42, *p), "pop")


@query(
    "choose_edits",
    f"""SELECT doc_id, array_to_string({choose_sql('doc_id')}, '+') AS edits FROM documents""",
)
def choose_edits(spark, sf_dir):
    docs = text_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.array_join(variation.choose_edits(42, F.col("doc_id")), "+").alias("edits"))


def _augmented_sql(factor: int, edits: str, order=("shuffle", "pop", "swap")) -> str:
    rid = "DialogID || '|' || seq || '|' || round"
    return f"""{CONV_PAIRS_SQL}, rounds AS (SELECT pairs.*, question AS q, round FROM pairs, (SELECT unnest(range(1, {factor + 1})) AS round)),
    src AS (SELECT *, {edits.replace('$rid', rid)} AS edits FROM rounds), {edit_ctes('src', rid, order)}
    SELECT DISTINCT * FROM (SELECT DialogID, seq, question, answer FROM pairs WHERE question NOT IN ('', ' ')
      UNION ALL SELECT DialogID, seq, q AS question, answer FROM edited) WHERE question IS NOT NULL AND answer IS NOT NULL"""


@query("augment_questions", _augmented_sql(5, choose_sql("$rid").replace("'$rid'", "$rid")))
def augment_questions(spark, sf_dir):
    pairs = _conv_pairs(spark, sf_dir).select("DialogID", "seq", "question", "answer")
    return augmentation.augment_questions(pairs, ["DialogID", "seq"], 5, stop_words=STOP)


@query("augment_questions_all", _augmented_sql(2, "['shuffle', 'pop', 'swap']", ("shuffle", "swap", "pop")))
def augment_questions_all(spark, sf_dir):
    pairs = _conv_pairs(spark, sf_dir).select("DialogID", "seq", "question", "answer")
    return augmentation.augment_questions(pairs, ["DialogID", "seq"], 2, mode="all", stop_words=STOP)


@query(
    "augment_questions_translated",
    _augmented_sql(2, "['shuffle', 'pop', 'swap']", ("shuffle", "swap", "pop")).replace(
        "question AS q, round", "CASE WHEN length(question) % 2 = 0 THEN question || ', said again' ELSE question END AS q, round"),
)
def augment_questions_translated(spark, sf_dir):
    pairs = _conv_pairs(spark, sf_dir).select("DialogID", "seq", "question", "answer")
    # A table of translations that lacks every other text.
    known = pairs.where(F.char_length("question") % 2 == 0).select(F.col("question").alias("text"), F.concat("question", F.lit(", said again")).alias("translation"))
    return augmentation.augment_questions(pairs, ["DialogID", "seq"], 2, mode="all", stop_words=STOP, translate=known)


_REFUSAL_ROWS = ", ".join("({}, '{}', '{}')".format(i, q.replace("'", "''"), a.replace("'", "''")) for i, (q, a) in enumerate(REFUSALS, 1))
_REFUSAL_CTES = f"""
drawn AS (SELECT timestamp, row_number() OVER (ORDER BY md5('42-sample|' || DialogID || '|' || seq), DialogID, seq) AS n FROM contexts
          ORDER BY n LIMIT {len(REFUSALS)}),
refusals AS (SELECT question, answer, 'Jailbreak' AS DialogID, timestamp, 'Time Gap' AS context
             FROM (VALUES {_REFUSAL_ROWS}) AS v(n, question, answer) JOIN drawn USING (n))"""


@query(
    "inject_refusal_pairs",
    f"""{CONTEXTS_SQL}, {_REFUSAL_CTES} SELECT lower(question) AS question, answer, DialogID, strftime(timestamp, {STAMP_SQL}) AS timestamp, context
    FROM (SELECT question, answer, DialogID, timestamp, context FROM contexts UNION ALL SELECT * FROM refusals)""",
)
def inject_refusal_pairs(spark, sf_dir):
    rows = _contexts(spark, sf_dir)
    out = augmentation.inject_refusal_pairs(rows, REFUSALS, ["DialogID", "seq"])
    return out.select("question", "answer", "DialogID", F.date_format("timestamp", STAMP).alias("timestamp"), "context")


@query(
    "spot_check",
    f"""{CONTEXTS_SQL}, {_REFUSAL_CTES}, t AS (SELECT question, answer, timestamp FROM contexts UNION ALL SELECT question, answer, timestamp FROM refusals)
    SELECT strftime(timestamp, {STAMP_SQL}) AS timestamp, min((question, answer))[1] AS question, min((question, answer))[2] AS answer
    FROM t WHERE timestamp IN (SELECT timestamp FROM refusals) GROUP BY timestamp""",
)
def spot_check(spark, sf_dir):
    rows = _contexts(spark, sf_dir)
    refusals = augmentation.refusal_rows(rows, REFUSALS, ["DialogID", "seq"])
    whole = rows.unionByName(refusals, allowMissingColumns=True).select("question", "answer", "timestamp")
    return augmentation.spot_check(whole, refusals).withColumn("timestamp", F.date_format("timestamp", STAMP))


def _reversed(texts):
    return texts.str[::-1]


@query("apply_text_transform", "SELECT doc_id, text, reverse(text) AS reversed FROM documents")
def apply_text_transform(spark, sf_dir):
    docs = text_table(spark, sf_dir, "documents").select("doc_id", "text")
    return augmentation.apply_text_transform(docs, "text", _reversed, "reversed")


@query(
    "nearest_words",
    """WITH p AS (SELECT a.vec_id AS w, b.vec_id AS s, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS c
                  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
       SELECT CAST(w AS VARCHAR) AS word, CAST(arg_max(s, c) AS VARCHAR) AS synonym, round(max(c), 5) AS score FROM p GROUP BY w""",
)
def nearest_words(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("word"), F.col("embedding").alias("vector"))
    return augmentation.nearest_words(vectors, 256).withColumn("score", F.round("score", 5))


_SYNONYM_SQL = f"""
WITH rows AS (SELECT row_number() OVER () AS r, list_filter(regexp_extract_all(lower(text), {TOKENS}), lambda w: regexp_matches(w, '\\p{{L}}')) AS w FROM conversations),
tokens AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM rows),
frequent AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS c FROM tokens GROUP BY word QUALIFY c < 64),
met AS (SELECT a.word, c, count(*) AS n FROM tokens a JOIN tokens b ON a.r = b.r AND b.i <> a.i AND abs(b.i - a.i) <= 2 JOIN frequent f ON f.word = b.word GROUP BY ALL),
cells AS (SELECT g.word, g.c, coalesce(m.n, 0) AS n FROM (SELECT w.word, f.c FROM (SELECT DISTINCT word FROM met) w, frequent f) g LEFT JOIN met m ON g.word = m.word AND g.c = m.c),
vectors AS (SELECT word, list(CAST(n AS DOUBLE) ORDER BY c) AS v FROM cells GROUP BY word),
signs AS (SELECT bit, list(CASE WHEN md5(c || '|' || bit)[1] < '8' THEN CAST(1 AS DOUBLE) ELSE -1 END ORDER BY c) AS s
          FROM (SELECT unnest(range(24)) AS bit), (SELECT c FROM frequent) GROUP BY bit),
codes AS (SELECT word, v, bit // 6 || ':' || string_agg(CASE WHEN list_inner_product(v, s) >= 0 THEN '1' ELSE '0' END, '' ORDER BY bit) AS code FROM vectors, signs GROUP BY word, v, bit // 6),
scored AS (SELECT a.word, b.word AS synonym, list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) AS score
           FROM codes a JOIN codes b ON a.code = b.code AND a.word <> b.word)
SELECT word, m.synonym, round(m.score, 6) AS score FROM (SELECT word, max({{'score': score, 'synonym': synonym}}) AS m FROM scored GROUP BY word)"""


@query("synonym_table", _SYNONYM_SQL)
def synonym_table(spark, sf_dir):
    found = augmentation.synonym_table(table(spark, sf_dir, "conversations"), "text")
    return found.withColumn("score", F.round("score", 6))


# A rule that gives every word of the vocabulary a partner, for a checkable lookup.
_PARTNERS = f"""
words AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, {TOKENS}))) AS word FROM conversations),
partners AS (SELECT word, reverse(word) AS synonym FROM words WHERE length(word) > 3)"""


def _partners(spark, sf_dir):
    from parley.functions.text import tokenize

    words = table(spark, sf_dir, "conversations").select(F.explode(F.transform(tokenize(F.col("text")), F.lower)).alias("word"))
    return words.distinct().where(F.char_length("word") > 3).select("word", F.reverse("word").alias("synonym"))


@query(
    "replace_synonyms",
    f"""WITH {_PARTNERS},
    t AS (SELECT conv_id, turn, text, regexp_extract_all(text, {TOKENS}) AS tk FROM conversations),
    n AS (SELECT *, list_filter(list_transform(tk, lambda w, i: {{'i': i - 1, 'w': w}}), lambda s: lower(s.w) NOT IN ({_in_list(STOP)})) AS free FROM t),
    k AS (SELECT *, list_sort(list_transform(free, lambda s: {{'k': md5('42-synonym|' || conv_id || '|' || turn || '|' || s.i), 'i': s.i, 'w': s.w}})) AS sh FROM n),
    d AS (SELECT conv_id, turn, unnest(sh[:greatest(CAST(floor(len(sh) * CAST(0.7 AS DOUBLE)) AS INTEGER), 1)]) AS s FROM k),
    f AS (SELECT conv_id, turn, list({{'i': s.i, 'y': synonym}}) AS ch FROM d JOIN partners ON lower(s.w) = word GROUP BY conv_id, turn)
    SELECT t.conv_id, t.turn, CASE WHEN ch IS NULL THEN text ELSE array_to_string(list_transform(tk, lambda w, i:
      coalesce(list_filter(ch, lambda c: c.i = i - 1)[1].y, w)), ' ') END AS text FROM t LEFT JOIN f USING (conv_id, turn)""",
)
def replace_synonyms(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return augmentation.replace_synonyms(rows, "text", _partners(spark, sf_dir), ["conv_id", "turn"], stop_words=STOP)


@query(
    "normalize_tokens",
    f"""WITH {_PARTNERS} SELECT conv_id, turn, array_to_string(list_transform(regexp_extract_all(text, {TOKENS}),
      lambda w: CASE WHEN length(w) > 3 AND w = lower(w) THEN reverse(w) ELSE w END), ' ') AS text FROM conversations""",
)
def normalize_tokens(spark, sf_dir):
    lookup = _partners(spark, sf_dir).select(F.col("word").alias("form"), F.col("synonym").alias("lemma"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return encoding.normalize_tokens(rows, "text", lookup, ["conv_id", "turn"])


# --- encoding -----------------------------------------------------------------------------

_VOCAB = f"""
vocab AS (SELECT token, count, row_number() OVER (ORDER BY count DESC, token) + 1 AS id FROM
  (SELECT token, count(*) AS count FROM (SELECT unnest(regexp_extract_all(lower(text), {TOKENS})) AS token FROM documents) GROUP BY token))"""


@query("build_vocab", f"WITH {_VOCAB} SELECT token, count, id FROM vocab")
def build_vocab(spark, sf_dir):
    return encoding.build_vocab(text_table(spark, sf_dir, "documents"), ["text"])


def _encoded_sql(column: str, length: int) -> str:
    return f"""(SELECT doc_id, list(coalesce(id, 1) ORDER BY i) AS ids FROM (SELECT doc_id, tk[i] AS token, i FROM
      (SELECT doc_id, tk, unnest(range(1, least(len(tk), {length}) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(lower({column}), {TOKENS}) AS tk FROM documents)))
      LEFT JOIN small USING (token) GROUP BY doc_id)"""


def _padded_sql(ids: str, length: int) -> str:
    return f"array_to_string(list_resize(coalesce({ids}, []), {length}, 0), ' ')"


@query(
    "encode_fixed",
    f"""WITH {_VOCAB}, small AS (SELECT token, id FROM vocab)
    SELECT d.doc_id, {_padded_sql('a.ids', 512)} AS input_ids, {_padded_sql('b.ids', 128)} AS labels
    FROM documents d LEFT JOIN {_encoded_sql('text', 512)} a USING (doc_id) LEFT JOIN {_encoded_sql('source', 128)} b USING (doc_id)""",
)
def encode_fixed(spark, sf_dir):
    docs = text_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    vocab = encoding.build_vocab(docs, ["text"])
    out = encoding.encode_fixed(docs, ["doc_id"], vocab, {"text": ("input_ids", 512), "source": ("labels", 128)})
    return out.select("doc_id", *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("input_ids", "labels")])


# --- scores -------------------------------------------------------------------------------

SCORED = rf"""{CONV_PAIRS_SQL}, scored AS (SELECT DialogID, seq, answer AS t, question AS p, string_split(answer, ' ') AS tw, string_split(question, ' ') AS pw FROM pairs)"""


def _scored(spark, sf_dir):
    return _conv_pairs(spark, sf_dir).select("DialogID", "seq", F.col("answer").alias("y_true"), F.col("question").alias("y_pred"))


def _score(name, fn, sql=None):
    @query(name, f"{SCORED} {sql}" if sql else None)
    def run(spark, sf_dir):
        return _scored(spark, sf_dir).select("DialogID", "seq", F.round(fn(F.col("y_true"), F.col("y_pred")), 6).alias(name))


_score(
    "cer",
    metrics.cer,
    """, abc AS (SELECT *, list_distinct(list_concat(string_split(t, ''), string_split(p, ''))) AS abc FROM scored)
    SELECT DialogID, seq, round(levenshtein(array_to_string(list_transform(string_split(t, ''), lambda c: chr(CAST(33 + list_position(abc, c) AS INTEGER))), ''),
      array_to_string(list_transform(string_split(p, ''), lambda c: chr(CAST(33 + list_position(abc, c) AS INTEGER))), '')) / length(t), 6) AS cer FROM abc""",
)
# Edit distance and common subsequence, one row of the table of prefixes per step: within a row the
# dependence on the left neighbour is a running minimum (maximum) over a window.
_WORD_TABLES = f"""{SCORED.replace('WITH ', 'WITH RECURSIVE ', 1)}, ided AS (SELECT *, row_number() OVER (ORDER BY DialogID, seq) AS id FROM scored),
  tws AS (SELECT id, unnest(tw) AS w, unnest(range(1, len(tw) + 1)) AS i FROM ided),
  pws AS (SELECT id, unnest(list_concat([''], pw)) AS w, unnest(range(0, len(pw) + 1)) AS j FROM ided)"""
_WER_SQL = f"""{_WORD_TABLES}, dp AS (SELECT id, CAST(0 AS BIGINT) AS i, j, j AS v FROM pws UNION ALL
    SELECT id, i, j, j + min(c - j) OVER (PARTITION BY id ORDER BY j) AS v FROM (
      SELECT d.id, t.i, d.j, CASE WHEN d.j = 0 THEN t.i ELSE least(d.v + 1, lag(d.v) OVER (PARTITION BY d.id ORDER BY d.j) + CASE WHEN p.w = t.w THEN 0 ELSE 1 END) END AS c
      FROM dp d JOIN tws t ON t.id = d.id AND t.i = d.i + 1 JOIN pws p ON p.id = d.id AND p.j = d.j))
  SELECT DialogID, seq, round(v / len(tw), 6) AS wer FROM ided JOIN dp ON dp.id = ided.id AND dp.i = len(tw) AND dp.j = len(pw)"""
_LCS = f"""{_WORD_TABLES}, dp AS (SELECT id, CAST(0 AS BIGINT) AS i, j, CAST(0 AS BIGINT) AS v FROM pws UNION ALL
    SELECT id, i, j, max(c) OVER (PARTITION BY id ORDER BY j) AS v FROM (
      SELECT d.id, t.i, d.j, greatest(d.v, coalesce(lag(d.v) OVER (PARTITION BY d.id ORDER BY d.j) + CASE WHEN p.w = t.w THEN 1 ELSE 0 END, 0)) AS c
      FROM dp d JOIN tws t ON t.id = d.id AND t.i = d.i + 1 JOIN pws p ON p.id = d.id AND p.j = d.j)), lcs AS (SELECT DialogID, seq, tw, pw, v FROM ided JOIN dp ON dp.id = ided.id AND dp.i = len(tw) AND dp.j = len(pw))"""


def _table_score(name, fn, sql):
    @query(name, sql)
    def run(spark, sf_dir):
        return _scored(spark, sf_dir).select("DialogID", "seq", F.round(fn(F.col("y_true"), F.col("y_pred")), 6).alias(name))


_table_score("wer", metrics.wer, _WER_SQL)
_score(
    "jaccard",
    metrics.jaccard,
    """SELECT DialogID, seq, round(len(list_intersect(tw, pw)) / len(list_distinct(list_concat(tw, pw))), 6) AS jaccard FROM scored""",
)
_score(
    "vocab_recall",
    metrics.vocab_recall,
    r""", v AS (SELECT *, list_distinct(regexp_extract_all(lower(t), '[\p{L}\p{M}\p{N}_]{2,}')) AS tv, list_distinct(regexp_extract_all(lower(p), '[\p{L}\p{M}\p{N}_]{2,}')) AS pv FROM scored)
    SELECT DialogID, seq, CASE WHEN len(tv) > 0 THEN round(len(list_intersect(tv, pv)) / len(tv), 6) END AS vocab_recall FROM v""",
)


def _overlap(p: str, t: str) -> str:
    return f"""coalesce(list_sum(list_transform(list_distinct({p}), lambda w: least(len(list_filter({p}, lambda x: x = w)), len(list_filter({t}, lambda x: x = w))))), 0)"""


_score(
    "rouge1",
    lambda t, p: metrics.rouge1(t, p)["f1"],
    f"SELECT DialogID, seq, round(2.0 * {_overlap('pw', 'tw')} / (len(tw) + len(pw)), 6) AS rouge1 FROM scored",
)
_score(
    "rouge1_precision",
    lambda t, p: metrics.rouge1(t, p)["precision"],
    f"SELECT DialogID, seq, round(1.0 * {_overlap('pw', 'tw')} / len(pw), 6) AS rouge1_precision FROM scored",
)
_table_score("rouge_l", lambda t, p: metrics.rouge_l(t, p)["f1"], f"{_LCS} SELECT DialogID, seq, round(2.0 * v / (len(tw) + len(pw)), 6) AS rouge_l FROM lcs")
_table_score("rouge_l_precision", lambda t, p: metrics.rouge_l(t, p)["precision"], f"{_LCS} SELECT DialogID, seq, round(1.0 * v / len(pw), 6) AS rouge_l_precision FROM lcs")


def _grams(words: str, n: int) -> str:
    return f"list_transform(range(1, greatest(len({words}) - {n - 2}, 1)), lambda i: array_to_string({words}[i:i + {n - 1}], ' '))"


def _bleu_sql(missing: str) -> str:
    """``missing`` is what an order without a match scores; ``$g`` stands for its number of grams."""
    grams = ", ".join(f"{_grams('tw', n)} AS t{n}, {_grams('pw', n)} AS p{n}" for n in range(1, 5))
    hits = ", ".join(f"{_overlap(f'p{n}', f't{n}')} AS h{n}" for n in range(1, 5))
    total = " + ".join(
        f"ln(CASE WHEN h{n} > 0 THEN h{n} / greatest(len(p{n}), 1) ELSE {missing.replace('$g', f'greatest(len(p{n}), 1)')} END)" for n in range(1, 5)
    )
    return f""", grams AS (SELECT *, {grams} FROM scored), hits AS (SELECT *, {hits} FROM grams)
    SELECT DialogID, seq, round(CASE WHEN h1 = 0 THEN 0.0 ELSE exp(CASE WHEN len(pw) > len(tw) THEN 0 ELSE 1 - len(tw) / len(pw) END) * exp(({total}) / 4) END, 6) AS bleu FROM hits"""


_score("bleu", metrics.bleu, _bleu_sql("0.1 / $g"))
_score("bleu_unsmoothed", lambda t, p: metrics.bleu(t, p, smooth=False), _bleu_sql("CAST('2.2250738585072014e-308' AS DOUBLE)").replace("AS bleu FROM", "AS bleu_unsmoothed FROM"))


def _means_sql(columns: dict[str, str], where: str = "true") -> str:
    """Means over the rows of the single scores; ``columns`` maps a score to the query it comes from."""
    first, *rest = columns.values()
    joined = f"({ORACLES[first]}) AS q_{first} " + " ".join(f"JOIN ({ORACLES[q]}) AS q_{q} USING (DialogID, seq)" for q in rest)
    means = ", ".join(f"round(avg({q}), 4) AS {score}" for score, q in columns.items())
    return f"SELECT count(*) AS pairs, {means} FROM (SELECT * FROM {joined}) WHERE {where}"


def _means(spark, sf_dir, **options):
    rows = _scored(spark, sf_dir).withColumn("id", F.concat_ws("-", "DialogID", "seq"))
    means = evaluation.evaluate_pairs(rows.select("id", "y_pred"), rows.select("id", "y_true"), **options)
    return means.select("pairs", *[F.round(s, 4).alias(s) for s in evaluation.SCORES])


@query("evaluate_pairs", _means_sql({s: s for s in evaluation.SCORES}))
def evaluate_pairs(spark, sf_dir):
    return _means(spark, sf_dir)


_DRAWN = f"""DialogID || '-' || seq IN (SELECT id FROM (SELECT DialogID || '-' || seq AS id FROM ({ORACLES['cer']})) ORDER BY md5('42-sample|' || id), id LIMIT 50)"""


@query(
    "evaluate_pairs_precision",
    _means_sql(
        {"bleu": "bleu_unsmoothed", "rouge1": "rouge1_precision", "rouge_l": "rouge_l_precision", "wer": "wer", "cer": "cer", "jaccard": "vocab_recall"},
        _DRAWN,
    ),
)
def evaluate_pairs_precision(spark, sf_dir):
    return _means(spark, sf_dir, samples=50, variant="precision")


@query("subword_round_trip", "SELECT conv_id, turn, text, 0 AS unknown FROM conversations")
def subword_round_trip(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    coded = subwords.encode_subwords(rows, {"text": ("ids", None)}).drop("text")
    unknown = F.size(F.filter("ids", lambda i: (i < 0) | (i >= 50_257)))
    return subwords.decode_subwords(coded, "ids", "text").select("conv_id", "turn", "text", unknown.cast("bigint").alias("unknown"))


@query(
    "subword_training_features",
    f"""{CONV_PAIRS_SQL} SELECT DialogID, seq, 64 AS n_input, 16 AS n_labels, true AS starts_input, true AS starts_labels,
    strlen(question) <= 20 AS short_padded FROM pairs""",
)
def subword_training_features(spark, sf_dir):
    """Ids cut and padded; decoded, they are the beginnings of the texts."""
    rows = _conv_pairs(spark, sf_dir).select("DialogID", "seq", F.col("question").alias("input_text"), F.col("answer").alias("output_text"))
    coded = subwords.encode_subwords(rows, {"input_text": ("input_ids", 64), "output_text": ("labels", 16)})
    for column, out in (("input_ids", "input_back"), ("labels", "labels_back")):
        coded = subwords.decode_subwords(coded, column, out, mask=f"{column}_mask")
    # A cut inside a character leaves a mark of replacement at the end.
    start = lambda c: F.regexp_replace(c, "\\uFFFD+$", "")
    whole = F.col("input_back") == F.col("input_text")
    return coded.select(
        "DialogID", "seq", F.size("input_ids").cast("bigint").alias("n_input"), F.size("labels").cast("bigint").alias("n_labels"),
        F.startswith("input_text", start("input_back")).alias("starts_input"), F.startswith("output_text", start("labels_back")).alias("starts_labels"),
        ((F.octet_length("input_text") <= 20) & whole & (F.array_min("input_ids_mask") == 0)).alias("short_padded"))


# Every vowel becomes a character that no text holds, so that each costs one edit and nothing else does.
_HIDDEN = "\ue000"


@query(
    "turn_edits",
    """SELECT conv_id, turn, length(text) - length(translate(text, 'aeiou', '')) AS edits,
    CASE WHEN length(text) - length(translate(text, 'aeiou', '')) <= 30 THEN length(text) - length(translate(text, 'aeiou', '')) ELSE -1 END AS bounded
    FROM conversations""",
)
def turn_edits(spark, sf_dir):
    """Edits between whole turns and their disguised texts, as long texts are compared: all of them, and up to 30."""
    text, hidden = F.col("text"), F.translate("text", "aeiou", _HIDDEN * 5)
    return text_table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        edits.text_edits(text, hidden, short_cells=0).cast("bigint").alias("edits"),
        edits.text_edits(text, hidden, at_most=30, short_cells=0).cast("bigint").alias("bounded"),
    )


# Words of letters only, their cuts, the endings that are rules, and each word's best cut.
_STEMS = f"""
forms AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), {TOKENS})) AS word FROM documents)
  WHERE regexp_full_match(word, '[\\p{{L}}\\p{{M}}]+') GROUP BY word),
cuts AS (SELECT word, n, substr(word, 1, length(word) - k) AS stem, substr(word, length(word) - k + 1) AS ending
  FROM (SELECT word, n, unnest(range(0, least(5, length(word) - 4) + 1)) AS k FROM forms WHERE length(word) >= 4)),
varied AS (SELECT stem FROM cuts GROUP BY stem HAVING count(DISTINCT substr(ending, 1, 1)) > 1),
endings AS (SELECT ending, count(*) AS beginnings FROM cuts JOIN varied USING (stem) GROUP BY ending
  HAVING count(*) >= 5 AND count(DISTINCT right(stem, 1)) >= 3),
ruled AS (SELECT * FROM cuts JOIN endings USING (ending)),
alive AS (SELECT stem, count(*) AS words FROM ruled GROUP BY stem HAVING count(*) > 1),
placed AS (SELECT * FROM ruled JOIN alive USING (stem) QUALIFY row_number() OVER (PARTITION BY word ORDER BY words * beginnings DESC, length(stem) DESC) = 1)"""


@query(
    "stem_lemmas",
    f"""WITH {_STEMS} SELECT word AS form, stem, ending, first_value(word) OVER (PARTITION BY stem ORDER BY length(word), n DESC, word) AS lemma
    FROM placed QUALIFY count(*) OVER (PARTITION BY stem) > 1""",
)
def stem_lemmas(spark, sf_dir):
    return stems.learn_stems(stems.word_counts(text_table(spark, sf_dir, "documents"), ["text"]))


@query("learned_endings", f"WITH {_STEMS} SELECT ending, beginnings FROM endings")
def learned_endings(spark, sf_dir):
    words = settle(stems.word_counts(text_table(spark, sf_dir, "documents"), ["text"]), "words")
    return stems.learn_endings(stems.word_cuts(words))
