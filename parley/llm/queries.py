"""The corpus queries over the given tables; each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parley.llm.alignment import align_tokens
from parley.llm.common import table
from parley.llm.decontaminate import contamination
from parley.llm.line_dedup import line_report
from parley.llm.lm import score_texts
from parley.llm.merkle import prove_rows
from parley.llm.mixing import mix_sizes
from parley.llm.near_dedup import near_duplicates
from parley.llm.pii import find_personal_data
from parley.llm.quality import score_quality, train_quality
from parley.llm.quality_rules import quality_digest
from parley.llm.topk import top_k
from parley.llm.toxicity import score_toxicity, train_toxicity
from parley.llm.warc import archive_pages

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).drop("record_id")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prove_rows(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_digest(table(spark, sf_dir, "documents"))


OP7_SQL = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
grouped AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM hashed)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM grouped"""


QUERIES: dict[str, Query] = {
    "op1_lm_score": op1_lm_score,
    "op2_mix_sources": op2_mix_sources,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality": op4_quality,
    "op5_line_dedup": op5_line_dedup,
    "op6_topk": op6_topk,
    "op7_warc": op7_warc,
    "op8_decontaminate": op8_decontaminate,
    "op9_personal_data": op9_personal_data,
    "op10_toxicity": op10_toxicity,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_quality_rules": op13_quality_rules,
}
OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 1) AS shingle
  FROM w, unnest(range(1, greatest(len(w), 2))) t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
lowest AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)"""

OP8_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS g
  FROM iw, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0),
dg AS (
  SELECT rid, i, n, list_slice(w, i, i + n - 1) AS g
  FROM dw, (SELECT DISTINCT n FROM win) lens, unnest(range(1, greatest(len(w) - n + 2, 1))) t(i)),
hit AS (SELECT DISTINCT rid, i, dg.n, item_id FROM dg JOIN win ON dg.n = win.n AND dg.g = win.g),
cover AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hit GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cover USING (rid) LEFT JOIN items USING (rid)"""

OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.q) = len(b.q) AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10"""


def _merkle_sql(levels: int = 17) -> str:
    """The tree level by level; every node carries the path of its leaf as (left, right)."""
    field = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')".format
    hashed = lambda text: "sha256(" + " || ".join([*[field(c) for c in ("doc_id", "source", "lang", "n_chars")], field(text)]) + ")"
    crc = """list_reduce(list_concat([4294967295], list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"""
    parts = [f"""given AS (
  SELECT doc_id, source, {hashed("text")} AS leaf,
         {hashed(f"CASE WHEN xor({crc}, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS other
  FROM documents),
rows AS (SELECT row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS rid, * FROM given),
l0 AS (SELECT rid, source, row_number() OVER (PARTITION BY source ORDER BY rid) - 1 AS rank, leaf AS h, leaf AS node, other AS folded, '' AS proof FROM rows)"""]

    def climb(name: str, group: str, out: str) -> None:
        # h: hash of the node above a row; folded: the same from the other leaf.
        for i in range(levels):
            prev = f"{name}{i}"
            parts.append(f"""{prev}n AS (SELECT DISTINCT {group} AS g, rank, h FROM {prev}),
{prev}s AS (SELECT g, rank // 3 AS up, string_agg(h, '' ORDER BY rank) AS joined, count(*) OVER (PARTITION BY g) AS ups, max(max(rank)) OVER (PARTITION BY g) AS top,
  string_agg(h, '' ORDER BY rank) FILTER (rank % 3 < 1) AS h0, string_agg(h, '' ORDER BY rank) FILTER (rank % 3 = 1) AS h1, string_agg(h, '' ORDER BY rank) FILTER (rank % 3 = 2) AS h2
  FROM {prev}n GROUP BY g, rank // 3),
{name}{i + 1} AS (SELECT rid, source, CASE WHEN top > 0 THEN rank // 3 ELSE rank END AS rank,
  CASE WHEN top > 0 THEN sha256(joined) ELSE p.h END AS h, node,
  CASE WHEN top > 0 THEN sha256(CASE rank % 3 WHEN 0 THEN folded || coalesce(h1, '') || coalesce(h2, '') WHEN 1 THEN h0 || folded || coalesce(h2, '') ELSE h0 || h1 || folded END) ELSE folded END AS folded,
  CASE WHEN top > 0 THEN proof || CASE rank % 3 WHEN 0 THEN coalesce(h1, '') || coalesce(h2, '') WHEN 1 THEN h0 || coalesce(h2, '') ELSE h0 || h1 END ELSE proof END AS proof
  FROM {prev} p JOIN {prev}s s ON {group} IS NOT DISTINCT FROM s.g AND rank // 3 = s.up)""")
        parts.append(f"{out} AS (SELECT * FROM {name}{levels})")

    climb("l", "source", "subroots")
    parts.append("""r0 AS (SELECT rid, source, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS rank, h, h AS node, folded, proof FROM subroots)""")
    climb("r", "1", "roots")
    return "WITH " + ",\n".join(parts) + """
SELECT doc_id, leaf, r.node AS subroot, r.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.h AS verified
FROM roots r JOIN rows USING (rid)"""


OP12_SQL = _merkle_sql(11)

OP13_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (SELECT rid, i, list_slice(w, i, i + 2) AS g FROM w, unnest(range(1, greatest(len(w) - 1, 1))) t(i)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1),
hit AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid),
c AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
         strlen(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS letters, strlen(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS visible,
         coalesce(list_max(list_transform(w, lambda x: strlen(x))), 0) AS longest
  FROM w LEFT JOIN hit USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 2 * n_dup_lines > n_lines
            OR 2 * letters < visible OR longest > 1000) AS kept
FROM b"""


ORACLES: dict[str, str] = {
    "op3_near_dedup": OP3_SQL,
    "op8_decontaminate": OP8_SQL,
    "op6_topk": OP6_SQL,
    "op7_warc": OP7_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_quality_rules": OP13_SQL,
}
