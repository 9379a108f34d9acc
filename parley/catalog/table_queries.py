"""Calendar counts, samples, splits and chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.catalog.registry import query
from parley.catalog.views import table
from parley.functions.dates import day_key
from parley.operators import limits, profile
from parley.plans.ranking import with_position

YEARS = "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


@query("messages_by_year", f"SELECT year, count(*) AS messages FROM ({YEARS}) GROUP BY year")
def messages_by_year(spark, sf_dir):
    return profile.messages_by_year(_orders(spark, sf_dir), "o_orderdate")


TOP_YEAR = f"(SELECT year FROM ({YEARS}) GROUP BY year ORDER BY count(*) DESC, year LIMIT 1)"
TOP_MONTH = f"(SELECT month FROM ({YEARS}) WHERE year = {TOP_YEAR} GROUP BY month ORDER BY count(*) DESC, month LIMIT 1)"


@query("messages_by_month_in_top_year", f"SELECT year, month, count(*) AS messages FROM ({YEARS}) WHERE year = {TOP_YEAR} GROUP BY year, month")
def messages_by_month_in_top_year(spark, sf_dir):
    return profile.messages_by_month_in_top_year(_orders(spark, sf_dir), "o_orderdate")


@query(
    "messages_by_day_in_top_month",
    f"SELECT year, month, day, count(*) AS messages FROM ({YEARS}) WHERE year = {TOP_YEAR} AND month = {TOP_MONTH} GROUP BY year, month, day",
)
def messages_by_day_in_top_month(spark, sf_dir):
    return profile.messages_by_day_in_top_month(_orders(spark, sf_dir), "o_orderdate")


@query("daily_counts", f"SELECT year, month, day, count(*) AS messages FROM ({YEARS}) GROUP BY year, month, day")
def daily_counts(spark, sf_dir):
    return profile.daily_counts(_orders(spark, sf_dir), "o_orderdate")


# ``orders`` covers so many months; a pivot over a stated list can be part of a larger statement.
_N_MONTHS = 80


@query(
    "message_heatmap",
    f"""SELECT * FROM (PIVOT (SELECT day(o_orderdate) AS day,
         'month_' || (1 + date_diff('month', (SELECT min(o_orderdate) FROM orders), o_orderdate)) AS month FROM orders)
       ON month IN ({", ".join(f"'month_{i + 1}'" for i in range(_N_MONTHS))}) USING count(*) GROUP BY day)""",
)
def message_heatmap(spark, sf_dir):
    """Days by months; the months numbered in order."""
    found = profile.message_heatmap(_orders(spark, sf_dir), "o_orderdate").na.fill(0)
    months = sorted(c for c in found.columns if c != "day")
    return found.withColumnsRenamed({c: f"month_{i}" for i, c in enumerate(months, 1)})


@query("messages_by_day_key", "SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS messages FROM orders GROUP BY 1")
def messages_by_day_key(spark, sf_dir):
    days = _orders(spark, sf_dir).select(day_key(F.col("o_orderdate")).alias("day"))
    return days.groupBy("day").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "message_heatmap_events",
    """SELECT day(ts) AS day, count(*) AS "2024-01" FROM events GROUP BY 1""",
)
def message_heatmap_events(spark, sf_dir):
    return profile.message_heatmap(table(spark, sf_dir, "events"), "ts")


@query("message_totals", "SELECT source, count(*) AS messages FROM documents GROUP BY source")
def message_totals(spark, sf_dir):
    return profile.message_totals(table(spark, sf_dir, "documents"), "source")


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang")


@query("head_rows", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 25")
def head_rows(spark, sf_dir):
    return limits.head_rows(_docs(spark, sf_dir), 25, ("doc_id",))


@query("sample_exact", "SELECT doc_id, lang FROM documents ORDER BY md5('42-sample|' || doc_id), doc_id LIMIT 50")
def sample_exact(spark, sf_dir):
    return limits.sample_exact(_docs(spark, sf_dir), 50, ["doc_id"])


@query(
    "split_random",
    """SELECT doc_id, lang, CASE WHEN CAST('0x' || substr(md5('42-split|' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0 < 0.9
       THEN 'train' ELSE 'test' END AS split FROM documents""",
)
def split_random(spark, sf_dir):
    return limits.with_random_split(_docs(spark, sf_dir), ["doc_id"])


@query(
    "split_random_exact",
    """SELECT doc_id, lang, CASE WHEN row_number() OVER (ORDER BY md5('42-split|' || doc_id), doc_id) <= floor((SELECT count(*) FROM documents) * 0.9)
       THEN 'train' ELSE 'test' END AS split FROM documents""",
)
def split_random_exact(spark, sf_dir):
    return limits.with_random_split(_docs(spark, sf_dir), ["doc_id"], exact=True)


@query(
    "split_ordered",
    """SELECT doc_id, lang, CASE WHEN row_number() OVER (ORDER BY doc_id) <= floor((SELECT count(*) FROM documents) * 0.9)
       THEN 'train' ELSE 'test' END AS split FROM documents""",
)
def split_ordered(spark, sf_dir):
    return limits.with_ordered_split(_docs(spark, sf_dir), ["doc_id"])


@query("assign_chunks", "SELECT doc_id, lang, ntile(32) OVER (ORDER BY doc_id) AS chunk FROM documents")
def assign_chunks(spark, sf_dir):
    return limits.assign_chunks(_docs(spark, sf_dir), 32, ["doc_id"])


@query("with_position", "SELECT event_id, row_number() OVER (ORDER BY user_id, event_id) AS place FROM events")
def position(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return with_position(events, "place", ("user_id", "event_id"), rows_per_range=1_000).select("event_id", "place")


@query("chunk_round_trip", "SELECT doc_id, lang FROM documents")
def chunk_round_trip(spark, sf_dir):
    from parley.plans.scratch import scratch_path
    from parley.sources.files import read_chunks, write_chunks

    path = scratch_path(spark, "chunks")
    write_chunks(_docs(spark, sf_dir), path, 8)
    return read_chunks(spark, path)
