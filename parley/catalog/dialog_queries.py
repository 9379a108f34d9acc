"""Turns, conversations and context over ``conversations`` and ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.catalog.registry import query
from parley.catalog.text_queries import clean_ctes, normalize_sql
from parley.catalog.views import CHAT_CONV_SQL, CHAT_DAYS_SQL, CHAT_EVENTS_SQL, chat_conv, chat_events, table
from parley.functions.text import normalize_text
from parley.operators import context, dedup, filters, limits, profile, turns
from parley.plans.ranking import with_position
from parley.plans.scratch import settle
from parley.plans.sequence import by_dialog
from parley.plans.training import build_training_table, pairs_with_context

STAMP = "yyyy-MM-dd HH:mm:ss"
STAMP_SQL = "'%Y-%m-%d %H:%M:%S'"


def _stamped(df, *columns):
    """``df`` with its dates as text."""
    dates = [c for c in ("Date", "timestamp") if c in df.columns]
    df = df.withColumns({c: F.date_format(c, STAMP) for c in dates})
    return df.select(*columns) if columns else df


def turn_ctes(source: str) -> str:
    """CTEs ending in ``turns`` and ``pairs`` over ``source``."""
    return f"""
sided AS (SELECT *, CASE WHEN Sent_by_me THEN 'me' ELSE 'other ' || Sender END AS side FROM {source} WHERE Message IS NOT NULL),
marked AS (SELECT *, CASE WHEN lag(side) OVER (PARTITION BY DialogID ORDER BY Date, seq) = side THEN 0 ELSE 1 END AS st FROM sided),
numbered AS (SELECT *, sum(st) OVER (PARTITION BY DialogID ORDER BY Date, seq) AS run FROM marked),
merged AS (SELECT DialogID, run, array_to_string(list(Message ORDER BY Date DESC, seq DESC), ' ') AS Message,
             arg_max(Sender, (Date, seq)) AS Sender, max(Date) AS Date, bool_or(Sent_by_me) AS Sent_by_me, arg_max(seq, (Date, seq)) AS seq
           FROM numbered GROUP BY DialogID, run),
followed AS (SELECT *, lead(Sent_by_me) OVER (PARTITION BY DialogID ORDER BY run) AS next_mine FROM merged),
turns AS (SELECT * FROM followed WHERE NOT (NOT Sent_by_me AND coalesce(NOT next_mine, false)) AND NOT (Sent_by_me AND run = 1)),
firsts AS (SELECT DialogID, min(Date) AS first FROM {source} GROUP BY DialogID),
answered AS (SELECT *, lead(Message) OVER (PARTITION BY DialogID ORDER BY run) AS answer FROM turns),
pairs AS (SELECT Message AS question, answer, DialogID, Date AS timestamp, Sent_by_me, seq,
            (epoch_us(Date) - epoch_us(first)) // 1000000 AS time_diff_seconds
          FROM answered JOIN firsts USING (DialogID) WHERE NOT Sent_by_me AND answer IS NOT NULL)"""


def session_ctes(pairs: str = "pairs") -> str:
    return f"""
gaps AS (SELECT *, coalesce(time_diff_seconds - lag(time_diff_seconds) OVER (PARTITION BY DialogID ORDER BY time_diff_seconds, seq), 0) AS gap FROM {pairs}),
sessions AS (SELECT *, CAST(sum(CASE WHEN gap > 21600 THEN 1 ELSE 0 END) OVER (PARTITION BY DialogID ORDER BY time_diff_seconds, seq) AS BIGINT) AS ConversationID FROM gaps)"""


def context_cte(style: str, scope: str, size: int = 10) -> str:
    keys = "DialogID, ConversationID" if scope == "session" else "DialogID"
    one = {
        "plain": "'Q' || i || ': ' || p.q || '. A' || i || ': ' || p.a || ' || '",
        "tags": "' <Q' || i || '> ' || p.q || ' <A' || i || '> ' || p.a",
    }[style]
    fresh = "" if scope == "session" else "OR gap > 21600"
    return f"""
windowed AS (SELECT *, list({{'q': question, 'a': answer}}) OVER (PARTITION BY {keys} ORDER BY time_diff_seconds, seq
              ROWS BETWEEN {size} PRECEDING AND 1 PRECEDING) AS prev FROM sessions),
contexts AS (SELECT *, CASE WHEN coalesce(len(prev), 0) = 0 {fresh} THEN 'Time Gap'
              ELSE array_to_string(list_transform(prev, lambda p, i: {one}), ' ') END AS context FROM windowed)"""


NORMAL_CONV = f"WITH {CHAT_CONV_SQL}, normal AS (SELECT * REPLACE ({normalize_sql('Message')} AS Message) FROM chat_conv)"
EVENTS = f"WITH {CHAT_EVENTS_SQL}"


def _normal_conv(spark, sf_dir):
    return chat_conv(spark, sf_dir).withColumn("Message", normalize_text(F.col("Message")))


def _pairs(messages):
    return by_dialog(messages, lambda part: turns.pair_runs(turns.alternate_runs(context.elapsed_part(part))))


def _conv_pairs(spark, sf_dir):
    return _pairs(_normal_conv(spark, sf_dir))


def _event_pairs(spark, sf_dir):
    return _pairs(chat_events(spark, sf_dir))


CONV_PAIRS_SQL = f"{NORMAL_CONV}, {turn_ctes('normal')}"
EVENT_PAIRS_SQL = f"{EVENTS}, {turn_ctes('chat_events')}"


def _burst_sql(fold: str, oldest_first: bool = False) -> str:
    rest = f"list_transform(m[2:], lambda x: {fold})"
    commas = "CASE WHEN m[1][-1] IN ('.', '!', '?') THEN '' ELSE repeat(',', len(m) - 1) END"
    text = f"array_to_string(list_concat(list_reverse({rest}), [m[1]]), ' ') || {commas}"
    if oldest_first:
        text = f"array_to_string(list_concat([m[1] || {commas}], {rest}), ' ')"
    return f"""{EVENTS},
      marked AS (SELECT *, CASE WHEN lag(Sender) OVER (PARTITION BY DialogID ORDER BY seq) = Sender THEN 0 ELSE 1 END AS st FROM chat_events),
      numbered AS (SELECT *, sum(st) OVER (PARTITION BY DialogID ORDER BY seq) AS run FROM marked),
      merged AS (SELECT DialogID, run, list(Message ORDER BY seq) AS m, any_value(Sender) AS Sender, min(seq) AS seq, arg_min(Date, seq) AS Date FROM numbered GROUP BY DialogID, run)
      SELECT DialogID, Sender, seq, strftime(Date, {STAMP_SQL}) AS Date, {text} AS Message FROM merged"""


def _bursts(name, case, fold, order="newest_first"):
    @query(name, _burst_sql(fold, order == "oldest_first"))
    def run(spark, sf_dir):
        merged = turns.coalesce_bursts(chat_events(spark, sf_dir), case, order)
        return _stamped(merged, "DialogID", "Sender", "seq", "Date", "Message")


_bursts("coalesce_bursts_first", "first", "lower(x[1]) || x[2:]")
_bursts("coalesce_bursts_all", "all", "lower(x)")
_bursts("coalesce_bursts_none", "none", "x")
_bursts("coalesce_bursts_oldest_first", "none", "x", "oldest_first")

_TURNS = f"SELECT DialogID, Sender, Sent_by_me, seq, strftime(Date, {STAMP_SQL}) AS Date, Message FROM turns"


@query("alternate_turns_events", f"{EVENT_PAIRS_SQL} {_TURNS}")
def alternate_turns_events(spark, sf_dir):
    out = turns.alternate_turns(chat_events(spark, sf_dir))
    return _stamped(out, "DialogID", "Sender", "Sent_by_me", "seq", "Date", "Message")


@query("alternate_turns_conversations", f"{CONV_PAIRS_SQL} {_TURNS}")
def alternate_turns_conversations(spark, sf_dir):
    out = turns.alternate_turns(_normal_conv(spark, sf_dir))
    return _stamped(out, "DialogID", "Sender", "Sent_by_me", "seq", "Date", "Message")


@query(
    "alternate_turns_table_scope",
    f"""WITH {CHAT_CONV_SQL}, sided AS (SELECT *, CASE WHEN Sent_by_me THEN 'me' ELSE 'other ' || Sender END AS side FROM chat_conv),
    marked AS (SELECT *, CASE WHEN lag(side) OVER (ORDER BY DialogID, Date, seq) = side THEN 0 ELSE 1 END AS st FROM sided),
    numbered AS (SELECT *, sum(st) OVER (ORDER BY DialogID, Date, seq) AS run FROM marked),
    merged AS (SELECT run, array_to_string(list(Message ORDER BY DialogID DESC, Date DESC, seq DESC), ' ') AS Message,
       arg_max(Sender, (DialogID, Date, seq)) AS Sender, max(DialogID) AS DialogID, bool_or(Sent_by_me) AS Sent_by_me, arg_max(seq, (DialogID, Date, seq)) AS seq FROM numbered GROUP BY run),
    followed AS (SELECT *, lead(Sent_by_me) OVER (ORDER BY run) AS next_mine FROM merged)
    SELECT DialogID, Sender, Sent_by_me, seq, Message FROM followed
    WHERE NOT (NOT Sent_by_me AND coalesce(NOT next_mine, false)) AND NOT (Sent_by_me AND run = 1)""",
)
def alternate_turns_table_scope(spark, sf_dir):
    out = turns.alternate_turns(chat_conv(spark, sf_dir), scope="table")
    return out.select("DialogID", "Sender", "Sent_by_me", "seq", "Message")


_PAIRS = f"SELECT question, answer, DialogID, strftime(timestamp, {STAMP_SQL}) AS timestamp, Sent_by_me, seq, time_diff_seconds FROM pairs"


@query("pair_turns_events", f"{EVENT_PAIRS_SQL} {_PAIRS}")
def pair_turns_events(spark, sf_dir):
    return _stamped(_event_pairs(spark, sf_dir))


@query("pair_turns_conversations", f"{CONV_PAIRS_SQL} {_PAIRS}")
def pair_turns_conversations(spark, sf_dir):
    return _stamped(_conv_pairs(spark, sf_dir))


@query(
    "alternation_violations",
    f"""WITH {CHAT_CONV_SQL}, placed AS (SELECT *, row_number() OVER (PARTITION BY DialogID ORDER BY Date, seq) AS position FROM chat_conv)
    SELECT DialogID, seq, Sender, position FROM placed WHERE Sent_by_me <> (position % 2 = 0)""",
)
def alternation_violations(spark, sf_dir):
    return turns.alternation_violations(chat_conv(spark, sf_dir)).select("DialogID", "seq", "Sender", "position")


@query(
    "with_elapsed",
    f"{EVENTS} SELECT DialogID, seq, (epoch_us(Date) - epoch_us(min(Date) OVER (PARTITION BY DialogID))) // 1000000 AS time_diff_seconds FROM chat_events",
)
def with_elapsed(spark, sf_dir):
    return context.with_elapsed(chat_events(spark, sf_dir)).select("DialogID", "seq", "time_diff_seconds")


@query(
    "sessionize",
    f"""{EVENTS}, elapsed AS (SELECT *, (epoch_us(Date) - epoch_us(min(Date) OVER (PARTITION BY DialogID))) // 1000000 AS time_diff_seconds FROM chat_events),
    {session_ctes('elapsed')} SELECT DialogID, seq, time_diff_seconds, ConversationID FROM sessions""",
)
def sessionize(spark, sf_dir):
    out = context.sessionize(context.with_elapsed(chat_events(spark, sf_dir)))
    return out.select("DialogID", "seq", "time_diff_seconds", "ConversationID")


_CONTEXT = "SELECT DialogID, seq, ConversationID, question, answer, context FROM contexts"


def _contexts(name, messages_of, pairs_sql, style, scope):
    @query(name, f"{pairs_sql}, {session_ctes()}, {context_cte(style, scope)} {_CONTEXT}")
    def run(spark, sf_dir):
        out = pairs_with_context(messages_of(spark, sf_dir), style=style, scope=scope)
        return out.select("DialogID", "seq", "ConversationID", "question", "answer", "context")


_contexts("add_context_plain_conversations", _normal_conv, CONV_PAIRS_SQL, "plain", "session")
_contexts("add_context_tags_conversations", _normal_conv, CONV_PAIRS_SQL, "tags", "dialog")
_contexts("add_context_plain_events", chat_events, EVENT_PAIRS_SQL, "plain", "session")
_contexts("add_context_tags_events", chat_events, EVENT_PAIRS_SQL, "tags", "dialog")


@query(
    "context_gap_count",
    f"{EVENT_PAIRS_SQL}, {session_ctes()}, {context_cte('plain', 'session')} SELECT count(*) FILTER (context = 'Time Gap') AS gaps FROM contexts",
)
def context_gap_count(spark, sf_dir):
    return profile.context_gap_count(pairs_with_context(chat_events(spark, sf_dir)))


TRAINING_SQL = f"""{CONV_PAIRS_SQL}, {session_ctes()}, {context_cte('plain', 'session')},
  ranked AS (SELECT *, row_number() OVER (PARTITION BY question ORDER BY DialogID, time_diff_seconds, seq) AS n FROM contexts)
  SELECT question, answer, DialogID, strftime(timestamp, {STAMP_SQL}) AS timestamp, context FROM ranked WHERE n = 1"""


@query("training_table", TRAINING_SQL)
def training_table(spark, sf_dir):
    out = build_training_table(chat_conv(spark, sf_dir), cleaning="normalize", max_participants=None)
    return _stamped(out)


@query(
    "training_table_full",
    f"""WITH {CHAT_DAYS_SQL}, {clean_ctes('chat_days', 'Message', ('1234',))},
    members AS (SELECT DialogID, count(DISTINCT Sender) FILTER (Sender <> 'error') AS n FROM cleaned GROUP BY DialogID),
    small AS (SELECT * FROM cleaned WHERE DialogID NOT IN (SELECT DialogID FROM members WHERE n > 2) AND Sender <> 'error'),
    {turn_ctes('small')}, {session_ctes()}, {context_cte('tags', 'dialog', 3)},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY question ORDER BY DialogID, time_diff_seconds, seq) AS n FROM contexts)
    SELECT question, answer, DialogID, strftime(timestamp, {STAMP_SQL}) AS timestamp, context FROM ranked WHERE n = 1""",
)
def training_table_full(spark, sf_dir):
    out = build_training_table(
        chat_events(spark, sf_dir, per_day=True), sensitive=("1234",), ignore=("error",), size=3, style="tags", scope="dialog"
    )
    return _stamped(out)


@query(
    "dialog_participants",
    f"WITH {CHAT_DAYS_SQL} SELECT DialogID, count(DISTINCT Sender) AS participants FROM chat_days GROUP BY DialogID",
)
def dialog_participants(spark, sf_dir):
    return filters.dialog_participants(chat_events(spark, sf_dir, per_day=True))


@query(
    "drop_group_chats",
    f"""WITH {CHAT_DAYS_SQL}, members AS (SELECT DialogID, count(DISTINCT Sender) FILTER (Sender <> 'error') AS n FROM chat_days GROUP BY DialogID)
    SELECT DialogID, seq, Sender FROM chat_days WHERE DialogID NOT IN (SELECT DialogID FROM members WHERE n > 2) AND Sender <> 'error'""",
)
def drop_group_chats(spark, sf_dir):
    kept = filters.drop_group_chats(chat_events(spark, sf_dir, per_day=True), ignore=("error",))
    return kept.select("DialogID", "seq", "Sender")


@query(
    "structure_report",
    f"""{EVENT_PAIRS_SQL}, a AS (SELECT DialogID, count(*) AS rows_in FROM chat_events GROUP BY 1), b AS (SELECT DialogID, count(*) AS n FROM turns GROUP BY 1)
    SELECT DialogID, rows_in, coalesce(n, 0) AS rows_out, rows_in - coalesce(n, 0) AS removed FROM a LEFT JOIN b USING (DialogID)""",
)
def structure_report(spark, sf_dir):
    before = chat_events(spark, sf_dir)
    return profile.structure_report(before, turns.alternate_turns(before))


@query(
    "filter_dialogs",
    f"{EVENTS} SELECT DialogID, seq FROM chat_events WHERE DialogID IN (SELECT DialogID FROM chat_events GROUP BY DialogID HAVING count(*) > 66)",
)
def filter_dialogs(spark, sf_dir):
    return filters.filter_dialogs(chat_events(spark, sf_dir), 66).select("DialogID", "seq")


@query(
    "filter_dialogs_inclusive",
    f"{EVENTS} SELECT DialogID, seq FROM chat_events WHERE DialogID IN (SELECT DialogID FROM chat_events GROUP BY DialogID HAVING count(*) >= 66)",
)
def filter_dialogs_inclusive(spark, sf_dir):
    return filters.filter_dialogs(chat_events(spark, sf_dir), 66, strict=False).select("DialogID", "seq")


@query("with_sent_by_me", f"{EVENTS} SELECT DialogID, seq, Sender, Sender = 'view' AS Sent_by_me FROM chat_events")
def with_sent_by_me(spark, sf_dir):
    return filters.with_sent_by_me(chat_events(spark, sf_dir), "view").select("DialogID", "seq", "Sender", "Sent_by_me")


@query(
    "filter_entities",
    """SELECT event_id, user_id FROM events
    WHERE event_type <> 'error' AND event_type <> 'click' AND user_id <> 7""",
)
def filter_entities(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") == "error", "Channel").otherwise("User").alias("entity_type"),
        (F.col("event_type") == "click").alias("is_bot"),
        F.col("user_id").alias("entity_id"),
    )
    return filters.filter_entities(rows, me=7).select("event_id", "user_id")


@query(
    "order_dialogs_by_start",
    f"""{EVENTS}, f AS (SELECT *, min(Date) OVER (PARTITION BY DialogID) AS first FROM chat_events)
    SELECT DialogID, seq, row_number() OVER (ORDER BY first, DialogID, Date, seq) AS place FROM f""",
)
def order_dialogs_by_start(spark, sf_dir):
    ordered = context.order_dialogs_by_start(chat_events(spark, sf_dir))
    # Ids that grow with the order the operator put the rows in, written once.
    numbered = settle(ordered.select("DialogID", "seq", F.monotonically_increasing_id().alias("_nth")), "ordered")
    return with_position(numbered, "place", ("_nth",)).select("DialogID", "seq", "place")


@query(
    "first_message_per_dialog",
    f"""{EVENTS} SELECT DialogID, seq, Sender, Message FROM (SELECT *, row_number() OVER (PARTITION BY DialogID ORDER BY Date, seq) AS n FROM chat_events) WHERE n = 1""",
)
def first_message_per_dialog(spark, sf_dir):
    return dedup.first_message_per_dialog(chat_events(spark, sf_dir)).select("DialogID", "seq", "Sender", "Message")


@query(
    "latest_per_dialog",
    f"{EVENTS} SELECT DialogID, seq FROM (SELECT *, row_number() OVER (PARTITION BY DialogID ORDER BY Date DESC, seq DESC) AS n FROM chat_events) WHERE n <= 5",
)
def latest_per_dialog(spark, sf_dir):
    return limits.latest_per_dialog(chat_events(spark, sf_dir), 5).select("DialogID", "seq")


@query(
    "limit_messages",
    f"""{EVENTS}, d AS (SELECT DialogID, count(*) AS n, min((Date, seq)) AS first_at FROM chat_events GROUP BY DialogID),
    t AS (SELECT *, sum(n) OVER (ORDER BY first_at, DialogID) AS total FROM d)
    SELECT DialogID, seq FROM chat_events WHERE DialogID IN (SELECT DialogID FROM t WHERE total - n < 1000)""",
)
def limit_messages(spark, sf_dir):
    return limits.limit_messages(chat_events(spark, sf_dir), 1000).select("DialogID", "seq")


@query(
    "limit_dialogs",
    f"""{EVENTS}, d AS (SELECT DialogID, min((Date, seq)) AS first_at FROM chat_events GROUP BY DialogID ORDER BY first_at, DialogID LIMIT 20)
    SELECT DialogID, seq FROM chat_events WHERE DialogID IN (SELECT DialogID FROM d)""",
)
def limit_dialogs(spark, sf_dir):
    return limits.limit_dialogs(chat_events(spark, sf_dir), 20).select("DialogID", "seq")
