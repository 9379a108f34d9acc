"""Exports and streams derived from the tables, written to scratch and read back."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from parley.catalog.dialog_queries import CONV_PAIRS_SQL, STAMP, STAMP_SQL, _conv_pairs, context_cte, session_ctes, turn_ctes
from parley.catalog.registry import ORACLES, query
from parley.catalog.text_queries import normalize_sql
from parley.catalog.views import CHAT_CONV_SQL, CHAT_EVENTS_SQL, chat_conv, chat_events, table
from parley.functions.prompts import labels_for
from parley.operators import augmentation
from parley.operators.turns import coalesce_bursts
from parley.plans.scratch import scratch_path, settle
from parley.plans.training import build_training_table
from parley.sources import collect, discord, files, instagram, telegram
from parley.streaming import events as event_log
from parley.streaming import ingest, live_context, sessions

# Dialogs per derived Telegram document.
DIALOGS_PER_DOCUMENT = 40
# Derived documents that one task writes, about.
FILES_PER_TASK = 200


def _write_documents(df, path, *keys):
    """One JSON text per row of ``df`` (keys, value), each in a file and folder of its own.

    A file costs its time however short it is, so the tasks are cut by files; by bytes, as Spark
    joins small partitions, a task would write all that a core can get.
    """
    tasks = max(1, -(-df.count() // FILES_PER_TASK))
    df.repartition(tasks, *keys).write.partitionBy(*keys).text(path)


def _messages(*fields):
    return F.sort_array(F.collect_list(F.struct(F.col("seq").alias("seq"), *fields)))


def _telegram_export(spark, sf_dir):
    """Documents of several chats; system messages get a list as text, chats of six messages are groups."""
    dialogs = (
        chat_conv(spark, sf_dir)
        .withColumn("conv_id", F.col("DialogID").cast("bigint"))
        .groupBy("conv_id")
        .agg(_messages(F.col("Message").alias("text"), F.col("Sender").alias("role"), F.date_format("Date", "yyyy-MM-dd'T'HH:mm:ss").alias("date")).alias("m"))
    )
    # The two forms of ``text`` in one array need JSON that is put together as text.
    message = lambda m: F.concat(
        F.lit('{"text":'),
        F.when(m["role"] == "system", F.lit('["a",{"type":"bold","text":"b"}]')).otherwise(F.to_json(F.array(m["text"])).substr(F.lit(2), F.length(F.to_json(F.array(m["text"]))) - 2)),
        F.lit(',"from_id":"'), F.when(m["role"] == "assistant", "user1").otherwise("user2"),
        F.lit('","from":"x","date":"'), m["date"], F.lit('"}'),
    )
    chat = F.concat(
        F.lit('{"type":"'), F.when(F.size("m") == 6, "private_group").otherwise("personal_chat"),
        F.lit('","messages":['), F.array_join(F.transform("m", message), ","), F.lit("]}"),
    )
    documents = (
        dialogs.select((F.col("conv_id") / DIALOGS_PER_DOCUMENT).cast("bigint").alias("doc"), "conv_id", chat.alias("chat"))
        .groupBy("doc")
        .agg(F.sort_array(F.collect_list(F.struct("conv_id", "chat")))["chat"].alias("chats"))
        .select(F.lpad(F.col("doc").cast("string"), 8, "0").alias("doc"), F.concat(F.lit('{"chats":{"list":['), F.array_join("chats", ","), F.lit("]}}")).alias("value"))
    )
    path = scratch_path(spark, "telegram-export")
    _write_documents(documents, path, "doc")
    return path


# Documents and kept chats are numbered from 1; texts that were lists count as empty.
_TELEGRAM_SQL = f"""WITH {CHAT_CONV_SQL}, sized AS (SELECT *, CAST(DialogID AS BIGINT) AS c, count(*) OVER (PARTITION BY DialogID) AS n FROM chat_conv),
  kept AS (SELECT *, c // {DIALOGS_PER_DOCUMENT} AS doc FROM sized WHERE n > 3 AND n <> 6),
  docs AS (SELECT doc, row_number() OVER (ORDER BY doc) AS file FROM (SELECT DISTINCT CAST(DialogID AS BIGINT) // {DIALOGS_PER_DOCUMENT} AS doc FROM chat_conv)),
  named AS (SELECT CASE WHEN (SELECT count(*) FROM docs) > 1 THEN 'T' || file || '_' ELSE 'T_' END || dense_rank() OVER (PARTITION BY kept.doc ORDER BY c) AS DialogID,
     CASE WHEN Sender = 'system' THEN '' ELSE Message END AS Message, CASE WHEN Sent_by_me THEN '1' ELSE '2' END AS Sender, Date, Sent_by_me, seq
     FROM kept JOIN docs ON kept.doc = docs.doc)"""


@query("scan_telegram", f"{_TELEGRAM_SQL} SELECT DialogID, Message, Sender, strftime(Date, {STAMP_SQL}) AS Date, Sent_by_me, seq FROM named")
def scan_telegram(spark, sf_dir):
    rows = telegram.scan_telegram(spark, _telegram_export(spark, sf_dir), me="1", min_messages=3)
    return rows.withColumn("Date", F.date_format("Date", STAMP))


@query("scan_large_telegram", f"{_TELEGRAM_SQL} SELECT DialogID, Message, Sender, strftime(Date, {STAMP_SQL}) AS Date, Sent_by_me, seq FROM named")
def scan_large_telegram(spark, sf_dir):
    rows = telegram.scan_large_telegram(spark, _telegram_export(spark, sf_dir), me="1", min_messages=3)
    return rows.withColumn("Date", F.date_format("Date", STAMP))


def _burst_sql(named: str, fold: str) -> str:
    """Rows of the CTE ``named`` with bursts joined, newest first."""
    return f"""marked AS (SELECT *, CASE WHEN lag(Sender) OVER (PARTITION BY DialogID ORDER BY seq) = Sender THEN 0 ELSE 1 END AS st FROM {named} WHERE Message <> ''),
      numbered AS (SELECT *, sum(st) OVER (PARTITION BY DialogID ORDER BY seq) AS run FROM marked),
      merged AS (SELECT DialogID, run, list(Message ORDER BY seq) AS m, any_value(Sender) AS Sender, min(seq) AS seq, arg_min(Date, seq) AS Date, bool_or(Sent_by_me) AS Sent_by_me FROM numbered GROUP BY DialogID, run),
      bursts AS (SELECT DialogID, Sender, seq, Sent_by_me, strftime(Date, {STAMP_SQL}) AS Date,
        array_to_string(list_concat(list_reverse(list_transform(m[2:], lambda x: {fold})), [m[1]]), ' ') || CASE WHEN m[1][-1] IN ('.', '!', '?') THEN '' ELSE repeat(',', len(m) - 1) END AS Message FROM merged)"""


@query("scan_telegram_pattern", f"{_TELEGRAM_SQL} SELECT DialogID, seq, Message FROM named")
def scan_telegram_pattern(spark, sf_dir):
    # Other documents beside the export, of other names: they neither count nor break the scan.
    path = _telegram_export(spark, sf_dir)
    spark.range(3).select(F.lit("no json").alias("value")).write.csv(f"{path}/doc=00000000/settings")
    rows = telegram.scan_telegram(spark, path, min_messages=3, file_pattern=r"part-.*\.txt$")
    return rows.select("DialogID", "seq", "Message")


@query("read_telegram", f"{_TELEGRAM_SQL}, {_burst_sql('named', 'lower(x[1]) || x[2:]')} SELECT * FROM bursts")
def read_telegram(spark, sf_dir):
    rows = telegram.read_telegram(spark, _telegram_export(spark, sf_dir), me="1", min_messages=3)
    return rows.withColumn("Date", F.date_format("Date", STAMP)).select("DialogID", "Sender", "seq", "Sent_by_me", "Date", "Message")


def _instagram_export(spark, sf_dir, inbox_only=False):
    """One document per dialog, texts garbled as the messenger does it, system texts missing.

    ``inbox_only``: every third dialog in a folder of that name, the others in one before it.
    """
    garbled = F.decode(F.encode(F.col("Message"), "UTF-8"), "ISO-8859-1")
    fields = [
        F.col("Sender").alias("sender_name"),
        F.unix_millis("Date").alias("timestamp_ms"),
        F.when(F.col("Sender") != "system", garbled).alias("content"),
    ]
    documents = chat_conv(spark, sf_dir).groupBy("DialogID").agg(_messages(*fields).alias("messages"))
    path = scratch_path(spark, "instagram-export")
    documents = documents.select(F.lpad("DialogID", 10, "0").alias("dialog"), F.to_json(F.struct("messages")).alias("value"))
    if inbox_only:
        place = F.when(F.col("dialog").cast("bigint") % 3 == 0, "inbox").otherwise("archive")
        _write_documents(documents.withColumn("place", place), path, "place", "dialog")
    else:
        _write_documents(documents, path, "dialog")
    return path


_INSTAGRAM_SQL = f"""WITH {CHAT_CONV_SQL}, sized AS (SELECT *, count(*) OVER (PARTITION BY DialogID) AS n, dense_rank() OVER (ORDER BY CAST(DialogID AS BIGINT)) - 1 AS i FROM chat_conv),
  named AS (SELECT 'I_' || i AS DialogID, CASE WHEN Sender <> 'system' THEN Message END AS Message, Sender, Date, Sent_by_me, seq FROM sized WHERE n >= 4)"""


@query("scan_instagram", f"{_INSTAGRAM_SQL} SELECT DialogID, Message, Sender, strftime(Date, {STAMP_SQL}) AS Date, Sent_by_me, seq FROM named")
def scan_instagram(spark, sf_dir):
    path = _instagram_export(spark, sf_dir)
    rows = instagram.scan_instagram(spark, path, me="assistant", min_messages=4, file_name="part-*")
    return rows.withColumn("Date", F.date_format("Date", STAMP))


@query(
    "scan_instagram_inbox",
    f"""WITH {CHAT_CONV_SQL}, sized AS (SELECT *, count(*) OVER (PARTITION BY DialogID) AS n, CAST(DialogID AS BIGINT) % 3 = 0 AS wanted FROM chat_conv),
    named AS (SELECT *, dense_rank() OVER (ORDER BY CAST(DialogID AS BIGINT)) - 1 AS i FROM sized WHERE wanted)
    SELECT 'I_' || i AS DialogID, Sender, seq FROM named WHERE n >= 4 AND i < 20""",
)
def scan_instagram_inbox(spark, sf_dir):
    path = _instagram_export(spark, sf_dir, inbox_only=True)
    rows = instagram.scan_instagram(spark, path, min_messages=4, file_name="part-*", dir_pattern="place=inbox$", dialogs_limit=20)
    return rows.select("DialogID", "Sender", "seq")


@query("read_instagram", f"{_INSTAGRAM_SQL}, {_burst_sql('named', 'lower(x)')} SELECT * FROM bursts")
def read_instagram(spark, sf_dir):
    path = _instagram_export(spark, sf_dir)
    rows = instagram.read_instagram(spark, path, me="assistant", min_messages=4, file_name="part-*")
    return rows.withColumn("Date", F.date_format("Date", STAMP)).select("DialogID", "Sender", "seq", "Sent_by_me", "Date", "Message")


def _discord_export(spark, sf_dir):
    fields = [F.date_format("Date", "yyyy-MM-dd HH:mm:ss").alias("Timestamp"), F.col("Message").alias("Contents")]
    documents = chat_conv(spark, sf_dir).groupBy("DialogID").agg(_messages(*fields).alias("m"))
    value = F.to_json(F.transform("m", lambda m: F.struct(m["Timestamp"].alias("Timestamp"), m["Contents"].alias("Contents"))))
    path = scratch_path(spark, "discord-export")
    _write_documents(documents.select(F.lpad("DialogID", 10, "0").alias("channel"), value.alias("value")), path, "channel")
    return path


_DISCORD_SQL = f"""WITH {CHAT_CONV_SQL} SELECT 'D_' || (dense_rank() OVER (ORDER BY CAST(DialogID AS BIGINT)) - 1) AS DialogID, Message, strftime(Date, {STAMP_SQL}) AS Date, seq FROM chat_conv"""


@query("read_discord", _DISCORD_SQL)
def read_discord(spark, sf_dir):
    rows = discord.read_discord(spark, _discord_export(spark, sf_dir), file_name="part-*")
    return rows.withColumn("Date", F.date_format("Date", STAMP))


@query("read_discord_first_only", f"SELECT * FROM ({_DISCORD_SQL}) WHERE seq = 0")
def read_discord_first_only(spark, sf_dir):
    rows = discord.read_discord(spark, _discord_export(spark, sf_dir), first_only=True, file_name="part-*")
    return rows.withColumn("Date", F.date_format("Date", STAMP))


_LANDED_SQL = f"""WITH {CHAT_EVENTS_SQL}, named AS (SELECT * REPLACE (CASE WHEN Sender = 'error' THEN 'peer' || DialogID ELSE Sender END AS Sender) FROM chat_events),
  {_burst_sql('(SELECT * REPLACE (false AS Sent_by_me) FROM named)', 'x')} SELECT DialogID, Sender, seq, Date, Message FROM bursts"""


@query("from_landed_messages", _LANDED_SQL)
def from_landed_messages(spark, sf_dir):
    landed = chat_events(spark, sf_dir).select(
        F.col("DialogID").alias("dialog_id"),
        F.concat(F.lit(" "), "Message", F.lit(" \n")).alias("message"),
        F.when(F.col("Sender") != "error", F.col("Sender")).alias("from_id"),
        F.concat(F.lit("peer"), "DialogID").alias("peer_id"),
        F.col("Date").alias("date"),
        "seq",
    )
    rows = telegram.from_landed_messages(landed)
    return rows.withColumn("Date", F.date_format("Date", STAMP)).select("DialogID", "Sender", "seq", "Date", "Message")


@query(
    "collect_sources",
    f"""WITH {CHAT_CONV_SQL}, {CHAT_EVENTS_SQL} SELECT DialogID, Message, Sent_by_me, seq, 'telegram' AS source FROM chat_conv
    UNION ALL SELECT DialogID, Message, Sent_by_me, seq, 'instagram' AS source FROM chat_events""",
)
def collect_sources(spark, sf_dir):
    both = collect.collect_sources(telegram=chat_conv(spark, sf_dir), instagram=chat_events(spark, sf_dir))
    return both.select("DialogID", "Message", "Sent_by_me", "seq", "source")


def _named(sql: str, prefix: str) -> str:
    """The CTEs of ``sql`` (which begins with WITH chat_conv) under names of their own."""
    body = sql.split(CHAT_CONV_SQL, 1)[1]
    for name in ("sized", "kept", "docs", "named"):
        body = re.sub(rf"\b{name}\b", f"{prefix}_{name}", body)
    return body


@query(
    "training_table_from_exports",
    f"""WITH {CHAT_CONV_SQL}{_named(_TELEGRAM_SQL, 'tg')}{_named(_INSTAGRAM_SQL, 'ig')},
    collected AS (SELECT DialogID, Message, Sender, Date, Sent_by_me, seq FROM tg_named UNION ALL SELECT DialogID, Message, Sender, Date, Sent_by_me, seq FROM ig_named),
    collected_normal AS (SELECT * FROM (SELECT * REPLACE ({normalize_sql('Message')} AS Message) FROM collected) WHERE Message IS NULL OR Message <> ''),
    {turn_ctes('collected_normal')}, {session_ctes()}, {context_cte('plain', 'session')},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY question ORDER BY DialogID, time_diff_seconds, seq) AS n FROM contexts)
    SELECT question, answer, DialogID, strftime(timestamp, {STAMP_SQL}) AS timestamp, context FROM ranked WHERE n = 1""",
)
def training_table_from_exports(spark, sf_dir):
    telegram_rows = telegram.scan_telegram(spark, _telegram_export(spark, sf_dir), me="1", min_messages=3)
    instagram_rows = instagram.scan_instagram(spark, _instagram_export(spark, sf_dir), me="assistant", min_messages=4, file_name="part-*")
    rows = settle(collect.collect_sources(telegram=telegram_rows, instagram=instagram_rows), "collected")
    out = build_training_table(rows, cleaning="normalize", max_participants=None, checked=True)
    return out.withColumn("timestamp", F.date_format("timestamp", STAMP))


@query("csv_round_trip", f"WITH {CHAT_CONV_SQL} SELECT DialogID, Message, Sender, strftime(Date, {STAMP_SQL}) AS Date, Sent_by_me, seq FROM chat_conv")
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.save_dataset(chat_conv(spark, sf_dir), path)
    return files.read_messages_csv(spark, path).withColumn("Date", F.date_format("Date", STAMP))


@query(
    "load_wordlist",
    r"SELECT DISTINCT w AS word FROM (SELECT unnest(regexp_split_to_array(lower(text), '[\s,]+')) AS w FROM benchmark) WHERE w <> ''",
)
def load_wordlist(spark, sf_dir):
    path = scratch_path(spark, "words")
    table(spark, sf_dir, "benchmark").select("text").write.text(path)
    return files.load_wordlist(spark, path)


# --- streams ------------------------------------------------------------------------------


def _finish(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@query("ingest_incremental", "SELECT event_id, user_id, event_type, value FROM events")
def ingest_incremental(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    target, progress = scratch_path(spark, "ingested"), scratch_path(spark, "progress")
    stream = ingest.message_stream(spark, f"{sf_dir}/events*.parquet", schema)
    for _ in range(2):  # the second run finds nothing new
        _finish(ingest.ingest_incremental(stream, target, progress))
    return spark.read.schema(schema).parquet(target).select("event_id", "user_id", "event_type", "value")


@query(
    "stream_sessions",
    f"""WITH {CHAT_EVENTS_SQL}, gaps AS (SELECT *, epoch_us(Date) - lag(epoch_us(Date)) OVER (PARTITION BY DialogID ORDER BY Date, seq) AS gap FROM chat_events),
    numbered AS (SELECT *, sum(CASE WHEN gap > 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY DialogID ORDER BY Date, seq) AS c FROM gaps)
    SELECT DialogID, strftime(min(Date), {STAMP_SQL}) AS first_message, strftime(max(Date), {STAMP_SQL}) AS last_message, count(*) AS messages,
      max(Date) + INTERVAL 6 HOURS < (SELECT max(ts) FROM events) AS closed
    FROM numbered GROUP BY DialogID, c""",
)
def stream_sessions(spark, sf_dir):
    # Files that cut through the dialogs and their time order, one per micro-batch.
    source = scratch_path(spark, "stream-input")
    rows = chat_events(spark, sf_dir).select("DialogID", "Date", "seq")
    rows.withColumn("part", F.pmod(F.xxhash64("seq"), F.lit(3))).repartition(3, "part").drop("part").write.parquet(source)
    target, progress = scratch_path(spark, "sessions"), scratch_path(spark, "progress")
    stream = ingest.message_stream(spark, source, rows.schema, files_per_batch=1)
    _finish(sessions.stream_sessions(stream, target, progress))
    done = sessions.read_sessions(spark, target)
    return done.withColumns({c: F.date_format(c, STAMP) for c in ("first_message", "last_message")})


_LATENESS = 40 * 86_400


@query(
    "stream_closed_sessions",
    f"""WITH {CHAT_EVENTS_SQL}, gaps AS (SELECT *, epoch_us(Date) - lag(epoch_us(Date)) OVER (PARTITION BY DialogID ORDER BY Date, seq) AS gap FROM chat_events),
    numbered AS (SELECT *, sum(CASE WHEN gap > 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY DialogID ORDER BY Date, seq) AS c FROM gaps),
    whole AS (SELECT DialogID, min(Date) AS a, max(Date) AS z, count(*) AS messages FROM numbered GROUP BY DialogID, c)
    SELECT DialogID, strftime(a, {STAMP_SQL}) AS first_message, strftime(z, {STAMP_SQL}) AS last_message, messages
    FROM whole WHERE z + INTERVAL 6 HOURS <= (SELECT max(ts) FROM events)""",
)
def stream_closed_sessions(spark, sf_dir):
    # Three runs over files that cut through the dialogs in no order; the lateness covers all of them
    # until a last message, long after, moves the watermark to the newest event.
    source = scratch_path(spark, "stream-input")
    rows = chat_events(spark, sf_dir).select("DialogID", "Date", "seq")
    rows.withColumn("part", F.pmod(F.xxhash64("seq"), F.lit(3))).repartition(3, "part").drop("part").write.parquet(source)
    target, progress = scratch_path(spark, "closed"), scratch_path(spark, "progress")
    stream = ingest.message_stream(spark, source, rows.schema, files_per_batch=1)
    _finish(sessions.stream_closed_sessions(stream, target, progress, lateness_seconds=_LATENESS))
    newest = rows.agg(F.max("Date").alias("Date")).select(
        F.lit("clock").alias("DialogID"), (F.col("Date") + F.make_dt_interval(secs=F.lit(_LATENESS))).alias("Date"), F.lit(-1).cast("bigint").alias("seq"))
    newest.write.mode("append").parquet(source)
    _finish(sessions.stream_closed_sessions(stream, target, progress, lateness_seconds=_LATENESS))
    done = spark.read.schema(sessions.FRAGMENT).parquet(target)
    return done.withColumns({c: F.date_format(c, STAMP) for c in ("first_message", "last_message")})


_UK = labels_for("uk")
_TURN = "' <Q' || i || '> ' || p.q || ' <A' || i || '> ' || p.a"


@query(
    "stream_context",
    f"""{CONV_PAIRS_SQL}, windowed AS (SELECT *, list({{'q': question, 'a': answer}}) OVER (PARTITION BY DialogID ORDER BY timestamp, seq ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS prev FROM pairs)
    SELECT DialogID AS chat_id, seq AS message_id, question, answer, '[{_UK.question}]:' || question || chr(10) || '[{_UK.context}]: ' ||
      CASE WHEN coalesce(len(prev), 0) = 0 THEN '[{_UK.no_context}]: ' ELSE array_to_string(list_transform(prev, lambda p, i: {_TURN}), '') END || chr(10) AS input_text FROM windowed""",
)
def stream_context(spark, sf_dir):
    rows = _conv_pairs(spark, sf_dir).select(
        F.col("DialogID").alias("chat_id"),
        F.col("seq").alias("message_id"),
        F.col("timestamp").alias("message_time"),
        F.concat(F.lit("  "), "question", F.lit(" \n")).alias("message"),
        "answer",
    )
    raw = settle(rows, "stream-input")
    source = raw.inputFiles()[0].rsplit("/", 1)[0]
    target, progress = scratch_path(spark, "contexts"), scratch_path(spark, "progress")
    prompts = live_context.stream_context(ingest.message_stream(spark, source, raw.schema))
    _finish(ingest.ingest_incremental(prompts, target, progress))
    done = spark.read.schema(prompts.schema).parquet(target)
    return done.select("chat_id", "message_id", "question", "answer", "input_text")


@query("keep_context", ORACLES["stream_context"])
def keep_context(spark, sf_dir):
    # The same messages in three files, one a micro-batch: the state carries the turns over.
    rows = _conv_pairs(spark, sf_dir).select(
        F.col("DialogID").alias("chat_id"), F.col("seq").alias("message_id"), F.col("timestamp").alias("message_time"), F.col("question").alias("message"), "answer")
    source = scratch_path(spark, "stream-input")
    first, second = (F.col("message_id") <= n for n in (2, 4))
    for part in (first, ~first & second, ~second):
        rows.where(part).coalesce(1).write.mode("append").parquet(source)
    target, progress = scratch_path(spark, "contexts"), scratch_path(spark, "progress")
    _finish(live_context.land_context(ingest.message_stream(spark, source, rows.schema, files_per_batch=1), target, progress))
    done = spark.read.schema(live_context.OUTPUT).parquet(target)
    return done.select("chat_id", "message_id", "question", "answer", "input_text")


_FORGET = 20_000


@query(
    "stream_context_forget",
    f"""{CONV_PAIRS_SQL}, gaps AS (SELECT *, CASE WHEN epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (PARTITION BY DialogID ORDER BY timestamp, seq) > {_FORGET * 1_000_000} THEN 1 ELSE 0 END AS far FROM pairs),
    parts AS (SELECT *, sum(far) OVER (PARTITION BY DialogID ORDER BY timestamp, seq) AS part FROM gaps),
    windowed AS (SELECT *, list({{'q': question, 'a': answer}}) OVER (PARTITION BY DialogID, part ORDER BY timestamp, seq ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS prev FROM parts)
    SELECT DialogID AS chat_id, seq AS message_id, '[{_UK.question}]:' || question || chr(10) || '[{_UK.context}]: ' ||
      CASE WHEN coalesce(len(prev), 0) = 0 THEN '[{_UK.no_context}]: ' ELSE array_to_string(list_transform(prev, lambda p, i: {_TURN}), '') END || chr(10) AS input_text FROM windowed""",
)
def stream_context_forget(spark, sf_dir):
    rows = _conv_pairs(spark, sf_dir).select(
        F.col("DialogID").alias("chat_id"), F.col("seq").alias("message_id"), F.col("timestamp").alias("message_time"),
        F.col("question").alias("message"), "answer")
    source = scratch_path(spark, "stream-input")
    rows.write.parquet(source)
    target, progress = scratch_path(spark, "contexts"), scratch_path(spark, "progress")
    prompts = live_context.stream_context(ingest.message_stream(spark, source, rows.schema), forget_after_seconds=_FORGET)
    _finish(ingest.ingest_incremental(prompts, target, progress))
    return spark.read.schema(prompts.schema).parquet(target).select("chat_id", "message_id", "input_text")


def _update_text():
    """Events as chat updates: errors are commands, views are photos without text."""
    kind = F.col("event_type")
    return F.when(kind == "error", F.concat(F.lit("/"), "props")).when(kind != "view", F.col("props"))


_UPDATES_SQL = f"""SELECT props AS message, 'a' || event_id AS answer, strftime(ts, {STAMP_SQL}) AS message_time, user_id, 'u' || user_id AS username, 'F' AS first_name,
  CAST(NULL AS VARCHAR) AS last_name, user_id * 10 AS chat_id, event_id AS message_id, user_id % 2 = 0 AS is_bot, 'en' AS language_code
  FROM events WHERE event_type NOT IN ('error', 'view')"""


@query("stream_event_log", _UPDATES_SQL)
def stream_event_log(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    target, progress = scratch_path(spark, "event-log"), scratch_path(spark, "progress")
    updates = ingest.message_stream(spark, f"{sf_dir}/events*.parquet", schema).select(
        _update_text().alias("message"),
        F.concat(F.lit("a"), F.col("event_id")).alias("answer"),
        F.col("ts").cast("timestamp").alias("message_time"),
        F.concat(F.lit("u"), F.col("user_id")).alias("username"),
        F.lit("F").alias("first_name"),
        (F.col("user_id") * 10).alias("chat_id"),
        F.col("event_id").alias("message_id"),
        "user_id",
        (F.col("user_id") % 2 == 0).alias("is_bot"),
        F.lit("en").alias("language_code"),
    )
    log = event_log.stream_event_log(updates)
    _finish(ingest.ingest_incremental(log, target, progress))
    done = spark.read.schema(log.schema).parquet(target)
    return done.select(*event_log.EVENT_FIELDS).withColumn("message_time", F.date_format("message_time", STAMP))


@query(
    "message_routes",
    """SELECT route, count(*) AS messages FROM (SELECT CASE event_type WHEN 'error' THEN 'command' WHEN 'view' THEN 'photo' ELSE 'text' END AS route FROM events) GROUP BY route""",
)
def message_routes(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        _update_text().alias("message"),
        F.when(F.col("event_type") == "view", F.col("props")).alias("photo"),
    )
    return event_log.with_route(rows, photo="photo").groupBy("route").agg(F.count(F.lit(1)).alias("messages"))


@query("read_refusal_pairs", "SELECT item_id, text AS question, reverse(text) AS answer FROM benchmark")
def read_refusal_pairs(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    # Each document holds one pair, and a question without an answer.
    value = F.to_json(F.struct(F.array("text", F.lit("unanswered")).alias("jailbreak_q"), F.array(F.reverse("text")).alias("jailbreak_ans")))
    path = scratch_path(spark, "refusals")
    _write_documents(items.select("item_id", value.alias("value")), path, "item_id")
    pairs = augmentation.read_refusal_pairs(spark, f"{path}/*/part-*")
    return pairs.join(items.select(F.col("text").alias("question"), "item_id"), "question").select("item_id", "question", "answer")
