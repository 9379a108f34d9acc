"""Chat updates: routing and the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The fields kept for each update, in log order.
EVENT_FIELDS = (
    "message",
    "answer",
    "message_time",
    "user_id",
    "username",
    "first_name",
    "last_name",
    "chat_id",
    "message_id",
    "is_bot",
    "language_code",
)


def with_route(df: DataFrame, text: str = "message", photo: str | None = None) -> DataFrame:
    """Add ``route``: ``command`` for text that starts with a slash, ``text``, ``photo`` or ``other``."""
    body = F.col(text)
    spoken = F.coalesce(body != "", F.lit(False))
    route = F.when(spoken & body.startswith("/"), "command").when(spoken, "text")
    if photo is not None:
        route = route.when(F.col(photo).isNotNull(), "photo")
    return df.withColumn("route", route.otherwise("other"))


def stream_event_log(df: DataFrame) -> DataFrame:
    """The text updates with exactly the logged fields; a missing field is null."""
    present = set(df.columns)
    fields = [F.col(f) if f in present else F.lit(None).cast("string").alias(f) for f in EVENT_FIELDS]
    return with_route(df).where(F.col("route") == "text").select(*fields)
