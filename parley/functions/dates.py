"""Dates, durations and calendar keys as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried in this order for columns that mix several.
MIXED_FORMATS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][XXX]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "yyyy-MM-dd",
    "dd.MM.yyyy HH:mm[:ss]",
    "MM/dd/yyyy HH:mm[:ss]",
)


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a timestamp; null where it is none."""
    return F.try_to_timestamp(text)


def parse_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def parse_mixed(text: Column, formats: Sequence[str] = MIXED_FORMATS) -> Column:
    return F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def whole_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.floor(micros / 1_000_000).cast("bigint")


def day_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")
