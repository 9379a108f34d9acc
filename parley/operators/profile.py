"""Counts and profiles of a message table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.dates import month_key
from parley.schema import DATE, DIALOG, MESSAGE, NO_CONTEXT, SEQ


def _calendar(df: DataFrame, date: str, *parts: str) -> DataFrame:
    take = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    keys = [take[p](F.col(date)).cast("bigint").alias(p) for p in parts]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("messages"))


def _most(counts: DataFrame, key: str) -> DataFrame:
    """The key with the most messages, the smallest one on a tie: a single row."""
    totals = counts.groupBy(key).agg(F.sum("messages").alias("messages"))
    return totals.agg(F.max_by(F.col(key), F.struct(F.col("messages"), -F.col(key))).alias(key))


def messages_by_year(df: DataFrame, date: str = DATE) -> DataFrame:
    return _calendar(df, date, "year")


def messages_by_month_in_top_year(df: DataFrame, date: str = DATE) -> DataFrame:
    """Messages per month of the year with the most messages."""
    counts = _calendar(df, date, "year", "month")
    return counts.join(_most(counts, "year"), "year").select("year", "month", "messages")


def messages_by_day_in_top_month(df: DataFrame, date: str = DATE) -> DataFrame:
    """Messages per day of the busiest month of the busiest year."""
    counts = _calendar(df, date, "year", "month", "day")
    in_year = counts.join(_most(counts, "year"), "year")
    in_month = in_year.join(_most(in_year, "month"), "month")
    return in_month.select("year", "month", "day", "messages")


def daily_counts(df: DataFrame, date: str = DATE) -> DataFrame:
    return _calendar(df, date, "year", "month", "day")


def message_heatmap(df: DataFrame, date: str = DATE, months: Sequence[str] | None = None) -> DataFrame:
    """Messages per day of the month (rows) and month (columns ``yyyy-MM`` in time order).

    Without ``months`` they are looked up first; their number is bounded by the calendar.
    """
    counts = df.groupBy(F.dayofmonth(date).cast("bigint").alias("day"), month_key(F.col(date)).alias("_month"))
    counts = counts.agg(F.count(F.lit(1)).alias("_n")).where(F.col("_month").isNotNull())
    if months is None:
        months = [r[0] for r in counts.select("_month").distinct().orderBy("_month").collect()]
    return counts.groupBy("day").pivot("_month", list(months)).agg(F.sum("_n"))


def text_profile(df: DataFrame, column: str = MESSAGE, order: Sequence[str] = (SEQ,)) -> DataFrame:
    """Rows, nulls, mean and largest length, and the first of the longest texts."""
    length = F.char_length(F.col(column))
    longest = F.min_by(F.col(column), F.when(length.isNotNull(), F.struct((-length).alias("l"), *order)))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(column).isNull()).alias("nulls"),
        F.avg(length).alias("mean_length"),
        F.max(length).cast("bigint").alias("max_length"),
        longest.alias("longest"),
    )


def null_count(df: DataFrame) -> DataFrame:
    """Null cells over all columns."""
    cells: Column = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    return df.agg(F.coalesce(F.sum(cells), F.lit(0)).alias("nulls"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"))


def message_totals(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("messages"))


def context_gap_count(df: DataFrame, context: str = "context") -> DataFrame:
    return df.agg(F.count_if(F.col(context) == NO_CONTEXT).alias("gaps"))


def structure_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows per dialog before and after a step, and how many were merged or dropped."""
    def count(df, name):
        return df.groupBy(DIALOG).agg(F.count(F.lit(1)).alias(name))

    both = count(before, "rows_in").join(count(after, "rows_out"), DIALOG, "left")
    both = both.withColumn("rows_out", F.coalesce("rows_out", F.lit(0)))
    return both.withColumn("removed", F.col("rows_in") - F.col("rows_out"))
