"""All sources in one message table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collect_sources(*tables: DataFrame, **named: DataFrame) -> DataFrame:
    """Union of message tables by column name; named ones get their name in ``source``."""
    parts = [*tables, *[df.withColumn("source", F.lit(name)) for name, df in named.items()]]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
