"""Discord: one JSON array of messages per channel, named ``messages.json``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.dates import parse_mixed
from parley.schema import DATE, DIALOG, MESSAGE, SEQ
from parley.sources.files import BROKEN, file_ranks

EXPORT_SCHEMA = "Timestamp STRING, Contents STRING"
FILE_NAME = "messages.json"


def read_discord(spark: SparkSession, path: str, first_only: bool = False, file_name: str = FILE_NAME, broken: str = "fail") -> DataFrame:
    """Message rows of all channels below ``path``; ``first_only`` takes the first of each file.

    A channel's array is one value while its file is parsed, so that list positions are known.  A
    file that is no such array ends the job; ``broken="skip"`` leaves it out.
    """
    texts = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_name)
        .text(path, wholetext=True)
        .withColumn("_file", F.col("_metadata.file_path"))
    )
    if broken not in BROKEN:
        raise ValueError(f"broken must be one of {BROKEN}")
    ranks = file_ranks(spark, path, glob=file_name)
    mode = {"mode": "FAILFAST" if broken == "fail" else "PERMISSIVE"}
    parsed = F.from_json("value", f"ARRAY<STRUCT<{EXPORT_SCHEMA.replace(' STRING', ': STRING')}>>", mode)
    rows = texts.join(ranks, "_file").select("_rank", F.posexplode(parsed).alias("at", "m"))
    if first_only:
        rows = rows.where(F.col("at") == 0)
    return rows.select(
        F.concat(F.lit("D_"), (F.col("_rank") - 1).cast("string")).alias(DIALOG),
        F.col("m.Contents").alias(MESSAGE),
        parse_mixed(F.col("m.Timestamp")).alias(DATE),
        F.col("at").cast("bigint").alias(SEQ),
    )
