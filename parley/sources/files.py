"""Files: JSON documents, CSV tables, chunks, word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parley.plans.ranking import with_position
from parley.plans.scratch import settle
from parley.schema import MESSAGE_SCHEMA

SAVE_MODES = ("errorifexists", "overwrite", "ignore")


CORRUPT = "_corrupt"
BROKEN = ("fail", "skip")


def json_documents(
    spark: SparkSession,
    path: str,
    schema: str,
    file_pattern: str | None = None,
    glob: str | None = None,
    dir_pattern: str | None = None,
    broken: str = "fail",
) -> DataFrame:
    """JSON documents below ``path``, one per file, with the file's path as ``_file``.

    ``glob`` selects by file name while listing.  ``file_pattern`` and ``dir_pattern`` are regular
    expressions that have to match from the start of the name of the file, or of one of the
    folders above it.  A document that is no JSON of this schema ends the job; ``broken="skip"``
    leaves it out, and ``broken_documents`` lists what was left out.
    """
    if broken not in BROKEN:
        raise ValueError(f"broken must be one of {BROKEN}")
    reader = _reader(spark, glob).option("multiLine", True)
    if broken == "fail":
        df = reader.schema(schema).option("mode", "FAILFAST").json(path)
    else:
        df = reader.schema(f"{schema}, {CORRUPT} STRING").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    df = _matching(df, file_pattern, dir_pattern).withColumn("_file", F.col("_metadata.file_path"))
    return df if broken == "fail" else df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def broken_documents(
    spark: SparkSession,
    path: str,
    schema: str,
    file_pattern: str | None = None,
    glob: str | None = None,
    dir_pattern: str | None = None,
) -> DataFrame:
    """(path, content) of the documents that ``json_documents`` cannot read."""
    reader = _reader(spark, glob).option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT)
    df = _matching(reader.schema(f"{schema}, {CORRUPT} STRING").json(path), file_pattern, dir_pattern)
    # Spark parses only if a data column is read as well, and the mark is final only once it is written.
    parsed = df.select(F.col("_metadata.file_path").alias("path"), F.col(CORRUPT).alias("content"), F.col(df.columns[0]).isNull().alias("empty"))
    return settle(parsed, "parsed").where(F.col("content").isNotNull()).select("path", "content")


def _reader(spark: SparkSession, glob: str | None):
    reader = spark.read.option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", glob) if glob else reader


def _matching(df: DataFrame, file_pattern: str | None, dir_pattern: str | None) -> DataFrame:
    if file_pattern:
        df = df.where(F.col("_metadata.file_name").rlike(f"^(?:{file_pattern})"))
    if dir_pattern:
        parts = F.split(F.col("_metadata.file_path"), "/")
        folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
        df = df.where(F.exists(folders, lambda folder: folder.rlike(f"^(?:{dir_pattern})")))
    return df


def file_ranks(
    spark: SparkSession,
    path: str,
    file_pattern: str | None = None,
    glob: str | None = None,
    dir_pattern: str | None = None,
) -> DataFrame:
    """``_file`` and its 1-based rank in path order, over the files that match all patterns.

    The listing is a table of paths (no file is opened), ranked by ranges.
    """
    files = _matching(_reader(spark, glob).format("binaryFile").load(path), file_pattern, dir_pattern)
    return with_position(files.select(F.col("_metadata.file_path").alias("_file")), "_rank", ["_file"])


def read_messages_csv(spark: SparkSession, path: str, schema: StructType | str = MESSAGE_SCHEMA, line_breaks: bool = True) -> DataFrame:
    """An interchange CSV with a header.

    Quoted texts may hold line breaks, which makes a file one task's work; where they hold none,
    ``line_breaks=False`` lets Spark split files.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", line_breaks)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def save_dataset(df: DataFrame, path: str, mode: str = "errorifexists", format: str = "csv") -> None:
    """Write a table; ``mode`` says what to do when ``path`` exists."""
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}")
    writer = df.write.mode(mode)
    if format == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(format).save(path)


def write_chunks(df: DataFrame, path: str, chunks: int, mode: str = "errorifexists") -> None:
    """Write ``df`` as ``chunks`` files of about equal size."""
    df.repartition(chunks).write.mode(mode).parquet(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_wordlist(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lower-case words of a text file that separates them by whitespace or commas."""
    words = spark.read.text(path).select(F.explode(F.split(F.lower("value"), r"[\s,]+")).alias("word"))
    return words.where(F.col("word") != "").distinct()


def collect_words(words: DataFrame, limit: int = 100_000) -> list[str]:
    """A word list as Python values for use as literals; refuses lists beyond ``limit``."""
    rows = words.select("word").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"word list longer than {limit}")
    return sorted(r[0] for r in rows)
