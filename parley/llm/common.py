"""Small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of text that a Python worker looks at together.
PIECE = 1 << 20


def pieces(parts: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The rows of ``parts`` in slices with about ``limit`` bytes in ``column``, or one longer row.

    A batch is bounded by its rows, whatever their size; what is made of a slice is bounded by bytes.
    Memory goes back after every batch, so that a worker does not keep what its longest one took.
    """
    for part in parts:
        sizes = pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        first = 0
        while first < part.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield part.slice(first, last - first)
            first = last
        del part
        pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """True for rows whose crc32 of the id, as text, leaves ``part``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def unit_draw(*columns: Column | str) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) * F.lit(2.0**-53)


def boxed(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` beside the whole row as ``_row``, so that no other column name can clash."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), *columns)


def unboxed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col("_row").getField(c).alias(c) for c in columns])
