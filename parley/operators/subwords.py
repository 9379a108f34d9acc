"""Subword ids from a given vocabulary, and texts back from ids.

Nothing is trained here: the vocabulary is a file, whose path is a parameter.  The driver reads it
once and sends it to the tasks (a few megabytes, whatever the table).  Texts go through the
tokenizer in Arrow batches; there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Stands at padded places of labels, which a loss then leaves out (a fixed value of the trainers).
IGNORED = -100
#: Bytes of text that the tokenizer gets at once.
CALL_BYTES = 1 << 18


def _loaded(contents: bytes):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(contents.decode())
    # Strings of special tokens inside a text are ordinary text.
    tokenizer.encode_special_tokens = True
    return tokenizer


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _slices(part: pa.RecordBatch, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """``part`` in slices of about ``CALL_BYTES`` bytes of text, or one longer row."""
    sizes = sum(pc.fill_null(pc.binary_length(part.column(c)), 0).to_numpy(zero_copy_only=False) for c in columns)
    first = size = 0
    for i, n in enumerate(sizes.tolist()):
        if size and size + n > CALL_BYTES:
            yield part.slice(first, i - first)
            first, size = i, 0
        size += n
    if first < part.num_rows:
        yield part.slice(first)


def encode_subwords(
    df: DataFrame, columns: dict[str, tuple[str, int | None]], vocabulary: str = VOCABULARY, pad_id: int | None = None
) -> DataFrame:
    """Add token ids: ``{text column: (output, length)}``; with a length also ``<output>_mask``.

    With a length, ids are cut and padded to it by ``pad_id`` (by default the vocabulary's last id,
    its end-of-text token) and the mask is 1 where a token stands; without one (None) they are as
    long as the text.  A null text has no tokens.  Every id decodes back to its bytes: no text has
    unknown tokens.
    """
    contents = df.sparkSession.sparkContext.broadcast(_read(vocabulary))
    pad = pad_id if pad_id is not None else _loaded(contents.value).get_vocab_size(with_added_tokens=True) - 1
    names, sources = df.columns, list(columns)
    texts = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), *[F.col(f"`{c}`").cast("string").alias(f"_t{i}") for i, c in enumerate(sources)])
    added = [(out, "array<int>") for out, _ in columns.values()] + [(f"{out}_mask", "array<int>") for out, length in columns.values() if length]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _loaded(contents.value)
        for part in parts:
            for piece in _slices(part, [f"_t{i}" for i in range(len(sources))]):
                ids, masks = [], []
                for i, (_, length) in enumerate(columns.values()):
                    found = tokenizer.encode_batch_fast([t or "" for t in piece.column(f"_t{i}").to_pylist()], add_special_tokens=False)
                    rows = [e.ids[:length] for e in found]
                    if length:
                        masks.append(pa.array([[1] * len(r) + [0] * (length - len(r)) for r in rows], pa.list_(pa.int32())))
                        rows = [r + [pad] * (length - len(r)) for r in rows]
                    ids.append(pa.array(rows, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([piece.column("_row"), *ids, *masks], names=["_row", *[f"_o{i}" for i in range(len(added))]])

    shape = texts.schema["_row"].dataType.simpleString()
    found = texts.mapInArrow(run, f"_row {shape}, " + ", ".join(f"_o{i} {kind}" for i, (_, kind) in enumerate(added)))
    return found.select(*[F.col("_row").getField(c).alias(c) for c in names], *[F.col(f"_o{i}").alias(out) for i, (out, _) in enumerate(added)])


def decode_subwords(df: DataFrame, column: str, out: str, vocabulary: str = VOCABULARY, mask: str | None = None) -> DataFrame:
    """Add ``out``, the text behind the ids in ``column`` (only where ``mask`` is 1, if given); null ids stay null."""
    contents = df.sparkSession.sparkContext.broadcast(_read(vocabulary))
    names = df.columns
    ids = F.col(column)
    if mask:
        ids = F.transform(F.filter(F.arrays_zip(F.col(column).alias("i"), F.col(mask).alias("m")), lambda x: x["m"] == 1), lambda x: x["i"])
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), ids.alias("_ids"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _loaded(contents.value)
        for part in parts:
            texts = [tokenizer.decode(r, skip_special_tokens=False) if r is not None else None for r in part.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(texts, pa.string())], names=["_row", "_out"])

    shape = rows.schema["_row"].dataType.simpleString()
    return rows.mapInArrow(run, f"_row {shape}, _out string").select(*[F.col("_row").getField(c).alias(c) for c in names], F.col("_out").alias(out))


def training_features(
    df: DataFrame, ids: Sequence[str], max_length: int = 512, target_max_length: int = 128, vocabulary: str = VOCABULARY, pad_id: int | None = None,
    ignore_padding: bool = False,
) -> DataFrame:
    """input_ids, attention_mask and labels of rendered rows (``input_text``, ``output_text``).

    Inputs and targets are cut and padded to their lengths; ``ignore_padding`` puts ``IGNORED`` at
    the padded places of the labels.
    """
    columns = {"input_text": ("input_ids", max_length), "output_text": ("labels", target_max_length)}
    found = encode_subwords(df.select(*ids, "input_text", "output_text"), columns, vocabulary, pad_id)
    labels = F.col("labels")
    if ignore_padding:
        labels = F.zip_with("labels", "labels_mask", lambda i, m: F.when(m == 1, i).otherwise(F.lit(IGNORED)))
    return found.select(*ids, "input_ids", F.col("input_ids_mask").alias("attention_mask"), labels.alias("labels"))
