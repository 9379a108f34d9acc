"""Training frames: labels, prompts, vocabulary, fixed-length token ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.dates import parse_mixed
from parley.functions.prompts import labels_for, render_prompt
from parley.functions.text import strip_text, tokenize
from parley.plans.ranking import with_position
from parley.plans.scratch import settle
from parley.schema import NO_CONTEXT

MAX_LENGTH = 512
TARGET_MAX_LENGTH = 128

# Ids below FIRST_WORD_ID are reserved.
PAD_ID = 0
UNKNOWN_ID = 1
FIRST_WORD_ID = 2
# Ids are integers of 32 bits.
_ID_RANGE = 1 << 32

# A lookup table of up to this many rows is broadcast; a larger one is joined by shuffle.
MAX_BROADCAST_ROWS = 200_000
# Forms whose rows are not shuffled by form; any other has less than a ten-thousandth of the rows.
FREQUENT_FORMS = 10_000


def prepare_training_frame(df: DataFrame) -> DataFrame:
    """Lower-case and trim question and context, parse timestamps of mixed formats."""
    trimmed = {c: strip_text(F.lower(F.col(c).cast("string"))) for c in ("question", "context")}
    parsed = parse_mixed(F.col("timestamp").cast("string"))
    return df.withColumns({**trimmed, "timestamp": parsed})


def localize_context(df: DataFrame, language: str = "uk") -> DataFrame:
    """Put the language's own words for a missing context."""
    label = labels_for(language).no_context
    return df.withColumn("context", F.when(F.col("context") == NO_CONTEXT, label).otherwise(F.col("context")))


def render_prompts(df: DataFrame, prompt: str = "", language: str = "uk", template: str = "full") -> DataFrame:
    """Add ``input_text`` and ``output_text``."""
    text = render_prompt(F.col("question"), F.col("context"), prompt, language, template)
    return df.withColumns({"input_text": text, "output_text": F.col("answer")})


def size_checked(lookup: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``lookup`` marked for broadcast if it is small; otherwise as it is, so that the join
    shuffles and AQE splits its frequent keys."""
    return F.broadcast(lookup) if lookup.limit(max_rows + 1).count() <= max_rows else lookup


def build_vocab(df: DataFrame, columns: Sequence[str], max_size: int | None = None) -> DataFrame:
    """Tokens with counts and ids, the most frequent first, ties in alphabetical order.

    ``max_size`` fixes the size of the vocabulary; rarer tokens are encoded as unknown.
    """
    tokens = F.flatten(F.array(*[F.coalesce(tokenize(F.lower(F.col(c))), F.array().cast("array<string>")) for c in columns]))
    counts = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    # Ranking reads its input several times (count, sample, sort); the texts are read once.
    counts = settle(counts.withColumn("_rare", -F.col("count")), "token-counts")
    ranked = with_position(counts, "_pos", ("_rare", "token"))
    vocab = ranked.select("token", "count", (F.col("_pos") + (FIRST_WORD_ID - 1)).alias("id"))
    return vocab.where(F.col("id") < FIRST_WORD_ID + max_size) if max_size else vocab


def encode_fixed(
    df: DataFrame,
    ids: Sequence[str],
    vocab: DataFrame,
    columns: dict[str, tuple[str, int]],
) -> DataFrame:
    """Token ids of fixed length, one array per column: ``{text column: (output, length)}``.

    Texts are cut and padded to the length, which is the point of the encoding; so a group that
    is put together again after the lookup is never longer than that.
    """
    keys, lengths = list(ids), [length for _, length in columns.values()]
    starts = [sum(lengths[:n]) for n in range(len(lengths))]

    def cut(column: str, start: int, length: int):
        tokens = F.coalesce(tokenize(F.lower(F.col(column))), F.array().cast("array<string>"))
        return F.transform(
            F.slice(tokens, F.lit(1), F.lit(length)),
            lambda w, i: F.struct((F.lit(start) + i).cast("bigint").alias("place"), w.alias("token")),
        )

    cells = F.concat(*[cut(c, start, length) for c, start, length in zip(columns, starts, lengths)])
    # Cut texts are read twice, once for the frequent tokens and once for the others.
    texts = settle(df.select(*keys, cells.alias("_cells")), "cells")
    tokens = texts.select(*keys, F.explode("_cells").alias("cell")).select(*keys, "cell.*")
    known = _with_ids(tokens, vocab.select("token", F.col("id").cast("int").alias("_id")))
    # Place and id in one number: it sorts by place, and a row of the exchange is as short as can be.
    packed = F.col("place") * _ID_RANGE + (F.coalesce("_id", F.lit(UNKNOWN_ID)).cast("bigint") + _ID_RANGE // 2)
    # Dealt out by the row before anything is gathered, so that no task gathers twice.
    rows = known.select(*keys, packed.alias("_cell")).repartition(*keys)
    rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("_cell")).alias("_cells"))
    rows = df.select(*keys).join(rows, keys, "left")

    def padded(start: int, length: int):
        found = F.coalesce(F.col("_cells"), F.array().cast("array<bigint>"))
        mine = F.filter(found, lambda c: (c >= start * _ID_RANGE) & (c < (start + length) * _ID_RANGE))
        mine = F.transform(mine, lambda c: (c % _ID_RANGE - _ID_RANGE // 2).cast("int"))
        return F.slice(F.concat(mine, F.array_repeat(F.lit(PAD_ID), length)), F.lit(1), F.lit(length))

    outs = [out for out, _ in columns.values()]
    return rows.select(*keys, *[padded(*x).alias(out) for out, *x in zip(outs, starts, lengths)])


def _with_ids(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """``tokens`` with the ``_id`` of each token, null where ``vocab`` lacks it.

    A join by shuffle brings all rows of a token to one task, to be sorted there.  So a vocabulary that
    is too large to broadcast is cut by id: the lowest ids, which ``build_vocab`` gives to the most
    frequent tokens, are broadcast, and only rows of the others are shuffled by token.
    """
    if vocab.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        return tokens.join(F.broadcast(vocab), "token", "left")
    is_low = F.col("_id") < FIRST_WORD_ID + MAX_BROADCAST_ROWS
    low = size_checked(vocab.where(is_low).withColumnRenamed("_id", "_low"))
    found = tokens.join(low, "token", "left")
    rest = found.where(F.col("_low").isNull()).drop("_low").join(vocab.where(~is_low), "token", "left")
    return found.where(F.col("_low").isNotNull()).withColumnRenamed("_low", "_id").unionByName(rest)


def normalize_tokens(df: DataFrame, column: str, lookup: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Replace each token by its entry in ``lookup`` (form, lemma) and join by one space.

    A form that is listed several times takes its first lemma in alphabetical order.
    """
    keys = list(ids)
    texts = df.select(*keys, tokenize(F.col(column)).alias("_tokens"))
    forms = lookup.groupBy("form").agg(F.min("lemma").alias("lemma"))
    if forms.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        found = texts.select(*keys, F.posexplode("_tokens").alias("at", "form")).join(F.broadcast(forms), "form", "left")
    else:
        # As in ``_with_ids``: the most frequent forms are not shuffled.  A form without a lemma is its own.
        texts, forms = settle(texts, "tokens"), settle(forms, "forms")
        tokens = texts.select(*keys, F.posexplode("_tokens").alias("at", "form"))
        counts = tokens.groupBy("form").agg(F.count(F.lit(1)).alias("n"))
        frequent = settle(counts.orderBy(F.desc("n"), "form").limit(FREQUENT_FORMS).select("form"), "frequent")
        frequent = settle(frequent.join(forms, "form", "left").select("form", F.coalesce("lemma", "form").alias("_lemma")), "frequent-lemmas")
        marked = tokens.join(F.broadcast(frequent), "form", "left")
        rest = marked.where(F.col("_lemma").isNull()).drop("_lemma").join(forms, "form", "left")
        found = marked.where(F.col("_lemma").isNotNull()).withColumnRenamed("_lemma", "lemma").unionByName(rest)
    changed = found.select(*keys, "at", F.coalesce("lemma", "form").alias("w"))
    texts = changed.groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("at", "w")))["w"], " ").alias("_text")
    )
    return df.join(texts, keys, "left").withColumn(column, F.coalesce("_text", F.substring(column, 1, 0))).drop("_text")
