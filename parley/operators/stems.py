"""Stems without a word list: endings are learnt from the words of a table.

A word is cut at every place of its last ``MAX_ENDING`` characters.  A beginning that several words
share has several continuations (its successor variety), an ending that many such beginnings share
is a rule.  The cut of a word is the one whose ending is backed by the most beginnings; words with
the same stem form a group, whose shortest word is the lemma.  The result is a table (form, lemma)
for ``encoding.normalize_tokens``.

All of it is aggregates over the distinct words, at most ``MAX_ENDING`` + 1 rows a word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.encoding import tokenize
from parley.plans.scratch import settle

#: Longest ending, and shortest stem, in characters.
MAX_ENDING = 5
MIN_STEM = 4
#: Beginnings that must back an ending, and different characters that must stand before it.
MIN_BEGINNINGS = 5
MIN_BEFORE = 3


def word_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(word, count) of the tokens of ``columns`` in lower case that are letters only; null texts have none."""
    tokens = F.flatten(F.array(*[F.coalesce(tokenize(F.lower(c)), F.array().cast("array<string>")) for c in columns]))
    words = df.select(F.explode(tokens).alias("word")).where(F.col("word").rlike(r"^[\p{L}\p{M}]+$"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def word_cuts(words: DataFrame, max_ending: int = MAX_ENDING, min_stem: int = MIN_STEM) -> DataFrame:
    """(stem, ending) for every cut of a word with a stem of ``min_stem`` characters or more."""
    size = F.char_length("word")
    longest = F.least(F.lit(max_ending), size - min_stem)
    cuts = words.where(size >= min_stem).select("word", F.explode(F.sequence(F.lit(0), longest)).alias("n"))
    return cuts.select(F.substr("word", F.lit(1), size - F.col("n")).alias("stem"), F.substr("word", size - F.col("n") + 1).alias("ending"))


def learn_endings(cuts: DataFrame, min_beginnings: int = MIN_BEGINNINGS, min_before: int = MIN_BEFORE) -> DataFrame:
    """(ending, beginnings): endings of stems that go on in at least two ways, and how many such stems there are."""
    one_stem, next_letter = Window.partitionBy("stem"), F.substr("ending", F.lit(1), F.lit(1))
    # More than one continuation: the first and the last of them differ.
    varied = F.min(next_letter).over(one_stem) != F.max(next_letter).over(one_stem)
    shared = cuts.withColumn("varied", varied).where("varied").withColumn("letter", F.right("stem", F.lit(1)))
    by_letter = shared.groupBy("ending", "letter").agg(F.count(F.lit(1)).alias("n"))
    endings = by_letter.groupBy("ending").agg(F.sum("n").alias("beginnings"), F.count(F.lit(1)).alias("before"))
    return endings.where((F.col("beginnings") >= min_beginnings) & (F.col("before") >= min_before)).select("ending", "beginnings")


def learn_stems(words: DataFrame, max_ending: int = MAX_ENDING, min_stem: int = MIN_STEM,
                min_beginnings: int = MIN_BEGINNINGS, min_before: int = MIN_BEFORE) -> DataFrame:
    """(form, stem, ending, lemma) of every word that shares its stem with another one.

    ``words``: (word, count), one row a word.  A cut counts if its ending is a rule and its stem has
    another word with such an ending.  A word takes the cut with the most words times beginnings
    of its ending, then the longer stem; the lemma of a stem is its shortest word, then the most
    frequent, then the first by code points.  The result does not depend on the order of rows; null
    words are left out; an empty table gives no rows.
    """
    # Words come from whole texts and are needed several times, so they are written once.
    words = settle(words.where(F.col("word").isNotNull()), "words")
    cuts = word_cuts(words, max_ending, min_stem)
    endings = settle(learn_endings(cuts, min_beginnings, min_before), "endings")
    one_stem = Window.partitionBy("stem")
    ruled = cuts.join(endings, "ending").withColumn("words", F.count(F.lit(1)).over(one_stem)).where("words > 1")
    cut = F.struct((F.col("words") * F.col("beginnings")).alias("weight"), F.char_length("stem").alias("size"), "stem", "ending")
    best = ruled.groupBy(F.concat("stem", "ending").alias("word")).agg(F.max(cut).alias("best"))
    placed = settle(best.select("word", "best.stem", "best.ending").join(words, "word"), "stems")
    lemma = placed.groupBy("stem").agg(
        F.min(F.struct(F.char_length("word").alias("size"), (-F.col("count")).alias("less"), F.col("word"))).alias("first"), F.count(F.lit(1)).alias("n"))
    grouped = placed.join(lemma.where("n > 1"), "stem")
    return grouped.select(F.col("word").alias("form"), "stem", "ending", F.col("first.word").alias("lemma"))


def stem_lemmas(df: DataFrame, columns: Sequence[str], **limits) -> DataFrame:
    """(form, lemma) learnt from the texts of ``columns``, for ``normalize_tokens`` and ``evaluate_pairs``."""
    return learn_stems(word_counts(df, columns), **limits).select("form", "lemma")
