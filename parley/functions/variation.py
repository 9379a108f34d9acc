"""Random edits of one text: clause shuffle, word swap, word removal, choice of edits.

``parts`` are the columns that identify one draw, usually a row id and a round number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.binding import let
from parley.functions.draws import draw_key, uniform
from parley.functions.text import remove_stopwords, split_clauses, squeeze_commas, tokenize

# Edits in the order in which the chosen ones are applied, with their drawing weights.
EDITS = ("translate", "shuffle", "pop", "swap")
WEIGHTS = (0.1, 0.3, 0.3, 0.3)


def _keyed(items: Column, seed, *parts: Column) -> Column:
    """``items`` as structs (key, position, item); sorting them puts the items in random order."""
    return F.transform(items, lambda item, i: F.struct(draw_key(seed, *parts, i).alias("k"), i.alias("i"), item.alias("item")))


def shuffle_clauses(text: Column, seed, *parts: Column) -> Column:
    """Comma-separated clauses in random order."""
    shuffled = F.sort_array(_keyed(split_clauses(squeeze_commas(text)), f"{seed}-shuffle", *parts))
    return F.array_join(F.transform(shuffled, lambda s: s["item"]), ", ")


def swap_words(text: Column, seed, *parts: Column) -> Column:
    """Exchange two random tokens; a text of fewer than two tokens stays as it is."""
    def swapped(tokens, picked):
        first, second = F.get(picked, F.lit(0)), F.get(picked, F.lit(1))
        return F.transform(
            tokens,
            lambda w, i: F.when(i == first["i"], second["item"]).when(i == second["i"], first["item"]).otherwise(w),
        )

    def edit(tokens):
        joined = let(F.sort_array(_keyed(tokens, f"{seed}-swap", *parts)), lambda picked: F.array_join(swapped(tokens, picked), " "))
        return F.when(F.size(tokens) < 2, text).otherwise(joined)

    return let(tokenize(text), edit)


def pop_word(text: Column, stop_words: Sequence[str], seed, *parts: Column) -> Column:
    """Remove the first occurrence of a random token that is no stop word, if there is one."""
    def without(tokens, chosen):
        kept = let(F.array_position(tokens, chosen), lambda at: F.filter(tokens, lambda w, i: i + 1 != at))
        return F.when(chosen.isNull(), text).otherwise(F.array_join(kept, " "))

    def edit(tokens):
        candidates = _keyed(remove_stopwords(tokens, stop_words), f"{seed}-pop", *parts)
        return let(F.array_min(candidates)["item"], lambda chosen: without(tokens, chosen))

    return let(tokenize(text), edit)


def choose_edits(seed, *parts: Column, weights: Sequence[float] = WEIGHTS, edits: Sequence[str] = EDITS) -> Column:
    """Between one and all of ``edits``, drawn by weight without replacement, in fixed order.

    Exponential keys -ln(u)/w: taking the smallest ones is weighted drawing without replacement.
    """
    count = F.floor(uniform(f"{seed}-count", *parts) * len(edits)).cast("int") + 1
    keyed = F.array(
        *[
            F.struct(
                (-F.log(uniform(f"{seed}-edit", *parts, F.lit(name))) / F.lit(float(w))).alias("k"),
                F.lit(i).alias("i"),
                F.lit(name).alias("name"),
            )
            for i, (name, w) in enumerate(zip(edits, weights))
        ]
    )
    drawn = F.slice(F.sort_array(keyed), F.lit(1), count)
    in_order = F.sort_array(F.transform(drawn, lambda s: F.struct(s["i"].alias("i"), s["name"].alias("name"))))
    return F.transform(in_order, lambda s: s["name"])
