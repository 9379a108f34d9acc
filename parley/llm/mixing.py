"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

Every source gets a target in words.  A document of a source should appear ``target / size of the
source`` times on average: the whole part of that number holds for all its documents, the
fractional part is rounded to 0 or 1 per document so that the words of the source stay put:

* Two documents with undecided mass (fraction * words) play a duel: words move from one to the
  other until one document has none or all of its own; the direction is drawn so that the
  expectation of both stays as it was.  The decided one leaves, the other keeps the remainder.
* The duels form a tree: hashed buckets of about ``FAN`` documents leave one remainder each, the
  remainders of ``FAN`` neighbouring buckets meet on the next level, up to one per source.  Only
  that last one is rounded by itself, to the nearer side, so a source misses its target by half
  a document at most.

A source with a third of all rows has as many more buckets; no task or group sees more than a
bucket.  All draws are hashes of ids, so that reruns and recomputed tasks agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import WORD, boxed, unboxed, unit_draw
from parley.plans.ranking import with_position
from parley.plans.scratch import settle

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
FAN = 16
SEED = 20_011

_ITEM = "struct<size:bigint,doc_id:bigint,ord:bigint,mass:double>"
_DECIDED = "array<struct<size:bigint,doc_id:bigint,ord:bigint,extra:bigint>>"


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Targets per source from (source, size) rows: source, n_docs, source_size, target.

    Sources in code point order, null last, weigh ``weights``, repeating.  They share the sum of
    all sizes by weight; a target stops at ``max_repeat`` times its source's size and the excess
    is shared again by weight, until none is above.  Each round is one aggregate over the sources.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    sources = sources.withColumn("_null", F.col("source").isNull())
    placed = with_position(sources, "_pos", ["_null", "source"])
    weight = F.array(*[F.lit(w) for w in weights])[((F.col("_pos") - 1) % len(weights)).cast("int")]
    placed = settle(placed.select("source", "n_docs", "source_size", weight.alias("_weight")), "mix-sources")
    cap = F.col("source_size") * max_repeat
    total, all_weights = placed.agg(F.sum("source_size"), F.sum("_weight")).first()
    share, full = (total / all_weights if total else 0.0), -1
    while total:
        above = cap < F.col("_weight") * share
        fixed, free, count = placed.agg(
            F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("_weight"))), F.count_if(above)
        ).first()
        if count == full or not free:
            break
        share, full = (total - fixed) / free, count
    target = F.least(cap.cast("double"), F.col("_weight") * F.lit(float(share)))
    return placed.select("source", "n_docs", "source_size", target.alias("target"))


def _duel(state: Column, b: Column) -> Column:
    """Let the undecided document of ``state`` meet ``b``."""
    def item(x: Column, mass: Column) -> Column:
        return F.struct(x["size"].alias("size"), x["doc_id"].alias("doc_id"), x["ord"].alias("ord"), mass.alias("mass")).cast(_ITEM)

    def out(x: Column, extra: int) -> Column:
        one = F.struct(x["size"], x["doc_id"], x["ord"], F.lit(extra).cast("bigint"))
        return F.concat(state["out"], F.array(one).cast(_DECIDED))

    def after(keep: Column, decided: Column) -> Column:
        return F.struct(keep.alias("cur"), decided.alias("out"))

    a = state["cur"]
    up = F.least(a["size"] - a["mass"], b["mass"])  # words that a can take from b
    down = F.least(a["mass"], b["size"] - b["mass"])
    draw = unit_draw(a["doc_id"], a["ord"], b["doc_id"], b["ord"], F.lit(SEED))
    fills = a["size"] - a["mass"] <= b["mass"]
    empties = a["mass"] <= b["size"] - b["mass"]
    return (
        F.when(a.isNull(), after(b.cast(_ITEM), state["out"]))
        .when(
            draw * (up + down) < down,
            F.when(fills, after(item(b, b["mass"] - up), out(a, 1))).otherwise(after(item(a, a["mass"] + up), out(b, 0))),
        )
        .otherwise(F.when(empties, after(item(b, b["mass"] + down), out(a, 0))).otherwise(after(item(a, a["mass"] - down), out(b, 1))))
    )


def _level(items: DataFrame) -> DataFrame:
    """One level of the tree: a row per (source, bucket) with the remainder and the decided ones."""
    start = F.struct(F.lit(None).cast(_ITEM).alias("cur"), F.array().cast(_DECIDED).alias("out"))
    entrants = F.sort_array(F.collect_list(F.struct("size", "doc_id", "ord", "mass").cast(_ITEM)), asc=False)
    bucketed = items.groupBy("source", "bucket", "levels").agg(entrants.alias("_entrants"))
    done = F.aggregate("_entrants", start, _duel)
    return bucketed.select("source", "bucket", "levels", done.alias("_done"))


def round_copies(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Copies per document: source, doc_id, size, ord, r, source_size, target, copies.

    ``rows`` has source, doc_id and size.  ``r`` rows that agree in all three are told apart by
    ``ord`` (1 to r).  Documents without words get the whole part of their copies.
    """
    units = settle(rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("r")), "mix-units")
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    wanted = targets.select(F.col("source").alias("_source"), "n_docs", "source_size", "target")
    placed = units.join(wanted, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    placed = placed.withColumn("whole", F.floor(rate)).withColumn("mass", (rate - F.col("whole")) * F.col("size"))
    placed = placed.withColumn("ord", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("r"))))
    undecided = (F.col("size") > 0) & (F.col("mass") > 0)
    buckets = F.greatest(F.ceil(F.col("n_docs") / FAN), F.lit(1))
    items = placed.where(undecided).select(
        "source", "doc_id", "size", "ord", "mass",
        F.pmod(F.xxhash64("doc_id", "ord", F.lit(SEED)), buckets).alias("bucket"),
        F.lit(0).alias("levels"),
    )
    levels = 1 + max(0, math.ceil(math.log(max(1, -(-most // FAN)), FAN)))
    decided = None
    for level in range(levels):
        folded = settle(_level(items), "mix-level")
        out = folded.select("source", F.explode("_done.out").alias("_d")).select("source", "_d.doc_id", "_d.size", "_d.ord", "_d.extra")
        decided = out if decided is None else decided.unionByName(out)
        left = folded.where(F.col("_done.cur").isNotNull())
        items = left.select("source", "_done.cur.doc_id", "_done.cur.size", "_done.cur.ord", "_done.cur.mass",
                            F.expr(f"bucket div {FAN}").alias("bucket"), F.lit(level + 1).alias("levels"))
    last = F.col("mass") * 2 >= F.col("size")
    decided = decided.unionByName(items.select("source", "doc_id", "size", "ord", last.cast("bigint").alias("extra")))
    counts = units.select(F.col("source").alias("_s"), F.col("doc_id").alias("_d"), F.col("size").alias("_z"), "r").where("r > 1")
    free = placed.where(~undecided).select("source", "doc_id", "size", "ord", F.lit(0).cast("bigint").alias("extra"))
    rate = F.col("target") / F.col("source_size")
    copies = F.when(F.col("source_size") > 0, F.floor(rate)).otherwise(F.lit(0)) + F.col("extra")
    joined = decided.unionByName(free).join(wanted, F.col("source").eqNullSafe(F.col("_source")))
    repeated = F.col("source").eqNullSafe(F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("size") == F.col("_z"))
    return joined.join(counts, repeated, "left").select(
        "source", "doc_id", "size", "ord", F.coalesce("r", F.lit(1).cast("bigint")).alias("r"),
        "source_size", "target", copies.cast("bigint").alias("copies"),
    )


def document_sizes(docs: DataFrame) -> DataFrame:
    """source, doc_id and size (number of words, 0 for null) of ``docs``."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select("source", F.col("doc_id").cast("bigint").alias("doc_id"), size.alias("size"))


def mix_sizes(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """What the mix takes of each row of ``docs``: doc_id, size, source_size, target, taken, copies.

    Null text has size 0, a null source is a source of its own (the last one), a null id is an id
    like any other, repeated rows are decided one by one, an empty table gives no rows; further
    columns are not looked at.
    """
    rows = settle(document_sizes(docs), "mix-rows")
    copies = round_copies(rows, source_targets(rows, weights, max_repeat))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return copies.select("doc_id", "size", "source_size", "target", taken, "copies")


def mix_documents(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mixed table: the rows of ``docs``, each as often as the mix takes it (see ``mix_sizes``)."""
    rows = settle(document_sizes(docs), "mix-rows")
    copies = settle(round_copies(rows, source_targets(rows, weights, max_repeat)).where("copies > 0 OR r > 1"), "mix-copies")
    keyed = boxed(docs, "source", F.col("doc_id").cast("bigint").alias("doc_id"),
                  F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))
    wanted = copies.select(F.col("source").alias("_s"), F.col("doc_id").alias("_d"), F.col("size").alias("_z"),
                           F.col("ord").alias("_ord"), "r", "copies")
    same = F.col("source").eqNullSafe(F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("size") == F.col("_z"))
    picked = keyed.join(wanted.where("r = 1"), same).select("_row", "copies")
    several = wanted.where("r > 1")
    if not several.isEmpty():
        again = keyed.join(several.where("_ord = 1"), same, "left_semi")
        order = Window.partitionBy("source", "doc_id", "size").orderBy(F.xxhash64("_row"))
        again = again.withColumn("_nth", F.row_number().over(order))
        picked = picked.unionByName(again.join(several, same & (F.col("_nth") == F.col("_ord"))).select("_row", "copies"))
    repeated = picked.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return unboxed(repeated, docs.columns)
