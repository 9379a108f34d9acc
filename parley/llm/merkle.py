"""Manifest of a dataset as a Merkle tree, with a proof of inclusion per row.

Every row is a leaf, the leaves of a source form a ternary tree in the order of their ids, and the
roots of the sources form another one.  A leaf's rank in its source is written in base 3: the last
``DIGITS`` digits are columns of their own, the rest names a block of ``SPAN`` leaves.  Blocks are
dealt out by one exchange; then the digits are grouped away from the last to the first, each
grouping nesting the structs of up to three children below the hash of their parent.  Since a block
stays in one task, these groupings need no further exchange.  The roots of the blocks are the leaves
of the next level, until a source has a single block.

Going down again, a block and the path above it meet by grouping on the block's name, and nested
transforms walk through the structs and put the siblings of every step in front of the path.  A
source may hold any share of the rows: nothing is grouped by source alone but one row per block.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.plans.ranking import with_position
from parley.plans.scratch import settle
from parley.plans.sequence import BLOCK, assign_blocks

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGITS = 7
SPAN = 3**DIGITS
ROWS_PER_RANGE = 65_536


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hash of a row: each field as its length in bytes, a colon and its value; ``-`` for null."""
    parts = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields]
    return F.sha2(F.concat(*parts), 256)


def _ranked(leaves: DataFrame) -> DataFrame:
    """Add ``rank`` (from 0) in the leaf's source and ``n``, the leaves of that source.

    Equal rows are told apart by ``at`` only, so that even these spread over the ranges.
    """
    order = ["source", "doc_id", "leaf", "at"]
    ranges = max(1, -(-leaves.count() // ROWS_PER_RANGE))
    ranged = assign_blocks(leaves, order, ranges)
    counts = ranged.groupBy("source", BLOCK).agg(F.count(F.lit(1)).alias("_k"))
    whole = Window.partitionBy("source")
    before = whole.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("source").alias("_source"), F.col(BLOCK).alias("_at_block"),
                            F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_offset"), F.sum("_k").over(whole).alias("n"))
    inside = F.row_number().over(Window.partitionBy(BLOCK, "source").orderBy(*order[1:]))
    placed = ranged.withColumn("_inside", inside)
    same = (F.col(BLOCK) == F.col("_at_block")) & F.col("source").eqNullSafe(F.col("_source"))
    return placed.join(offsets, same).select("source", "n", (F.col("_offset") + F.col("_inside") - 1).alias("rank"),
                                             F.col("leaf").alias("h"), F.struct("doc_id", "other").alias("kids"))


def _nested(nodes: DataFrame) -> DataFrame:
    """One row a block: source, n, up (its place), h and kids (structs nested ``DIGITS`` deep).

    ``nodes``: source, n (nodes of the source), rank, h, kids.  A digit whose level has one node in
    the whole source is not hashed: there the tree has ended.
    """
    digits = [f"d{i}" for i in range(DIGITS)]
    # Dealt out by block; the groupings below then find their rows in place.
    place = [F.expr(f"rank div {3**i} % 3").cast("tinyint").alias(d) for i, d in enumerate(digits)]
    rows = nodes.select("source", "n", F.expr(f"rank div {SPAN}").alias("up"), "h", "kids", *place).repartition("source", "n", "up")
    for level, digit in enumerate(digits):
        keys = ["source", "n", "up", *digits[level + 1 :]]
        rows = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(digit).alias("d"), "h", "kids"))).alias("kids"))
        joined = F.sha2(F.array_join(F.col("kids.h"), ""), 256)
        rows = rows.withColumn("h", F.when(F.col("n") > 3**level, joined).otherwise(F.get(F.col("kids.h"), F.lit(0))))
    return rows


def _steps(kids: Column, path: Column, n: Column) -> Column:
    """Array of (h, kids, path) of the nodes that a block was nested from; paths start at the node."""

    def child(parent: Column, hashed: Column):
        def of(node: Column, i: Column) -> Column:
            hashes = parent["kids"]["h"]
            step = F.struct(F.array_join(F.slice(hashes, 1, i), "").alias("left"), F.array_join(F.slice(hashes, i + 2, 3), "").alias("right"))
            longer = F.when(hashed, F.concat(F.array(step), parent["path"])).otherwise(parent["path"])
            return F.struct(node["h"].alias("h"), node["kids"].alias("kids"), (parent["rank"] * 3 + node["d"]).alias("rank"), longer.alias("path"))

        return of

    def children(hashed: Column):
        return lambda parent: F.transform(parent["kids"], child(parent, hashed))

    found = F.array(F.struct(F.lit("").alias("h"), kids.alias("kids"), F.lit(0).cast("bigint").alias("rank"), path.alias("path")))
    for level in reversed(range(DIGITS)):
        found = F.flatten(F.transform(found, children(n > 3**level)))
    return found


_PATH = "array<struct<left:string,right:string>>"


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """Nested blocks, level by level, until every source has come down to a single block."""
    found = []
    while True:
        blocks = settle(_nested(nodes), "merkle")
        found.append(blocks)
        largest = blocks.agg(F.max("n")).first()[0]
        if not largest or largest <= SPAN:
            return found
        nodes = blocks.where(F.col("n") > SPAN).select(
            "source", F.ceil(F.col("n") / F.lit(SPAN)).cast("bigint").alias("n"), F.col("up").alias("rank"), "h", F.lit(None).cast("string").alias("kids"))


def _tops(levels: list[DataFrame]) -> DataFrame:
    """(source, h): the root of every source."""
    return reduce(DataFrame.unionByName, [blocks.where(F.col("n") <= SPAN).select("source", "h") for blocks in levels])


def _down(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """(source, top, h, kids, path) per node of the lowest level.

    ``above``: source, path from the source's root on, and ``top``, a struct to carry along.
    """
    top = above.schema["top"].dataType.simpleString()
    paths = above.select("source", F.lit(0).cast("bigint").alias("up"), "path", "top")
    nodes = None
    for i, blocks in enumerate(reversed(levels)):
        kids = blocks.schema["kids"].dataType.simpleString()
        lower = blocks.select("source", "up", "n", "kids", F.lit(None).cast(_PATH).alias("path"), F.lit(None).cast(top).alias("top"))
        upper = paths.select("source", "up", F.lit(None).cast("bigint").alias("n"), F.lit(None).cast(kids).alias("kids"), "path", "top")
        # A block and the path above it have one row each: they meet by grouping.
        met = lower.unionByName(upper).groupBy("source", "up").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", "top")])
        if i < len(levels) - 1:
            met = settle(met, "merkle-met")
        nodes = met.where(F.col("kids").isNotNull()).select("source", "up", "top", F.explode(_steps(F.col("kids"), F.col("path"), F.col("n"))).alias("node"))
        nodes = nodes.select("source", "top", (F.col("up") * SPAN + F.col("node.rank")).alias("rank"), "node.h", "node.kids", "node.path")
        # A source whose tree ends further down waits for its level.
        waiting = met.where(F.col("kids").isNull()).select("source", F.lit(0).cast("bigint").alias("up"), "path", "top")
        paths = nodes.select("source", F.col("rank").alias("up"), "path", "top").unionByName(waiting)
    return nodes


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def merkle_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, other: dict[str, Column] | None = None) -> DataFrame:
    """source, doc_id, leaf, subroot, root, path and ``other_leaf`` for every row of ``docs``.

    ``fields`` are what a leaf covers; ``path`` holds (left, right), the joined hashes of the
    siblings on either side, from the leaf's step to the root's.  ``other`` replaces some fields and
    gives ``other_leaf``, for instance of a copy that is to be checked.  A row without an id comes
    first in its source; a null source is a source of its own and the first one; of rows with equal
    ids the one with the smaller hash comes first, and repeated rows are leaves one by one.  Null
    fields count as such, empty texts as texts without bytes.  An empty table gives no rows; further
    columns are not looked at.
    """
    column = {c: F.col(f"`{c}`").cast("string") for c in fields}
    changed = leaf_hash([(other or {}).get(c, column[c]) for c in fields]) if other else F.lit(None).cast("string")
    leaves = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                         leaf_hash([column[c] for c in fields]).alias("leaf"), changed.alias("other"), F.monotonically_increasing_id().alias("at"))
    # Written once, with ``at``: the texts are read and hashed a single time.
    levels = _levels(_ranked(settle(leaves.withColumn("other", F.nullif("other", "leaf")), "leaves")))
    placed = with_position(_tops(levels), "rank", ["source"])
    placed = settle(placed, "subroots")
    n_sources = placed.count()
    roots = placed.select(F.lit("").alias("source"), F.lit(n_sources).cast("bigint").alias("n"), (F.col("rank") - 1).alias("rank"), "h",
                          F.struct(F.col("source").alias("name")).alias("kids"))
    upper = _levels(roots)
    crown = _tops(upper).select("source", F.array().cast(_PATH).alias("path"), F.struct(F.col("h").alias("root")).alias("top"))
    above = _down(upper, crown).select(F.col("kids.name").alias("source"), "path", F.struct(F.col("top.root"), F.col("h").alias("subroot")).alias("top"))
    found = _down(levels, settle(above, "subroot-paths"))
    return found.select("source", F.col("kids.doc_id").alias("doc_id"), F.col("h").alias("leaf"), "top.subroot", "top.root", "path",
                        F.coalesce("kids.other", "h").alias("other_leaf"))


def prove_rows(docs: DataFrame) -> DataFrame:
    """Proofs of all rows, each checked against a copy of the table in which some texts lost their line feeds.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.  Where 2 divides the
    crc32 of the id, the copy's text has no line feeds; a row without an id is left alone.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.col("text").cast("string")
    tampered = F.when(hit, F.translate(text, "\n", "")).otherwise(text)
    found = merkle_manifest(docs, other={"text": tampered})
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    found = found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), fold(F.col("other_leaf"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
