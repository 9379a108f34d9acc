"""Exact top-k inner products by a dual-tree search over cover trees, block by block.

1. Components become integers.  Of rows with equal vectors only the smallest ids can be among the
   k best (ties go to smaller ids), so k + 1 of each are kept; they are picked by a row number
   whose limit Spark applies before the exchange.
2. A bounded sample of pivots deals all rows into cells, cells into blocks of about ``BLOCK_ROWS``;
   each block becomes one row: a cover tree over its vectors, with centre and radius.  Queries are
   dealt and packed in the same way.
3. Every group of queries first meets the block with the best bound, which gives each query a kth
   score.  A second round lets the group meet all other blocks whose bound reaches the worst of
   these.  In a block, pairs of tree nodes are searched best bound first and pruned by the covering
   radii against the worst kth score of the query node.
4. Meetings are dealt to tiles, a bundle of groups by a bundle of blocks, both bounded by bytes.  A
   tree goes once to each tile where it meets another, not once to each meeting, and a tile gives
   back k rows a query.
5. A row number per query over what the tiles found gives the ranks.

For a query node (centre a, radius r) and a data node (centre b, radius s) no inner product is
larger than a.b + r|b| + s|a| + rs.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import unit_draw
from parley.plans.scratch import settle

K = 10
SCALE = 1024
BLOCK_ROWS = 4_000
GROUP_ROWS = 256
#: Pivots are a sample of at most this many vectors, those with the smallest hashes.
MAX_PIVOTS = 512
LEAF = 64
MAX_CHILDREN = 64
#: Bytes of block centres that are held and sent out at once.
BOUND_BYTES = 32 << 20
#: Bytes of vectors in a tile: its data blocks, and its groups of queries.
TILE_BLOCK_BYTES = 32 << 20
TILE_GROUP_BYTES = 8 << 20


class CoverTree:
    """Nodes with a point as centre, a covering radius, and children whose centres lie further
    apart than half the parent's radius; nodes of at most ``LEAF`` points, or of points that are
    all far apart, keep them as they are."""

    def __init__(self, points: np.ndarray):
        self.points = points
        #: (members or None, children or None, centre, radius, norm of the centre)
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(points)))

    def state(self) -> tuple:
        return self.points, self.nodes, self.root

    @classmethod
    def of(cls, state: tuple) -> CoverTree:
        tree = cls.__new__(cls)
        tree.points, tree.nodes, tree.root = state
        return tree

    def _build(self, members: np.ndarray) -> int:
        centre = self.points[members[0]]
        away = np.sqrt(((self.points[members] - centre) ** 2).sum(1))
        radius = float(away.max())
        number = len(self.nodes)
        self.nodes.append(())
        groups = []
        if len(members) > LEAF and radius > 0:
            left, distance = members, away
            while len(left) and len(groups) <= MAX_CHILDREN:
                near = distance <= radius / 2
                groups.append(left[near])
                left = left[~near]
                if len(left):
                    distance = np.sqrt(((self.points[left] - self.points[left[0]]) ** 2).sum(1))
            if len(left):
                groups = []
        children = [self._build(g) for g in groups] if len(groups) > 1 else None
        self.nodes[number] = (None if children else members, children, centre, radius, float(np.sqrt(centre @ centre)))
        return number


class Best:
    """The k best (score, id) of each query: larger scores first, then smaller ids."""

    def __init__(self, ids: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.kth = floor.copy()

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        for q, row in zip(queries.tolist(), scores):
            good = np.flatnonzero(row >= self.kth[q])
            good = good[ids[good] != self.ids[q]]
            if not len(good):
                continue
            heap = self.found[q]
            for score, i in zip(row[good].tolist(), ids[good].tolist()):
                item = (int(score), -i)
                if len(heap) < self.k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
            if len(heap) == self.k:
                self.kth[q] = max(self.kth[q], heap[0][0])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors held as doubles."""
    if not a.size or not b.size or np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return a @ b.T
    return (a.astype(np.int64) @ b.astype(np.int64).T)


def dual_search(queries: CoverTree, data: CoverTree, ids: np.ndarray, best: Best) -> None:
    """Improve ``best`` by all of ``data`` that can still matter."""
    def bound(q: int, d: int) -> float:
        _, _, a, r, na = queries.nodes[q]
        _, _, b, s, nb = data.nodes[d]
        value = float(a @ b) + r * nb + s * na + r * s
        return value + 1e-9 * abs(value) + 1e-6

    below: dict[int, np.ndarray] = {}

    def members(q: int) -> np.ndarray:
        if q not in below:
            own, children, *_ = queries.nodes[q]
            below[q] = own if children is None else np.concatenate([members(c) for c in children])
        return below[q]

    heap = [(-bound(queries.root, data.root), queries.root, data.root)]
    while heap:
        value, q, d = heapq.heappop(heap)
        inside = members(q)
        if -value < best.kth[inside].min():
            continue
        q_members, q_children, _, q_radius, _ = queries.nodes[q]
        d_members, d_children, _, d_radius, _ = data.nodes[d]
        if q_children is None and d_children is None:
            best.add(q_members, _products(queries.points[q_members], data.points[d_members]), ids[d_members])
        elif q_children is None or (d_children is not None and d_radius >= q_radius):
            for c in d_children:
                heapq.heappush(heap, (-bound(q, c), q, c))
        else:
            for c in q_children:
                heapq.heappush(heap, (-bound(c, d), c, d))


def _assign(pivots: np.ndarray):
    """Cell (number of the nearest pivot) of each row (vec_id, v)."""
    schema = pa.schema([("vec_id", pa.int64()), ("cell", pa.int64()), ("v", pa.binary())])
    norms = (pivots**2).sum(1)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            v = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, -1)
            cell = (norms[None, :] - 2 * (v @ pivots.T)).argmin(1)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(cell.astype(np.int64)), pa.array([x.tobytes() for x in v], pa.binary())], schema=schema)

    return run


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    """One row for a block: its cover tree and ids, centre and radius."""
    frame = frame.sort_values("vec_id", kind="stable")
    tree = CoverTree(np.stack([np.frombuffer(v, np.float64) for v in frame.v]))
    _, _, centre, radius, _ = tree.nodes[tree.root]
    return pd.DataFrame({"block": [int(frame.block.iloc[0])], "size": [len(frame)], "centre": [centre.tobytes()], "radius": [radius],
                         "tree": [pickle.dumps((frame.vec_id.to_numpy(np.int64), tree.state()))]})


def _blocks(assigned: DataFrame, rows_per_block: int) -> DataFrame:
    sizes = assigned.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows_per_block).alias("parts"))
    dealt = assigned.join(F.broadcast(sizes), "cell")  # at most MAX_PIVOTS rows
    dealt = dealt.withColumn("block", F.xxhash64("cell", F.pmod(F.xxhash64("vec_id"), "parts")))
    return settle(dealt.select("block", "vec_id", "v").groupBy("block").applyInPandas(
        _pack, "block bigint, size bigint, centre binary, radius double, tree binary"), "cover-trees")


def _meetings(blocks: list, first: bool):
    """Blocks that each group of queries has to see: the best one, or the rest that may matter."""
    centres = np.stack([np.frombuffer(b.centre, np.float64) for b in blocks])
    radii, norms = np.array([b.radius for b in blocks]), np.sqrt((centres**2).sum(1))
    names = np.array([b.block for b in blocks], np.int64)
    schema = pa.schema([("group", pa.int64()), ("block", pa.int64()), ("bound", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                a, r = np.frombuffer(row["centre"], np.float64), row["radius"]
                bound = centres @ a + r * norms + radii * np.sqrt(a @ a) + r * radii
                bound += 1e-9 * np.abs(bound) + 1e-6
                at = [int(bound.argmax())] if first else np.flatnonzero(bound >= row["worst"])
                if not first:
                    at = at[names[at] != row["seen"]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row["block"])), pa.array(names[at]), pa.array(bound[at])], schema=schema)

    return run


def _search(k: int):
    """The k best of each query among the data blocks that its group meets in one tile."""
    def run(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        index = {block: pickle.loads(tree) for block, tree in zip(theirs.block.tolist(), theirs.tree)}
        rows = []
        for group, tree, floors, meet in zip(mine.group.tolist(), mine.tree, mine.floors, mine.meet):
            ids, state = pickle.loads(tree)
            known = dict(floors) if floors is not None else {}
            best = Best(ids, np.array([known.get(i, -np.inf) for i in ids.tolist()], np.float64), k)
            queries = CoverTree.of(state)
            for m in sorted(meet, key=lambda m: (-m["bound"], m["block"])):
                if m["bound"] >= best.kth.min():
                    data_ids, data = index[m["block"]]
                    dual_search(queries, CoverTree.of(data), data_ids, best)
            rows += [(group, i, -j, s) for i, found in zip(ids.tolist(), best.found) for s, j in found]
        return pd.DataFrame(rows, columns=["group", "query_id", "vec_id", "score"], dtype="int64")

    return run


def _tiles(blocks: int, rows: int, dims: int, tile_bytes: int) -> int:
    """Bundles that ``blocks`` blocks of ``rows`` vectors are dealt to."""
    return -(-blocks // max(1, tile_bytes // (8 * rows * max(1, dims))))


def _search_meetings(meet: DataFrame, groups: DataFrame, index: DataFrame, floors: DataFrame | None, k: int, tiles: tuple[int, int]) -> DataFrame:
    # Block numbers are hashes, so that their remainders deal them evenly.
    tile = [F.pmod("group", F.lit(tiles[0])).alias("row"), F.pmod("block", F.lit(tiles[1])).alias("column")]
    meet = meet.select(*tile, "group", "block", "bound")
    mine = meet.groupBy("row", "column", "group").agg(F.collect_list(F.struct("block", "bound")).alias("meet"))
    mine = mine.join(groups.select(F.col("block").alias("group"), "tree"), "group")
    if floors is None:
        mine = mine.withColumn("floors", F.lit(None).cast("map<bigint,double>"))
    else:
        mine = mine.join(floors.select("group", "floors"), "group")
    there = meet.select(F.col("row").alias("_row"), F.col("column").alias("_column"), "block").distinct()
    theirs = there.join(index.select("block", "tree"), "block")
    return mine.groupBy("row", "column").cogroup(theirs.groupBy("_row", "_column")).applyInPandas(
        _search(k), "group bigint, query_id bigint, vec_id bigint, score bigint")


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dims): components times 1024, rounded down; vectors with null or non-finite ones left out."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(F.coalesce(finite, F.lit(False)))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"), F.size("embedding").alias("dims"))


def top_k(vectors: DataFrame, every: int = 100, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for rows whose id divides by ``every``.

    Rows without id, and vectors that are null or hold null or non-finite components, take no part;
    only vectors with as many components can be partners; a row never meets rows of its own id, and
    repeated rows count once.  With fewer than k partners all are returned; an empty table gives no
    rows; further columns are not looked at.  Scores are exact up to 2 ** 63.
    """
    rows = settle(integer_vectors(vectors).dropDuplicates(["vec_id", "v"]), "vectors")
    found = None
    for dims in sorted(r.dims for r in rows.select("dims").distinct().collect()):
        part = _top_k_of(rows.where(F.col("dims") == dims).drop("dims"), every, k)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _top_k_of(rows: DataFrame, every: int, k: int) -> DataFrame | None:
    queries = rows.where(F.col("vec_id") % every == 0)
    alike = Window.partitionBy("v").orderBy("vec_id")
    data = rows.withColumn("_nth", F.row_number().over(alike)).where(F.col("_nth") <= k + 1).drop("_nth")
    total = rows.count()
    wanted = max(1, min(MAX_PIVOTS, total // BLOCK_ROWS))
    # A few times as many rows as wanted pass the threshold, so that no task sends its whole share.
    drawn = rows.withColumn("_draw", unit_draw("vec_id", "v")).where(F.col("_draw") < min(1.0, (64 + 4 * wanted) / max(1, total)))
    pivots = [r.v for r in drawn.orderBy("_draw", "vec_id").limit(wanted).select("v").collect()]
    if not pivots or not len(pivots[0]):
        # Vectors without components: all products are 0.
        pivots = pivots and [[]]
    pivots = np.array(pivots, np.float64)
    if not total:
        return None
    fields = "vec_id bigint, cell bigint, v binary"
    index = _blocks(data.mapInArrow(_assign(pivots), fields), BLOCK_ROWS)
    groups = _blocks(queries.mapInArrow(_assign(pivots), fields), GROUP_ROWS)
    if groups.isEmpty():
        return None
    dims, n_blocks = pivots.shape[1], index.count()
    chunks = -(-n_blocks // max(1, BOUND_BYTES // (8 * max(1, dims))))
    tiles = _tiles(groups.count(), GROUP_ROWS, dims, TILE_GROUP_BYTES), _tiles(n_blocks, BLOCK_ROWS, dims, TILE_BLOCK_BYTES)

    def meetings(shape: DataFrame, first: bool) -> DataFrame:
        """Bounds of all groups against all blocks; BOUND_BYTES of centres are held at a time."""
        parts = []
        for chunk in range(chunks):
            part = index.where(F.pmod(F.xxhash64("block"), F.lit(chunks)) == chunk).select("block", "centre", "radius")
            if blocks := part.orderBy("block").collect():
                parts.append(settle(shape.mapInArrow(_meetings(blocks, first), "group bigint, block bigint, bound double"), "bounds"))
        return reduce(DataFrame.unionByName, parts)

    group_shape = groups.select("block", "centre", "radius")
    meet = meetings(group_shape, True)
    best = F.max(F.struct("bound", "block"))
    meet = settle(meet.groupBy("group").agg(best.alias("best")).select("group", "best.block", "best.bound"), "meetings")
    first = settle(_search_meetings(meet, groups, index, None, k, tiles), "first")
    kth = first.groupBy("group", "query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).cast("double").alias("kth"))
    floors = kth.where("kth IS NOT NULL").groupBy("group").agg(
        F.map_from_entries(F.collect_list(F.struct("query_id", "kth"))).alias("floors"), F.min("kth").alias("worst"), F.count(F.lit(1)).alias("n"))
    sizes = groups.select(F.col("block").alias("group"), "size")
    # A group whose queries do not all have k partners yet must see every block.
    state = meet.select("group", F.col("block").alias("seen")).join(sizes, "group").join(floors, "group", "left")
    worst = F.when(F.col("n") == F.col("size"), F.col("worst")).otherwise(F.lit(float("-inf")))
    state = settle(state.select("group", "seen", F.coalesce("floors", F.create_map().cast("map<bigint,double>")).alias("floors"), worst.alias("worst")), "floors")
    shape = group_shape.join(state.select(F.col("group").alias("block"), "seen", "worst"), "block")
    rest = _search_meetings(meetings(shape, False), groups, index, state, k, tiles)
    return first.unionByName(rest).select("query_id", "vec_id", "score")
