"""Near-duplicate documents by b-bit MinHash.

1. Documents with equal shingle sets form one class (a 128-bit fingerprint of the set), numbered in
   the order of the fingerprints; the class goes on.  A group of a thousand exact copies costs one
   signature.
2. 128 minima per set.  Four minima at a time make a band key; the two low bits of every minimum,
   packed into four longs, are the signature that is kept.
3. Candidates: in each band bucket the smallest id is the hub, all others meet the hub.  That is one
   pair per member and bucket, however large the bucket.  The bit counts of two signatures give the
   similarity, corrected for chance collisions; pairs far below the threshold leave.
4. Documents that may be similar, through hubs or, in buckets that still hold several families,
   directly (pairs of blocks again), form families.  Only their texts are read again.  Families are compared on full sets
   in pairs of blocks of about ``BLOCK_SETS`` documents; a pair of blocks gives a spanning forest of
   its links, never all pairs, and pairs of blocks that are known to be connected are left out.

With bands of four minima, 32 of them, a pair at similarity 0.8 shares no bucket with probability
(1 - 0.8 ** 4) ** 32 = 5e-8; one at the threshold falls below ``MARGIN`` with less than 1e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import pieces, unboxed
from parley.llm.graph import connected_components
from parley.llm.wordhash import batches, mix
from parley.plans.ranking import with_position
from parley.plans.scratch import settle

SHINGLE_WORDS = 5
PERCENT = 80
BANDS, ROWS = 32, 4
BITS = 2
#: Estimates below the threshold by more than this (six standard deviations) are no candidates.
MARGIN = 0.25
#: Sets, and shingles of them, that a block of a family holds about.
BLOCK_SETS, BLOCK_SHINGLES = 200, 400_000
MATRIX_COLUMNS = 8_192
#: Signatures that a block of a mixed bucket holds about.
BLOCK_SIGNATURES = 512
#: So many ids of documents in families may be broadcast (16 bytes each); beyond, they are joined.
BROADCAST_IDS = 2_000_000
ROWS_PER_RANGE = 65_536
#: What tells a class of equal sets.
CLASS = ["f1", "f2", "n_shingles"]

_MULTIPLIERS = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[bytes | None], words: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first, sets): the sorted distinct shingle hashes of runs of texts."""
    for first, hashes, bounds in batches(texts):
        n = len(hashes)
        whole = np.zeros(n, np.uint64)
        for k in range(words):
            whole[: n - k] = mix(whole[: n - k] + hashes[k:] + np.uint64(k + 1))
        sets = []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo >= words:
                sets.append(np.unique(whole[lo : hi - words + 1]))
            elif hi > lo:
                short = np.array([hi - lo], np.uint64)
                for k in range(lo, hi):
                    short = mix(short + hashes[k])
                sets.append(short)
            else:
                sets.append(np.empty(0, np.uint64))
        yield first, sets


def _minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per set and hash function the smallest value; ``starts``: where each (non-empty) set begins."""
    out = np.empty((len(starts), len(_MULTIPLIERS)), np.uint64)
    for k, a in enumerate(_MULTIPLIERS):
        out[:, k] = np.minimum.reduceat(values * a, starts)
    return out


def _fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per set that tell its contents; zeros for an empty one."""
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    f1, f2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    if len(full):
        values = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        f1[full] = np.add.reduceat(mix(values), starts)
        f2[full] = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
    return f1.view(np.int64), f2.view(np.int64)


def _features(words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                        ("bands", pa.list_(pa.int64())), ("sig", pa.list_(pa.int64()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(parts):
            ids = part.column("doc_id")
            texts = part.column("text").cast(pa.binary()).to_pylist()
            for first, sets in shingle_sets(texts, words):
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                f1, f2 = _fingerprints(sets)
                bands = [[] for _ in sets]
                sigs = [[] for _ in sets]
                if len(full):
                    low = _minima(np.concatenate([sets[i] for i in full]), np.concatenate([[0], np.cumsum(sizes[full])[:-1]]))
                    keys = np.zeros((len(full), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                    for r in range(ROWS):
                        keys = mix(keys + low[:, r::ROWS])
                    packed = (low & np.uint64(3)).reshape(len(full), -1, 64 // BITS) << np.arange(0, 64, BITS, dtype=np.uint64)
                    packed = np.bitwise_or.reduce(packed, axis=2)
                    for at, i in enumerate(full):
                        bands[i], sigs[i] = keys[at].view(np.int64), packed[at].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(sets)), pa.array(sizes), pa.array(f1), pa.array(f2),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int64()))], schema=schema)

    return run


def _set_bytes(words: int):
    schema = pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("n_shingles", pa.int64()), ("members", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(parts):
            for _, sets in shingle_sets(part.column("text").cast(pa.binary()).to_pylist(), words):
                f1, f2 = _fingerprints(sets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f1), pa.array(f2), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    return run


def _marked(words: int):
    """Rows (_row, text) with the fingerprint of their set."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(parts):
            for first, sets in shingle_sets(part.column("text").cast(pa.binary()).to_pylist(), words):
                f1, f2 = _fingerprints(sets)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row").slice(first, len(sets)), pa.array(f1), pa.array(f2), pa.array([len(s) for s in sets], pa.int64())],
                    names=["_row", "f1", "f2", "n_shingles"])

    return run


def _confirm(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keep = []
            for x, y in zip(part.column("x"), part.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], schema=schema).filter(pa.array(keep, pa.bool_()))

    return run


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over the shared shingles."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    number = np.cumsum(new) - 1
    shared = np.bincount(number) > 1
    keep = shared[number]
    number, owner = (np.cumsum(shared) - 1)[number[keep]], owner[keep]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(shared.sum()), MATRIX_COLUMNS):
        lo, hi = np.searchsorted(number, [at, at + MATRIX_COLUMNS])
        part = np.zeros((len(sets), min(MATRIX_COLUMNS, int(shared.sum()) - at)), np.float32)
        part[owner[lo:hi], number[lo:hi] - at] = 1
        out += part @ part.T
    return out


def _forest(nodes: list[int], sides: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links among the sets of one pair of blocks, reduced to a spanning forest."""
    both, sizes = _overlaps(sets), np.array([len(s) for s in sets])
    side = np.array(sides)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    linked &= (side[:, None] != side[None, :]) | (side[:, None] == 2)
    left, right = np.nonzero(np.triu(linked, 1))
    root = list(range(len(nodes)))
    out = []
    for i, j in zip(left.tolist(), right.tolist()):
        while root[i] != i:
            root[i] = i = root[root[i]]
        while root[j] != j:
            root[j] = j = root[root[j]]
        if i != j:
            root[j] = i
            out.append((nodes[i], nodes[j]))
    return out


def _compare(percent: int):
    """Links of the tasks in a partition; rows (task, side, node, members) come sorted by task."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, links = None, ([], [], []), []
        for part in parts:
            columns = (part.column(c).to_pylist() for c in ("task", "side", "node"))
            for key, side, node, members in zip(*columns, part.column("members")):
                if key != task:
                    links += _forest(held[1], held[0], held[2], percent) if len(held[1]) > 1 else []
                    task, held = key, ([], [], [])
                held[0].append(side)
                held[1].append(node)
                held[2].append(np.frombuffer(members.as_py(), np.uint64))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], schema=schema)
                links = []
        links += _forest(held[1], held[0], held[2], percent) if len(held[1]) > 1 else []
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], schema=schema)

    return run


def _near(sig: np.ndarray, sizes: np.ndarray, component: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of components that two signatures of one pair of blocks may bring together."""
    found = []
    low, chance = np.uint64(0x5555555555555555), 1 / 2**BITS
    for at in range(0, len(sig), 64):
        mine = slice(at, at + 64)
        different = sig[mine, None, :] ^ sig[None, :, :]
        different = np.bitwise_count((different | (different >> np.uint64(1))) & low).sum(2, dtype=np.int64)
        estimate = ((1 - different / (BANDS * ROWS)) - chance) / (1 - chance)
        small, large = np.minimum(sizes[mine, None], sizes), np.maximum(sizes[mine, None], sizes)
        ok = (estimate >= percent / 100 - MARGIN) & (100 * small >= percent * large) & (component[mine, None] < component)
        ok &= (side[mine, None] != side) | (side[mine, None] == 2)
        i, j = np.nonzero(ok)
        found.append(np.unique(np.stack([component[mine][i], component[j]], 1), axis=0))
    return np.unique(np.concatenate(found), axis=0)


def _meet(percent: int):
    """Links of components by task; rows (task, side, component, n_shingles, sig) come sorted by task."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            column = lambda c: rows.column(c).to_numpy()
            sig = np.stack(rows.column("sig").to_numpy()).astype(np.int64).view(np.uint64)
            found = _near(sig, column("n_shingles"), column("component"), column("side"), percent)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

        task, held = None, []
        for part in parts:
            tasks = part.column("task").to_numpy()
            borders = np.flatnonzero(np.diff(tasks, prepend=tasks[:1] - 1)) if len(tasks) else []
            for lo, hi in zip(borders, [*borders[1:], len(tasks)]):
                if tasks[lo] != task and held:
                    yield pairs()
                    held = []
                task = tasks[lo]
                held.append(part.slice(int(lo), int(hi - lo)))
        if held:
            yield pairs()

    return run


def similarity(x: Column, y: Column) -> Column:
    """Similarity of two sets from their packed signatures, corrected for equal low bits by chance."""
    chance, lanes = 1 / 2**BITS, BANDS * ROWS
    low = F.lit(0x5555555555555555)
    different = sum(
        F.bit_count((x[i].bitwiseXOR(y[i])).bitwiseOR(F.shiftrightunsigned(x[i].bitwiseXOR(y[i]), 1)).bitwiseAND(low))
        for i in range(lanes * BITS // 64)
    )
    return ((1 - different / lanes) - chance) / (1 - chance)


def _families(pairs: DataFrame, crowded: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(node, component): families such that all pairs of a bucket that may be similar share one."""
    family = connected_components(pairs)
    labelled = crowded.join(family, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = settle(labelled.select("key", "node", "component"), "labelled")
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    across = labelled.join(mixed.select("key"), "key").join(nodes.select("node", "n_shingles", "sig"), "node")
    across = settle(across, "across")
    # A bucket is cut into blocks, and every pair of blocks meets in a task of its own.
    blocks = across.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SIGNATURES).cast("bigint").alias("blocks"))
    placed = across.join(blocks, "key").withColumn("k", F.pmod(F.xxhash64("node"), "blocks"))
    seats = placed.withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    side = F.when(F.col("k") == F.col("j"), 2).when(F.col("k") < F.col("j"), 0).otherwise(1).alias("side")
    task = F.xxhash64("key", F.least("k", "j"), F.greatest("k", "j")).alias("task")
    seats = seats.select(task, side, "component", "n_shingles", "sig").repartition("task").sortWithinPartitions("task")
    more = settle(seats.mapInArrow(_meet(percent), "a bigint, b bigint").distinct(), "more")
    if more.isEmpty():
        return family
    # Families that meet become one.
    return connected_components(pairs.unionByName(more))


def _exact_links(texts: DataFrame, classes: DataFrame, nodes: DataFrame, family: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) on full sets; enough of them to connect what is connected.

    Members of a family are compared in pairs of blocks.  In large families the best hub of every
    member is confirmed first; a component that comes out of it fills blocks of its own, and pairs
    of blocks of one component are left out.
    """
    wanted = settle(classes.join(family.select("node").distinct(), "node"), "wanted")
    few = wanted.count() <= BROADCAST_IDS
    ids = wanted.where("low IS NOT NULL").select(F.col("low").alias("doc_id"))
    chosen = texts.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    if not wanted.where("low IS NULL").isEmpty():
        # A class that has no id is looked up among all rows without one.
        chosen = chosen.unionByName(texts.where("doc_id IS NULL"))
    found = chosen.mapInArrow(_set_bytes(words), "f1 bigint, f2 bigint, n_shingles bigint, members binary")
    named = wanted.select("node", *CLASS)
    found = found.join(F.broadcast(named) if few else named, CLASS).groupBy("node").agg(F.first("members").alias("members"))
    sets = settle(found, "sets")

    placed = settle(nodes.select("node", "n_shingles").join(family, "node").withColumnRenamed("component", "family"), "families")
    large = placed.groupBy("family").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK_SETS).select("family")
    inside = placed.join(large, "family", "left_semi").select("node", "family")
    best = pairs.join(inside.withColumnRenamed("node", "b"), "b").groupBy("b").agg(F.max_by("a", F.struct("estimate", "a")).alias("a"))
    both = best.join(sets.select(F.col("node").alias("a"), F.col("members").alias("x")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("members").alias("y")), "b").select("a", "b", "x", "y")
    first = settle(both.mapInArrow(_confirm(percent), "a bigint, b bigint"), "links")
    if not first.isEmpty():
        placed = placed.join(connected_components(first), "node", "left")
    else:
        placed = placed.withColumn("component", F.lit(None).cast("bigint"))
    own = placed.where("component IS NOT NULL").groupBy("component").agg(F.count(F.lit(1)).alias("_n"))
    placed = placed.join(own.where(F.col("_n") > BLOCK_SETS // 2), "component", "left")
    # The pool of a node: its component if that is large, else the rest of its family (null).
    placed = settle(placed.select("node", "n_shingles", "family", F.when(F.col("_n").isNotNull(), F.col("component")).alias("pool")), "pools")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("bigint")
    pools = settle(placed.groupBy("family", "pool").agg(blocks.alias("blocks")), "blocks")
    numbered = pools.select("family", "pool", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("k"))
    left, right = (numbered.select(F.col("family").alias(f"f{e}"), F.col("pool").alias(f"p{e}"), F.col("k").alias(f"k{e}")) for e in "ab")
    ordered = F.struct("pa", "ka") <= F.struct("pb", "kb")
    same = F.col("pa").eqNullSafe(F.col("pb")) & F.col("pa").isNotNull()
    meet = left.join(right, F.col("fa") == F.col("fb")).where(ordered & ~same)
    meet = meet.withColumn("task", F.xxhash64("fa", "pa", "ka", "pb", "kb"))
    twin = F.col("pa").eqNullSafe(F.col("pb")) & (F.col("ka") == F.col("kb"))
    seats = meet.select("task", F.col("fa").alias("family"), F.col("pa").alias("pool"), F.col("ka").alias("k"), F.when(twin, 2).otherwise(0).alias("side"))
    seats = seats.unionByName(meet.where(~twin).select("task", F.col("fa").alias("family"), F.col("pb").alias("pool"), F.col("kb").alias("k"), F.lit(1).alias("side")))
    located = placed.join(pools.withColumnsRenamed({"family": "_f", "pool": "_p"}), (F.col("family") == F.col("_f")) & F.col("pool").eqNullSafe(F.col("_p")))
    located = located.select("node", F.col("family").alias("_f"), F.col("pool").alias("_p"), F.pmod(F.xxhash64("node"), "blocks").alias("_k"))
    dealt = located.join(seats, (F.col("family") == F.col("_f")) & F.col("pool").eqNullSafe(F.col("_p")) & (F.col("k") == F.col("_k")))
    rows = dealt.select("task", "side", "node").join(sets, "node").select("task", "side", "node", "members")
    rows = rows.repartition("task").sortWithinPartitions("task", "node")
    return first.unionByName(settle(rows.mapInArrow(_compare(percent), "a bigint, b bigint"), "links"))


def _components(texts: DataFrame, words: int, percent: int, by_id: bool) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, group) for every row of ``texts``; no group for a text without shingles.

    A group is a number that linked rows share; ``by_id``: rows with one doc_id are linked, whatever
    their texts.
    """
    features = settle(texts.mapInArrow(_features(words),
                                       "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, bands array<bigint>, sig array<bigint>"), "minhash")
    full = features.where("n_shingles > 0")
    # Numbered by contents: neither the order of the rows nor their ids have a say.
    classes = full.groupBy(*CLASS).agg(F.min("doc_id").alias("low"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    nodes = settle(with_position(settle(classes, "classes"), "node", CLASS, ROWS_PER_RANGE), "nodes")

    bands = nodes.select("node", F.explode("bands").alias("key"))
    hubs = bands.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "hub")
    crowded = settle(bands.join(hubs, "key"), "buckets")  # the rows of buckets with company

    def estimated(pairs: DataFrame) -> DataFrame:
        """(a, b, estimate) of those (a, b) that may reach the threshold."""
        sig = nodes.select("node", "n_shingles", "sig")
        with_a = pairs.join(sig.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa")), "a")
        with_b = with_a.join(sig.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb")), "b")
        fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
        return with_b.where(fits).withColumn("estimate", similarity(F.col("sa"), F.col("sb"))).where(
            F.col("estimate") >= percent / 100 - MARGIN).select("a", "b", "estimate")

    met = crowded.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    pairs = settle(estimated(met), "candidates")
    family = _families(pairs.select("a", "b"), crowded, nodes, percent)
    links = _exact_links(texts, nodes.select("node", "low", *CLASS), nodes, family, pairs, words, percent)

    if by_id:
        # An id that has several texts brings their classes together.
        several = full.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct(*CLASS)).alias("x"), F.max(F.struct(*CLASS)).alias("y")).where("x <> y")
        member = full.select("doc_id", *CLASS).join(several.select("doc_id"), "doc_id").join(nodes.select("node", *CLASS), CLASS)
        lowest = member.groupBy("doc_id").agg(F.min("node").alias("a"))
        again = member.join(lowest, "doc_id").where("a <> node").select("a", F.col("node").alias("b")).distinct()
        links = links.unionByName(again)
    component = connected_components(links)
    placed = nodes.select("node", *CLASS).join(component, "node", "left").select(*CLASS, F.coalesce("component", "node").alias("group"))
    return features.select("doc_id", *CLASS).join(placed, CLASS, "left")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Words are runs of non-whitespace, A-Z in lower case.  A text with fewer words than a shingle is
    one shingle; null, empty and blank texts have none and are linked with nothing.  Rows that
    share a doc_id are linked, and each row is compared by its own text.  A row without id takes
    the smallest id of its component, or none; it is kept if there is none.  The result does not
    depend on the order of the rows.  An empty table gives no rows; further columns are not
    looked at.
    """
    found = settle(_components(_texts(docs), shingle_words, percent, by_id=True), "grouped")
    # Most groups are a row by themselves: only the others change anything.
    lowest = found.where("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    out = found.join(lowest.select("group", "low"), "group", "left")
    same_id = found.where("doc_id IS NOT NULL AND group IS NULL").select("doc_id").distinct()
    if not same_id.isEmpty():
        # A blank text whose id also has others goes with them.
        beside = out.where("group IS NOT NULL").join(same_id, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("low").alias("_low"))
        out = out.join(beside, "doc_id", "left").withColumn("low", F.coalesce("low", "_low"))
    component_id = F.coalesce("low", "doc_id")
    return out.select("doc_id", "n_shingles", component_id.alias("component_id"), F.col("doc_id").eqNullSafe(component_id).alias("kept"))


def keep_representatives(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates; all columns.

    It is the row with the smallest doc_id; rows without id come last.  Of several rows with this id
    and the same shingles one stays (the smallest hash of the row).  Rows are grouped by their texts
    alone: an id that has two different texts may keep both.  Rows without any word stay.
    """
    found = _components(_texts(docs), shingle_words, percent, by_id=False).where("group IS NOT NULL")
    found = settle(found, "grouped")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *CLASS)
    best = settle(found.groupBy("group").agg(F.min(first).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1").select("group", "best"), "best")
    several = settle(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").select("doc_id"), "repeated")
    gone = found.join(best, "group").where(first != F.col("best")).where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_gone"))
    plain = docs
    kept_twice = None
    if not several.isEmpty():
        # Ids that several rows have cannot name a row: those are told apart by id and contents.
        key = F.col("doc_id").cast("bigint")
        hard = several.select(F.col("doc_id").alias("_hard"))
        gone = gone.join(hard.where("_hard IS NOT NULL"), F.col("_gone") == F.col("_hard"), "left_anti")
        names = docs.columns
        is_hard = key.eqNullSafe(F.col("_hard"))
        rows = docs.join(hard, is_hard, "left_semi")
        plain = docs.join(hard, is_hard, "left_anti")
        boxed = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("text").cast("string").alias("text"))
        shape = boxed.schema["_row"].dataType.simpleString()
        marked = boxed.mapInArrow(_marked(shingle_words), f"_row {shape}, f1 bigint, f2 bigint, n_shingles bigint")
        marked = marked.withColumn("_id", F.col("_row.doc_id").cast("bigint"))
        blank = marked.where("n_shingles = 0").select("_row")
        # The groups of these rows, and the one row that stays of each.
        alone = found.join(best, "group", "left").where(F.col("best").isNull() | (first == F.col("best")))
        stays = alone.select(F.col("doc_id").alias("_id"), *CLASS).distinct()
        same = marked["_id"].eqNullSafe(stays["_id"])
        for c in CLASS:
            same = same & (marked[c] == stays[c])
        chosen = marked.where("n_shingles > 0").join(stays, same, "left_semi")
        one = chosen.groupBy("_id", *CLASS).agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row")
        kept_twice = unboxed(one.unionByName(blank), names)
    gone = settle(gone.distinct(), "copies")
    few = gone.count() <= BROADCAST_IDS
    plain = plain.join(F.broadcast(gone) if few else gone, F.col("doc_id").cast("bigint") == F.col("_gone"), "left_anti")
    return plain.unionByName(kept_twice) if kept_twice is not None else plain
