"""More questions from the given ones: random edits, synonyms, refusal pairs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.binding import let
from parley.functions.draws import draw_key
from parley.functions.text import listed, tokenize, word_list
from parley.functions.variation import choose_edits, pop_word, shuffle_clauses, swap_words
from parley.operators.limits import sample_exact
from parley.plans.ranking import first_rows
from parley.plans.scratch import settle
from parley.schema import DIALOG, NO_CONTEXT

# Vectors compared at once by one task.
VECTORS_PER_BLOCK = 4_096
# Bytes of the vectors that ``nearest_words`` writes as one row, and of those that answer in one task.
PACK_BYTES = 2 << 20
PART_BYTES = 128 << 20
# So many parts of the answering vectors, up to ``PART_BYTES`` each: every word has a candidate from each.
ANSWERING_PARTS = 16
PACK_SCHEMA = pa.schema([("name", pa.string()), ("words", pa.list_(pa.string())), ("vectors", pa.binary())])
# The most frequent words, whose neighbourhood describes a word.
CONTEXT_WORDS = 64


def augment_questions(
    df: DataFrame,
    ids: Sequence[str],
    factor: int = 2,
    seed: int = 42,
    mode: str = "random",
    stop_words: Sequence[str] = (),
    translate: Callable[[Column], Column] | DataFrame | None = None,
    samples: int | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """The rows plus ``factor`` edited copies of each, without nulls and repeated rows.

    ``mode="random"`` draws the edits per row and round; ``mode="all"`` applies translate,
    shuffle, swap and pop in this order.  ``translate`` is a function of a column, or a table
    (text, translation) of texts that were translated before; texts that it lacks stay as they are.
    ``samples`` takes only the first rows in ``order``.  The draws depend on ``ids`` and the round
    alone.  The input is read once: a row and its copies come from one ``explode``.
    """
    if mode not in ("random", "all"):
        raise ValueError("mode must be 'random' or 'all'")
    if samples is not None:
        df = first_rows(df, samples, order or ids)
    columns = df.columns
    # The edits make no nulls, so nulls are dropped here: a filter on the result would be pushed
    # below the projections and have each edit computed twice.
    rounds = df.na.drop("any").withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(factor))))
    # A row that is blank itself goes, its copies stay.
    rounds = rounds.where((F.col("_round") > 0) | ~F.col("question").isin(" ", ""))
    if isinstance(translate, DataFrame):
        known = translate.groupBy("text").agg(F.min("translation").alias("_translation"))
        rounds = rounds.join(known.withColumnRenamed("text", "_text"), F.col("question") == F.col("_text"), "left")
        rounds = rounds.withColumn("_translation", F.coalesce("_translation", "question")).drop("_text")
        steps_translate = lambda t: F.col("_translation")  # noqa: E731  translating comes first
    else:
        steps_translate = translate or (lambda t: t)
    parts = [*[F.col(c) for c in ids], F.col("_round")]
    names = ("translate", "shuffle", "pop", "swap") if mode == "random" else ("translate", "shuffle", "swap", "pop")
    steps = {
        "translate": steps_translate,
        "shuffle": lambda t: shuffle_clauses(t, seed, *parts),
        "pop": lambda t: pop_word(t, stop_words, seed, *parts),
        "swap": lambda t: swap_words(t, seed, *parts),
    }
    if mode == "random":
        rounds = rounds.withColumn("_edits", choose_edits(seed, *parts))
    for name in names:
        wanted = F.col("_round") > 0
        if mode == "random":
            wanted &= F.array_contains("_edits", name)
        edited = F.when(wanted, steps[name](F.col("question"))).otherwise(F.col("question"))
        # One projection per edit: the next one refers to a finished column.
        rounds = rounds.withColumn("question", edited)
    rounds = rounds.select(*columns)
    if translate is not None:
        rounds = rounds.na.drop("any")
    return rounds.dropDuplicates()


def read_refusal_pairs(spark: SparkSession, path: str, questions: str = "jailbreak_q", answers: str = "jailbreak_ans") -> DataFrame:
    """Question and answer arrays of a JSON document as rows, cut to the shorter array."""
    schema = f"{questions} array<string>, {answers} array<string>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    n = F.least(F.size(questions), F.size(answers))
    pairs = F.arrays_zip(F.slice(questions, F.lit(1), n).alias("question"), F.slice(answers, F.lit(1), n).alias("answer"))
    return raw.select(F.inline(pairs).alias("question", "answer"))


def refusal_rows(df: DataFrame, pairs: Sequence[tuple[str, str]], ids: Sequence[str], seed: int = 42) -> DataFrame:
    """Refusal pairs as training rows, each with the timestamp of a different random row.

    ``pairs`` is a hand-written list on the driver; as many timestamps are drawn.
    """
    found = df.limit(len(pairs)).count()
    if found < len(pairs):
        raise ValueError(f"{len(pairs)} refusal pairs need as many rows to take timestamps from; there are {found}")
    spark = df.sparkSession
    listed = spark.createDataFrame(
        [(i, q, a) for i, (q, a) in enumerate(pairs, 1)], "n long, question string, answer string"
    )
    key = draw_key(f"{seed}-sample", *[F.col(c) for c in ids])
    drawn = sample_exact(df, len(pairs), ids, seed).select(F.struct(key.alias("k"), *[F.col(c) for c in ids], F.col("timestamp").alias("t")).alias("s"))
    # As many rows as there are pairs: one small array puts them in drawing order.
    drawn = drawn.agg(F.sort_array(F.collect_list("s")).alias("s")).select(F.posexplode("s").alias("n", "s"))
    drawn = drawn.select((F.col("n") + 1).cast("bigint").alias("n"), F.col("s.t").alias("timestamp"))
    return listed.join(drawn, "n").select(
        "question", "answer", F.lit("Jailbreak").alias(DIALOG), "timestamp", F.lit(NO_CONTEXT).alias("context")
    )


def inject_refusal_pairs(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]],
    ids: Sequence[str],
    seed: int = 42,
    factor: int = 0,
    lower_questions: bool = True,
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """Add refusal pairs (and ``factor`` edited copies of each) to a training table, by timestamp."""
    rows = refusal_rows(df, pairs, ids, seed)
    if factor:
        rows = augment_questions(rows, ["question"], factor, seed, stop_words=stop_words)
    table = df.unionByName(rows, allowMissingColumns=True)
    if lower_questions:
        table = table.withColumn("question", F.lower("question"))
    return table.orderBy("timestamp", DIALOG, "question", "answer")


def spot_check(table: DataFrame, sample: DataFrame, order: Sequence[str] = ("question", "answer")) -> DataFrame:
    """For each sampled timestamp the first row of ``table`` that carries it."""
    wanted = sample.select("timestamp").distinct()
    found = table.join(wanted, "timestamp", "left_semi")
    rest = [c for c in table.columns if c != "timestamp"]
    first = found.groupBy("timestamp").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select("timestamp", "_row.*")


def apply_text_transform(
    df: DataFrame,
    column: str,
    fn: Callable[[pd.Series], pd.Series],
    out: str,
) -> DataFrame:
    """Add ``fn(column)``, computed once per distinct text in Arrow batches.

    ``fn`` is the caller's batch function, a translator for instance.
    """
    source, target = column, out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({source: batch[source], target: fn(batch[source])})

    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    mapped = distinct.mapInPandas(run, f"`{column}` string, `{out}` string")
    return df.join(mapped, column, "left").select(*df.columns, out)


def _packed(rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (word, vector) as rows that hold up to ``rows`` words, sorted, and their vectors."""

    def pack(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks().sort_by("word")
        if len(pa.compute.unique(pa.compute.list_value_length(table["vector"]))) > 1:
            raise ValueError("vectors of different lengths")
        values = table["vector"].combine_chunks().flatten().fill_null(float("nan"))
        vectors = values.to_numpy(zero_copy_only=False).astype("float32").tobytes()
        words = table["word"].combine_chunks()
        name = hashlib.md5(vectors + repr(words.to_pylist()).encode()).hexdigest()
        return pa.RecordBatch.from_pylist([{"name": name, "words": words.to_pylist(), "vectors": vectors}], PACK_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            while batch.num_rows:
                part, batch = batch.slice(0, rows - held), batch.slice(rows - held)
                parts.append(part)
                held += part.num_rows
                if held == rows:
                    yield pack(parts)
                    parts, held = [], 0
        if parts:
            yield pack(parts)

    return run


def _unpacked(words: pa.Scalar, vectors: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """Words and unit vectors of a pack; vectors that are not finite take no part."""
    names = words.values.to_numpy(zero_copy_only=False)
    matrix = np.frombuffer(vectors.as_buffer(), "float32").reshape(len(names), -1).astype("float64")
    finite = np.isfinite(matrix).all(axis=1)
    names, matrix = names[finite], matrix[finite]
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return names, np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _nearest(block_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs of packs to one candidate for each asking word; the pairs of one asking pack follow each other."""

    def found(words: np.ndarray, other: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        some = np.isfinite(score)
        columns = [pa.array(words[some], pa.string()), pa.array(other[some], pa.string()), pa.array(score[some])]
        return pa.RecordBatch.from_arrays(columns, ["word", "synonym", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, words, asking, other, score = None, None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                if batch["name"][i].as_py() != name:
                    if name is not None:
                        yield found(words, other, score)
                    name = batch["name"][i].as_py()
                    words, asking = _unpacked(batch["words"][i], batch["vectors"][i])
                    other, score = np.full(len(words), "", dtype=object), np.full(len(words), -np.inf)
                names, answering = _unpacked(batch["others"][i], batch["other_vectors"][i])
                # The words are sorted: equal ones are found once a pair of packs, not in each comparison.
                same = [(r, lo, hi) for r, (lo, hi) in enumerate(zip(names.searchsorted(words, "left"), names.searchsorted(words, "right"))) if lo < hi]
                for q in range(0, len(words), block_rows):
                    own = slice(q, min(q + block_rows, len(words)))
                    rows, here = np.arange(own.stop - own.start), [x for x in same if own.start <= x[0] < own.stop]
                    for a in range(0, len(names), block_rows):
                        scores = asking[own] @ answering[a : a + block_rows].T
                        for r, lo, hi in here:
                            if lo < a + block_rows and hi > a:
                                scores[r - q, max(lo - a, 0) : hi - a] = -np.inf
                        # Of equal scores the last word counts.
                        at = scores.shape[1] - 1 - scores[:, ::-1].argmax(axis=1)
                        best, word = scores[rows, at], names[a + at]
                        better = best > score[own]
                        ties = np.flatnonzero((best == score[own]) & np.isfinite(best))
                        better[ties] = word[ties] > other[own][ties]
                        score[own][better], other[own][better] = best[better], word[better]
        if name is not None:
            yield found(words, other, score)

    return run


def nearest_words(vectors: DataFrame, block_rows: int = VECTORS_PER_BLOCK, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """For every (word, vector) row the other word with the most similar vector (cosine).

    Exact, and all pairs by nature: the time grows with the square of the rows (``similar_words``
    is the approximate way).  What is moved does not: the vectors are written once, in packs of
    ``pack_bytes``; a task reads some asking packs and the packs of one of a fixed number of answering
    parts, compares ``block_rows`` with ``block_rows`` vectors at once and sends on one candidate per
    word.  Of equal scores the last word counts; rows without a word or a vector take no part.
    """
    rows = vectors.select(F.col("word").cast("string").alias("word"), F.col("vector").cast("array<float>").alias("vector"))
    rows = rows.where("word IS NOT NULL AND vector IS NOT NULL")
    count, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    row_bytes = 4 * max(width or 0, 1)
    per_pack = max(1, pack_bytes // row_bytes)
    # Dealt out evenly, but for a few rows, which are no reason for a further pack.
    dealt = rows.repartition(max(1, -(-count // per_pack)))
    packs = settle(dealt.mapInArrow(_packed(2 * per_pack), "name string, words array<string>, vectors binary"), "packs")
    parts = max(ANSWERING_PARTS, -(-count * row_bytes // PART_BYTES))
    answering = packs.select(F.col("words").alias("others"), F.col("vectors").alias("other_vectors")).coalesce(parts)
    # Every pair of partitions is a task that reads the packs from the shared folder.
    pairs = packs.crossJoin(answering.hint("shuffle_replicate_nl"))
    best = pairs.mapInArrow(_nearest(block_rows), "word string, synonym string, score double")
    best = best.groupBy("word").agg(F.max(F.struct("score", "synonym")).alias("b"))
    return best.select("word", "b.synonym", "b.score")


def context_vectors(corpus: DataFrame, text: str, contexts: int = CONTEXT_WORDS, reach: int = 2, min_count: int = 1) -> DataFrame:
    """(word, vector): how often each of the most frequent words stands within ``reach`` of ``word``.

    Words hold a letter and are in lower case; ties for the most frequent ones go by the alphabet.
    Only words with such a neighbour have a row.
    """
    words = F.filter(F.transform(tokenize(F.col(text)), F.lower), lambda w: w.rlike(r"\p{L}"))
    rows = settle(corpus.select(words.alias("w")).where(F.size("w") > 0), "tokens")
    counts = rows.select(F.explode("w").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = settle(counts, "word-counts")
    frequent = [r.word for r in counts.orderBy(F.desc("n"), "word").limit(contexts).collect()]
    if not frequent:
        return rows.sparkSession.createDataFrame([], "word string, vector array<bigint>")
    lo = lambda i: F.greatest(i - reach, F.lit(0))
    around = F.transform("w", lambda w, i: F.struct(
        w.alias("word"), F.concat(F.slice("w", lo(i) + 1, i - lo(i)), F.slice("w", i + 2, F.lit(reach))).alias("near")))
    met = rows.select(F.explode(around).alias("m")).select("m.word", F.explode("m.near").alias("near"))
    met = met.where(F.col("near").isin(frequent)).groupBy("word", "near").agg(F.count(F.lit(1)).alias("n"))
    if min_count > 1:
        met = met.join(counts.where(F.col("n") >= min_count).select("word"), "word", "left_semi")
    by_word = met.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("near", "n"))).alias("m"))
    vector = F.transform(F.array(*[F.lit(c) for c in frequent]), lambda c: F.coalesce(F.try_element_at("m", c), F.lit(0)).cast("bigint"))
    return by_word.select("word", vector.alias("vector"))


def _band_codes(bands: int, bits: int, contexts: int) -> Column:
    """Per band the signs of ``bits`` sums of the vector, each with signs fixed by md5."""
    def sign(bit: int) -> list[int]:
        return [1 if hashlib.md5(f"{c}|{bit}".encode()).hexdigest()[0] < "8" else -1 for c in range(contexts)]

    def total(bit: int) -> Column:
        signed = F.zip_with("vector", F.array(*[F.lit(s) for s in sign(bit)]), lambda v, s: v * s)
        return F.aggregate(signed, F.lit(0).cast("bigint"), lambda a, v: a + F.coalesce(v, F.lit(0)))

    one = lambda bit: F.when(total(bit) >= 0, "1").otherwise("0")
    return F.array(*[F.concat(F.lit(f"{k}:"), *[one(k * bits + i) for i in range(bits)]) for k in range(bands)])


def _closest(table: pa.Table) -> pa.Table:
    """For each row of one block, or of two blocks against each other, the best of the others."""
    table = table.take(pa.compute.sort_indices(table["top"]))  # by bytes, as Spark compares
    tops, block = table["top"].to_numpy(zero_copy_only=False), table["b"].to_numpy()
    flat = table["vector"].combine_chunks().flatten().fill_null(0)
    matrix = flat.to_numpy(zero_copy_only=False).astype("float64").reshape(len(tops), -1)
    norms = (matrix * matrix).sum(axis=1)
    low, high = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    at, best, score = [], [], []
    for asking, answering in [(low, high)] if block.min() == block.max() else [(low, high), (high, low)]:
        for k in range(0, len(asking), 512):
            rows = asking[k : k + 512]
            scores = matrix[rows] @ matrix[answering].T
            with np.errstate(divide="ignore", invalid="ignore"):
                scores /= np.sqrt(norms[rows, None] * norms[None, answering])
            scores[(rows[:, None] == answering[None, :]) | np.isnan(scores)] = -np.inf
            # Of equal scores the last word counts.
            found = scores.shape[1] - 1 - scores[:, ::-1].argmax(axis=1)
            at.append(rows)
            best.append(answering[found])
            score.append(scores[np.arange(len(rows)), found])
    at, best, score = np.concatenate(at), np.concatenate(best), np.concatenate(score)
    some = np.isfinite(score)
    return pa.table({"top": pa.array(tops[at[some]], pa.string()), "synonym": pa.array(tops[best[some]], pa.string()), "score": score[some]})


def similar_words(vectors: DataFrame, contexts: int = CONTEXT_WORDS, bands: int = 4, bits: int = 6, block_rows: int = VECTORS_PER_BLOCK) -> DataFrame:
    """For every (word, vector) row the most similar word by cosine among its candidates; approximate.

    Candidates share the signs of a band, and a word meets all of them: words of equal vectors are
    compared as one, and a bucket of more than ``block_rows`` vectors is cut into blocks of which
    every pair meets in one bounded task.  Words without candidates have no row.
    """
    words = settle(vectors.select("word", "vector"), "vectors")
    groups = settle(words.groupBy("vector").agg(F.max("word").alias("top")), "groups")
    members = settle(words.join(groups, "vector").select("word", "top"), "members")
    placed = settle(groups.select("top", "vector", F.explode(_band_codes(bands, bits, contexts)).alias("code")), "bands")
    # At most bands * 2 ** bits rows.
    sizes = placed.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    placed = placed.join(F.broadcast(sizes), "code").withColumn("b", F.pmod(F.xxhash64("top"), F.col("blocks")))
    placed = placed.withColumn("p", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    pairs = placed.select("code", F.least("b", "p").alias("i"), F.greatest("b", "p").alias("j"), "b", "top", "vector")
    best = pairs.groupBy("code", "i", "j").applyInArrow(_closest, "top string, synonym string, score double")
    best = best.groupBy("top").agg(F.max(F.struct("score", "synonym")).alias("other"))
    # Words of the same vector: the last of them, or for that one the last but one.
    second = members.where("word <> top").groupBy("top").agg(F.max("word").alias("second"))
    found = members.join(best, "top", "left").join(second, "top", "left")
    twin = F.when(F.col("word") == F.col("top"), F.col("second")).otherwise(F.col("top"))
    own = F.when(twin.isNotNull(), F.struct(F.lit(1.0).alias("score"), twin.alias("synonym")))
    found = found.select("word", F.greatest("other", own).alias("b")).where("b IS NOT NULL")
    return found.select("word", "b.synonym", "b.score")


def synonym_table(corpus: DataFrame, text: str, min_count: int = 1, contexts: int = CONTEXT_WORDS) -> DataFrame:
    """A similar word for each corpus word, from counts of the words around it; approximate."""
    return similar_words(context_vectors(corpus, text, contexts, min_count=min_count), contexts)


def replace_synonyms(
    df: DataFrame,
    column: str,
    synonyms: DataFrame,
    ids: Sequence[str],
    share: float = 0.7,
    stop_words: Sequence[str] = (),
    seed: int = 42,
) -> DataFrame:
    """Replace a random ``share`` of the words that are no stop words by their synonyms.

    Of n such words floor(share * n), at least one, are drawn; a drawn word without an entry stays.
    Tokens travel with their row id and position only, and only drawn ones reach the join.  A word
    that is listed several times takes its first synonym in alphabetical order.
    """
    keys = list(ids)
    tokens = df.select(*keys, tokenize(F.col(column)).alias("_tokens"))
    numbered = F.transform(F.col("_tokens"), lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    if word_list(stop_words):
        numbered = F.filter(numbered, lambda s: ~listed(s["w"], stop_words))
    shuffled = F.sort_array(
        F.transform(numbered, lambda s: F.struct(draw_key(f"{seed}-synonym", *[F.col(c) for c in keys], s["i"]).alias("k"), s["i"].alias("i"), s["w"].alias("w")))
    )
    drawn = tokens.select(*keys, shuffled.alias("_s"))
    wanted = F.greatest(F.floor(F.size("_s") * share).cast("int"), F.lit(1))
    drawn = drawn.select(*keys, F.explode(F.slice("_s", F.lit(1), wanted)).alias("s"))
    found = drawn.select(*keys, F.col("s.i").alias("i"), F.lower("s.w").alias("word")).join(
        synonyms.groupBy("word").agg(F.min("synonym").alias("synonym")), "word"
    )
    change = F.struct("i", F.lit(1).alias("p"), F.col("synonym").alias("w"))
    changes = found.groupBy(*keys).agg(F.collect_list(change).alias("_changes"))
    joined = df.join(changes, keys, "left")
    text = F.when(F.col("_changes").isNull(), F.col(column)).otherwise(
        F.array_join(_replaced(tokenize(F.col(column)), F.col("_changes")), " ")
    )
    return joined.withColumn(column, text).select(*df.columns)


def _replaced(tokens: Column, changes: Column) -> Column:
    """Tokens with the words of ``changes`` (structs i, p, w with p = 1) at their positions.

    Tokens and changes are sorted together by position, and of two entries for one position the
    later one stays; looking up each position in the changes would be quadratic.
    """
    old = F.transform(tokens, lambda w, i: F.struct(i.alias("i"), F.lit(0).alias("p"), w.alias("w")))
    both = F.sort_array(F.concat(old, changes))

    def last_of_each(entries):
        following = lambda k: F.get(entries, k + 1)["i"]
        return F.transform(
            F.filter(entries, lambda e, k: F.coalesce(following(k) != e["i"], F.lit(True))), lambda e: e["w"]
        )

    return let(both, last_of_each)
