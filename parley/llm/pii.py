"""Personal data in texts: strict patterns plus weakly supervised spans (DataFrame functions only).

Base spans come from four patterns with a check each.  Beyond them, wider patterns propose
candidates: numbers and phone numbers that a base match has swallowed and dropped, and credentials.
Five labelers (strict shape, gazetteer, context words, delimiters, character mix) vote yes, no or
nothing on every candidate.  The votes of all candidates are counted per pattern of votes (at most
3 ** 5 rows); expectation-maximisation over these counts estimates how reliable each labeler is and
how likely each pattern means a true span.  With these likelihoods as soft labels a final span
classifier (log odds of span features) is trained by one aggregate; it decides on the candidates.

Patterns are written so that matching is linear in the text: possessive runs that start only where
a run starts.  Positions come from the lengths of the matches and of the pieces between them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.binding import let
from parley.plans.scratch import settle

KINDS = ("email", "ip", "card", "phone")
ADDED = "secret"

# The base patterns (here with possessive runs).
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"


# Wider patterns that only propose.
CARD_SHAPE = r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])"
PHONE_SHAPE = r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
SECRET_SHAPE = r"(?<![A-Za-z0-9_])(?=[A-Za-z_]{0,64}[0-9])[A-Za-z0-9_]{12,}+"

CONTEXT_WORDS = r"(?i)(?:passw|pwd|secret|token|api.?key|access.?key|credential|card|visa|iban|phone|mobile|call|tel)[a-z_ ]{0,12}[=: \"']{0,3}$"
CREDENTIAL_PREFIXES = r"^(?:AKIA|ASIA|AROA|AIza|ghp_|gho_|sk_|pk_|rk_|xox|eyJ)"
CARD_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6)"
COUNTRY_CODES = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"

LABELERS = ("shape", "gazetteer", "context", "delimiter", "mix")
ROUNDS = 30
#: Candidates' worth of belief, before any is seen, that a labeler is right four times in five.
BELIEF = 2.0
CHUNK = 256

SPAN = "array<struct<start:bigint,rank:int,end:bigint>>"
CANDIDATE = "array<struct<start:bigint,rank:int,end:bigint,votes:array<int>,features:array<string>>>"


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Inclusive running results of ``join`` over an array of longs (0 first), by chunks of chunks, so
    that long arrays stay cheap."""
    empty, zero = F.array().cast("array<bigint>"), F.lit(0).cast("bigint")

    def fold(part: Column, start: Column) -> Column:
        def step(acc: Column, v: Column) -> Column:
            return F.concat(acc, F.array(join(F.coalesce(F.try_element_at(acc, F.lit(-1)), start), v)))

        return F.aggregate(part, empty, step)

    def level(v: Column, whole: Callable[[Column], Column]) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(CHUNK))

        def with_offsets(chunks: Column) -> Column:
            results = F.transform(chunks, lambda c: F.aggregate(c, zero, join))
            return let(whole(results), lambda ends: F.flatten(F.transform(
                chunks, lambda c, i: fold(c, F.when(i > 0, F.get(ends, i - 1)).otherwise(zero)))))

        return let(F.transform(starts, lambda s: F.slice(v, s, F.lit(CHUNK))), with_offsets)

    return let(values, lambda v: level(v, lambda results: level(results, lambda top: fold(top, zero))))


def running_totals(values: Column) -> Column:
    """Inclusive running sums of an array of longs."""
    return _running(values, lambda a, v: a + v)


def running_tops(values: Column) -> Column:
    """The largest of an array of longs (0 or more) up to each place."""
    return _running(values, lambda a, v: F.greatest(a, v))


def _below(sorted_values: Column, limit: Column) -> Column:
    """How many of ``sorted_values`` are less than ``limit``, by binary search."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(sorted_values) + 1)).cast("int"))
    ends = F.struct(F.lit(0).alias("lo"), F.size(sorted_values).alias("hi"))

    def halve(at: Column, _: Column) -> Column:
        mid = F.shiftright(at["lo"] + at["hi"], 1)
        less = (at["lo"] < at["hi"]) & F.coalesce(F.get(sorted_values, mid) < limit, F.lit(False))
        return F.struct(F.when(less, mid + 1).otherwise(at["lo"]).alias("lo"), F.when(less | (at["lo"] >= at["hi"]), at["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(rounds, ends, halve)["lo"]


def untouched(found: Column, spans: Column) -> Column:
    """Those of ``found`` (structs with start, end) that share no character with any of ``spans``, sorted by start.

    Of the spans that start before a match's end, the furthest end decides: one binary search each.
    """
    known = F.struct(F.transform(spans, lambda s: s["start"]).alias("starts"), running_tops(F.transform(spans, lambda s: s["end"])).alias("tops"))

    def free(k: Column) -> Column:
        return F.filter(found, lambda m: F.coalesce(F.get(k["tops"], _below(k["starts"], m["end"]) - 1) <= m["start"], F.lit(True)))

    return F.when((F.size(spans) == 0) | (F.size(found) == 0), found).otherwise(let(known, free))


def matches(text: Column, pattern: str, context: bool = False) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value), in code points.

    ``context`` adds the 24 characters before a match and the one after it.  They come from the
    pieces between the matches: cutting them out of the text would count its characters anew for
    every match.
    """
    def around(found: Column, gaps: Column, i: Column) -> list[Column]:
        last = lambda array, at: F.right(F.coalesce(F.get(array, at), F.lit("")), F.lit(24))
        first = lambda array, at: F.left(F.coalesce(F.get(array, at), F.lit("")), F.lit(1))
        before = F.right(F.concat(last(found, i - 2), last(gaps, i - 1), last(found, i - 1), last(gaps, i)), F.lit(24))
        after = F.left(F.concat(first(gaps, i + 1), first(found, i + 1)), F.lit(1))
        return [before.alias("before"), after.alias("after")]

    def located(found: Column, gaps: Column) -> Column:
        steps = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: (F.char_length(m) + F.char_length(g)).cast("bigint"))
        return let(running_totals(steps), lambda ends: F.transform(found, lambda m, i: F.struct(
            (F.get(ends, i) - F.char_length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("value"), *(around(found, gaps, i) if context else []))))

    kind = "array<struct<start:bigint,end:bigint,value:string" + (",before:string,after:string>>" if context else ">>")
    none = F.array().cast(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) == 0, none).otherwise(
        let(F.split(text, pattern, -1), lambda gaps: located(m, gaps))).cast(kind))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _valid(kind: str, value: Column) -> Column:
    digits = F.length(_digits(value))
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: let(
            F.regexp_replace(p, "^0+", ""), lambda q: (F.length(q) <= 2) | ((F.length(q) == 3) & (q <= "255"))))
    if kind == "card":
        return digits.between(14, 19) & _luhn(_digits(value))
    if kind == "phone":
        return digits.between(10, 15)
    return F.lit(True)


def _checked(found: Column, kind: str, rank: int) -> Column:
    valid = F.filter(found, lambda m: _valid(kind, m["value"]))
    return F.transform(valid, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Base spans of all kinds, sorted by start, then kind (rank 0 to 3)."""
    # A cheap test first: most texts hold none of these.
    could = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][ -]?[0-9]"), "phone": text.rlike(r"\+[0-9]")}
    parts = []
    for rank, (kind, pattern) in enumerate(zip(KINDS, (EMAIL, IP, CARD, PHONE))):
        parts.append(F.when(could[kind], _checked(matches(text, pattern), kind, rank)).otherwise(F.array()).cast(SPAN))
    return F.array_sort(F.concat(*parts))


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, F.lit(1))
    return (vote.when(no, F.lit(-1)) if no is not None else vote).otherwise(F.lit(0))


def _candidate(m: Column, rank: int) -> Column:
    """Votes and features of one proposed span."""
    value, before, after = m["value"], m["before"], m["after"]
    changes = F.regexp_count(value, F.lit("[0-9](?=[A-Za-z])")) + F.regexp_count(value, F.lit("[A-Za-z](?=[0-9])"))

    def described(b: Column) -> Column:
        last = F.substring(b, -1, 1)
        quoted = last.isin('"', "'", "`", "=", ":")
        joined = last.rlike("[A-Za-z0-9_@.-]") | after.rlike("[A-Za-z0-9_@]")
        if rank == 2:
            shape, known = _vote(_luhn(_digits(value)), ~_luhn(_digits(value))), _vote(value.rlike(CARD_ISSUERS), ~value.rlike(CARD_ISSUERS))
            mix = _vote(F.lit(False), value.rlike(r"^([0-9])\1+$"))
        elif rank == 3:
            shape, known = _vote(F.length(_digits(value)).between(10, 15)), _vote(value.rlike(COUNTRY_CODES), ~value.rlike(COUNTRY_CODES))
            mix = _vote(F.lit(False), _digits(value).rlike(r"^([0-9])\1+$"))
        else:
            shape = _vote(value.rlike(r"^(?:[A-Z0-9]{16,}|[0-9a-f]{16,})$") & value.rlike("[A-Za-z]"), value.rlike("^[0-9_]+$"))
            known = _vote(value.rlike(CREDENTIAL_PREFIXES))
            mix = _vote(changes >= 4, changes <= 1)
        votes = F.array(shape, known, _vote(b.rlike(CONTEXT_WORDS)), _vote(quoted, joined), mix)
        length = F.least(F.floor(F.length(value) / 4), F.lit(16)).cast("string")
        share = F.floor(4 * F.length(_digits(value)) / F.length(value)).cast("string")
        features = F.array(
            F.concat(F.lit(f"kind{rank} length"), length), F.concat(F.lit(f"kind{rank} digits"), share),
            F.concat(F.lit("before "), F.when(quoted, "quote").when(last.rlike("[A-Za-z0-9_]"), "word").otherwise("other")),
            F.concat(F.lit(f"kind{rank} changes"), F.least(changes, F.lit(8)).cast("string")),
            F.concat(F.lit(f"kind{rank} shape"), shape.cast("string")),
            F.concat(F.lit(f"kind{rank} known"), known.cast("string")))
        return F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), votes.alias("votes"), features.alias("features"))

    return let(before, described)


def _described(found: Column, rank: int) -> Column:
    return F.transform(found, lambda m: _candidate(m, rank)).cast(CANDIDATE)


def candidate_spans(text: Column, base: Column) -> Column:
    """Proposed spans that touch no base span, with their votes and features."""
    parts = []
    for rank, pattern in ((2, CARD_SHAPE), (3, PHONE_SHAPE), (4, SECRET_SHAPE)):
        free = let(matches(text, pattern, context=True), lambda found: untouched(found, base))
        if rank == 4:
            free = F.filter(free, lambda m: m["value"].rlike("[A-Za-z]"))
        parts.append(_described(free, rank))
    return F.when(text.rlike("[0-9]"), F.concat(*parts)).otherwise(F.array()).cast(CANDIDATE)


def estimate_reliability(counts: list[tuple[tuple[int, ...], int]]) -> dict[tuple[int, ...], float]:
    """Probability of a true span per pattern of votes, by expectation-maximisation.

    ``counts``: (pattern, how many candidates); votes are -1, 0 or 1.  Starts from the share of
    yes among the votes; each labeler is believed to be right more often than wrong until its votes say otherwise.
    """
    n = sum(c for _, c in counts)
    if not n:
        return {}
    truth = {p: min(max((1 + sum(v == 1 for v in p)) / (2 + sum(v != 0 for v in p)), 0.05), 0.95) for p, _ in counts}
    for _ in range(ROUNDS):
        prior = min(max(sum(truth[p] * c for p, c in counts) / n, 0.05), 0.95)
        odds = dict.fromkeys(truth, math.log(prior / (1 - prior)))
        for k in range(len(LABELERS)):
            seen = {(v, t): BELIEF * (4 if v == 2 * t - 1 else 1 if v else 5) for v in (-1, 0, 1) for t in (0, 1)}
            for p, c in counts:
                seen[p[k], 1] += truth[p] * c
                seen[p[k], 0] += (1 - truth[p]) * c
            total = {t: sum(seen[v, t] for v in (-1, 0, 1)) for t in (0, 1)}
            for p in odds:
                # A vote may not count against its own direction.
                step = math.log(seen[p[k], 1] / total[1]) - math.log(seen[p[k], 0] / total[0])
                odds[p] += max(step, 0.0) if p[k] == 1 else min(step, 0.0) if p[k] == -1 else 0.0
        truth = {p: min(max(1 / (1 + math.exp(-o)), 1e-4), 1 - 1e-4) for p, o in odds.items()}
    return truth


def train_classifier(candidates: DataFrame, truth: dict[tuple[int, ...], float]) -> tuple[float, dict[str, float]]:
    """(bias, log odds per feature) from soft labels; features take a few dozen values in all."""
    label = F.create_map(*[x for p, t in truth.items() for x in (F.lit(",".join(map(str, p))), F.lit(t))])
    soft = candidates.select("features", F.element_at(label, F.concat_ws(",", F.col("votes").cast("array<string>"))).alias("t"))
    yes, n = soft.agg(F.sum("t"), F.count("t")).first()
    rows = soft.select(F.explode("features").alias("f"), "t").groupBy("f").agg(F.sum("t").alias("yes"), F.count("t").alias("n")).collect()
    weights = {r.f: math.log((r.yes + 0.5) / (yes + 1)) - math.log((r.n - r.yes + 0.5) / (n - yes + 1)) for r in rows}
    return math.log((yes + 0.5) / (n - yes + 0.5)), weights


def _texts(spans: Column, kinds: tuple[str, ...]) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["rank"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans for every row of ``docs``.

    Null text counts as empty and has no spans; repeated rows are searched one by one; an empty
    table, or one without candidates, trains nothing; further columns are not looked at.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.withColumn("base", let(F.col("text"), base_spans))
    found = settle(rows.select("doc_id", "base", let(F.struct("text", "base"), lambda r: candidate_spans(r["text"], r["base"])).alias("found")), "pii")
    candidates = found.where(F.size("found") > 0).select(F.explode("found").alias("c")).select("c.votes", "c.features")
    counts = [(tuple(r.votes), r.n) for r in candidates.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()]
    added = F.array().cast(SPAN)
    if truth := estimate_reliability(counts):
        bias, weights = train_classifier(candidates, truth)
        table = F.create_map(*[x for f, w in sorted(weights.items()) for x in (F.lit(f), F.lit(w))])
        score = lambda c: F.aggregate(c["features"], F.lit(bias), lambda s, f: s + F.coalesce(F.element_at(table, f), F.lit(0.0)))
        good = F.filter("found", lambda c: score(c) >= 0)
        added = F.transform(good, lambda c: F.struct(c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end"))).cast(SPAN)
    out = found.select("doc_id", "base", added.alias("added"))
    ranks = F.transform("base", lambda s: s["rank"])
    count = [(F.size("base") - F.size(F.array_remove(ranks, k))).cast("bigint").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    kinds = (*KINDS, ADDED)
    return out.select(
        "doc_id", *count, F.sha2(_texts(F.col("base"), kinds), 256).alias("base_sha256"),
        _texts(F.array_sort(F.concat("base", "added")), kinds).alias("spans"), F.size("added").cast("bigint").alias("n_added"),
        (F.size("base") + F.size("added")).cast("bigint").alias("n_spans"))
