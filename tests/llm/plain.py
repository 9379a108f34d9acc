"""Straightforward versions of the operators over lists of rows."""

import collections
import hashlib
import math
import re
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def held(doc_id, parts, part):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == part


def lm_scores(rows, mu):
    counts, pairs, before = collections.Counter(), collections.Counter(), collections.Counter()
    for doc_id, text, *_ in rows:
        if not held(doc_id, 10, 0):
            w = words(text) + [None]
            counts.update(w)
            pairs.update(zip(["<"] + w[:-1], w))
            before.update(["<"] + w[:-1])
    n, v = sum(counts.values()), len(counts)
    ones, twos = (sum(c == k for c in counts.values()) for k in (1, 2))
    d = min(max(ones / (ones + 2 * twos), 0.1), 0.9)
    for doc_id, text, *_ in rows:
        w = words(text) + [None]
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        share = lambda x: (counts[x] - d) / n if counts[x] else d * v / n
        score = sum(math.log10((pairs[p, x] + mu * share(x)) / (before[p] + mu)) for p, x in zip(["<"] + w[:-1], w))
        yield doc_id, held(doc_id, 10, 0), len(w), sum(counts[x] > 0 for x in w), n, base, score


def targets(sizes):
    """sizes: source -> words; weights 1, 2, 3 in code point order, null last; at most 3 times the source."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while free:
        share = (total - sum(out.values())) / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * share > 3 * sizes[s]}
        if not above:
            return out | {s: weight[s] * share for s in free}
        out |= {s: 3 * sizes[s] for s in above}
        free -= above
    return out


def shingle_set(text, n):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def near_components(rows, n):
    """doc_id -> smallest doc_id reachable; rows of one id are one document."""
    sets = [(i, shingle_set(t, n)) for i, t, *_ in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[k + 1 :]:
            both = len(x & y)
            if x and 100 * both >= 80 * (len(x) + len(y) - both):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: find(i) for i in root}


def dedup_lines(rows, min_words):
    """Texts without later copies of repeated runs, and removed lines; rows in order of (doc_id, place)."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    lines = {k: rows[k][1].split("\n") if rows[k][1] is not None else [] for k in order}
    seen, out = [], {}
    at = collections.defaultdict(list)
    for k in order:
        own = lines[k]
        size = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in own]
        gone = [False] * len(own)
        for p in range(len(own)):
            best = 0
            for m, q in at[own[p]]:
                n = 0
                while p + n < len(own) and q + n < len(lines[m]) and own[p + n] == lines[m][q + n]:
                    n += 1
                best = max(best, n)
            if sum(size[p : p + best]) >= min_words:
                gone[p : p + best] = [True] * best
            at[own[p]].append((k, p))
        text = rows[k][1] if not any(gone) else "\n".join(x for x, g in zip(own, gone) if not g)
        out[k] = (len(own), sum(gone), text)
    return [out[k] for k in range(len(rows))]


def contamination(rows, items, window=10):
    index = collections.defaultdict(set)
    for item_id, text in items:
        w = item_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            index[tuple(w[i : i + n])].add(str(item_id) if item_id is not None else None)
    lengths = {len(k) for k in index}
    for doc_id, text, *_ in rows:
        w, hit, found = item_words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in index:
                    hit.update(range(i, i + n))
                    found |= index[tuple(w[i : i + n])]
        found.discard(None)
        yield doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    patterns = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    out = []
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = (True, kind == 1 and all(int(p) <= 255 for p in m[0].split(".")), 14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15)
            if good[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def top_k(vectors, k=10):
    """(query_id, rank, vec_id, score) over distinct (id, integer vector) rows."""
    rows = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v in vectors
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    for q, a in rows:
        if q % 100 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q and len(a) == len(b)]
            for rank, (score, i) in enumerate(sorted(scored)[:k], 1):
                yield q, rank, i, -score
