"""Token alignment, Merkle manifest and quality rules against plain versions."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from parley.llm import alignment, merkle, quality_rules


def counted(rows):
    return collections.Counter(rows)


# Token alignment -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoders():
    from tokenizers import Tokenizer
    import sentencepiece

    a = Tokenizer.from_file(f"{alignment.TOKENIZERS}/{alignment.A_FILE}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/{alignment.B_FILE}")
    return a, b


VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_OF = {chr(b): b for b in VISIBLE} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in VISIBLE)}


def a_piece(token):
    return bytes(BYTE_OF[c] for c in token)


def b_piece(piece):
    hexed = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
    return bytes([int(hexed[1], 16)]) if hexed else piece.replace("▁", " ").encode()


def plain_alignment(texts, encoders):
    """Sequential version: token by token, with dictionaries over the whole corpus."""
    a_side, b_side = encoders
    documents, holders = [], collections.Counter()
    for text in texts:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        spans = []
        for ids, piece in ((a, lambda i: a_piece(a_side.id_to_token(i))), (b, lambda i: b_piece(b_side.id_to_piece(i)))):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(piece(i)), i))
                at += len(piece(i))
            spans.append((b"".join(piece(i) for i in ids), out))
        if not text or any(joined != (" " + text).encode() for joined, _ in spans):
            spans = [(b"", []), (b"", [])]
        (_, a), (_, b) = spans
        links, j = [], 0
        for start, end, i in a:
            while j < len(b) and b[j][1] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][0] < end:
                links.append((i, b[k][2]))
                k += 1
        both = {e for _, e, _ in a} & {e for _, e, _ in b}
        groups, at = [], 0
        for cut in sorted(both):
            groups.append(",".join(str(i) for s, e, i in a if at <= s and e <= cut) + "|" + ",".join(str(i) for s, e, i in b if at <= s and e <= cut) if len(a) < 400 else "")
            at = cut
        documents.append((len(a), len(b), len(both), links, ";".join(groups)))
        holders.update(set(links))
    highest = {}
    for (a, _), n in holders.items():
        highest[a] = max(highest.get(a, 0), n)
    out = []
    for n_a, n_b, n_groups, links, joined in documents:
        digest = hashlib.sha256(joined.encode()).hexdigest() if joined else ""
        out.append((n_a, n_b, n_groups, len(links), sum(holders[x] == highest[x[0]] for x in links), sum(holders[x] for x in links), digest if n_a < 400 else None))
    return out


ODD = [None, "", " ", "  two  blanks ", "▁ low line", "<|endoftext|> and <s></s> <0x41>", "tab\tand\nline\r\n", "emoji 👩‍👩‍👧 and 𝒳", "ﬁ ligature", "\u0000 zero",
       "é and é", "日本語の文章", "word word word word", "same", "same", "a" * 300]


def test_alignment_of_odd_texts(spark, encoders):
    rows = [(i if i != 3 else None, t, "x") for i, t in enumerate(ODD)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, n_a string").repartition(3)
    found = alignment.align_tokens(table).collect()
    want = plain_alignment(ODD, encoders)
    got = counted((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found)
    assert got == counted((i if i != 3 else None, *w) for i, w in enumerate(want))


def test_alignment_of_the_corpus(result, docs, encoders):
    want = plain_alignment([t for _, t, _ in docs], encoders)
    rows = result("op11_token_alignment")
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    assert counted((r["doc_id"], *(r[c] for c in names)) for r in rows) == counted((i, *w[:6]) for (i, *_), w in zip(docs, want))
    hashes = collections.defaultdict(set)
    for r in rows:
        hashes[r["doc_id"]].add(r["groups_sha256"])
    assert all(w[6] in hashes[i] for (i, *_), w in zip(docs, want) if w[6] is not None)


def test_alignment_over_many_runs(spark, encoders, monkeypatch):
    """Small runs and a small fan: several merges in a row give the same counts."""
    monkeypatch.setattr(alignment, "RUN_DOCS", 5)
    texts = [f"the {'cat' if i % 3 else 'dog'} number {i % 17} sat on mat {i % 5}" for i in range(120)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    monkeypatch.setattr(alignment, "FRAME", 7)
    pair = alignment.Pair(*(open(f"{alignment.TOKENIZERS}/{f}", "rb").read() for f in (alignment.A_FILE, alignment.B_FILE)))
    want = plain_alignment(texts, encoders)
    found = {r.doc_id: r for r in alignment.align_tokens(table, radix=3, fan=2).collect()}
    assert [(found[i].n_links, found[i].n_best, found[i].count_sum) for i in range(120)] == [w[3:6] for w in want]
    assert pair.n_b == 32_000


def test_heap_merge_equals_a_dictionary():
    rng = np.random.Generator(np.random.PCG64(3))
    runs, want = [], collections.Counter()
    for k in range(9):
        pairs = np.unique(rng.integers(0, 60 if k % 2 else 4000, 300))
        counts = rng.integers(1, 9, len(pairs))
        want.update(dict(zip(pairs.tolist(), counts.tolist())))
        frames = [alignment.pack(np.diff(pairs[i : i + 11], prepend=0), counts[i : i + 11]) for i in range(0, len(pairs), 11)]
        runs.append(frames)
    blocks = list(alignment.with_highest(alignment.merge_runs([*runs, []]), 10))
    pairs, counts, highest = (np.concatenate(c) for c in zip(*blocks))
    assert (np.diff(pairs) > 0).all() and dict(zip(pairs.tolist(), counts.tolist())) == want
    top = collections.defaultdict(int)
    for p, n in want.items():
        top[p // 10] = max(top[p // 10], n)
    assert highest.tolist() == [top[p // 10] for p in pairs.tolist()]


# Merkle manifest -----------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """(root, paths): per leaf the (left, right) siblings, level by level."""
    level, paths, place = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(place):
            run = level[i // 3 * 3 : i // 3 * 3 + 3]
            paths[k].append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
            place[k] = i // 3
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    sources = collections.defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] if row[0] is not None else -(1 << 62), plain_leaf(row), row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        sources[name].sort(key=lambda x: x[:2])
        trees[name] = plain_tree([leaf for _, leaf, _ in sources[name]])
    root, tops = plain_tree([trees[name][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for (_, leaf, row), path in zip(sources[name], trees[name][1]):
            path = path + tops[k]
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = plain_leaf((*row[:4], text))
            for left, right in path:
                folded = sha(left + folded + right)
            out.append((row[0], leaf, trees[name][0], root, sha("".join(a + b for a, b in path)), folded, folded == root))
    return out


NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_manifest_of_the_corpus(spark, corpus, result):
    rows = [tuple(r) for r in spark.read.parquet(f"{corpus}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = counted(tuple(r[c] for c in NAMES) for r in result("op12_merkle_manifest"))
    assert got == counted(plain_manifest(rows))
    assert any(not r["verified"] for r in result("op12_merkle_manifest"))


@pytest.mark.parametrize("digits", [1, 2])
def test_manifest_over_several_levels(spark, monkeypatch, digits):
    """Small blocks: sources of very different sizes, so that their trees end on different levels."""
    monkeypatch.setattr(merkle, "DIGITS", digits)
    monkeypatch.setattr(merkle, "SPAN", 3**digits)
    monkeypatch.setattr(merkle, "ROWS_PER_RANGE", 13)
    sizes = {None: 1, "": 4, "a": 82, "ab": 9, "b": 10, "é": 27, "z": 3}
    rows = [(i, name, "en", None if i % 7 == 0 else i, f"line\n{i}" if i % 5 else None) for name, n in sizes.items() for i in range(n)]
    rows += [rows[-1], (None, "z", None, None, "no id"), (None, "z", None, None, "no id")]
    table = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    got = counted(tuple(r[c] for c in NAMES) for r in merkle.prove_rows(table).collect())
    assert got == counted(plain_manifest(rows))


def test_manifest_of_one_row(spark):
    table = spark.createDataFrame([(5, "s", "en", 1, "x")], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    (row,) = merkle.prove_rows(table).collect()
    leaf = plain_leaf((5, "s", "en", 1, "x"))
    assert (row.leaf, row.subroot, row.root, row.proof_sha256, row.verified) == (leaf, leaf, leaf, sha(""), True)


# Quality rules -------------------------------------------------------------------------------


def plain_digest(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = counted(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    dup = len(lines) - len(set(lines))
    symbols, characters = len(re.findall(r"[#*$%&|<>]", text)), sum(map(len, words))
    visible = sum(len(w.encode()) for w in words)
    letters = sum(len(c.encode()) for c in text if c.isascii() and c.isalpha() or not c.isascii())
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    rejected = (10 * symbols > len(words), characters < 3 * len(words) or characters > 10 * len(words), 2 * dup > len(lines), 2 * letters < visible,
                any(len(w.encode()) > 1000 for w in words))
    return len(words), characters, symbols, dup, len(repeated), failed, not failed and not any(rejected)


def test_rules_over_the_corpus(result, docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    got = counted((r["doc_id"], *(r[c] for c in names)) for r in result("op13_quality_rules"))
    assert got == counted((i, *plain_digest(t)) for i, t, _ in docs)


def test_rules_on_odd_texts():
    texts = ["a b c a b c", "a\n a\n\n a\na", "x " * 30_000, "one two three four one two three", "é é \x1c x", "\n \n\x0b\n", "A a A a A", "w" * 400_000 + " " + "v " * 300_000]
    raw = [t.encode() for t in texts]
    for count, k in ((quality_rules.word_counts, 0), (quality_rules.word_characters, 1), (quality_rules.symbol_counts, 2), (quality_rules.repeated_lines, 3), (quality_rules.repeated_words, 4)):
        assert count(raw).tolist() == [plain_digest(t)[k] for t in texts]


def test_order_by_rejections_per_cost():
    # Rule 0 is dear and rejects most; 1 is cheap; 2 rejects only what 1 already has; 3 nothing.
    patterns = {0b0001: 40, 0b0110: 10, 0b0010: 5, 0: 100}
    assert quality_rules.order_rules([100.0, 1.0, 1.0, 5.0], patterns) == [1, 0, 2, 3]


def test_cascade_stops_at_the_first_failure():
    seen = []

    def rule(name, fails):
        return quality_rules.Rule(name, lambda texts: (seen.append((name, list(texts))), np.array([fails(t) for t in texts], bool))[1])

    rules = [rule("short", lambda t: len(t) < 2), rule("x", lambda t: b"x" in t), rule("never", lambda t: False)]
    assert quality_rules.cascade([b"a", b"xx", b"ok", b"yes"], rules).tolist() == [0, 1, -1, -1]
    assert [s for s in seen] == [("short", [b"a", b"xx", b"ok", b"yes"]), ("x", [b"xx", b"ok", b"yes"]), ("never", [b"ok", b"yes"])]


def test_order_does_not_change_what_is_kept(spark, corpus):
    table = spark.read.parquet(f"{corpus}/documents.parquet").withColumn("failed_rule", quality_rules.F.lit("old"))
    rules = quality_rules.GENERAL_RULES
    first = quality_rules.apply_rules(table, rules).collect()
    last = quality_rules.apply_rules(table, rules[::-1]).collect()
    planned = quality_rules.apply_rules(table, quality_rules.plan_cascade(table, rules, sample_rows=50)).collect()
    kept = lambda rows: counted((r.doc_id, r.failed_rule is None) for r in rows)
    assert kept(first) == kept(last) == kept(planned)
    assert {r.failed_rule for r in first} <= {None, *(r.name for r in rules)}


def test_quick_encoder_equals_the_full_one():
    files = [open(f"{alignment.TOKENIZERS}/{f}", "rb").read() for f in (alignment.A_FILE, alignment.B_FILE)]
    pair = alignment.Pair(*files)
    rng = np.random.Generator(np.random.PCG64(11))
    letters = [chr(c) for c in range(256)] + list(" \n\t'a1 sé\x85\xa0\x1c.") * 12
    texts = ["".join(rng.choice(letters, rng.integers(1, 40))) for _ in range(3000)]
    texts += ["it's we'll I'd  x", " " * 5000, "a" * 5000, "a1" * 3000, "\n\n" * 150 + "x", "ab " * 4000, "œuvre — “x”", "é" * 399 + " " + "\t" * 399]
    assert pair.quick is not None
    assert pair.encode_a(texts) == [e.ids for e in pair.a.encode_batch(texts, add_special_tokens=False)]
    assert alignment.quick_encoder(files[0].replace(b'"add_prefix_space":false', b'"add_prefix_space":true').replace(b'"add_prefix_space": false', b'"add_prefix_space": true')) is None
