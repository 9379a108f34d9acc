"""Parts of the corpus operators on their own."""

import numpy as np
import pytest

from parley.llm import elias_fano, linear, pii, toxicity, warc
from parley.llm.topk import Best, CoverTree, dual_search


def test_monotone_sequences_find_successors():
    draw = np.random.default_rng(1)
    for universe in (1, 2, 1000, 1 << 40, 1 << 64):
        for n in (0, 1, 5, 3000):
            values = np.sort(draw.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True))
            seq = elias_fano.Monotone.encode(values, universe)
            assert (seq.access(np.arange(n)) == values).all()
            asked = np.concatenate([values, draw.integers(0, universe - 1, 200, dtype=np.uint64, endpoint=True)])
            at, equal = seq.successor(asked)
            assert (at == np.searchsorted(values, asked)).all()
            assert (equal == np.isin(asked, values)).all()


def test_trie_survives_a_memory_map():
    words, contexts = np.array([3, 9, 2**63 + 5], np.uint64), np.array([1, 7, 2**64 - 1], np.uint64)
    trie = elias_fano.Trie.build(words, np.array([4, 1, 2]), contexts, np.array([0, 0, 1, 2]), np.array([0, 2, 1, 0]), np.array([0.5, 0.7, 0.0, 1.0]))
    again = elias_fano.mapped(trie.to_bytes())
    assert again.counts(np.arange(3)).tolist() == [4, 1, 2]
    mass = again.pair_mass(np.array([0, 0, 0, 1, 2, 2]), np.array([0, 1, 2, 1, 0, 2]))
    assert np.isnan(mass[[1, 5]]).all() and mass[[0, 2, 3, 4]] == pytest.approx([0.5, 0.7, 0.0, 1.0], abs=0.02)


@pytest.mark.parametrize("kind", ["random", "clustered", "equal"])
def test_dual_search_is_exact(kind):
    draw = np.random.default_rng(2)
    data = draw.integers(-50, 50, (600, 8)).astype(float)
    if kind == "clustered":
        data = np.repeat(draw.integers(-900, 900, (6, 8)), 100, 0) + draw.integers(-3, 3, (600, 8)).astype(float)
    if kind == "equal":
        data[:] = data[0]
    ids = draw.permutation(600)
    best = Best(ids[:50], np.full(50, -np.inf), 10)
    dual_search(CoverTree(data[:50]), CoverTree(data), ids, best)
    scores = data[:50] @ data.T
    for q in range(50):
        want = sorted((-int(s), int(i)) for s, i in zip(scores[q], ids) if i != ids[q])[:10]
        assert sorted((-s, -i) for s, i in best.found[q]) == want


def test_disguised_words_are_restored():
    letters = " ".join(["idiot stupid moron normal words here and there"] * 50).encode()
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([letters.decode()])], names=["text"])
    found = next(toxicity._trigrams(iter([batch])))
    counts = np.zeros(toxicity.LETTERS**3)
    counts[found.column(0).to_numpy()] = found.column(1).to_numpy()
    three = counts.reshape((toxicity.LETTERS,) * 3) + 0.01
    restorer = toxicity.Restorer(np.log(three / three.sum(2, keepdims=True)))
    for disguised, word in (("1d10t", "idiot"), ("st*pid", "stupid"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("stuuuupid", "stupid")):
        assert word in restorer(f"you {disguised} there").split()
    assert restorer("normal words, 2024 and 4.0") == "normal words, 2024 and 4.0"


def test_support_vectors_separate_indicator_rows():
    draw = np.random.default_rng(4)
    labels = np.arange(400) % 2
    rows = [np.unique(np.append(draw.integers(100, 2000, 40), 7 if y and i % 9 else 8 if not y else 9)) for i, y in enumerate(labels)]
    model = linear.fit(rows, labels, (200.0, 200.0))
    weight = dict(zip(model["at"].tolist(), model["w"].tolist()))
    assert weight[7] > 0 > weight[8]
    assert linear.fit([], np.empty(0, int), (0.0, 0.0))["w"].size == 0


def test_reliability_follows_the_agreeing_labelers():
    votes = [((1, 1, 0, 1, 1), 50), ((-1, -1, 0, -1, -1), 50), ((1, 0, 1, 0, 1), 5), ((-1, 0, 0, -1, 0), 5)]
    truth = pii.estimate_reliability(votes)
    assert truth[1, 1, 0, 1, 1] > 0.9 > 0.1 > truth[-1, -1, 0, -1, -1]
    assert pii.estimate_reliability([]) == {}


@pytest.mark.parametrize("version", [1, 2])
def test_arc_and_warc_round_trip(version):
    payloads = [b"", b"plain", b"\n\r\n\r\nWARC/1.0\r\n" * 3, "é".encode() * 10]
    content = warc.arc_version_block(version, "f") + b"\n" + b"\n".join(warc.arc_record(version, "http://a b", i, p) for i, p in enumerate(payloads)) + b"\n"
    read = list(warc.read_arc(content))
    assert [warc.split_http(r[4])[1] for r in read] == payloads and read[0][0] == "http://a%20b"
    out = b"".join(warc.warc_record(u, ip, d, i, p, 9 if i == 1 else None) + b"\r\n\r\n" for i, ((u, ip, d, _, _), p) in enumerate(zip(read, payloads)))
    records = list(warc.read_warc(out))
    assert [f["warc-type"] for f, _ in records] == ["response", "revisit", "response", "response"]
    assert records[0][0]["warc-date"] == "1970-01-01T00:00:00Z" and warc.split_http(records[3][1])[1] == payloads[3]
    with pytest.raises(warc.ArchiveError):
        list(warc.read_arc(content[:-9]))
    with pytest.raises(warc.ArchiveError):
        list(warc.read_arc(b"http://x 0 1 t 3\nabc\n"))


@pytest.mark.parametrize("version", [1, 2])
def test_foreign_arc_records_keep_their_bytes(spark, tmp_path, version):
    image, big = bytes(range(256)) * 2, b"caf\xe9 " * 300
    blocks = {
        "http://a/gone": ("text/html", b"HTTP/1.0 404 Not Found\r\nServer: old\r\nX-Name: \xe9\r\nContent-Length: 99\r\n\r\nno"),
        "http://a/img": ("image/png", b"HTTP/1.1 200 OK\nContent-Type: image/png\n\n" + image),
        "http://a/head": ("text/html", b"HTTP/1.1 304 Not Modified\r\nServer: old\r\n"),
        "http://a/one": ("text/html", b"HTTP/1.1 200 OK\r\nX-Page-Id: 1\r\nServer: one\r\n\r\n" + big),
        "http://a/two": ("text/html", b"HTTP/1.1 200 Fine\r\nX-Page-Id: 2\r\nServer: two\r\n\r\n" + big),
        "dns:a": ("text/dns", b"20010101000000\na. 60 IN A 1.2.3.4\n"),
        "ftp://a/f": ("no-type", big),
    }
    more = ["200", "-", "-", "0", "f"] if version == 2 else []
    content = warc.arc_version_block(version, "f") + b"\n"
    for url, (mime, block) in blocks.items():
        content += " ".join([url, "1.2.3.4", "20010203040506", mime, *more, str(len(block))]).encode() + b"\n" + block + b"\n"
    (tmp_path / "old.arc").write_bytes(content)
    warc.convert_arcs(spark, str(tmp_path / "old.arc"), str(tmp_path / "warc"))
    files = [warc._unzipped(f.read_bytes()) for f in (tmp_path / "warc").glob("part-*")]
    found = {f["warc-target-uri"]: (f, block) for content in files for f, block in warc.read_warc(content)}
    assert set(found) == set(blocks)
    revisit, block = found.pop("http://a/one")
    assert revisit["warc-type"] == "revisit" and block + big == blocks["http://a/one"][1]
    assert all(block == blocks[url][1] for url, (_, block) in found.items())
    http = {"response": "application/http; msgtype=response"}
    for url, (fields, _) in found.items():
        kind = "response" if url.startswith("http") else "resource"
        assert fields["warc-type"] == kind and fields["warc-date"] == "2001-02-03T04:05:06Z"
        assert fields["content-type"] == http.get(kind, "text/dns" if url == "dns:a" else "application/octet-stream")
    rows = {r.url: r for r in warc.read_warcs(spark, str(tmp_path / "warc")).collect()}
    assert rows["http://a/img"].payload == image and rows["http://a/gone"].payload_bytes == 2 and rows["ftp://a/f"].payload == big
    assert (rows["http://a/one"].refers_to, rows["http://a/one"].payload_bytes) == (2, len(big))


def test_pages_need_not_be_utf8(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", bytearray(b"\xff\xe9"))], "page_id long, url string, payload binary")
    warc.write_arc(pages, str(tmp_path / "arc"))
    assert [bytes(r.payload) for r in warc.read_arcs(spark, str(tmp_path / "arc")).collect()] == [b"\xff\xe9"]
