"""A small corpus with awkward rows, and plain versions of the operators to compare with."""

import pathlib

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SF = pathlib.Path("/root/testdata/sf0.001")


def read(name):
    return pq.read_table(SF / f"{name}.parquet").to_pandas()


@pytest.fixture(scope="session")
def corpus(tmp_path_factory):
    """Folder with the small tables plus nulls, blanks, repeats, a very long text and clashing columns."""
    if not SF.exists():
        pytest.skip("test tables not present")
    folder = tmp_path_factory.mktemp("corpus")
    docs = read("documents")
    bench = read("benchmark")
    passage = bench.text[0]
    long_text = " ".join(f"word{i % 7919}x" for i in range(60_000))
    shared = "shared " * 55 + "end of the passage"
    extra = [
        (900_001, None), (900_002, ""), (900_003, " \n\t "), (900_004, long_text), (900_005, "the same row twice"),
        (900_005, "the same row twice"), (None, "a row without an id"), (900_006, "One"), (900_007, "one"),
        (900_008, f"before {passage.upper()} after"), (900_009, f"first line\n{shared}\nlast"), (900_010, f"{shared}\nother tail"),
        (900_011, f"x\n\n\n{shared}\n"), (900_012, "mail a.b@c-d.org now 10.0.0.256 and 10.0.0.25, call +1 (269) 555-3296 4524132264652876"),
        (900_013, "card 4111 1111 1111 1111 and 1.2.3.4.5 a@b a@b.c.@d.e token = \"0641917ea4e9feb9cda83477b57ac2654884f485\""),
        (900_014, "É Ünïcode 𝒳 +49 (30) 1234 567 é@ü x@y.zz"), (900_015, "word " * 3000),
    ]
    more = pd.DataFrame({"doc_id": [i for i, _ in extra], "text": [t for _, t in extra]})
    more["lang"], more["source"], more["n_chars"] = "en", [None if i % 4 > 1 else "src0" for i in range(len(more))], 0
    frame = pd.concat([docs, more], ignore_index=True)
    frame["doc_id"] = frame.doc_id.astype("Int64")
    for name in ("_row", "size", "node", "word", "score", "hits", "at", "rank", "found"):
        frame[name] = name
    pq.write_table(pa.Table.from_pandas(frame, preserve_index=False), folder / "documents.parquet")

    labels = pd.concat([read("labels"), pd.DataFrame({"doc_id": [None, 900_006, 900_006], "quality": [1, None, 1], "toxic": [0, 0, None]})])
    labels = labels.astype("Int64")
    pq.write_table(pa.Table.from_pandas(labels, preserve_index=False), folder / "labels.parquet")

    items = pd.concat([bench, pd.DataFrame({"item_id": [90_001, 90_002, 90_003, 90_004, None, bench.item_id[0] + 70_000],
                                            "text": [None, " ..", "row twice", bench.text[1][:200], "first line", passage]})], ignore_index=True)
    items["item_id"], items["words"] = items.item_id.astype("Int64"), "words"
    pq.write_table(pa.Table.from_pandas(items, preserve_index=False), folder / "benchmark.parquet")

    vectors = read("embeddings").head(220)
    first = [float(x) for x in vectors.embedding[0]]
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(vectors.vec_id, vectors.embedding)]
    rows += [(10_000 + i, first) for i in range(30)] + [(20_000, None), (20_001, []), (20_100, [float("nan")] * 64), (20_002, [None] * 64),
                                                       (20_200, [1.0, 2.0]), (20_003, [3.0, 4.0]), (None, first), (10_000, first)]
    table = pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                      "label": pa.array([0] * len(rows), pa.int32()), "v": pa.array(["v"] * len(rows))})
    pq.write_table(table, folder / "embeddings.parquet")

    pages = read("pages").head(60)
    big = "<p>same body</p>" * 100
    odd = [(5001, "http://x/ a b", big), (5002, None, big), (5003, "http://y", None), (5004, "", ""), (5005, "u", big + "\r\n\r\nWARC/1.0\r\n"),
           (5006, "u", "small"), (5007, "u", "small"), (5002, "again", big), (None, "n", big), (5008, "é", "é" * 2000)]
    more = pd.DataFrame(odd, columns=["page_id", "url", "html"])
    frame = pd.concat([pages, more], ignore_index=True)
    frame["page_id"], frame["payload"] = frame.page_id.astype("Int64"), "payload"
    pq.write_table(pa.Table.from_pandas(frame, preserve_index=False), folder / "pages.parquet")
    return folder


@pytest.fixture(scope="session")
def empty(corpus, tmp_path_factory):
    """The same tables without rows."""
    folder = tmp_path_factory.mktemp("empty")
    for path in corpus.glob("*.parquet"):
        pq.write_table(pq.read_table(path).slice(0, 0), folder / path.name)
    return folder


@pytest.fixture(scope="session")
def docs(corpus):
    frame = pq.read_table(corpus / "documents.parquet", columns=["doc_id", "text", "source"]).to_pylist()
    return [(r["doc_id"], r["text"], r["source"]) for r in frame]


@pytest.fixture(scope="session")
def result(spark, corpus):
    """Rows of a query over the corpus, computed once."""
    from parley.llm.queries import QUERIES

    found = {}

    def of(name):
        if name not in found:
            found[name] = [r.asDict() for r in QUERIES[name](spark, str(corpus)).collect()]
        return found[name]

    return of
