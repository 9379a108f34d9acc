"""Personal data in long logs, and archives that are broken or loosely written."""

import gzip
import random
import time

import pytest
from pyspark.sql import functions as F

from parley.llm import pii, warc


def test_untouched_equals_a_plain_test(spark):
    rnd = random.Random(1)
    rows = []
    for k in range(40):
        spans = sorted((a, 0, a + rnd.randint(1, 30)) for a in (rnd.randint(0, 400) for _ in range(rnd.choice([0, 1, 5, 40]))))
        found = sorted((a, a + rnd.randint(1, 12)) for a in (rnd.randint(0, 400) for _ in range(rnd.choice([0, 3, 30]))))
        rows.append((k, found, spans))
    df = spark.createDataFrame(rows, "k int, found array<struct<start:bigint,end:bigint>>, spans array<struct<start:bigint,rank:int,end:bigint>>")
    got = {r.k: [tuple(x) for x in r.free] for r in df.select("k", pii.untouched(F.col("found"), F.col("spans")).alias("free")).collect()}
    for k, found, spans in rows:
        assert got[k] == [(a, b) for a, b in found if not any(s < b and a < e for s, _, e in spans)]


def test_running_results_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(pii, "CHUNK", 3)
    rnd = random.Random(2)
    rows = [[rnd.randint(0, 9) for _ in range(n)] for n in (0, 1, 2, 3, 9, 10, 40)]
    df = spark.createDataFrame([(r,) for r in rows], "v array<bigint>")
    for r in df.select("v", pii.running_totals(F.col("v")).alias("sums"), pii.running_tops(F.col("v")).alias("tops")).collect():
        assert r.sums == [sum(r.v[: i + 1]) for i in range(len(r.v))] and r.tops == [max(r.v[: i + 1]) for i in range(len(r.v))]


def test_a_log_of_megabytes(spark):
    """Addresses and long numbers by the ten thousand in one text."""
    n = 12_000
    text = "".join(f"10.0.{i % 256}.{i // 256 % 256} id {4000000000000000 + i * 7}\n" for i in range(n))
    df = spark.createDataFrame([(1, text), (2, "mail a@b.cc")], "doc_id bigint, text string")
    start = time.perf_counter()
    rows = {r.doc_id: r for r in pii.find_personal_data(df).collect()}
    assert rows[1].n_ip == n and rows[2].n_email == rows[2].n_spans == 1 and rows[1].n_spans >= n + rows[1].n_card
    assert time.perf_counter() - start < 90


def arc(*records):
    body = b"1 0 test\nURL IP-address Archive-date Content-type Archive-length\n"
    return b"filedesc://x 0.0.0.0 20010101000000 text/plain %d\n%s\n" % (len(body), body) + b"".join(records)


def test_loose_headers_and_line_ends():
    a = b"http://a/ b c 1.2.3.4 20010101000000 text/html; charset=utf-8 3\nabc\r\n"
    b = b"dns:x 1.2.3.4 20010102000000 text/dns 2\r\nhi\n"
    found = list(warc.read_arc(arc(a, b)))
    assert found == [("http://a/ b c", "1.2.3.4", "20010101000000", "text/html; charset=utf-8", b"abc"), ("dns:x", "1.2.3.4", "20010102000000", "text/dns", b"hi")]
    with pytest.raises(warc.ArchiveError):
        list(warc.read_arc(arc(b"only three fields 7\nabc")))


def test_a_cut_gzip_member_is_an_error():
    one, two = gzip.compress(arc()), gzip.compress(b"http://a/ 1.2.3.4 20010101000000 text/plain 3\nabc\n" * 50)
    assert len(list(warc.read_arc(warc._unzipped(one + two)))) == 50
    for cut in (3, 12, len(two) - 1):
        with pytest.raises(warc.ArchiveError):
            warc._unzipped(one + two[:cut])
