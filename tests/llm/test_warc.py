import gzip
import hashlib
from collections import Counter
from pathlib import Path

import pytest

from tidemark.llm import warc
from tidemark.llm.warc import archived_pages, member, read_warc, record, write_warc

PAGES = "page_id long, url string, html string"
ROWS = [
    (1, "http://a/", None),
    (2, "http://b/", ""),
    (3, "http://c/x\r\ny", "a" * 99),
    (4, "http://d/", "a" * 99),
    (9, "http://e/", "b" * 100),
    (5, None, "b" * 100),
    (6, "http://f/ü", "é" * 50),
    (7, "http://g/", "é" * 50),
    (8, "http://h/", "\r\n\r\nHTTP/1.1 " + "z" * 300_000),
    (10, "http://i/", "\r\n\r\nHTTP/1.1 " + "z" * 300_000),
    (11, "http://j/", "b" * 100),
    (11, "http://j/", "b" * 100),
    (None, "http://k/", "c" * 200),
]


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "archives")


def expected(rows):
    first = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(first.get(raw, i), i)
    out = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        keep = first.get(raw, i)
        again = i is not None and keep != i
        out[(i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", keep if again else None)] += 1
    return out


def test_against_brute_force(spark, folder):
    df = spark.createDataFrame(ROWS, PAGES).repartition(3)
    got = archived_pages(df, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(map(tuple, got.collect())) == expected(ROWS)


def test_small_files_and_parts(spark, folder, monkeypatch):
    rows = [(i, f"http://x/{i}", f"page {i % 70} " * 40) for i in range(200)]
    write_warc(warc.page_records(spark.createDataFrame(rows, PAGES).repartition(2)), folder, file_bytes=4000)
    assert len(list(Path(folder).glob("*.warc.gz"))) > 3
    got = read_warc(spark, folder).filter("record_type <> 'warcinfo'").collect()
    assert len(got) == 200
    whole = {r.payload_digest: r.payload for r in got if r.record_type == "response"}
    assert all(hashlib.sha256(p).hexdigest() == d.split(":")[1] for d, p in whole.items())
    assert all(r.payload == b"" and r.payload_digest in whole for r in got if r.record_type == "revisit")


def test_marks_cut_a_file(monkeypatch, tmp_path):
    import pyarrow as pa

    monkeypatch.setattr(warc, "PART_BYTES", 500)
    writer = warc.WarcWriter(str(tmp_path / "w"), ["record_id", "payload"], True, 1 << 20)
    ids = [f"<urn:page:{i}>" for i in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array([i.encode() * 9 for i in ids])], names=writer.columns)
    writer.commit([writer.write(iter([batch])), None])

    class Wanted:
        names = ["record_id", "payload"]

    reader = warc.WarcReader(str(tmp_path / "w"), Wanted)
    parts = reader.partitions()
    assert len(parts) > 5
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["record_id"], r["payload"]) for r in rows if r["record_id"]] == [(i, i.encode() * 9) for i in ids]


def test_predicates_are_pushed(spark, folder):
    archived_pages(spark.createDataFrame(ROWS, PAGES), folder)
    found = read_warc(spark, folder, "record_type string, payload_length bigint, target_uri string")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    revisits = found.filter("record_type = 'revisit'")
    assert "Filter (" not in plan(revisits) and revisits.count() == 5
    assert found.filter("payload_length >= 300000 and record_type = 'response'").count() == 1
    assert found.filter("target_uri like 'http://c%'").first().target_uri == "http://c/x%0D%0Ay"
    files = len(list(Path(folder).glob("*.warc.gz")))
    assert found.filter("record_type in ('warcinfo', 'revisit') and target_uri is null").count() == files
    assert found.filter("length(record_type) = 7").count() == 5


def test_files_of_other_tools(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\nX: " + b"y" * 9000 + b"\r\nContent-Length: 5\r\n\r\nhello"
    rec = record({"WARC-Type": "response", "WARC-Record-ID": "<urn:1>"}, block)
    other = record({"WARC-Type": "request", "WARC-Record-ID": "<urn:2>"}, b"GET / HTTP/1.1\r\n\r\n")
    (tmp_path / "a.warc").write_bytes(rec + other + rec)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(rec) + gzip.compress(other) + member(rec))
    got = read_warc(spark, str(tmp_path)).collect()
    assert Counter((r.record_type, r.payload_length, r.content_type) for r in got) == {
        ("response", 5, "text/plain"): 4,
        ("request", None, None): 2,
    }
    assert all(r.payload == b"hello" for r in got if r.record_type == "response")
    assert read_warc(spark, str(tmp_path / "a.warc")).filter("record_type = 'request'").count() == 1


def test_members_are_plain_gzip():
    assert gzip.decompress(member(b"abc" * 1000) + member(b"")) == b"abc" * 1000


def test_other_columns_and_empty_table(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, PAGES)
    extra = df.withColumns({c: F.lit("x") for c in ("_digest", "_size", "_first", "payload", "record_type", "date")})
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, archived_pages(extra, str(tmp_path / "a")).select(names).collect())) == expected(ROWS)
    assert archived_pages(df.limit(0), str(tmp_path / "b")).collect() == []
