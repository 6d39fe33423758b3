import hashlib

from pyspark.sql import functions as F

from orewise.llm.warc import payloads, read, write


def _expect(rows):
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        same = [p for p, _, h, *_ in rows if p is not None and (h or "") == (html or "")]
        to = min(same) if same and len(data) >= 100 and (page is None or min(same) < page) else None
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    long = "é<p>line\r\n\r\nWARC/1.1\r\n" * 400
    rows = [
        (1, "http://a/", "<p>" + "x" * 200, "extra"), (2, "http://b/\r\nX: y", "<p>" + "x" * 200, "extra"), (7, None, long, None),
        (3, "u", long, None), (4, "u", "short", None), (5, "u", "short", None), (6, "u", None, None), (8, "u", "", None),
        (8, "u", "", None), (3, "u", long, None), (None, "u", long, None), (9, "u", "y" * 1000, None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, chunk string")
    chunks = read(write(pages, f"file://{tmp_path}/w", chunk_bytes=64, archive_bytes=500), chunk_bytes=64).cache()
    assert sorted(map(tuple, payloads(chunks).collect()), key=str) == _expect(rows)
    whole = chunks.where("page_id = 3").orderBy("chunk").collect()
    assert b"".join(bytes(x.data) for x in whole if x.page_id == 3)[: len(long.encode())].startswith("é<p>line".encode())
    assert chunks.agg(F.max(F.octet_length("data"))).first()[0] == 64
    one = chunks.where("page_id = 9").orderBy("chunk").collect()
    assert b"".join(bytes(x.data) for x in one) == b"y" * 1000
    assert [x.sha256 for x in one] == [hashlib.sha256(b"y" * x.end).hexdigest() for x in one]


def test_records_have_keys_of_their_own(spark, tmp_path):
    """Repeated and null page_ids, with equal and other payloads: each record is rebuilt by its identifier, byte for byte."""
    texts = ["a" * 150, "b" * 333, "é" * 90, "", None, "short"]
    rows = [(p, f"http://{k}/", t) for p in (1, None, 2) for k, t in enumerate(texts + texts[:2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    chunks = read(write(pages, f"file://{tmp_path}/k", chunk_bytes=64, archive_bytes=300), chunk_bytes=64).collect()
    assert len({(c.record_id, c.chunk) for c in chunks}) == len(chunks)
    records = {}
    for c in sorted(chunks, key=lambda c: c.chunk):
        records.setdefault(c.record_id, [c.page_id, c.record_type, c.refers_to, c.url, b""])[4] += bytes(c.data)
    want = [(p, "revisit", 1, u, b"") if t and len(t.encode()) >= 100 and p != 1 else (p, "response", None, u, (t or "").encode()) for p, u, t in rows]
    assert sorted(map(tuple, records.values()), key=str) == sorted(want, key=str)
    alone = spark.createDataFrame([(None, "u", "z" * 200)] * 2, "page_id long, url string, html string")
    assert [tuple(r)[2:] for r in payloads(read(write(alone, f"file://{tmp_path}/n"))).distinct().collect()] == [(hashlib.sha256(b"z" * 200).hexdigest(), "response", None)]


def test_empty(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert payloads(read(write(pages, f"file://{tmp_path}/e"))).count() == 0
