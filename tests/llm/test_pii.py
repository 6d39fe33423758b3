import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from orewise.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    total = 0
    for k, c in enumerate(reversed(s)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def holds(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    return kind == "email" or 9 <= len(d) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, (name, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if holds(name, m.group())]


HARD = [
    None, "", " ", "a@b.c_x@y.zz and .@-.- %@a.b.c.", "a@b a@b. @b.c x@@y.z a.b@c.d@e.f", "ü😀 é@mail.example.com 😀 +1 (017) 555-7713",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.00255 1.2.3 999999999999999999999.1.1.1", "4111 1111 1111 1111-2 4111-1111-1111-1111 41111111111111111111",
    "4012888888881881 378282246310005 1234567890123", "+1 2 3 4 5 6 7 8 9 +12345678 ++123456789 +1()()()123456789012345 +123456789)", "7" * 3000 + "@x.yy" + ".z" * 2500,
    "9 " * 4000, "1." * 3000, "+1" + "-2" * 3000, "a" * 9000, "x@y.zz x@y.zz", "4111 1111 1111 1111" * 3, "tel. (017) 555-7713, 5555",
]


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark)


def test_base_is_the_plain_patterns(spark, model):
    rows = [(k, x, "own") for k, x in enumerate(HARD)] + [(None, HARD[5], "own"), (5, HARD[5], "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = pii.find(docs, model).select("doc_id", "text", "base", "spans").collect()
    assert len(found) == len(rows)
    for r in found:
        assert [tuple(x)[:3] for x in r.base] == brute(r.text), r.text
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))
        for x in r.spans:
            assert (r.text or "").encode()[x.start_byte : x.end_byte].decode() == r.text[x.start : x.end]


def test_query_over_a_table(spark):
    from orewise.llm.queries import op8_pii

    want = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = op8_pii(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in got} == set(want)
    for r in got:
        base = brute(want[r.doc_id])
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x[0] for x in base) for k in range(4))


def test_query_adds_spans(spark):
    """Keys in the documents of the table, which no base rule sees, are added, and nothing else is."""
    from orewise.llm.queries import op8_pii

    text = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    added, want = set(), {(d, m.start(1), m.end(1)) for d, t in text.items() for m in re.finditer(r"(?i)token = \"([0-9a-f]{40})\"", t)}
    for r in op8_pii(spark, "/root/testdata/sf0.01").collect():
        base = {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in brute(text[r.doc_id])}
        assert base <= set(filter(None, r.spans.split(",")))
        for x in set(filter(None, r.spans.split(","))) - base:
            kind, a, b = x.split(":")
            added.add((kind, r.doc_id, int(a), int(b)))
    assert len(want) > 5 and added == {("secret", *x) for x in want}


# Sentences and forms of their own: nothing here is made by the operator's planter.
HELD_OUT = {
    "email": (["please drop {} a line", "Questions go to {}, thanks", "our inbox is {} (office)", "e-mail {} for a quote"], ["anna.lind(at)fjord.example", "sales [at] quarry [dot] com", "m_otto (at) heap.org", "info[at]yard.net"]),
    "ip": (["the machine at {} is down", "host {} refused", "server {} answered late"], ["10[.]2[.]33[.]4", "172(.)16(.)9(.)200", "192[.]168[.]0[.]17"]),
    "card": (["she gave her card {} yesterday", "Visa {} exp 12/27", "paid by credit card {} in full"], ["4111.1111.1111.1111", "5500/0000/0000/0004", "4012.8888.8888.1881"]),
    "phone": (["call me on {} tonight", "Tel: {}", "his mobile is {}, ask", "fax {} or write"], ["(030) 555-1234", "0171 555 8899", "212-555-0187", "030 1234 5678"]),
    "secret": (["export API_KEY={} first", "password: {}", "the access token {} leaked", 'secret = "{}"'], ["9f86d081884c7d659a2feaa0c55ad015a3bf4f1b", "hJ7kQ2mX9pL4vT8wZ1cR6bN3", "A94A8FE5CCB19BA61C4C0873D391E987982FBBD3"]),
}
CLEAN = [
    "order 100200300400 was sent on 2024-05-17", "ISBN 978-3-16-148410-0 of 1999 to 2005", "section 1.2.3 and figure 12-34", "commit 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b fixes it", "meet us (at) noon by the gate",
    "serial 4111 1111 1111 1112 was scrapped", "sha256: 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b9f86d081884c7d659a2feaa0", "a total of 1000 2000 3000 4000 tonnes", "invoice no 2024-0001-3321 is due",
    "the file heap_volume_report_final_2 is new", "card 1234567890123456 is a sample", "version 12[.]400[.]3[.]1 is odd", "user@localhost and @one@two", "number 9807915762804490 stands alone", "ueadoos 9807915762804491 raie",
]


def test_added_spans_on_planted_text(spark, model):
    """Recall and precision of added spans on sentences that aren't the planter's."""
    rng, rows, want = random.Random(3), [], set()
    for kind, (sentences, values) in HELD_OUT.items():
        for s in sentences:
            for v in values:
                before = " ".join(rng.choices(["heap", "größe", "of", "the", "yard", "😀"], k=rng.randrange(9))) + " "
                start = len(before) + s.index("{}")
                want.add((len(rows), kind, start, start + len(v)))
                rows.append(before + s.replace("{}", v))
    rows += CLEAN
    found = pii.find(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), model).collect()
    got = {(r.doc_id, pii.KINDS[x.kind], x.start, x.end) for r in found for x in r.spans if x not in r.base}
    right = len(got & want)
    assert right >= 0.9 * len(want), sorted(want - got)
    assert right >= 0.9 * len(got), [(x, rows[x[0]][x[2] : x[3]]) for x in got - want]


def test_held_out_examples(spark, model):
    """Planted examples of another seed: every kind's added spans are found, and few others."""
    rows = pii.training_rows(spark, 2_000, seed=77).withColumn("hit", model.score(F.struct(*pii.FEATURES)) >= model.threshold(F.col("kind")))
    for r in rows.groupBy("kind").agg(F.sum("label").alias("n"), F.count_if("hit").alias("found"), F.count_if(F.col("hit") & (F.col("label") > 0)).alias("right")).collect():
        assert r.n > 50 and r.right >= 0.9 * r.n and r.right >= 0.9 * r.found, r


def test_time_follows_the_text(spark, model):
    """A contact list of four times the length doesn't take anything like sixteen times as long."""
    line, seconds = "write to jane.doe@mail.example.com or call +1 (017) 555-7713, card 4111 1111 1111 1111, token = 0123456789abcdef0123456789abcdef01234567. ", []
    for k in (1_000, 4_000):
        docs = spark.createDataFrame([(1, line * k)], "doc_id long, text string")
        for _ in range(2):  # the second run has the compiled plan
            began = time.time()
            r = pii.find(docs, model).select(F.size("base"), F.size("spans"), pii.redact(F.col("text"), F.col("spans"))).first()
        seconds.append(time.time() - began)
        assert r[0] == 3 * k and r[1] == 4 * k
        assert r[2] == "write to <EMAIL> or call <PHONE>, card <CARD>, token = <SECRET>. " * k
    assert seconds[1] < 8 * seconds[0]


def test_redact_overlaps(spark):
    places = '[{"kind":0,"start_byte":2,"end_byte":8},{"kind":3,"start_byte":7,"end_byte":10},{"kind":1,"start_byte":11,"end_byte":12}]'
    spans = F.from_json(F.lit(places), "array<struct<kind:int,start_byte:bigint,end_byte:bigint>>")
    assert spark.range(1).select(pii.redact(F.lit("ab😀cdefghij"), spans)).first()[0] == "ab<EMAIL>g<IP>ij"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(docs, pii.fit(spark, 300)).count() == 0


def test_overlaps_lose_nothing(spark):
    """What an added span covered is covered by what stays, in chains and when one span holds others."""
    from orewise.llm.pii import _apart

    span = "struct<kind:int,start:bigint,end:bigint,start_byte:bigint,end_byte:bigint"
    chain = [(0, 0, 10, 0, 10, 0.82), (1, 8, 20, 8, 20, 0.90), (2, 18, 30, 18, 30, 0.95)]
    long = [(0, 0, 30, 0, 30, 0.9), (1, 2, 8, 2, 8, 0.8), (2, 12, 18, 12, 18, 0.95), (2, 12, 18, 12, 18, 0.95)]
    base = [(0, 40, 50, 40, 50)]
    rows = [([], chain), ([], long), (base, [(1, 45, 60, 45, 60, 0.99), (1, 50, 55, 50, 55, 0.9)])]
    df = spark.createDataFrame(rows, f"base array<{span}>>, added array<{span},p:double>>")
    got = [[(x.start, x.end) for x in r[0]] for r in df.select(_apart(F.col("base"), F.col("added"))).collect()]
    assert got[0] == [(0, 10), (8, 20), (18, 30)]
    covered = lambda spans: {k for a, b in spans for k in range(a, b)}
    assert covered(got[1]) == set(range(30)) and got[2] == [(50, 55)]
