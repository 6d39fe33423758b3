"""The pipeline's stages on small tables: what goes, what stays, and what the rows become."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from orewise.llm import pii
from orewise.llm.bpe import tokenizer
from orewise.llm.decontaminate import brute_force

from test_similar import components

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_stage(spark, documents):
    from orewise.llm.quality import quality

    kept = {r.doc_id for r in quality(documents).where("kept").collect()}
    out = cp.quality_stage(spark, documents, SF)
    assert out.columns == COLUMNS and {r.doc_id for r in out.collect()} == kept and 0 < len(kept) < documents.count()
    good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").join(documents, "doc_id")
    long = {r.doc_id for r in good.collect() if len(r.text.split()) >= 50}
    assert len(long - kept) <= 0.05 * len(long)


def test_dedup_stage(spark, documents):
    rows = [r.asDict() for r in documents.collect()]
    rows += [rows[5] | {"doc_id": 9000}, rows[5] | {"doc_id": -4}, rows[6], {k: None for k in COLUMNS}, {k: None for k in COLUMNS} | {"doc_id": 9001}]
    docs = spark.createDataFrame(rows, documents.schema)
    got = [r.doc_id for r in cp.dedup_stage(spark, docs, SF).collect()]
    at = components([(k, r["text"]) for k, r in enumerate(rows) if r["text"] is not None])
    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault(at.get(k, -1 - k), []).append(r["doc_id"])
    want = [min(x for x in g if x is not None) for g in groups.values() if any(x is not None for x in g)] + [None] * sum(all(x is None for x in g) for g in groups.values())
    assert sorted(got, key=str) == sorted(want, key=str)


def test_decontamination_stage(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    extra = spark.createDataFrame([(9000, "Words before. " + items[4][1] + " Words after.", "en", "s", 0)], documents.schema)
    docs = documents.unionByName(extra)
    out = {r.doc_id for r in cp.decontamination_stage(spark, docs, SF).collect()}
    leaky = {d for d, _ in brute_force([(r.doc_id, r.text) for r in docs.collect()], items)}
    assert 9000 in leaky and out == {r.doc_id for r in docs.collect()} - leaky


def test_pii_stage(spark):
    rows = [(1, "write to a.b@mail.example.com or call +1 (017) 555-7713 now", "en", "s", 99), (2, None, "en", "s", None), (3, "nothing here", "en", "s", 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in cp.pii_stage(spark, docs, SF).collect()}
    assert got[1].text == "write to <EMAIL> or call <PHONE> now" and got[1].n_chars == len(got[1].text) and got[3].text == "nothing here"
    assert got[2].text is None and cp.pii_stage(spark, docs, SF).columns == COLUMNS
    clean = cp.pii_stage(spark, docs, SF)
    assert clean.select(F.max(F.size(pii.base_spans(F.coalesce("text", F.lit("")))))).first()[0] == 0


def test_stages_take_empty_tables(spark, documents):
    none = documents.limit(0)
    for name, stage in cp.STAGES:
        assert stage(spark, none, SF).count() == 0, name


def test_run(spark, documents):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "bpe"]
    out = cp.run(spark, SF)
    rows = out.collect()
    assert len({r.doc_id for r in rows}) == len(rows) and 0 < len(rows) < documents.count()
    text = {r.doc_id: r.text for r in documents.collect()}
    plain = {r.doc_id: r.text for r in pii.find(documents, pii.fit(spark)).withColumn("text", pii.redact(F.col("text"), F.col("spans"))).collect()}
    import public_tokenizers

    tok = tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    for r in rows[:20]:
        if plain[r.doc_id] == text[r.doc_id]:
            assert r.n_tokens == len(tok.encode(text[r.doc_id], add_special_tokens=False).ids)


def test_stages_keep_other_columns(spark, documents):
    """Extra columns, whatever their names, pass through every stage but the last."""
    extra = {"spans": 1, "base": 2, "fp": 3, "kept": 4, "component_id": 5, "row": 6, "digest": 7, "n_words": 8}
    docs = documents.limit(40).select("*", *[F.lit(v).alias(k) for k, v in extra.items()])
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert {tuple(r[k] for k in extra) for r in out.collect()} <= {tuple(extra.values())}, name
    assert cp.bpe_stage(spark, docs, SF).count() == 40


def test_rows_go_by_their_own_text(spark, documents):
    """Rows that share a doc_id, or have none, stay or go each by its own text."""
    texts = [r.text for r in documents.orderBy("doc_id").collect()]
    at = components(list(enumerate(texts)), 0.3)
    alone = [x for k, x in enumerate(texts) if list(at.values()).count(at[k]) == 1][:8]
    bad = "line one here\n" * 200
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    made = lambda rows: spark.createDataFrame([(d, x, "en", "s", len(x)) for d, x in rows], documents.schema)
    # One doc_id and null hold unlike texts, and copies of other rows.
    rows = [(7, alone[0]), (7, alone[1]), (7, alone[1]), (3, alone[0]), (None, alone[2]), (None, alone[2]), (None, alone[3]), (9, alone[3])]
    got = [(r.doc_id, r.text) for r in cp.dedup_stage(spark, made(rows), SF).collect()]
    assert sorted(got, key=str) == sorted([(3, alone[0]), (7, alone[1]), (None, alone[2]), (9, alone[3])], key=str)
    good = next(r.text for r in cp.quality_stage(spark, documents, SF).collect())
    rows = [(7, good), (7, bad), (None, good), (None, bad)]
    assert sorted([(r.doc_id, r.text) for r in cp.quality_stage(spark, made(rows), SF).collect()], key=str) == sorted(rows[::2], key=str)
    rows = [(7, "nothing of it here"), (7, f"before {item} after"), (None, "nor here"), (None, item)]
    assert sorted([(r.doc_id, r.text) for r in cp.decontamination_stage(spark, made(rows), SF).collect()], key=str) == sorted(rows[::2], key=str)


def test_workers_keep_no_memory_for_later_stages(spark, documents):
    """Runs that the tokenizer's stage remembered are gone, and so is what a task had freed below something that stays."""
    import public_tokenizers
    import pyarrow as pa

    from orewise.llm.bpe import remembered
    from orewise.llm.common import given_back

    path = public_tokenizers.path("word_bpe_49k.json")

    def known(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([len(remembered(path).known)] * len(x), pa.int64())], ["n"]) for x in batches)

    assert cp.bpe_stage(spark, documents, SF).agg(F.sum("n_tokens")).first()[0] > 1000
    seen = spark.range(0, 400, 1, 4).mapInArrow(known, "n long").agg(F.max("n")).first()[0]
    assert seen == 1  # the empty run

    def anonymous():
        with open("/proc/self/smaps_rollup") as f:
            return next(int(x.split()[1]) for x in f if x.startswith("Anonymous:")) >> 10

    stays = []

    def run(batches):
        held = [b"x" * 50_000 for _ in range(4000)]  # 200 MB
        stays.append(b"x" * 50_000)
        yield from batches
        del held

    before = anonymous()
    assert list(given_back(run)([1, 2])) == [1, 2]
    assert anonymous() < before + 100


def test_decontamination_starts_no_other_workers(spark, documents):
    """No plan has rows of Python objects, whose workers are of another kind and stay beside the others."""
    from orewise.llm.decontaminate import leaks

    found = leaks(documents.select("doc_id", "text"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert "ExistingRDD" not in found._jdf.queryExecution().toString()
    assert [x for x, _ in found.dtypes] == ["doc_id", "item_id", "cosine", "common_words", "answer_words", "item_words"]
