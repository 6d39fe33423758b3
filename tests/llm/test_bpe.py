import hashlib
import random
from array import array

import pytest
from pyspark.sql import functions as F

from orewise.llm import bpe
from orewise.llm.bpe import can_be_cut, encode, leaf, remembered, tokenizer, tree

PATH = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
TEXTS = [
    None,
    "",
    "   \n\t ",
    "One short text, with 12 digits and it's <|endoftext|> marks.",
    "a" * 700,
    "x" * 90 + " " + "y" * 90,
    "Über straße naïve é ́x ﬁ ＡＢＣ 漢字かな  　 z " * 9,
    "word " * 300,
    "!?;:" * 200 + "' s't're " * 60,
    "tail <|startoftext|> " * 40,
    "!!'reply''s 'LL'd" * 50,
    "漢字かな交じり文日本語中文的一是不了" * 40,
    "".join(random.Random(1).choices("абвгдежзийклмноп ", k=900)),
    "e" + "\u0301\u0323" * 90 + "각한ᄀ\u1161\u11a8" * 30,
]


@pytest.mark.parametrize("cut", [7, 33, 64, 250])
def test_tree_equals_whole_text(cut):
    tok, runs = tokenizer(PATH), remembered(PATH)
    for text in filter(None, TEXTS):
        parts = [leaf(runs, text[k : k + cut], k) for k in range(0, len(text), cut)]
        assert tree(tok, text, parts).tolist() == tok.encode(text, add_special_tokens=False).ids


def test_random_texts():
    """Any characters, with and without white space, cut anywhere."""
    rng, tok, runs = random.Random(4), tokenizer(PATH), remembered(PATH)
    kinds = ["abcdefghijklmnop", "абвгдежзийклмноп", "漢字かな交じり文", "'!?.,-<|", "0123456789", " \n\t\u3000\x0b", "éİßﬁ각ᄀ\u1161\u11a8\u0301\u0323", ["'s", "'RE", "<|endoftext|>", "<|endof", "text|>", "👩\u200d👧"]]
    for _ in range(400):
        few = rng.sample(kinds, rng.randrange(1, 4))
        text = "".join(rng.choice(rng.choice(few)) for _ in range(rng.randrange(1, 500)))
        cut = rng.choice([5, 20, 90])
        parts = [leaf(runs, text[k : k + cut], k) for k in range(0, len(text), cut)]
        assert tree(tok, text, parts).tolist() == tok.encode(text, add_special_tokens=False).ids, (text, cut)


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "漢字かな交じり文日本語中文的一是不了人", "абвгдежзийклмнопрст ", "the cat sat on a mat. "])
def test_megabyte_is_settled_outside_the_windows(monkeypatch, letters):
    """A million characters: what joins encode anew is little, whatever the script and without white space."""
    text = "".join(random.Random(2).choices(letters, k=1_000_000))
    tok, runs, anew = tokenizer(PATH), remembered(PATH), []
    parts = [leaf(runs, text[k : k + bpe.LEAF_CHARS], k) for k in range(0, len(text), bpe.LEAF_CHARS)]
    plain = bpe.spelled
    monkeypatch.setattr(bpe, "spelled", lambda t, x, k: anew.append(len(x)) or plain(t, x, k))
    assert tree(tok, text, parts).tolist() == tok.encode(text, add_special_tokens=False).ids
    assert len(anew) >= len(parts) - 1 and sum(anew) < 0.05 * len(text)


def test_other_tokenizer_files(spark):
    """A file of another make is used whole, also on texts longer than a leaf."""
    other = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    assert can_be_cut(PATH) and not can_be_cut(other)
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: (bytes(r.ids), r.decoded) for r in encode(docs, other, leaf_chars=50).collect()}
    for k, x in enumerate(TEXTS):
        ids = tokenizer(other).encode(x or "", add_special_tokens=False).ids
        assert got[k] == (b"".join(i.to_bytes(4, "little") for i in ids), tokenizer(other).decode(ids, skip_special_tokens=False))


def test_encode_rows(spark):
    rows = [(k, x, "extra") for k, x in enumerate(TEXTS)] + [(3, TEXTS[3], "again"), (None, "none", "x"), (7, TEXTS[7], "again"), (7, TEXTS[7] + "x", "y")] + [(None, TEXTS[6], "x")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = sorted(map(tuple, encode(docs, PATH, leaf_chars=50).collect()), key=str)
    tok = tokenizer(PATH)
    want = []
    for doc_id, text, _ in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), b"".join(x.to_bytes(4, "little") for x in ids), tok.decode(ids, skip_special_tokens=False)))
    assert [(a, b, bytes(c), d) for a, b, c, d in found] == sorted(want, key=lambda x: str((x[0], x[1], bytearray(x[2]), x[3])))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert encode(docs, PATH).count() == 0


def test_query_digests(spark):
    from orewise.llm.queries import op7_bpe

    row = op7_bpe(spark, "/root/testdata/sf0.001").orderBy(F.desc("n_tokens")).first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.col("doc_id") == row.doc_id).first().text
    ids = tokenizer(PATH).encode(text, add_special_tokens=False).ids
    assert row.n_tokens == len(ids)
    assert row.ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(tokenizer(PATH).decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_runs_that_end_in_punctuation():
    """A body is asked for once, whatever punctuation ends its runs; ids are the tokenizer's."""
    tok = tokenizer(PATH)
    asked = []

    class Counting:
        def encode_batch_fast(self, texts, **how):
            asked.extend(texts)
            return tok.encode_batch_fast(texts, **how)

    bpe.Runs(Counting()).encode(["zebrate zebrate!! Zebrate?! zebrate*** ZEBRATE, éaux*** éaux"])
    assert asked.count("zebrate") == asked.count("éaux") == 1 and not any(x[:1].isalpha() and x[-1] in "!?*," for x in asked)
    texts = ["éaux*** İ!! क़. é! dogs' it's. x_?! SH!! 's! a\x0b! Σ! ΑΣ. 1!2? -- ... <|endoftext|>! ²! é.", "a! ́! q'!'s can't'"]
    assert bpe.Runs(tok).encode(texts) == [array("I", tok.encode(x, add_special_tokens=False).ids).tobytes() for x in texts]
