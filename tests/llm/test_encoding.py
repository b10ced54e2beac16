import os

import pytest

from assayflow.llm import encoding as en

HERE = os.path.join(en.TOKENIZER_DIR, "byte_bpe_50k.json")
pytestmark = pytest.mark.skipif(not os.path.exists(HERE), reason="no tokenizer files")
TEXTS = [
    "The composite retained its peroxidase-like behaviour.", "don't I'LL we've", "<|endoftext|> x", "", None, " ", "\t\n  \n", "a\x1cb\x1f c\x85d", "  x　​ y", "样品在4 °C下保存。",
    "नमूने को अंधेरे में", "𝒳\U0010ffff 123½²", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "é é", "The composite retained its peroxidase-like behaviour.",
]


def _reference(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(HERE)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_same_ids_as_the_library(spark):
    df = spark.createDataFrame([(i, t, [1], "w") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, ids array<int>, word string")
    got = {r.doc_id: list(r.ids) for r in en.encode(df).collect()}
    assert [got[i] for i in range(len(TEXTS))] == _reference(TEXTS)


def test_many_chunks_long_text_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(en, "CHUNK_CHARS", 50)
    texts = [f"run {i} of CuO" for i in range(60)] + ["lattice fringes " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: list(r.ids) for r in en.encode(df).collect()}
    assert [got[i] for i in range(len(texts))] == _reference(texts)
    assert en.encode(df.limit(0)).count() == 0


def test_replay_touches_neighbours_only():
    m = object.__new__(en.Merges)
    m.byte_ids = list(range(256))
    a, b = ord("a"), ord("b")
    m.pairs = {(a, a): (0, 300), (300, b): (1, 301), (a, b): (2, 302)}
    assert en.replay(["aab", "aaab", "ab", "", "aaaa"], m) == [[301], [300, 302], [302], [], [300, 300]]
