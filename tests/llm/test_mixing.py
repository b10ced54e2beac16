import os

import pytest
from hypothesis import given, settings, strategies as st

from assayflow.llm import encoding, mixing as mx


@settings(max_examples=200, deadline=None)
@given(st.floats(0, 1e6), st.lists(st.tuples(st.floats(0.01, 10), st.floats(0, 1e5)), min_size=1, max_size=8))
def test_share_out(budget, children):
    got = mx.share_out(budget, children)
    caps = [c for _, c in children]
    assert all(-1e-6 <= g <= c + 1e-3 for g, c in zip(got, caps))
    assert abs(sum(got) - min(budget, sum(caps))) < 1e-2
    free = [g / w for g, (w, c) in zip(got, children) if g < c - 1e-3]
    assert not free or max(free) - min(free) <= 1e-6 * max(1, max(free))


def test_shortage_goes_to_siblings_first():
    leaves = [(("d1", "en", "a"), 0.4, 100.0, 50.0), (("d1", "en", "b"), 0.2, 1000.0, 500.0), (("d2", "en", "c"), 0.4, 1000.0, 500.0)]
    got = mx.budgets(leaves, 500.0)
    assert got[("d2", "en", "c")] == pytest.approx(200) and got[("d1", "en", "a")] == pytest.approx(100) and got[("d1", "en", "b")] == pytest.approx(200)


SCHEMA = "doc_id bigint, text string, lang string, source string, doc_kind string, uses int"
TARGETS = "mix_name string, source string, target_share double, max_repeats int, total_ratio double, tokenizer string"


@pytest.mark.skipif(not os.path.exists(os.path.join(encoding.TOKENIZER_DIR, "byte_bpe_50k.json")), reason="no tokenizer files")
def test_shares_and_repeats(spark):
    rows = [(i, "word " * 20, ["en", None, "de"][i % 3], "big", "article", 9) for i in range(300)]
    rows += [(1000 + i, "word " * 20, "en", "small", "note", 9) for i in range(20)] + [(2000, None, "en", "small", "note", 9), (2001, "", "en", "big", None, 9), (2002, "word " * 20, None, None, None, 9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    targets = spark.createDataFrame([("m", "big", 0.5, 2, 0.5, "byte_bpe_50k"), ("m", "small", 0.3, 3, 0.5, "byte_bpe_50k"), ("m", "none", 0.2, 1, 0.5, "byte_bpe_50k")], TARGETS)
    chosen, rep = mx.mix(docs, targets)
    got = chosen.collect()
    assert {r.source for r in got} == {"big", "small"} and len({r.doc_id for r in got}) == len(got)
    assert max(r.uses for r in got if r.source == "small") == 3 and sum(r.uses for r in got if r.source == "small") == 60
    shares = {r.source: r for r in rep.collect()}
    assert shares["none"].tokens == 0 and shares["small"].most_uses == 3
    total = sum(r.n_tokens * r.uses for r in got)
    assert abs(total - shares["big"].wanted_total) <= 50
    assert sum(r.actual_share for r in shares.values()) == pytest.approx(1)
    odd = targets.unionByName(spark.createDataFrame([(None, "big", 0.5, 2, 0.5, "byte_bpe_50k"), ("m", None, 0.5, 2, 0.5, None), ("n", "big", None, None, None, "byte_bpe_50k")], TARGETS))
    assert {r.mix_name for r in mx.mix(docs, odd)[0].collect()} == {"m"}
    again = mx.mix(docs, targets)[0].collect()
    assert sorted(again) == sorted(got)
    empty, rep = mx.mix(docs.limit(0), targets)
    assert empty.count() == 0 and {r.tokens for r in rep.collect()} == {0}


@pytest.mark.skipif(not os.path.exists(os.path.join(encoding.TOKENIZER_DIR, "byte_bpe_50k.json")), reason="no tokenizer files")
def test_a_source_listed_twice(spark):
    docs = spark.createDataFrame([(i, "word " * 20, "en", "ab"[i % 2], "article", 9) for i in range(100)], SCHEMA)
    once = spark.createDataFrame([("m", "a", 0.6, 2, 0.5, "byte_bpe_50k"), ("m", "b", 0.4, 1, 0.5, "byte_bpe_50k")], TARGETS)
    twice = spark.createDataFrame([("m", "a", 0.2, 2, 0.5, "byte_bpe_50k"), ("m", "b", 0.4, 1, 0.1, "word_bpe_49k"), ("m", "a", 0.4, 1, 0.2, "byte_bpe_50k")], TARGETS)
    assert sorted(mx.mix(docs, twice)[0].collect()) == sorted(mx.mix(docs, once)[0].collect())
