from hypothesis import given, settings, strategies as st

from assayflow.llm import canonical as cn

ENTRIES = [(1, ["peroxidase-like", "POD-like", "POD"]), (2, ["oxidase-like", "OXD"]), (5, ["glutathione-peroxidase-like", "GPx"]), (6, ["glutathione-oxidase-like"]), (4, ["superoxide-dismutase-like", "SOD"])]
WORD = st.text("abc", max_size=6)


@settings(max_examples=150, deadline=None)
@given(WORD, WORD, WORD)
def test_distance_is_a_metric(a, b, c):
    ab, bc, ac = cn.distance(a, b), cn.distance(b, c), cn.distance(a, c)
    assert ac <= ab + bc and ab == cn.distance(b, a) and (ab == 0) == (a == b)


@settings(max_examples=60, deadline=None)
@given(st.lists(WORD, max_size=30), WORD, st.integers(0, 3))
def test_tree_returns_every_word_within(words, q, r):
    want = {(cn.distance(q, w), w) for w in words if cn.distance(q, w) <= r}
    assert set(cn.BKTree(iter(words)).within(q, r)) == want


def test_values():
    m = cn.Matcher(ENTRIES)
    want = {
        "Peroxidase–Like": 1, "peroxidaes miic": 1, "HRP-like peroxidase mimic (main)": 1, "pod": 1, "POD_like": 1, "glutathione peroxidtse like": 5, "glutathione oxidase mimic": 6,
        "gucosee": None, "dismutase of superoxide": 4, "glutathion eoxidase": 6, "XOD-like": None, "urease-like": None, "lipase": None, "": None, "??": None, "oxidase (OXD)-like": 2,
    }
    assert cn.Matcher([(35, ["ion exchange"])]).best("in exchaange route")[0] == 35
    assert {v: (m.best(v) or (None,))[0] for v in want} == want


REC = "record_id bigint, field string, main_activity struct<enzyme_like_type string, assay_method string>, selected_nanozyme struct<synthesis_method string>"


def test_operator(spark):
    ref = spark.createDataFrame([(t, "enzyme_like_type", n[0], n[1:]) for t, n in ENTRIES] + [(20, "synthesis_method", "sol-gel", None)], "term_id int, field string, canonical string, aliases array<string>")
    rows = [(1, "x", ("POD", None), ("solgel process",)), (2, "x", None, None), (3, "x", (" ", "HPLC"), ("a " * 3000,)), (3, "x", ("POD", None), None)]
    rows += [(i, "x", ("lixidase", None), None) for i in range(100, 110)]
    df = spark.createDataFrame(rows, REC)
    got = sorted((r.record_id, r.field, r.term_id) for r in cn.map_values(df, ref).collect() if r.record_id < 100)
    assert got == [(1, "enzyme_like_type", 1), (1, "synthesis_method", 20), (3, "assay_method", -1), (3, "enzyme_like_type", 1), (3, "synthesis_method", -1)]
    assert cn.map_values(df.limit(0), ref).count() == 0
    assert {r.term_id for r in cn.map_values(df, ref.limit(0)).collect()} == {-1}


def test_shards_merge(spark, monkeypatch):
    monkeypatch.setattr(cn, "SHARD_ENTRIES", 2)
    ref = spark.createDataFrame([(t, "enzyme_like_type", n[0], n[1:]) for t, n in ENTRIES], "term_id int, field string, canonical string, aliases array<string>")
    df = spark.createDataFrame([(i, "x", (v, None), None) for i, v in enumerate(["glutathione oxidse", "SOD", "oxidase", "none"])], REC)
    assert [r.term_id for r in cn.map_values(df, ref).orderBy("record_id").collect()] == [6, 4, 2, -1]
