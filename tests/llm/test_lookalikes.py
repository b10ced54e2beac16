from assayflow.functions.charforms import canonical_form
from assayflow.llm import lookalikes as la

SCHEMA = "origin string, row_id bigint, value string, canonical string"


def _rows(spark, values):
    return spark.createDataFrame([("t", i, v, "clash") for i, v in enumerate(values)], SCHEMA)


def test_one_form_per_class(spark):
    values = ["mM", "ｍＭ", "mМ", "m​M", None, "", " ", "mM", "ｍＭ", "mm", "MM", "r\u00e9sum\u00e9", "re\u0301sume\u0301", "resume", "Fe(Ⅲ)", "а" * 5000 + "z", "line\nbreak", "a\tb"]
    got = {(r.row_id, r.canonical) for r in la.consistent(_rows(spark, values)).collect()}
    want = {(i, canonical_form(v)) for i, v in enumerate(values) if v is not None and canonical_form(v) != v}
    assert got == want
    assert {i for i, _ in got} == {1, 2, 3, 8, 14, 15, 17} | {i for i in (11, 12) if canonical_form(values[i]) != values[i]}


def test_case_and_accent_stay_apart(spark):
    assert la.consistent(_rows(spark, ["mM", "MM", "mm", "é", "e"])).count() == 0


def test_empty_table(spark):
    assert la.consistent(_rows(spark, [])).count() == 0


def test_a_plain_value_may_be_the_canonical_member(spark):
    values = ["k\u0000M"] + ["kM"] * 3 + ["k-M"] * 5 + ["K M"]
    assert {(r.row_id, r.canonical) for r in la.consistent(_rows(spark, values)).collect()} == {(0, "kM")}


def test_values_equal_under_the_collation_share_the_key(spark):
    pairs = [("é1", "é1"), ("a­", "a"), ("Å", "Å"), ("가", "가"), ("x​y", "xy")]
    df = spark.createDataFrame([(canonical_form(a), canonical_form(b)) for a, b in pairs], "a string, b string")
    same = df.selectExpr("collate(a, 'UNICODE') = collate(b, 'UNICODE') AS e", "a", "b").select("e", (la.skeleton(df.a.substr(1, 99)) == la.skeleton(df.b.substr(1, 99))).alias("k"))
    assert all(r.k for r in same.collect() if r.e)
