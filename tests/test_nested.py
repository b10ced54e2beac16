import json

from pyspark.sql import types as T

from assayflow.functions.jsonrepair import loads_lenient
from assayflow.operators import nested

KIN = "struct<Km double, Km_unit string, substrate string>"
APP = "struct<application_type string, method string>"
SCHEMA = (
    "record_id bigint, paper_id bigint, paper struct<title string, year int>, "
    "selected_nanozyme struct<name string, metal_elements array<string>, synthesis_conditions struct<precursors array<string>>, "
    "composition_structured struct<dopants array<string>>>, "
    f"main_activity struct<enzyme_like_type string, substrates array<string>, kinetics_list array<{KIN}>>, applications array<{APP}>"
)


def _like() -> T.StructType:
    return T.StructType.fromDDL(SCHEMA)


def _links(df):
    return sorted((r.record_id, r.child, r.ord) for r in df.collect())


def test_typed_children_keep_positions(spark):
    rows = [
        (1, 1, None, ("a", ["Fe", None, "Fe"], (["x"],), None), ("p", [], [(None, None, None), (1.0, "mM", None), None]), [("s", None)]),
        (2, 1, None, None, None, None),
        (None, 1, None, ("b", None, None, (["N"],)), None, []),
    ]
    got = nested.child_links(spark.createDataFrame(rows, _like()))
    assert sorted(((r.record_id, r.child, r.ord) for r in got.collect()), key=str) == sorted(
        [
            (1, "selected_nanozyme.metal_elements", 0),
            (1, "selected_nanozyme.metal_elements", 2),
            (1, "selected_nanozyme.synthesis_conditions.precursors", 0),
            (1, "main_activity.kinetics_list", 1),
            (1, "applications", 0),
            (None, "selected_nanozyme.composition_structured.dopants", 0),
        ],
        key=str,
    )


def test_replies_as_untidy_as_they_come(spark):
    rec = {"paper": {}, "selected_nanozyme": {"metal_elements": "Mo", "bad": ["z"]}, "main_activity": {"kinetics_list": {"Km": "0.5"}}, "applications": [{}, None, {"x": 1}]}
    texts = [
        json.dumps(rec),
        "```json\n" + json.dumps({"record": rec}) + "\n```",
        "Here it is: " + json.dumps({"result": {"ok": True, "data": rec}}),
        json.dumps(rec | {"main_activity": json.dumps(rec["main_activity"])}),
        json.dumps(rec).replace('"', "'").replace("None", "null")[:-1] + ",}",
        json.dumps(rec | {"extra": {"kinetics_list": [{"Km": 1}]}}),
    ]
    rows = [(i, "m", t) for i, t in enumerate(texts)] + [(90, "m", None), (91, "m", ""), (92, "m", "no json"), (93, "m", "[]"), (94, "m", '{"a": 1}')]
    raw = spark.createDataFrame(rows, "record_id bigint, reply_from string, record_json string")
    got = nested.canonical_records(raw, _like())
    want = [(i, c, o) for i in range(len(texts)) for c, o in (("selected_nanozyme.metal_elements", 0), ("main_activity.kinetics_list", 0), ("applications", 2))]
    assert _links(nested.child_links(got)) == sorted(want)
    status = {r.record_id: r.parse_status for r in got.collect()}
    assert status[0] == "ok" and status[1] == "repaired" and {status[i] for i in (90, 91, 92, 93, 94)} == {"failed"}
    kin = nested.child_table(got, "main_activity.kinetics_list").where("record_id = 0").collect()
    assert [(r.ord, r.Km, r.Km_unit) for r in kin] == [(0, 0.5, None)]


def test_empty_table_extra_and_clashing_columns(spark):
    typed = spark.createDataFrame([], _like())
    assert nested.child_links(typed).count() == 0
    raw = spark.createDataFrame([(1, "x", '{"applications": ["sensing"]}', "clash")], "record_id bigint, paper string, record_json string, parse_status string")
    got = nested.canonical_records(raw, _like())
    assert _links(nested.child_links(got)) == [(1, "applications", 0)]


def test_lenient_reader():
    assert loads_lenient('{"a": 1, "a": null}')[0] == {"a": 1}
    assert loads_lenient("{a: 1, 'b': [1, 2,], c: None, // x\n d: True")[0] == {"a": 1, "b": [1, 2], "c": None, "d": True}
    assert loads_lenient('{"t": "line\nbreak", "n": 1.5e3')[0] == {"t": "line\nbreak", "n": 1500.0}
    assert loads_lenient("[" * 5000)[1] in ("repaired", "failed")
    assert loads_lenient(None) == (None, "failed")


def test_record_table_flattens_scalars(spark):
    df = spark.createDataFrame([(1, 1, ("t", 2000), None, None, None)], _like())
    row = nested.record_table(df).collect()[0]
    assert row["paper__title"] == "t" and row["paper__year"] == 2000 and row["main_activity__enzyme_like_type"] is None
