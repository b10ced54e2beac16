"""Queries that must not lose rows of their whole job, on small tables and against plain SQL written here."""

import glob
import os

import pytest

import __spark_entry__ as entry

SF = os.environ.get("ASSAYFLOW_TEST_SF", "/root/testdata/sf0.001")


def _run(spark, tmp_path, name, columns, **tables):
    for t, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{t}.parquet")
    return sorted(tuple(r[c] for c in columns) for r in entry.queries()[name](spark, str(tmp_path)).collect())


def _same_as(spark, name, columns, sql):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    got = sorted(tuple(r[c] for c in columns) for r in entry.queries()[name](spark, SF).collect())
    assert got == sorted(c.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()) and got


def test_jon02_lowest_record_has_a_partner(spark, tmp_path):
    rows = [(1, 9, [("sensing", "glucose")]), (2, 9, [("sensing", "glucose"), ("sensing", "uric acid")]), (3, 9, [("therapy", "glucose"), (None, None)]), (4, 8, [("sensing", "glucose")])]
    got = _run(spark, tmp_path, "jon02_best_application_match", ["record_id", "ord", "score", "partner"], records=(rows, "record_id bigint, paper_id bigint, applications array<struct<application_type string, target_analyte string>>"))
    assert got == [(1, 0, 5, 2), (2, 0, 5, 1), (2, 1, 2, 1), (3, 0, 3, 1)]


def test_jon02_same_as_self_join(spark):
    sql = """WITH a AS (SELECT record_id, paper_id, CAST(ord - 1 AS INTEGER) AS ord, a.target_analyte AS analyte, a.application_type AS kind FROM (SELECT record_id, paper_id, unnest(applications) AS a, generate_subscripts(applications, 1) AS ord FROM records) WHERE a IS NOT NULL),
    j AS (SELECT x.record_id, x.ord, y.record_id AS other, coalesce(CAST(x.analyte = y.analyte AS INTEGER), 0) * 3 + coalesce(CAST(x.kind = y.kind AS INTEGER), 0) * 2 AS score FROM a x JOIN a y ON x.paper_id = y.paper_id AND x.record_id <> y.record_id)
    SELECT record_id, ord, max(score) AS score, arg_min(other, (-score, other)) AS partner FROM j WHERE score >= 2 GROUP BY 1, 2"""
    _same_as(spark, "jon02_best_application_match", ["record_id", "ord", "score", "partner"], sql)


_MANY = dict(
    papers=([(1, "CuO and CuS"), (2, None)], "paper_id bigint, title string"),
    figures=([(1, "Co3O4 beside CuS")], "paper_id bigint, caption_text string"),
    sentences=([(1, "Fe3O4, CuO and then Fe3O4@C or CuO were mixed."), (1, "none"), (2, None)], "paper_id bigint, text string"),
)


def test_ext27_every_name_of_a_text(spark, tmp_path):
    got = _run(spark, tmp_path, "ext27_material_recall", ["paper_id", "name", "sources", "n_evidence"], **_MANY)
    assert got == [(1, "Co3O4", "caption", 1), (1, "CuO", "text|title", 2), (1, "CuS", "caption|title", 2), (1, "Fe3O4", "text", 1), (1, "Fe3O4@C", "text", 1)]


def test_agg13_every_name_of_a_text(spark, tmp_path):
    assert _run(spark, tmp_path, "agg13_absorbed_names", ["paper_id", "name", "n"], **_MANY) == [(1, "cuo", 1), (1, "fe3o4@c", 2)]


def test_ext27_same_as_unnest(spark):
    from assayflow.plans.values import _NAME

    each = " UNION ALL ".join(f"SELECT paper_id, '{n}' AS source, unnest(list_distinct(regexp_extract_all({c}, '{_NAME}', 1))) AS name FROM {t}" for n, c, t in (("title", "title", "papers"), ("caption", "caption_text", "figures"), ("text", "text", "sentences")))
    _same_as(spark, "ext27_material_recall", ["paper_id", "name", "sources", "n_evidence"], f"SELECT paper_id, name, array_to_string(list_sort(list(DISTINCT source)), '|') AS sources, count(*) AS n_evidence FROM ({each}) GROUP BY 1, 2")


def test_jon13_all_six_pairs(spark, tmp_path):
    rows = [(1, "a" * 30, "b", "c", "d"), (2, None, None, "c", "d" * 40), (3, None, None, None, "d")]
    got = _run(spark, tmp_path, "jon13_field_pairs", ["a", "b", "n", "n_apart"], kinetics=(rows, "kin_id bigint, _evidence_Km string, _evidence_Vmax string, _evidence_kcat string, _evidence_kcat_Km string"))
    assert got == [("Km", "Vmax", 1, 1), ("Km", "kcat", 1, 1), ("Km", "kcat_Km", 1, 1), ("Vmax", "kcat", 1, 0), ("Vmax", "kcat_Km", 1, 0), ("kcat", "kcat_Km", 2, 1)]


def test_jon13_same_as_sql_of_all_pairs(spark):
    fields = ["Km", "Vmax", "kcat", "kcat_Km"]
    arms = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, _evidence_{a} AS x, _evidence_{b} AS y FROM kinetics" for i, a in enumerate(fields) for b in fields[i + 1 :])
    _same_as(spark, "jon13_field_pairs", ["a", "b", "n", "n_apart"], f"SELECT a, b, count(*) AS n, CAST(sum(CASE WHEN abs(length(x) - length(y)) > 20 THEN 1 ELSE 0 END) AS BIGINT) AS n_apart FROM ({arms}) WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2")


def test_jon08_context_of_each_figure(spark, tmp_path):
    sentences = [
        (1, 1, "Plain first.", 1, "text"), (2, 1, "Fig. 3 shows the peroxidase-like trace.", 9, "text"), (3, 1, "The Km in Fig. 3 is low.", 9, "text"), (4, 1, "Figs. 3 and S5 agree.", 9, "text"), (5, 1, "Fig. 3. A caption with Km.", 1, "caption"),
        (6, 1, "Km a.", 2, "text"), (7, 1, "Km b.", 2, "text"), (8, 1, "Km a.", 2, None), (9, 1, "Catalytic activity.", 2, "text"), (10, 2, "Fig. 7 of another paper.", 1, "text"),
    ]
    figures = [(20, 1, 1, "Figure 3. Trace."), (21, 1, 1, "Fig. S5. Trace."), (22, 1, 2, "Fig. 7. Trace."), (23, 1, 1, None), (24, 1, None, None), (25, 1, 8, "Fig. 8.")]
    got = _run(
        spark, tmp_path, "jon08_body_context_top3", ["fig_key", "paper_id", "rank", "sent_key"],
        sentences=(sentences, "sent_key bigint, paper_id bigint, text string, page int, source_kind string"), figures=(figures, "fig_key bigint, paper_id bigint, page int, caption_text string"),
    )
    assert got == [(20, 1, 1, 3), (20, 1, 2, 2), (21, 1, 1, 4), (22, 1, 1, 6), (22, 1, 2, 7), (22, 1, 3, 9), (23, 1, 1, 1)]


def test_jon08_same_as_plain_python(spark):
    """The rule of the reference, figure by figure."""
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    import re

    from assayflow.functions import banks

    sen = sorted((r for r in spark.read.parquet(f"{SF}/sentences.parquet").collect() if r.text is not None and r.source_kind != "caption"), key=lambda r: r.sent_key)
    want = []
    for f in spark.read.parquet(f"{SF}/figures.parquet").collect():
        label = re.search(r"(?:^|\n) *(?:fig|abb)[.a-z]* *(s?[0-9]+)", (f.caption_text or "").lower())
        own = [r for r in sen if r.paper_id == f.paper_id]
        named = label and re.compile(rf"(?<![a-z])(?:(?:figs|figures)[.]? *(?:s?[0-9]+ *(?:,|and|&) *)*|(?:fig|abb)[.a-z]* *){label[1]}(?![0-9])")
        related = [r for r in own if named and named.search(r.text.lower())] or [r for r in own if f.page is not None and r.page == f.page]
        kinetics, activity = ([r for r in related if re.search(p, r.text.lower())] for p in (banks.KINETICS_SIGNAL, banks.ACTIVITY_SIGNAL))
        chosen = {}
        for r in kinetics[:2] + activity[:1] + related[:2]:
            chosen.setdefault(r.text, r.sent_key)
        want += [(f.fig_key, f.paper_id, i + 1, k) for i, k in enumerate(list(chosen.values())[:3])]
    got = [(r.fig_key, r.paper_id, r["rank"], r.sent_key) for r in entry.queries()["jon08_body_context_top3"](spark, SF).collect()]
    assert sorted(got) == sorted(want) and got


def test_p6_record_after_a_large_wrapper():
    from assayflow.operators import nested

    record = {"selected_nanozyme": {"name": "CuO"}}
    assert nested.find_record({"log": [{"i": i} for i in range(3000)], "reply": {"data": record}}) == record
