import json

import pytest
from pyspark.sql import functions as F

from assayflow.operators import extraction as ex, grouped as gr, lookups as lk, relations as rel, text as tx
from assayflow.sources import readers, sinks
from assayflow.streaming import ingest


@pytest.mark.parametrize(
    "raw,want",
    [
        ("Fe 3 O 4 nanozymes", "Fe3O4"), ("H 2 O 2 and O 2", "H2O2"), ("MnCo 2 O 4 nanotubes", "MnCo2O4"), ("La 0.5 Sr 0.5 MnO 3 nanozymes", "La0.5Sr0.5MnO3"), ("Fe 3+ ions", "Fe3+"),
        ("10 μg mL − 1 concentration", "mL^-1"), ("M − 1 s − 1 reaction rate", "M^-1 s^-1"), ("cm − 1 absorbance", "cm^-1"),
    ],
)
def test_scientific_spelling(raw, want):
    assert want in gr.scientific_spelling(raw)


def test_scientific_spelling_leaves_words():
    assert "shownin" not in gr.scientific_spelling("shown in Figure 3a")
    assert gr.scientific_spelling(None) is None and gr.scientific_spelling("") == ""


def test_assignment_never_crosses_and_beats_greedy():
    caps = [("c1", (0, 110, 100, 120)), ("c2", (0, 320, 100, 330))]
    figs = [("f1", (0, 0, 100, 100)), ("f2", (0, 210, 100, 310))]
    assert [(c, f) for c, f, _ in gr.assign(caps, figs, 600)] == [("c1", "f1"), ("c2", "f2")]
    assert gr.assign(caps, [("far", (0, 1000, 100, 1100))], 600) == []
    assert gr.assign([], figs, 600) == []


def test_short_chunks_merge_to_a_fixed_point():
    assert gr.merge_short_chunks([100, 5, 90, 3], 20) == [100, 98] or sum(gr.merge_short_chunks([100, 5, 90, 3], 20)) == 198
    assert gr.merge_short_chunks([3], 20) == [3] and gr.merge_short_chunks([], 5) == []


def test_layout_tree_in_reading_order():
    doc = {"kids": [{"type": "heading", "content": "A", "page number": 1}, {"type": "list", "list items": [{"content": "x"}, {"content": "y"}]}, {"type": "table", "rows": [{"cells": [{"kids": [{"type": "paragraph", "content": "c"}]}]}]}]}
    assert [e["text"] for e in gr.layout_elements(doc)] == ["A", "x", "y", "", "c"]
    assert gr.layout_elements(None) == []


def test_token_bucket(spark):
    rows = [(i, "u", 1_700_000_000 + i) for i in range(5)] + [(9, "u", 1_700_002_000), (7, "v", 1_700_000_000)]
    df = spark.createDataFrame(rows, "event_id bigint, user_id string, s bigint").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.event_id: r.allowed for r in gr.token_bucket(df, "user_id", "ts", 0.001, 3.0, "event_id").collect()}
    assert got == {0: True, 1: True, 2: True, 3: False, 4: False, 9: True, 7: True}


def test_text_operators(spark):
    row = spark.createDataFrame([("5.71 × 10³ μM", "A et al. found it. It fell. No.")], "n string, t string").select(
        tx.parse_number(F.col("n")).alias("v"), tx.split_sentences(F.col("t")).alias("s"), tx.greedy_pack(F.array(F.lit("aaaa"), F.lit("bb"), F.lit("cccccc")), 8).alias("p"), tx.composition_parts(F.lit("N-doped CuO@C")).alias("c"),
    ).collect()[0]
    assert row.v == pytest.approx(5710) and list(row.s) == ["A et al. found it.", "It fell."] and list(row.p) == ["aaaa bb", "cccccc"] and row.c.core == "CuO" and row.c.dopant == "N"


def test_lookup_and_extraction(spark):
    df = spark.createDataFrame([("Peroxidase (POD)-like", 2.0, "M", "Km(TMB) = 0.35 mM"), (None, None, None, None)], "v string, x double, u string, e string")
    got = lk.canonical_enzyme(df, "v").collect()
    assert sorted(str(r.canonical) for r in got) == ["None", "peroxidase-like"]
    assert [r.converted for r in lk.convert(df, "x", "u", "mM").collect()] == [2000.0, None]
    value, method = ex.cascade(F.col("e"), ex.KM_PATTERNS)
    assert [tuple(r) for r in df.select(value.alias("a"), method.alias("b")).collect()] == [(0.35, "named"), (None, None)]
    assert df.select(rel.range_status(F.col("x"), "Km").alias("s")).collect()[0].s == "flag"


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a_mid_task.json").write_text(json.dumps({"llm_task": {"chunks": ["c1", "c2"], "chunk_contexts": [{"candidate_system_mentions": ["CuO"]}]}}))
    (tmp_path / "in" / "sub" / "mid_task.json").write_text("{broken")
    (tmp_path / "in" / "gold_template.json").write_text("{}")
    (tmp_path / "in" / "x.png").write_bytes(b"\x89PNG")
    (tmp_path / "in" / "p SI.pdf").write_bytes(b"1")
    (tmp_path / "in" / "p.pdf").write_bytes(b"1")
    path = str(tmp_path / "in")
    tasks = readers.task_files(spark, path)
    assert [r.readable for r in tasks.collect()].count(True) == 1 and tasks.count() == 2
    assert [(r.ord, r.chunk, r.mentions) for r in readers.task_chunks(tasks).orderBy("ord").collect()] == [(0, "c1", ["CuO"]), (1, "c2", None)]
    assert readers.gold_records(spark, path).where("name LIKE '%template%'").count() == 0
    assert [r.name for r in readers.pdf_listing(spark, path).collect()] == ["p.pdf"] and readers.images(spark, path).count() == 1
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sinks.write_records(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    after = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "k int, v string")
    assert sorted(r.k for r in sinks.changed_only(df, after, "k").collect()) == [2, 3]
    assert sinks.pending(after, df, ["k"]).count() == 1 and sinks.invalidate(after, df, "k").count() == 1
    assert "| 1 | a |" in sinks.markdown(df.orderBy("k"), "t") and sinks.cache_key(df, ["k"], "c").select("cache_key").distinct().count() == 2
    files = spark.createDataFrame([("f1", "a.png"), ("f2", "a.png")], "file string, name string")
    assert sorted(r.target for r in sinks.unique_names(files, "name").collect()) == ["a.png", "a_1.png"]


def test_config(tmp_path, monkeypatch):
    monkeypatch.setenv("ASSAY_KEY", "s")
    (tmp_path / "c.json").write_text('{"a": {"b": "${ASSAY_KEY}"}, "l": ["env:ASSAY_KEY"]}')
    assert readers.load_config(str(tmp_path / "c.json"), {"a": {"b": 1, "c": 2}}) == {"a": {"b": "s", "c": 2}, "l": ["s"]}
    assert readers.rule_book(str(tmp_path / "none.json")) == {} and readers.render("x {a}", {"a": [1, 2]}, 1) == "x 1"


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(i, "u", i) for i in range(6)], "event_id bigint, user_id string, s bigint").withColumn("ts", F.timestamp_seconds("s"))
    rows.coalesce(1).write.parquet(str(tmp_path / "t" / "events.parquet"))
    stream = ingest.stream_table(spark, str(tmp_path / "t"), "events")
    assert ingest.run_available(stream, "t").count() == 6
    got = ingest.run_available(ingest.stream_table(spark, str(tmp_path / "t"), "events"), "l", lambda d: ingest.limited(d, "user_id", "ts", 0.001, 3.0))
    assert got.where("allowed").count() == 3
    assert ingest.windowed(stream, "ts", "1 hour", "10 minutes", "user_id").columns == ["start", "user_id", "n"]
