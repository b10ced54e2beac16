"""One case for each branch of the rules, with expected values written by hand."""

import pytest
from pyspark.sql import functions as F

from assayflow.functions import fixed
from assayflow.plans import judgements as ju, rules as ru


def _map(spark, fn, cases):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", fn(F.col("t")).alias("v")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


def test_enzyme_names(spark):
    _map(spark, ru.enzyme_underscore, [
        (None, "unknown"), ("", "unknown"), (" POD-like ", "peroxidase_like"), ("peroxidase mimic", "peroxidase_like"), ("glucose oxidase-like", "glucose_oxidase_like"), ("superoxide dismutase", "superoxide_dismutase_like"),
        ("vhpo", "haloperoxidase_like"), ("urease", "other"), ("nuclease-like mimic", "nuclease_like"),
    ])
    _map(spark, ru.enzyme_final, [("POD-like", "peroxidase-like"), ("sod_like", "superoxide-dismutase-like"), ("Peroxidase Like", "peroxidase-like"), ("urease_like", "urease-like"), ("urease", "urease")])
    _map(spark, ru.enzyme_conflict_key, [(None, None), ("", None), ("POD like", "peroxidase-like"), ("Peroxidase_Like", "peroxidase-like")])


def test_assay_and_signal(spark):
    _map(spark, ru.assay_method, [(None, "other"), ("UV/vis", "UV-vis"), ("a fluorometric readout", "fluorescence"), ("ESR", "EPR"), ("HPLC", "other"), ("chemiluminescence assay", "chemiluminescence")])
    _map(spark, ru.signal_type, [("Absorbance at 652 nm", "absorbance"), ("raman", "raman intensity"), ("odour", "odour")])


def test_application_types(spark):
    kind = lambda c: ru.application_type(c, F.lit(""))
    _map(spark, kind, [
        ("Colorimetric detection of glucose", "colorimetric_sensing"), ("fluorescent probe", "fluorescence_sensing"), ("amperometric sensor", "electrochemical_sensing"), ("SERS substrate", "SERS_sensing"), ("a biosensor", "biosensing"),
        ("wound healing", "therapeutic"), ("anti-microbial film", "antibacterial"), ("radical scavenging", "antioxidant"), ("water treatment", "environmental_detection"), ("food safety", "food_safety"), ("point-of-care test", "diagnostic"), (None, "other"), ("dyeing", "other"),
    ])
    _map(spark, ru.analyte_of, [("sensing of Glucose in serum", "glucose"), ("detection of nitrite ions by colour", "nitrite ions by colour"), ("", None), (None, None), ("a plain note", None)])
    _map(spark, ru.is_analyte, [(None, False), ("Glucose", True), ("HeLa cells", True), ("to detect", True), ("TMB", False)])


def test_table_type_ties_go_to_the_earlier(spark):
    _map(spark, ru.table_type, [
        ("Km and Vmax of all samples", "kinetics_table"), ("LOD and linear range", "sensing_performance_table"), ("Comparison with literature", "comparison_table"), ("Recovery of spiked samples, RSD", "recovery_table"),
        ("BET surface area", "characterization_table"), ("Km, LOD", "kinetics_table"), ("Km, LOD, sensitivity", "sensing_performance_table"), ("plain", "general_table"),
    ])


def test_table_priority(spark):
    rows = [("kinetics_table", "Km 0.35", 7, True, 17.0), ("general_table", "a", 1, False, 2.0), ("general_table", "a", 3, True, 3.0), ("characterization_table", "x" * 301, 2, False, 9.0)]
    df = spark.createDataFrame(rows, "k string, t string, n int, s boolean, want double")
    assert all(r.v == r.want for r in df.select("want", ru.table_priority(F.col("k"), F.col("t"), F.col("n"), F.col("s")).alias("v")).collect())


def test_caption_agreement(spark):
    rows = [("Kinetics of CuO", "kinetics", 1.0), ("Kinetics of CuO", None, 0.3), ("TEM images", "kinetics", 0.3), ("Photograph", None, 0.5), ("", "kinetics", 0.0), (None, None, 0.0), ("Km and TEM", "michaelis plot", 0.65)]
    df = spark.createDataFrame(rows, "c string, t string, want double")
    assert all(r.v == r.want for r in df.select("want", ru.agreement(F.col("c"), F.col("t")).alias("v")).collect())


def test_caption_values(spark, tmp_path):
    rows = [(1, "Km = 0.35 mM, then Km: 1.2e-1 μM and Vmax = 3.2 mM/s."), (2, "Km of CuO"), (3, None)]
    spark.createDataFrame(rows, "fig_key bigint, caption_text string").write.parquet(f"{tmp_path}/figures.parquet")
    got = sorted((r.fig_key, r.parameter, r.ord, r.value, r.unit) for r in ru.QUERIES["ext23_caption_values"](spark, str(tmp_path)).collect())
    assert got == [(1, "Km", 0, 0.35, "mM"), (1, "Km", 1, 0.12, "μM"), (1, "Vmax", 0, 3.2, "mM/s")]


@pytest.mark.parametrize("name, text, want", [
    ("surface_area", "The BET surface area was 85.2 m2/g here", "85.2 m2/g"), ("surface_area", "BET = 12 m²/g", "12 m²/g"), ("zeta_potential", "zeta potential of -21.5 mV", "21.5 mV"), ("zeta_potential", "showed a zeta potential 7 mV", "7 mV"),
    ("pore_size", "pore diameter: 3.4 nm", "3.4 nm"), ("pore_size", "BJH pore size of 4 Å", "4 Å"), ("pore_size", "pores everywhere", None),
])
def test_physical_properties(spark, name, text, want):
    assert spark.range(1).select(ru.physical(F.lit(text), name).alias("v")).first().v == want


def test_attribution_outcomes(spark):
    own, other = F.array(F.lit("cuo"), F.lit("cuo nps")), F.array(F.lit("fe3o4"))
    _map(spark, lambda t: ju.attribution(t, own, other), [
        ("cuo was active", "mentions_selected_only"), ("cuo, unlike enzymes, was stable", "mentions_selected_but_contrast"), ("in this work cuo was higher than fe3o4", "selected_with_this_work_marker_amid_contrast"),
        ("cuo was better than fe3o4", "selected_is_subject_in_contrast"), ("the rate was lower than with cuo and fe3o4", "contrast_context_mentions_both"), ("cuo and fe3o4 were mixed", "mentions_both_no_contrast"),
        ("herein fe3o4 was used", "this_work_marker_without_explicit_name"), ("fe3o4 was reported by others", "previous_work_reference"), ("fe3o4 was used", "mentions_other_only"),
        ("in this work a film was cast", "this_work_marker_generic"), ("see ref. 3", "previous_work_generic"), ("a film was cast", "no_material_mentioned"),
    ])
    _map(spark, lambda t: ju.is_subject(t, own), [("cuo was first", True), ("compared with  fe3o4, cuo showed more", True), ("then cuo came", False)])


def test_names(spark):
    _map(spark, lambda t: F.array_join(F.array_sort(ju.variants(t)), "|"), [("Au@CeO2", "au|au@ceo2|ceo2"), ("the N-doped C nanosheets", "n-doped c nanosheets|the n-doped c|the n-doped c nanosheets|thendopedcnanosheets"), ("", None)])
    _map(spark, ju.bare_name, [("CuO nanoparticles", "CuO"), ("CuO NPs ", "CuO"), (" nanosheets", " nanosheets"), ("CuO", "CuO")])
    _map(spark, lambda t: ju.compatible(F.lit("CuO nanosheets"), t), [("cuo", True), ("CuO-nanosheet", True), ("Fe3O4", False), ("CuOnanorods", False)])


def test_layout_marks(spark):
    _map(spark, ju.heading_collapsed, [("A B S T R A C T of X", "ABSTRACT of X"), ("A B test", "A B test"), (None, None)])
    _map(spark, ju.is_header_footer, [(None, True), (" ", True), ("12", True), ("Page 3", True), ("doi:10.1/x", True), ("https://x.org", True), ("Contents lists available at", True), ("Results", False)])
    _map(spark, ju.contents_marks, [("Table of Contents", "heading"), ("Supplementary Figure S1. Spectra", "entry"), ("Supplementary words", None)])


def test_contents_pages(spark, tmp_path):
    entry = "Supplementary Figure S1"
    blocks = [(1, 1, "heading", "Contents")] + [(1, 2, "paragraph", entry)] * 2 + [(1, 3, "paragraph", entry)] * 2 + [(1, 5, "paragraph", entry)] * 4 + [(1, 7, "paragraph", entry), (2, 1, "heading", "Contents"), (1, None, "heading", "Contents")]
    spark.createDataFrame(blocks, "paper_id bigint, page int, kind string, text string").write.parquet(f"{tmp_path}/blocks.parquet")
    spark.createDataFrame([(1, "supplementary"), (2, "main")], "paper_id bigint, document_kind string").write.parquet(f"{tmp_path}/papers.parquet")
    got = {(r.paper_id, r.page): r.contents for r in ju.QUERIES["lay12_contents_pages"](spark, str(tmp_path)).collect()}
    assert got == {(1, 1): True, (1, 2): True, (1, 3): False, (1, 5): True, (1, 7): False}


def test_nearest_table_caption(spark, tmp_path):
    blocks = [(1, 1, 1, "paragraph", "x"), (2, 1, 3, "caption", "Table 1. Constants"), (3, 1, 2, "caption", "Table S2"), (4, 1, 5, "paragraph", "y"), (5, 1, 9, "paragraph", "z"), (6, 1, 2, "paragraph", "w"), (7, 1, 2, "caption", "Fig. 1")]
    spark.createDataFrame(blocks, "block_key bigint, paper_id bigint, page int, kind string, text string").write.parquet(f"{tmp_path}/blocks.parquet")
    got = {(r.page, r.caption_key, r.distance) for r in ju.QUERIES["jon06_table_caption_within_two_pages"](spark, str(tmp_path)).collect()}
    assert got == {(1, 3, 1), (2, 3, 0), (5, 2, 2)}


def test_reply_text(spark):
    _map(spark, ju.reply_text, [
        ('{"choices": [{"message": {"content": "a"}}]}', "a"), ('{"choices": [{"message": {"content": "", "reasoning_content": "b"}}]}', "b"), ('{"choices": [{"delta": {"content": "c"}}]}', "c"),
        ('{"choices": [], "output_text": " ", "response": " d "}', "d"), ('{"choices": null, "text": "e"}', None), ('{"text": "f"}', None), ("no json", None), (None, None),
    ])


def test_context_around_recalled_sentences(spark, tmp_path):
    rows = [(1, 1, "a", "The Km was low."), (1, 2, "b", "Plain words follow here."), (1, 3, "b", "More plain words follow."), (1, 4, "c", "A value of 3 mM was used."), (1, 5, "c", "Its block has two sentences."), (1, 6, "d", "Far away from anything."), (2, 7, "a", "Another paper altogether.")]
    spark.createDataFrame(rows, "paper_id bigint, sent_key bigint, block_id string, text string").write.parquet(f"{tmp_path}/sentences.parquet")
    got = {r.sent_key: r.why for r in ju.QUERIES["win01_recall_context"](spark, str(tmp_path)).collect()}
    assert got == {1: "anchor", 2: "neighbour", 4: "anchor", 5: "block"}


def test_conflicts(spark):
    rows = [("CuO", "CuO NPs", "POD-like", "peroxidase-like", 1.0, 50.0, ""), ("CuO", "Fe3O4", "POD-like", "SOD-like", 1.0, 101.0, "name|enzyme_like_type|Km"), (None, "Fe3O4", None, "SOD-like", None, 3.0, ""), ("CuO", "CuO", "", "x", 1.0, 0.009, "Km"), ("CuO", "CuO", "x", "x", 0.0, 5.0, "")]
    df = spark.createDataFrame(rows, "rule_name string, reply_name string, rule_enzyme string, reply_enzyme string, rule_Km double, reply_Km double, want string")
    for k in ("Vmax", "kcat"):
        df = df.withColumn(f"rule_{k}", F.lit(None).cast("double")).withColumn(f"reply_{k}", F.lit(None).cast("double"))
    assert all(r.v == r.want for r in df.select("want", F.array_join(ju.conflicts(), "|").alias("v")).collect())


def test_lists_are_in_their_order():
    assert fixed.ANALYTES == sorted(fixed.ANALYTES) and fixed.SUBSTRATES == sorted(fixed.SUBSTRATES)


def test_alias_predicates(spark):
    _map(spark, ju.valid_alias, [("cat", True), ("c", False), ("12 nm", False), ("see table", False), ("with", False), ("x" * 31, False), ("a b c d e f", False), ("1a", False)])
    _map(spark, ju.could_be_alias, [("CuO", False), ("CuS@C", True), ("Cu", False), ("Fe2O3", False), ("a1", False), ("x", False), ("ZIF-8", True)])
    _map(spark, ju.likely_abbreviation, [("CNTs", True), ("MOF", True), ("some material", False), ("gold NPs", True)])


def test_forbidden_fields(spark):
    _map(spark, lambda t: F.array_join(ju.forbidden_fields(t), "|"), [
        ('{"paper": {"system_name": 1}, "assay_graph": []}', "assay_graph|system_name"), ('{"a": {"b": {"systems_count": 2}}}', "systems_count"), ('{"a": [{"system_name": "x"}]}', "system_name"),
        ('{"a": {"b": {"c": {"system_name": 1}}}}', ""), ("no json", ""), (None, ""), ("{}", ""),
    ])


@pytest.mark.parametrize("name, text, want", [
    ("Km", "Km(TMB) = 0.35 mM", (0.35, "mM", "named")), ("Km", "The Km for H2O2 was found to be 1.2 ± 0.1 mM here", (1.2, "mM", "named")), ("Km", "Km value of 3 × 10⁻² mM", (0.03, "mM", "plain")), ("Km", "Km 12.5 μM", (12.5, "μM", "plain")),
    ("Km", "a Michaelis constant near 4 mM", (4.0, "mM", "words")), ("Km", "Km of this batch, measured twice, was 7e-3 M.", (0.007, "M", "far")), ("Km", "Km and Vmax were 0.35 mM and 3.2 × 10^-7 M s-1", (0.35, "mM", "joint")), ("Km", "Km was 3 mM/s", None), ("Km", "no constant", None),
    ("Vmax", "Km and Vmax were 0.35 mM and 3.2 × 10⁻⁷ M s⁻¹", (3.2e-7, "M s-1", "joint")), ("Vmax", "Vmax = 5 μM/s", (5.0, "μM/s", "plain")), ("Vmax", "maximum velocity of about 2 mM/min", (2.0, "mM/min", "words")), ("Vmax", "Vmax of the plot. After correction 4e-8 M/s", (4e-8, "M/s", "window")),
])
def test_constants_with_units(spark, name, text, want):
    from assayflow.plans import kinetic_texts as kt

    got = spark.range(1).select(kt.stated(kt.plain_signs(F.lit(text)), name).alias("v")).first().v
    assert (got is None) == (want is None) and (want is None or (got.value == pytest.approx(want[0]) and got[1:] == want[1:]))
