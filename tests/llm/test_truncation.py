from assayflow.llm import truncation as tr

SCHEMA = "kin_id bigint, source string, _evidence_Km string, _evidence_Vmax string, field string, text string"
WHOLE = [
    "| CuS | TMB | Km 0.2 mM | pH 3 |",
    "[Km=64.7 μM; axis=1/v against 1/[TMB]]",
    "Km(TMB) was found to be 0.35 mM for CeO2.",
    "Fig. 3. Initial rate of CuO (Km = 0.2 mM)",
    "Figure 7. Double-reciprocal plot of WO3 for OPD, Km 0.938 mol/L",
    "以OPD为底物时，测得Km为0.634 mM。",
    "Kinetic constants are listed in Table 2.",
]
CUT = [
    "| CuS | TMB | Km 0.2 m",
    "[Km=64.7 μM; axis=1/v against 1/[TMB]",
    "Km was 0.35 mM. All runs were done at pH 6.",
    "Km was 0.35 mM. The buffer held 50 mM acetate and ca.",
    "Fig. 3. Initial rate of CuO (Km = 0",
    "以OPD为底物时，测得Km为0.634 mM。该值低于",
    "The value was re�",
    "Km(TMB) was found to be 0.35 mM for Ce…",
    "| CuS | TMB |",
]


def _found(spark, texts, source="text"):
    df = spark.createDataFrame([(i, source, t, None, "f", "t") for i, t in enumerate(texts)], SCHEMA)
    return {r.kin_id: r.reason for r in tr.cut_cells(df).collect()}


def test_whole_and_cut(spark):
    assert set(_found(spark, WHOLE + CUT)) == set(range(len(WHOLE), len(WHOLE) + len(CUT)))


def test_remarks_are_learned(spark):
    whole = ["constants as in the SI"] * 9 + ["Km 3 mM, double-reciprocal fit"] * 9 + ["Km of CuS: 3 mM, pH 4.5, 55 °C"] * 9
    cut = ["Km of CuS: 3 mM, p", "constants as in t", "Km 3 mM, double-recipr"]
    assert set(_found(spark, whole + cut)) == {27, 28, 29}


def test_field_limit_spike(spark):
    base = "Km was 0.5 mM for CuO. Comparable constants were found for the other batches of the same material and all of the runs"
    texts = [f"Km({i}) " + base[:93 - len(str(i))] for i in range(20)] + [base[:60] + "." * 1 for _ in range(5)] + [base[:n] for n in range(40, 60)]
    got = _found(spark, texts)
    assert all(got[i] == "limit_chars" for i in range(20)) and not any(i in got for i in range(20, 25)) and got[30] == "transfer"


def test_nulls_blanks_long_and_shares(spark):
    df = spark.createDataFrame(
        [(1, None, None, " ", "f", "t"), (2, None, "x" * 50_000 + " (", "", "f", "t"), (2, None, "x" * 50_000 + " (", "", "f", "t")], SCHEMA
    )
    assert [(r.kin_id, r.field) for r in tr.cut_cells(df).collect()] == [(2, "_evidence_Km")] * 2
    row = tr.cut_shares(df).collect()
    assert [(r.source, r.n_cells, r.n_cut, r.cut_share) for r in row] == [(None, 2, 2, 1.0)]
    assert tr.cut_cells(df.limit(0)).count() == 0
