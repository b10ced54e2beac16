from fractions import Fraction

import pytest

from assayflow.functions.charforms import canonical_form
from assayflow.functions.units import read_quantity, read_unit, to_common
from assayflow.operators import unit_harmony
from assayflow.plans import general


@pytest.mark.parametrize(
    "unit",
    ["mM", "ｍＭ", "mМ", "m​M", "mmol/L", "mmol L^-1", "mmol·L⁻¹", "mol m-3", "millimolar", "mmol dm^-3", "×10^-3 M", "E-3 M", "μmol/mL", "mmol L-1"],
)
def test_one_unit_many_spellings(unit):
    assert read_unit(unit) == (Fraction(1, 1000), (1, -1, 0))


@pytest.mark.parametrize("unit", ["", "a.u.", "mg/mL", "% w/v", "U/mg", "mmol", "M-", "mol·", "ΔA/min", "m", "μM s"])
def test_not_a_concentration(unit):
    got = read_unit(unit)
    assert got is None or got[1] != (1, -1, 0)


def test_compound_units():
    assert read_unit("M/min")[0] == Fraction(1, 60)
    assert read_unit("10⁻⁸ M s⁻¹") == (Fraction(1, 10**8), (1, -1, -1))
    assert read_unit("L/(mol·s)") == (1, (-1, 1, -1))
    assert read_unit("mL nmol^-1 s^-1") == (10**6, (-1, 1, -1))
    assert read_unit("m3 mol-1 s-1") == (1000, (-1, 1, -1))
    assert read_unit("M per second")[1] == (1, -1, -1)


@pytest.mark.parametrize(
    "args,want",
    [
        ((0.5, "mM", None, None), 500_000),
        ((None, None, "12,9 ± 0.4 μM", None), 12_900),
        ((None, None, "0.00113 ± 5e-05 mol/L", None), 1_130_000),
        ((None, None, "5.71 × 10³ μM", None), 5_710_000),
        ((None, "×10^-3 M", "17.6 ×10^-3 M", None), 17_600_000),
        ((17.6, None, None, "Km 17.6 ×10^-3 M."), 17_600_000),
        ((0.35, None, None, "in 50 mM acetate, Km was 0.35 mM"), 350_000),
        ((73.1, None, None, "米氏常数为73.1 mM。"), 73_100_000),
    ],
)
def test_reading_km(args, want):
    number, factor, _, status = read_quantity("Km", *args)
    assert status == "stated" and to_common("Km", number, factor) == want


@pytest.mark.parametrize(
    "args,status",
    [
        ((None, "mM", None, None), "no_value"),
        ((float("nan"), "mM", None, None), "no_value"),
        ((0.0, "mM", None, None), "not_positive"),
        ((1.0, "s^-1", "1 mM", None), "not_convertible"),
        ((1.0, "  ", None, "Km 1 μmo"), "no_unit"),
        ((1.0, None, None, "x" * 100_000), "no_unit"),
    ],
)
def test_values_that_are_no_case(args, status):
    assert read_quantity("Km", *args)[3] == status


SCHEMA = "kin_id bigint, source string, substrate string, Km double, Km_unit string, Km_raw string, Vmax double, Vmax_unit string, extra string"


def test_operator_routes(spark):
    rows = [(i, "text", "TMB", 0.1 + i % 7, "mM", None, None, None, "e") for i in range(300)]
    rows += [(i, "table", "OPD", 100.0 + i % 70, "μM", None, None, None, "e") for i in range(300, 600)]
    rows += [(1000, "text", "TMB", 0.5, None, None, 2.0, None, "e"), (1001, None, None, None, None, None, None, None, None), (1001, None, None, None, None, None, None, None, None)]
    out = unit_harmony.harmonise(spark.createDataFrame(rows, SCHEMA))
    got = {(r.kin_id, r.quantity): r for r in out.collect()}
    assert out.count() == 3 * len(rows)
    assert got[(1000, "Km")].status == "predicted" and got[(1000, "Km")].common_value == 500_000
    assert got[(1000, "Vmax")].status == "review"
    assert got[(1001, "Km")].status == "no_value"
    assert unit_harmony.stated_values(out).count() == 600
    read = unit_harmony.read_rows(spark.createDataFrame(rows, SCHEMA))
    assert sorted(unit_harmony.stated_values(read).collect()) == sorted(unit_harmony.stated_values(out).collect())


def test_operator_empty_and_untrainable(spark):
    assert unit_harmony.harmonise(spark.createDataFrame([], SCHEMA)).count() == 0
    out = unit_harmony.harmonise(spark.createDataFrame([(1, None, None, 2.0, None, None, None, None, None)], SCHEMA)).collect()
    assert {r.quantity: r.status for r in out} == {"Km": "review", "Vmax": "no_value", "kcat_Km": "no_value"}


def _mixed_rows():
    """Two scales that the magnitude tells apart but for an overlap, and three values without a unit."""
    rows = [(i, "text", "TMB", 0.1 + i % 97 / 10, "mM", None, None, None, "e") for i in range(300)]
    rows += [(i, "table", "OPD", 8.0 + i % 89, "μM", None, None, None, "e") for i in range(300, 600)]
    return rows + [(1000, "text", "TMB", 0.5, None, None, None, None, "e"), (1001, "table", "OPD", 70.0, None, None, None, None, "e"), (1002, None, None, 9.0, None, None, None, None, "e")]


def test_p4_found_goes_through_the_whole_method(spark, tmp_path, monkeypatch):
    spark.createDataFrame(_mixed_rows(), SCHEMA).write.parquet(f"{tmp_path}/kinetics.parquet")
    routed = []
    predict = unit_harmony.UnitModel.predict

    def seen(model, rows):
        out = predict(model, rows)
        routed.extend(sorted((r.kin_id, r.quantity, r.confidence is not None) for r in out.collect()))
        return out

    monkeypatch.setattr(unit_harmony.UnitModel, "predict", seen)
    found = general.p4_found(spark, str(tmp_path)).collect()
    assert routed == [(1000, "Km", True), (1001, "Km", True), (1002, "Km", True)]
    assert sorted(r.kin_id for r in found) == list(range(600))  # a predicted unit stands nowhere, so it is no case
    assert {r.kin_id: r.common_value for r in found}[300] == (8 + 300 % 89) * 1000


def test_models_do_not_depend_on_partitions(spark):
    rows = [(i, "text", "TMB", 0.1 + i * 7919 % 997 / 10, ("mM", "μM", "nM", None)[i * 31 % 4], None, None, None, "e") for i in range(800)]
    table = spark.createDataFrame(rows, SCHEMA)
    one, many = (unit_harmony.harmonise(table.repartition(n)).collect() for n in (1, 7))
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_rows_are_read_once(spark):
    rows = unit_harmony.read_rows(spark.createDataFrame(_mixed_rows(), SCHEMA))
    plan = unit_harmony.stated_values(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


@pytest.mark.parametrize(
    "raw,want",
    [("ｍＭ", "mM"), ("µM", "μM"), ("mМ", "mM"), ("υM", "uM"), ("кΩ" , "кΩ"), ("kΩ", "kΩ"), ("4 ºC", "4 °C"), ("n.º 5", "n.º 5"), ("Fe(Ⅲ)", "Fe(III)"), ("ﬁve", "five"),
     ("a​b­", "ab"), ("x　y", "x y"), ("е́cole", "école"), ("с 5 г", "с 5 г"), ("该材料（见Fig. 2），", "该材料（见Fig. 2），"), ("ｸﾞ", "グ"), ("最⼤", "最大"), ("α-Fe", "α-Fe"), ("10⁻⁸", "10⁻⁸")],
)
def test_canonical_form(raw, want):
    assert canonical_form(raw) == want
    assert canonical_form(want) == want


def test_canonical_form_null_empty_long():
    assert canonical_form(None) is None and canonical_form("") == ""
    assert canonical_form("а" * 100_000 + "z") == "a" * 100_000 + "z"
