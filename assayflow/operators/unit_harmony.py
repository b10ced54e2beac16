"""Problem 4: one common unit per quantity for values recorded in many units.

Method: every row's number and unit are read (unit column, else the value as captured,
else the evidence text); for values whose unit stands nowhere, a random forest trained on
the rows with a stated unit predicts it from the magnitude, the source, the substrate and
the units of the row's other quantities. Its scores are calibrated by isotonic regression
on held-out rows; a confident assignment is converted (status ``predicted``), any other
goes to ``review``. The forest is fitted on at most ``max_train`` labelled rows per
quantity, chosen by a hash of the key; everything else covers every row.

No shuffle of the table: reading is row-wise (one Arrow batch function) and written once
to the shared folder, only the training sample is shuffled and the models are small objects of fixed size.

Defined results, one row per key and quantity: ``no_value`` (column and raw null or not a
number), ``not_positive``, ``not_convertible`` (mass, activity, arbitrary or another
quantity's unit), ``stated``, ``predicted``, ``review``. Null or empty unit text counts
as absent. Very long texts are read whole. Rows delivered twice are converted twice. With
an empty table, or fewer than ``min_train`` labelled rows or one class, nothing is
predicted and values without a unit go to review. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import log10

import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.units import COMMON_UNIT, QUANTITIES, read_quantity, to_common
from ..runtime import materialise

SOURCES = ("text", "table", "figure_caption", "figure_candidate")
SUBSTRATE_BINS = 16
SAMPLE_PARTITIONS = 4
_OUT = "quantity string, number double, log_factor double, common_value bigint, unit_from string, status string"


def read_rows(kinetics: DataFrame, key: str = "kin_id") -> DataFrame:
    """One row per key and quantity as read, with the features the classifier needs."""
    has = set(kinetics.columns)

    def col(name: str, kind: str) -> Column:
        return (F.col(f"`{name}`") if name in has else F.lit(None)).cast(kind)

    @F.pandas_udf(f"array<struct<{_OUT.replace(' double', ': double').replace(' bigint', ': bigint').replace(' string', ': string')}>>")
    def read(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for cols in batches:
            out = []
            for row in zip(*cols):
                row = [None if x is None or x != x else x for x in row]
                got = []
                for name, at in (("Km", 0), ("Vmax", 4), ("kcat_Km", 8)):
                    number, factor, origin, status = read_quantity(name, *row[at : at + 4])
                    common = to_common(name, number, factor) if factor is not None else None
                    got.append((name, None if number is None else float(number), None if factor is None else log10(factor), common, origin, status))
                out.append([dict(zip(("quantity", "number", "log_factor", "common_value", "unit_from", "status"), g)) for g in got])
            yield pd.Series(out)

    args = []
    for q in QUANTITIES:
        args += [col(q, "double"), col(f"{q}_unit", "string"), col(f"{q}_raw", "string"), col(f"_evidence_{q}", "string")]
    rows = kinetics.select(F.col(key).alias("kin_id"), col("source", "string").alias("source"), col("substrate", "string").alias("substrate"), read(*args).alias("q"))
    # every array holds three rows; for plain ``inline`` the planner adds a test of the array that runs ``read`` a second time
    return rows.withColumn("others", F.expr("transform(q, x -> x.log_factor)")).selectExpr("kin_id", "source", "substrate", "others", "inline_outer(q)")


def _features(rows: DataFrame) -> DataFrame:
    """Adds the vector ``features``, built on the JVM: magnitude, source, substrate bin and the row's other units."""
    substrate_bin = F.when(F.col("substrate").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(F.lower("substrate")), F.lit(SUBSTRATE_BINS)).cast("int"))
    cols = {"_f0": F.log10("number")}
    cols |= {f"_s{i}": F.coalesce(F.col("source") == s, F.lit(False)).cast("double") for i, s in enumerate(SOURCES)}
    cols |= {f"_b{i}": (substrate_bin == i).cast("double") for i in range(SUBSTRATE_BINS)}
    for i, name in enumerate(QUANTITIES):
        other = F.when(F.col("quantity") != name, F.get("others", F.lit(i)))
        cols |= {f"_o{i}": F.coalesce(other, F.lit(0.0)), f"_h{i}": other.isNull().cast("double")}
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep").transform(rows.withColumns(cols)).drop(*cols)


class UnitModel:
    """A calibrated forest for one quantity: classes are the log10 factors of its units."""

    def __init__(self, classes: list[float], forest, bounds: list[float], probs: list[float]):
        self.classes, self.forest, self.bounds, self.probs = classes, forest, bounds, probs

    def calibrated(self, raw: Column) -> Column:
        """Piecewise linear isotonic map of the forest's top score."""
        if not self.bounds:
            return raw * 0
        out = F.when(raw <= self.bounds[0], F.lit(self.probs[0]))
        for (a, p), (b, r) in zip(zip(self.bounds, self.probs), zip(self.bounds[1:], self.probs[1:])):
            share = (raw - a) / (b - a) if b > a else F.lit(1.0)
            out = out.when(raw <= b, F.lit(p) + share * (r - p))
        return out.otherwise(F.lit(self.probs[-1]))

    def predict(self, rows: DataFrame) -> DataFrame:
        scored = self.forest.transform(_features(rows)).withColumn("_p", vector_to_array("probability"))
        top = F.array_max("_p")
        best = F.element_at(F.array(*[F.lit(c) for c in self.classes]), F.array_position("_p", top).cast("int"))
        return scored.select(*rows.columns, best.alias("predicted_log_factor"), self.calibrated(top).alias("confidence"))


def train(rows: DataFrame, max_train: int = 20_000, min_train: int = 200, trees: int = 20, depth: int = 8, seed: int = 7) -> dict[str, UnitModel]:
    """A model per quantity, fitted on at most about ``max_train`` stated rows of each; a fifth of them is held out to calibrate.

    Quantities with too few rows or one class have none. The sample is taken in one pass for all
    quantities and put in a fixed order, so that the models do not depend on how the table is divided.
    """
    labelled = rows.where("status = 'stated'").withColumn("label_key", F.round("log_factor", 3))
    sizes = {r["quantity"]: r["count"] for r in labelled.groupBy("quantity").count().collect() if r["count"] >= min_train}
    if not sizes:
        return {}
    h = F.pmod(F.xxhash64("kin_id", F.lit(seed)), F.lit(1_000_000))
    share = F.element_at(F.create_map(*[F.lit(x) for q, n in sizes.items() for x in (q, int(1_000_000 * min(1.0, max_train / n)))]), F.col("quantity"))
    sample = labelled.where(F.col("quantity").isin(*sizes) & (h < share)).withColumn("held_out", F.pmod(F.xxhash64("kin_id", F.lit(seed + 1)), F.lit(5)) == 0)
    sample = sample.repartition(SAMPLE_PARTITIONS, "kin_id").sortWithinPartitions("kin_id", "quantity", "number", "label_key")
    sample = _features(sample).select("quantity", "features", "label_key", "held_out").cache()
    try:
        classes: dict[str, list[float]] = {}
        for r in sample.groupBy("quantity", "label_key").count().where("count >= 5").collect():
            classes.setdefault(r["quantity"], []).append(r["label_key"])
        return {q: _fit(sample.where(F.col("quantity") == q), sorted(keys), trees, depth, seed) for q, keys in classes.items() if len(keys) >= 2}
    finally:
        sample.unpersist()


def _fit(sample: DataFrame, classes: list[float], trees: int, depth: int, seed: int) -> UnitModel:
    label = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label_key")).cast("double") - 1
    sample = sample.withColumn("label", label).where("label >= 0")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxBins=64).fit(sample.where("NOT held_out"))
    held = forest.transform(sample.where("held_out").coalesce(1)).select(
        F.array_max(vector_to_array("probability")).alias("score"), (F.col("prediction") == F.col("label")).cast("double").alias("right")
    )
    iso = IsotonicRegression(featuresCol="score", labelCol="right").fit(held)
    return UnitModel(classes, forest, [float(x) for x in iso.boundaries], [float(x) for x in iso.predictions])


def harmonise(kinetics: DataFrame, key: str = "kin_id", threshold: float = 0.9, max_train: int = 20_000) -> DataFrame:
    """(kin_id, quantity, number, common_value, common_unit, unit_from, status, confidence), one row per key and quantity."""
    rows = materialise(read_rows(kinetics, key), "unit-rows")  # read once; training, prediction and output scan it
    models = train(rows, max_train)
    plain = rows.where("status <> 'no_unit'").withColumn("confidence", F.lit(None).cast("double")).drop("others", "source", "substrate", "log_factor")
    parts = []
    for quantity, (_, size) in QUANTITIES.items():
        open_rows = rows.where((F.col("status") == "no_unit") & (F.col("quantity") == quantity))
        if quantity not in models:
            done = open_rows.withColumn("status", F.lit("review")).withColumn("confidence", F.lit(None).cast("double"))
        else:
            sure = F.col("confidence") >= threshold
            value = F.round(F.col("number") * F.pow(F.lit(10.0), F.col("predicted_log_factor") - log10(Fraction(size)))).cast("bigint")
            done = (
                models[quantity]
                .predict(open_rows)
                .withColumn("common_value", F.when(sure, value))
                .withColumn("unit_from", F.when(sure, F.lit("predicted")))
                .withColumn("status", F.when(sure, F.lit("predicted")).otherwise(F.lit("review")))
            )
        parts.append(done.select(plain.columns))
    routed = parts[0]
    for p in parts[1:]:
        routed = routed.unionByName(p)
    out = plain.unionByName(materialise(routed, "unit-routes"))  # decided once, whichever rows are taken of the result
    unit = F.element_at(F.create_map(*[F.lit(x) for kv in COMMON_UNIT.items() for x in kv]), F.col("quantity"))
    return out.withColumn("common_unit", F.when(F.col("common_value").isNotNull(), unit))


def stated_values(rows: DataFrame) -> DataFrame:
    """(kin_id, quantity, common_value) of the values whose unit is given somewhere in the row.

    ``rows`` are those of ``harmonise``; those of ``read_rows``, without the forest's routes, give the same values.
    """
    return rows.where("status = 'stated' AND common_value IS NOT NULL").select("kin_id", "quantity", "common_value")
