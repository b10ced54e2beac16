"""Queries of the general data-preparation problems (4 and 6) over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import nested, unit_harmony
from ..runtime import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values with a stated unit, of a table that went through the whole method: reading, forests, calibration, routes."""
    return unit_harmony.stated_values(unit_harmony.harmonise(table(spark, sf_dir, "kinetics")))


def p4_harmonised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value with its route: stated, predicted, review, or why it is not converted."""
    return unit_harmony.harmonise(table(spark, sf_dir, "kinetics"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.all_child_links(table(spark, sf_dir, "records"), table(spark, sf_dir, "raw_records"))


def _child(path: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = table(spark, sf_dir, "records")
        raw = nested.canonical_records(table(spark, sf_dir, "raw_records"), records.schema)
        return nested.child_table(records, path).unionByName(nested.child_table(raw, path))

    return query


def p6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parent table of both sources."""
    records = table(spark, sf_dir, "records")
    raw = nested.canonical_records(table(spark, sf_dir, "raw_records"), records.schema)
    return nested.record_table(records).unionByName(nested.record_table(raw))


def p6_typed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of the typed records alone, with their number per record and path."""
    links = nested.child_links(table(spark, sf_dir, "records"))
    return links.groupBy("child").agg(F.count("*").alias("n_children"), F.max("ord").alias("max_ord"))


QUERIES = {
    "p4_found": p4_found,
    "p4_harmonised": p4_harmonised,
    "p6_found": p6_found,
    "p6_records": p6_records,
    "p6_kinetics": _child("main_activity.kinetics_list"),
    "p6_applications": _child("applications"),
    "p6_substrates": _child("main_activity.substrates"),
    "p6_metal_elements": _child("selected_nanozyme.metal_elements"),
    "p6_dopants_or_defects": _child("selected_nanozyme.dopants_or_defects"),
    "p6_characterization": _child("selected_nanozyme.characterization"),
    "p6_precursors": _child("selected_nanozyme.synthesis_conditions.precursors"),
    "p6_structured_dopants": _child("selected_nanozyme.composition_structured.dopants"),
    "p6_typed_links": p6_typed_links,
}


def _typed_sql() -> str:
    arms = []
    for path in nested.CHILD_PATHS:
        if path in ("applications", "main_activity.kinetics_list"):
            fields = {
                "applications": "application_type target_analyte method linear_range detection_limit detection_limit_unit sample_type notes needs_review",
                "main_activity.kinetics_list": "Km Km_unit Vmax Vmax_unit kcat kcat_unit kcat_Km kcat_Km_unit substrate source needs_review",
            }[path].split()
            keep = " OR ".join(f'x."{f}" IS NOT NULL' for f in fields)
        else:
            keep = "x IS NOT NULL"
        arms.append(f"SELECT '{path}' AS child, ord FROM (SELECT unnest({path}) AS x, generate_subscripts({path}, 1) - 1 AS ord FROM records) WHERE {keep}")
    return "SELECT child, count(*) AS n_children, CAST(max(ord) AS INTEGER) AS max_ord FROM (" + " UNION ALL ".join(arms) + ") GROUP BY child"


ORACLE = {"p6_typed_links": _typed_sql()}
