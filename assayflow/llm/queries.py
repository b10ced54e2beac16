"""Queries of the text problems over whole tables, and their SQL where it can be written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..runtime import table
from . import canonical, encoding, lookalikes, mixing, residue, scans, sentences, truncation


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_consistent(spark, sf_dir).select("origin", "row_id")


def p1_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value that is not in the consistent form, with that form."""
    return lookalikes.consistent(lookalikes.long_values(table(spark, sf_dir, "kinetics"), table(spark, sf_dir, "sentences")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = canonical.map_values(table(spark, sf_dir, "records"), table(spark, sf_dir, "reference_terms"))
    return mapped.select("record_id", "field", "term_id")


def p2_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values without an entry, with their number."""
    return canonical.unmatched_report(canonical.map_values(table(spark, sf_dir, "records"), table(spark, sf_dir, "reference_terms")))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_cells(spark, sf_dir).select("kin_id", "field")


def p7_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that lost their end, with the reason."""
    return truncation.cut_cells(table(spark, sf_dir, "kinetics"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source truncates, by field."""
    return truncation.cut_shares(table(spark, sf_dir, "kinetics"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode(table(spark, sf_dir, "documents"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selection of every mix with the uses of each document."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual shares of every mix."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue_docs(table(spark, sf_dir, "documents")).select("doc_id")


def p10_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus without residue."""
    return residue.without_residue(table(spark, sf_dir, "documents"))


def p3_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scanned text with its continuous readable form and its damages."""
    scanned, clean = scans.split_origins(*[table(spark, sf_dir, t) for t in ("blocks", "sentences", "figures")])
    return scans.repaired(scanned, clean)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_repaired(spark, sf_dir).select("origin", "row_id", F.explode("damages").alias("damage"))


def _unscanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(origin, row_id, text) of the paragraphs and sentence rows that were not read from a scan."""
    blocks = table(spark, sf_dir, "blocks").where("kind = 'paragraph' AND NOT coalesce(ocr, false)")
    rows = table(spark, sf_dir, "sentences").where("NOT coalesce(ocr, false)")
    return blocks.select(F.lit("blocks").alias("origin"), F.col("block_key").alias("row_id"), "text").unionByName(
        rows.select(F.lit("sentences").alias("origin"), F.col("sent_key").alias("row_id"), "text")
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.starts(_unscanned(spark, sf_dir), F.col("text")).select("origin", "row_id", "next_start")


def p5_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentence units of each text with their offsets."""
    return sentences.units(_unscanned(spark, sf_dir), "text", ["origin", "row_id"])


QUERIES = {
    "p1_found": p1_found,
    "p1_consistent": p1_consistent,
    "p2_found": p2_found,
    "p2_unmatched": p2_unmatched,
    "p3_found": p3_found,
    "p3_repaired": p3_repaired,
    "p5_found": p5_found,
    "p5_units": p5_units,
    "p7_found": p7_found,
    "p7_cells": p7_cells,
    "p7_shares": p7_shares,
    "p8_ids": p8_ids,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_clean": p10_clean,
}
ORACLE: dict[str, str] = {}
