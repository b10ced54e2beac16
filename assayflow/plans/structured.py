"""Queries of the operators with sequential state, trees and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dual import extract_all
from ..operators import grouped as gr, nested, text as tx
from ..runtime import table
from ..streaming import ingest

_NAME = "((?:N-doped |hollow )?(?:Au@|Pt/)?(?:[A-Z][A-Za-z]*[0-9][A-Za-z0-9]*|CuO|CuS|IrOx|Fe-N-C|Cu-N-C)(?:@SiO2|@C|/rGO|-PEG)?)"


def lay01_tree_nodes(s, d):
    """Every node of every reply's tree in reading order."""
    return gr.flatten_tree(table(s, d, "raw_records"), "record_id", "record_json")


def jsn01_reply_status(s, d):
    """How each reply could be read, and which top parts it has."""
    got = nested.canonical_records(table(s, d, "raw_records"), table(s, d, "records").schema)
    return got.select("record_id", "parse_status", F.col("selected_nanozyme").isNotNull().alias("has_material"), F.col("main_activity").isNotNull().alias("has_activity"))


def srt10_evidence_budget(s, d):
    return gr.evidence_budget(table(s, d, "sentences"))


def jon03_caption_images(s, d):
    return gr.caption_images(table(s, d, "blocks"), table(s, d, "figures"))


def agg13_absorbed_names(s, d):
    names = table(s, d, "sentences").select("paper_id", F.explode(extract_all(F.col("text"), _NAME)).alias("name"))
    return gr.absorb_names(names)


def win04_assay_chunks(s, d):
    return gr.split_chunks(table(s, d, "sentences"), 1500)


def win05_packed_chunks(s, d):
    return table(s, d, "blocks").where("text IS NOT NULL").select("paper_id", "block_key", F.size(tx.greedy_pack(tx.split_sentences(F.col("text")), 400)).alias("n_chunks"))


def txt04_scientific_spelling(s, d):
    return table(s, d, "blocks").select("block_key", gr.spelled(F.col("text")).alias("spelled"))


def str03_token_bucket(s, d):
    return gr.token_bucket(table(s, d, "events"), "user_id", "ts", 0.001, 3.0, "event_id").select("event_id", "user_id", "allowed")


def str07_stream_ingest(s, d):
    """The events read as a stream, projected and written in micro-batches, then counted per hour and type."""
    rows = ingest.run_available(ingest.stream_table(s, d, "events"), "events", lambda df: df.select("event_id", "ts", "event_type"))
    return rows.groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (lay01_tree_nodes, jsn01_reply_status, srt10_evidence_budget, jon03_caption_images, agg13_absorbed_names, win04_assay_chunks, win05_packed_chunks, txt04_scientific_spelling, str03_token_bucket, str07_stream_ingest)}
ORACLE = {"str07_stream_ingest": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2"}
