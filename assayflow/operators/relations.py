"""Joins, aggregates, ranking, sets and ordered operators of the literature pipeline.

All are DataFrame to DataFrame. Ordering always ends in a key, so results are the same on
every run. Window operators partition by paper; where one paper may hold a large share of
the rows the operator aggregates first or uses a rank limit that Spark applies before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import banks
from ..functions.dual import hit
from . import ordered as od


def first_valid(kinetics: DataFrame, parameter: str, unit: Column | None = None) -> DataFrame:
    """Per paper the first positive value by source priority and entry, without a window."""
    prio = F.create_map(*[F.lit(x) for kv in banks.SOURCE_PRIORITY.items() for x in kv])[F.col("source")]
    ok = F.col(parameter).isNotNull() & (F.col(parameter) > 0)
    key = F.struct(-F.coalesce(prio, F.lit(0)), F.col("entry_no"), F.col("kin_id"))
    return kinetics.where(ok).groupBy("paper_id").agg(F.min_by(parameter, key).alias("value"), F.min_by("source", key).alias("value_source"), F.count("*").alias("n_valid"))


def top_per_paper(rows: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """The k best rows of each paper; the limit is applied before and after the shuffle."""
    order = W.partitionBy("paper_id").orderBy(F.desc(score), F.asc(key))
    return rows.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}")


def paragraph_runs(blocks: DataFrame) -> DataFrame:
    """Adjacent paragraphs of one page and section merged: run number, boxes united, texts joined in order.

    A run goes on while page and section stay and the left edges differ by less than 40.
    """
    left = F.get("bbox", F.lit(0))
    para = blocks.where("kind = 'paragraph' AND bbox IS NOT NULL").withColumn("left", left)
    para = od.with_neighbours(para, "paper_id", "block_key", F.struct("page", "section", "left"))
    prev = F.col("prev")
    same = (F.col("page") == prev["page"]) & F.coalesce(F.col("section") == prev["section"], F.lit(False)) & (F.abs(F.col("left") - prev["left"]) < 40)
    run = od.running_count(para.drop("next"), "paper_id", "block_key", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumnRenamed("total", "run")
    return run.groupBy("paper_id", "run").agg(
        F.count("*").alias("n_blocks"), F.min("block_key").alias("first_block"), F.min("left").alias("x0"), F.max(F.get("bbox", F.lit(2))).alias("x1"), F.min(F.get("bbox", F.lit(1))).alias("y0"), F.max(F.get("bbox", F.lit(3))).alias("y1")
    )


def evaluate(gold: DataFrame, got: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(field, match, n): exact, partial, wrong, miss and skip of every field over the joined records."""
    g = gold.select(key, *[F.lower(F.trim(f)).alias(f"g_{f}") for f in fields])
    e = got.select(key, *[F.lower(F.trim(f)).alias(f"e_{f}") for f in fields])
    arms = ", ".join(f"named_struct('field', '{f}', 'g', g_{f}, 'e', e_{f})" for f in fields)
    long = g.join(e, key).selectExpr(f"inline(array({arms}))")
    match = F.when(F.col("g").isNull(), "skip").when(F.col("e").isNull(), "miss").when(F.col("g") == F.col("e"), "exact").when(F.col("g").contains(F.col("e")) | F.col("e").contains(F.col("g")), "partial").otherwise("wrong")
    return long.groupBy("field", match.alias("match")).agg(F.count("*").alias("n"))


def attribution(text: Column, names: Column) -> Column:
    """Whether a sentence belongs to the paper's own material: selected, contrast, this-work and previous-work signs."""
    t = F.lower(text)
    own = F.coalesce(t.contains(F.lower(names)), F.lit(False))
    contrast, mine, prior = hit(t, banks.CONTRAST), hit(t, banks.THIS_WORK), hit(t, banks.PREVIOUS_WORK)
    return F.when(own & contrast, "yes_medium").when(own, "yes_high").when(mine, "yes_low").when(prior, "no_medium").otherwise("unknown_low")


def range_status(value: Column, parameter: str) -> Column:
    lo, hi, rlo, rhi = banks.RANGES[parameter]
    return F.when(value.isNull(), "skip").when((value < lo) | (value > hi), "demote").when((value < rlo) | (value > rhi), "flag").otherwise("ok")
