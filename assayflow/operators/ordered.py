"""Operators in the order of a group that do not sort a whole group in one task.

A group's rows are split by their key into spans of ``SPAN`` keys. Windows run within a span;
what a span hands to the next one (its first and last row, its number of rows, its last
value) is one row per span, and only these are put in order per group. So a group that
holds a third of all rows is spread over as many tasks as it has spans. Keys are whole
numbers and unique within a group; ``lead`` columns go before the key in the order and split
the spans too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

SPAN = 4096


def _spanned(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("_span", F.floor(F.col(key) / SPAN))


def _join(df: DataFrame, edges: DataFrame, on: list[str]) -> DataFrame:
    """Join on columns that may be null on both sides."""
    right = edges.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in edges.columns if c not in on])
    cond = None
    for c in on:
        one = df[c].eqNullSafe(right[f"_r_{c}"])
        cond = one if cond is None else cond & one
    return df.join(right, cond, "left").drop(*[f"_r_{c}" for c in on])


def with_neighbours(df: DataFrame, group: str, key: str, value: Column) -> DataFrame:
    """Adds ``prev`` and ``next``: ``value`` of the rows before and after in the group, null at its ends."""
    rows = _spanned(df.withColumn("_v", F.struct(value.alias("v"))), key)
    w = W.partitionBy(group, "_span").orderBy(key)
    over = W.partitionBy(group).orderBy("_span")
    edges = rows.groupBy(group, "_span").agg(F.min_by("_v", key).alias("_first"), F.max_by("_v", key).alias("_last"))
    edges = edges.select(group, "_span", F.lag("_last").over(over).alias("_before"), F.lead("_first").over(over).alias("_after"))
    inner = rows.withColumns({"_p": F.lag("_v").over(w), "_n": F.lead("_v").over(w)})
    joined = _join(inner, edges, [group, "_span"])
    return joined.withColumns({"prev": F.coalesce("_p", "_before")["v"], "next": F.coalesce("_n", "_after")["v"]}).drop("_v", "_span", "_p", "_n", "_before", "_after")


def running_count(df: DataFrame, group: str, key: str, step: Column, lead: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``total``: the sum of ``step`` over the rows of the group up to and with each row."""
    rows = _spanned(df.withColumn("_s", step.cast("bigint")), key)
    at = [group, *lead, "_span"]
    edges = rows.groupBy(*at).agg(F.sum("_s").alias("_sum"))
    before = F.sum("_sum").over(W.partitionBy(group).orderBy(*lead, "_span").rowsBetween(W.unboundedPreceding, -1))
    edges = edges.select(*at, F.coalesce(before, F.lit(0)).alias("_before"))
    inner = rows.withColumn("_in", F.sum("_s").over(W.partitionBy(*at).orderBy(key).rowsBetween(W.unboundedPreceding, 0)))
    return _join(inner, edges, at).withColumn("total", F.col("_before") + F.col("_in")).drop("_s", "_in", "_before", "_span")


def carried(df: DataFrame, group: str, key: str, value: Column) -> DataFrame:
    """Adds ``carried``: the last ``value`` that is not null, of the row itself or of those before it in the group."""
    rows = _spanned(df.withColumn("_v", value), key)
    edges = rows.groupBy(group, "_span").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(key))).alias("_last"))
    before = F.last("_last", ignorenulls=True).over(W.partitionBy(group).orderBy("_span").rowsBetween(W.unboundedPreceding, -1))
    edges = edges.select(group, "_span", before.alias("_before"))
    inner = rows.withColumn("_in", F.last("_v", ignorenulls=True).over(W.partitionBy(group, "_span").orderBy(key).rowsBetween(W.unboundedPreceding, 0)))
    return _join(inner, edges, [group, "_span"]).withColumn("carried", F.coalesce("_in", "_before")).drop("_v", "_in", "_before", "_span")


def after_first(df: DataFrame, group: str, key: str, marker: Column) -> DataFrame:
    """Adds ``after``: the row is the group's first marked one or comes after it."""
    first = df.where(marker).groupBy(group).agg(F.min(key).alias("_first"))
    return _join(df, first, [group]).withColumn("after", F.coalesce(F.col(key) >= F.col("_first"), F.lit(False))).drop("_first")
