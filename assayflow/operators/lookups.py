"""Dictionary lookups: enzymes, applications, methods, units, sources, tables, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import banks
from ..functions.dual import first_label, hit, replace_all


def alias_table(spark: SparkSession) -> DataFrame:
    """(alias, canonical): the enzyme aliases as a dimension table of fixed size."""
    return spark.createDataFrame(list(banks.ENZYME_ALIAS.items()), "alias string, canonical string")


def canonical_enzyme(values: DataFrame, column: str) -> DataFrame:
    """Adds ``canonical``: the alias table first, then the name without brackets, then the first pattern."""
    spark = values.sparkSession
    known = list(banks.ENZYME)
    key = F.lower(F.trim(F.col(column)))
    bare = replace_all(key, [(" *\\([a-z]+\\) *", " "), (" +", "-")])
    joined = values.withColumn("_key", key).join(F.broadcast(alias_table(spark)), F.col("_key") == F.col("alias"), "left")
    out = F.coalesce("canonical", F.when(bare.isin(known), bare), first_label(key, banks.ENZYME, None))
    return joined.select(*values.columns, out.alias("canonical"))


def application_type(c: Column) -> Column:
    return first_label(F.lower(c), banks.APPLICATION_TYPE, "other")


def normal_unit(c: Column) -> Column:
    return F.trim(replace_all(c, banks.UNIT_STEPS))


def factor_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(banks.UNIT_FACTORS, "unit_from string, unit_to string, factor double")


def convert(values: DataFrame, value: str, unit: str, target: str) -> DataFrame:
    """Adds ``converted``: forward factor, else reverse factor, else the value where the units agree."""
    f = F.broadcast(factor_table(values.sparkSession))
    fwd = f.where(F.col("unit_to") == target).select(F.col("unit_from").alias("_a"), F.col("factor").alias("_fwd"))
    rev = f.where(F.col("unit_from") == target).select(F.col("unit_to").alias("_b"), F.col("factor").alias("_rev"))
    j = values.join(fwd, F.col(unit) == F.col("_a"), "left").join(rev, F.col(unit) == F.col("_b"), "left")
    out = F.coalesce(F.when(F.col(unit) == target, F.col(value)), F.col(value) * F.col("_fwd"), F.col(value) / F.col("_rev"))
    return j.select(*values.columns, out.alias("converted"))


def source_class(c: Column) -> Column:
    return F.when(c == "text", "text").when(c == "table", "table").when(c == "figure_caption", "caption").when(c.startswith("figure"), "figure").otherwise("unknown")


def table_class(c: Column) -> Column:
    """Type with most matching key words; ties in the bank's order; ``general`` where none matches."""
    t = F.lower(c)
    scores = [F.size(F.regexp_extract_all(t, F.lit(p), 0)) for p in banks.TABLE_TYPE.values()]
    top = F.greatest(*scores)
    out = F.when(top <= 0, "general")
    for name, s in zip(banks.TABLE_TYPE, scores):
        out = out.when(s == top, name)
    return out


def name_variants(c: Column) -> Column:
    """The name, its parts at @ and /, and its compact form; lower case, distinct, in order."""
    low = F.lower(F.trim(c))
    return F.array_distinct(F.filter(F.concat(F.array(low), F.split(low, "[@/]"), F.array(F.regexp_replace(low, "[ -]", ""))), lambda x: F.length(x) > 1))


def compatible(a: Column, b: Column) -> Column:
    """Either name contains the other, once case and prefixes are off; empty names match nothing."""
    x, y = (F.regexp_replace(F.lower(F.trim(c)), "^(hollow|[a-z]+-doped) +", "") for c in (a, b))
    return F.coalesce((F.length(x) > 0) & (F.length(y) > 0) & (x.contains(y) | y.contains(x)), F.lit(False))


def has_signal(c: Column) -> Column:
    return hit(F.lower(c), banks.KINETICS_SIGNAL)
