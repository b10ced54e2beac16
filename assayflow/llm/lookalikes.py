"""Problem 1: visually identical text with different characters.

Method: every value is mapped to its look-alike form; the forms and the plain values that
may look like them are grouped in SQL under Unicode collation (accent- and case-sensitive,
``COLLATE UNICODE``), one canonical member is chosen per class, deterministically, and
joined back to the rows.

Canonical member: the form that most occurrences of the class share, ties by code points;
it always has the consistent form itself. Every value of the class that differs from it is
reported, plain ones too.

Cost at scale: the mapping is skipped on the JVM side for texts made of plain characters
only; values are counted per distinct value before they are mapped (map-side combine), so a
value that a third of all rows share becomes one row. A plain value takes part where its
ASCII letters and digits, in order, are those of a form: strings that are equal under the
collation and composed agree in them, so this leaves out no member, and only an eight-byte
key per form meets the plain rows. Nothing is broadcast by hand and nothing is collected.

Defined results: null stays null and is no case; the empty string has the form; repeated
rows are reported each; very long texts are mapped whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.charforms import PLAIN_CLASS, canonical_form
from ..runtime import materialise

#: East Asian signs that have the form only beside East Asian letters; beside them they are plain.
_WIDE_OK = "，：！？（）；"
_NOT_PLAIN = f"[^{PLAIN_CLASS}]"
_CONTROL = r"[\x00-\x09\x0B\x0C\x0E-\x1F\x7F]"


def is_odd(value: Column) -> Column:
    """The value has a character that is not plain; the large class only sees what is not ASCII."""
    ascii_only = F.octet_length(value) == F.length(value)
    rest = F.regexp_replace(value, r"[\n\r\x20-\x7E]+", "")
    return F.when(ascii_only, value.rlike(_CONTROL)).otherwise(rest.rlike(_NOT_PLAIN))


@F.pandas_udf(T.StringType())
def look_alike_form(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The consistent written form of each value (see functions.charforms)."""
    for texts in batches:
        yield pd.Series([canonical_form(t) if isinstance(t, str) else None for t in texts], dtype=object)


def skeleton(value: Column) -> Column:
    """A key of the ASCII letters and digits of a value, equal for values equal under the collation."""
    return F.xxhash64(F.regexp_replace(value, "[^0-9A-Za-z]+", ""))


def canonical_members(members: DataFrame) -> DataFrame:
    """(class, canonical): one member per class of ``members`` (form, n) under Unicode collation."""
    forms = members.groupBy("form").agg(F.sum("n").alias("n"))
    return forms.groupBy(F.collate(F.col("form"), "UNICODE").alias("class")).agg(F.min_by("form", F.struct(-F.col("n"), F.col("form"))).alias("canonical"))


def consistent(rows: DataFrame) -> DataFrame:
    """``rows`` (origin, row_id, value) -> origin, row_id, value, canonical of every value that differs from it."""
    rows = rows.select("origin", "row_id", "value").where("value IS NOT NULL")
    odd_rows = rows.where(is_odd(F.col("value")))
    odd = odd_rows.groupBy("value").agg(F.count("*").alias("n")).select("value", "n", look_alike_form("value").alias("form"))
    odd = materialise(odd, "lookalike-forms")  # mapped once, used three times
    keys = materialise(odd.select(skeleton(F.col("form")).alias("key")).distinct(), "lookalike-keys")
    near = rows.where(~is_odd(F.col("value"))).withColumn("key", skeleton(F.col("value"))).join(keys, "key", "left_semi").drop("key")
    near = materialise(near, "lookalike-plain")  # plain rows that may belong to a class
    plain = near.groupBy("value").agg(F.count("*").alias("n")).withColumn("form", F.col("value"))
    members = odd.unionByName(plain)
    best = canonical_members(members.select("form", "n"))
    changed = members.withColumn("class", F.collate(F.col("form"), "UNICODE")).join(best, "class").where(F.col("value") != F.col("canonical")).select("value", "canonical")
    return odd_rows.unionByName(near).join(changed, "value").select("origin", "row_id", "value", "canonical")


def long_values(kinetics: DataFrame, sentences: DataFrame) -> DataFrame:
    """(origin, row_id, value) of the three fields."""
    parts = [
        kinetics.select(F.lit("kinetics.Km_unit").alias("origin"), F.col("kin_id").alias("row_id"), F.col("Km_unit").alias("value")),
        kinetics.select(F.lit("kinetics.Vmax_unit").alias("origin"), F.col("kin_id").alias("row_id"), F.col("Vmax_unit").alias("value")),
        sentences.select(F.lit("sentences.text").alias("origin"), F.col("sent_key").alias("row_id"), F.col("text").alias("value")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
