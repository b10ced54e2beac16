"""Problem 6: deeply nested records to related flat tables.

Method: higher-order SQL projection. Per child path a ``transform`` attaches the record's
key, the path and the position to every element; ``flatten`` joins the arrays of all paths
and one ``inline`` per target table emits the rows. Nothing is shuffled: a child row is
computed where its record lies, so a record with very many children is the only unit of
work that cannot be split.

Replies in JSON (``raw_records``) first pass ``canonical_records``: one Arrow-batched
function per reply finds the record in whatever surrounds it and writes it in the typed
nesting, after which the same projection runs.

Defined results: a null record, a missing struct, a null or empty array gives no child; a
null element or an empty object keeps its position and is no child; a bare value instead
of an array is one child at position 0; unknown keys do not count; extra columns of the
input are ignored; rows delivered twice give their children twice (each has its own key);
a reply that cannot be read at all gives no child and status ``failed``.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.jsonrepair import loads_lenient

#: Child path -> where its array lies.
CHILD_PATHS = (
    "selected_nanozyme.metal_elements",
    "selected_nanozyme.dopants_or_defects",
    "selected_nanozyme.characterization",
    "selected_nanozyme.synthesis_conditions.precursors",
    "selected_nanozyme.composition_structured.dopants",
    "main_activity.substrates",
    "main_activity.kinetics_list",
    "applications",
)
TOP = ("paper", "selected_nanozyme", "main_activity", "applications")
PRESENT = "_present"


def _field(schema: T.StructType, path: str) -> T.DataType | None:
    here: T.DataType = schema
    for part in path.split("."):
        if not isinstance(here, T.StructType) or part not in here.fieldNames():
            return None
        here = here[part].dataType
    return here


def _is_child(elem: T.DataType) -> str:
    """SQL test over lambda variable x: the element counts as a child."""
    if not isinstance(elem, T.StructType):
        return "x IS NOT NULL"
    if PRESENT in elem.fieldNames():
        return f"x IS NOT NULL AND coalesce(x.{PRESENT}, false)"
    some = " OR ".join(f"x.`{f}` IS NOT NULL" for f in elem.fieldNames())
    return f"x IS NOT NULL AND ({some})"


def child_links(records: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, child, ord) of every child of every record, by one scan and one ``inline``."""
    parts = []
    for path in CHILD_PATHS:
        kind = _field(records.schema, path)
        if isinstance(kind, T.ArrayType):
            parts.append(
                f"transform(filter(transform({_quoted(path)}, (x, i) -> named_struct('keep', {_is_child(kind.elementType)}, 'ord', i)), "
                f"e -> e.keep), e -> named_struct('record_id', `{key}`, 'child', '{path}', 'ord', e.ord))"
            )
    if not parts:
        return records.select(F.col(key).alias("record_id"), F.lit("").alias("child"), F.lit(0).alias("ord")).limit(0)
    each = ", ".join(f"coalesce({p}, array())" for p in parts)
    return records.selectExpr(f"inline(flatten(array({each})))")


def child_table(records: DataFrame, path: str, key: str = "record_id") -> DataFrame:
    """The flat table of one child path: record_id, ord and the element's fields (or ``value``)."""
    kind = _field(records.schema, path)
    if not isinstance(kind, T.ArrayType):
        raise ValueError(f"{path} is no array of this table")
    elem = kind.elementType
    if isinstance(elem, T.StructType):
        names = [f for f in elem.fieldNames() if f != PRESENT]
        body = ", ".join(f"'{f}', e.x.`{f}`" for f in names)
    else:
        body = "'value', e.x"
    rows = (
        f"transform(filter(transform({_quoted(path)}, (x, i) -> named_struct('keep', {_is_child(elem)}, 'ord', i, 'x', x)), e -> e.keep), "
        f"e -> named_struct('record_id', `{key}`, 'ord', e.ord, {body}))"
    )
    return records.selectExpr(f"inline({rows})")


def record_table(records: DataFrame, key: str = "record_id") -> DataFrame:
    """The parent table: one row per record with its scalar leaves, names joined by ``__``."""
    out: list[Column] = [F.col(key).alias("record_id")]

    def walk(kind: T.StructType, path: str, name: str) -> None:
        for f in kind.fields:
            p, n = f"{path}.`{f.name}`", f"{name}__{f.name}"
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, p, n)
            elif not isinstance(f.dataType, T.ArrayType) and f.name != PRESENT:
                out.append(F.expr(p).alias(n))

    for top in TOP:
        if top in records.columns and isinstance(records.schema[top].dataType, T.StructType):
            walk(records.schema[top].dataType, f"`{top}`", top)
    return records.select(*out)


def _quoted(path: str) -> str:
    return ".".join(f"`{p}`" for p in path.split("."))


# ---------------------------------------------------------------- replies in JSON


def _with_presence(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.ArrayType):
        elem = kind.elementType
        if isinstance(elem, T.StructType):
            elem = T.StructType([*_with_presence(elem).fields, T.StructField(PRESENT, T.BooleanType())])
        return T.ArrayType(elem)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _with_presence(f.dataType)) for f in kind.fields])
    return kind


def find_record(value: object) -> dict | None:
    """The outermost object with a top field of a record, through wrappers and encoded strings."""
    queue = deque([(value, 0)])
    while queue:
        here, depth = queue.popleft()
        if isinstance(here, str) and depth and here.lstrip()[:1] in ("{", "["):
            here = loads_lenient(here)[0]
        if isinstance(here, dict):
            if any(k in here for k in ("selected_nanozyme", "main_activity", "applications")):
                return here
            queue += [(v, depth + 1) for v in here.values() if isinstance(v, (dict, list, str))]
        elif isinstance(here, list):
            queue += [(v, depth + 1) for v in here if isinstance(v, (dict, list, str))]
    if isinstance(value, dict) and "paper" in value:
        return value
    return None


def _shape(value: object, kind: T.DataType) -> object:
    """``value`` in the typed nesting; what cannot be read as its type becomes null."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        if isinstance(value, str) and value.lstrip()[:1] == "{":
            value = loads_lenient(value)[0]
        if not isinstance(value, dict):
            return None
        return {f.name: _shape(value.get(f.name), f.dataType) for f in kind.fields if value.get(f.name) is not None}
    if isinstance(kind, T.ArrayType):
        if isinstance(value, str) and value.lstrip()[:1] in ("[", "{"):
            parsed = loads_lenient(value)[0]
            value = value if parsed is None else parsed
        elem = kind.elementType
        out = []
        for x in value if isinstance(value, list) else [value]:
            if x is None or x == {}:
                out.append(None)
            elif isinstance(elem, T.StructType):
                if isinstance(x, str) and x.lstrip()[:1] == "{":
                    x = loads_lenient(x)[0] or x
                out.append((_shape(x, elem) or {}) | {PRESENT: True})
            else:
                out.append(_shape(x, elem))
        return out
    if isinstance(kind, T.StringType):
        if isinstance(value, (dict, list)):
            return json.dumps(value, ensure_ascii=False)
        return value if isinstance(value, str) else json.dumps(value)
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else {"true": True, "false": False}.get(str(value).strip().lower())
    try:
        number = float(value)
    except (TypeError, ValueError):
        return None
    if number != number or number in (float("inf"), float("-inf")):
        return None
    return int(number) if isinstance(kind, (T.IntegerType, T.LongType)) else number


def canonical_records(raw: DataFrame, like: T.StructType, text: str = "record_json") -> DataFrame:
    """``raw`` with the record's typed nesting (of ``like``) instead of its text, and ``parse_status``."""
    want = T.StructType([T.StructField(f.name, _with_presence(f.dataType)) for f in like.fields if f.name in TOP])
    shape = T.StructType([f for f in like.fields if f.name in TOP])

    @F.pandas_udf("json string, how string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                value, how = loads_lenient(t if isinstance(t, str) else None)
                record = find_record(value)
                if record is None:
                    rows.append((None, "failed"))
                else:
                    rows.append((json.dumps(_shape(record, shape), ensure_ascii=False), how))
            yield pd.DataFrame(rows, columns=["json", "how"])

    kept = [c for c in raw.columns if c not in (*TOP, text, "parse_status")]
    parsed = raw.select(*[F.col(f"`{c}`") for c in kept], read(F.col(text)).alias("_p"))
    parsed = parsed.select(*[F.col(f"`{c}`") for c in kept], F.col("_p.how").alias("parse_status"), F.from_json("_p.json", want).alias("_r"))
    return parsed.select(*[F.col(f"`{c}`") for c in kept], "parse_status", "_r.*")


def all_child_links(records: DataFrame, raw: DataFrame) -> DataFrame:
    """(record_id, child, ord) over typed records and JSON replies together."""
    return child_links(records).unionByName(child_links(canonical_records(raw, records.schema)))
