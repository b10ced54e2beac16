"""Kinetic constants with their units out of running text, by a cascade built from parts.

A statement is a name (Km, Vmax or their words), what it is of, a verb or sign, a number
and a unit. Forms are tried in order, for each sentence the first that matches; a paper's
value is that of the best measuring method, then of the earliest sentence. Sentences give
at most one value per constant, so the only shuffle carries one row per sentence and
constant, pre-aggregated per paper.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions.dual import quote, sql_pattern
from ..runtime import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

_PLAIN = r"[0-9]+(?:\.[0-9]+)?"
_NUMBER = rf"({_PLAIN}(?:\s*[×x]\s*10\s*\^?\s*[-−–]?\s*[0-9]+|[eE][-−]?[0-9]+)?)(?:\s*±\s*{_PLAIN})?\s*"
_CONC = r"(mmol/L|umol/L|μmol/L|nmol/L|mM|μM|uM|nM|M)"
_RATE = r"((?:mM|μM|uM|nM|M)\s*(?:/\s*(?:s|min)|[·*]?\s*(?:s|min)\s*\^?\s*[-−–]\s*1))"
_SAYS = r"\s*(?:was|were|is|are|=|:|≈|~)?\s*(?:(?:calculated|found|determined)\s+to\s+be\s*)?"
_OF = r"\s*(?:[(（][^)）]{1,30}[)）]|(?:values?\s+)?(?:for|of|to|toward)\s+[A-Za-zα-ω]\S*(?:\s+[A-Za-zα-ω]\S*){0,2}?)"
_KM, _VM = r"(?i)\bK\s?m", r"(?i)\bV\s?max"
_BOTH = r"(?i)\bK\s?m\b[^.]{0,40}?\bV\s?max\b[^.]{0,60}?"
#: (form, pattern, group of the number, group of the unit), tried in this order.
FORMS = {
    "Km": [
        ("joint", rf"{_BOTH}{_NUMBER}{_CONC}\s*(?:and|,|;)\s*{_NUMBER}{_RATE}", 1, 2),
        ("named", rf"{_KM}{_OF}{_SAYS}{_NUMBER}{_CONC}(?:$|[^A-Za-z/])", 1, 2),
        ("plain", rf"{_KM}(?:\s+values?)?(?:\s+of)?{_SAYS}{_NUMBER}{_CONC}(?:$|[^A-Za-z/])", 1, 2),
        ("words", rf"(?i)\bMichaelis(?:[ -]Menten)?\s+constant[^.]{{0,60}}?{_NUMBER}{_CONC}(?:$|[^A-Za-z/])", 1, 2),
        ("far", rf"{_KM}\b[^.]{{0,60}}?(?:was|were|is|are|=|to\s+be|[(])\s*{_NUMBER}{_CONC}(?:$|[^A-Za-z/])", 1, 2),
    ],
    "Vmax": [
        ("joint", rf"{_BOTH}{_NUMBER}{_CONC}\s*(?:and|,|;)\s*{_NUMBER}{_RATE}", 3, 4),
        ("named", rf"{_VM}{_OF}{_SAYS}{_NUMBER}{_RATE}", 1, 2),
        ("plain", rf"{_VM}(?:\s+values?)?(?:\s+of)?{_SAYS}{_NUMBER}{_RATE}", 1, 2),
        ("words", rf"(?i)\bmaxim(?:um|al)\s+(?:initial\s+)?(?:velocity|rate)[^.]{{0,60}}?{_NUMBER}{_RATE}", 1, 2),
        # a name whose number the scanner moved away: within 150 signs after it
        ("window", rf"{_VM}\b.{{0,150}}?{_NUMBER}{_RATE}", 1, 2),
    ],
}
# Measuring methods named in a sentence and their priority, first match.
METHOD_PRIORITY = {
    "uv-vis": 1, "uv/vis": 1, "uv vis": 1, "absorption": 1, "spectrophotometric": 1, "fluorescence": 2, "fluorometric": 2, "colorimetric": 2, "colorimetry": 2, "electrochemical": 3, "amperometric": 3, "sers": 4, "surface-enhanced": 4, "raman": 4,
}
_ASCII_FROM, _ASCII_TO = "⁰¹²³⁴⁵⁶⁷⁸⁹⁻", "0123456789-"


def plain_signs(c: Column) -> Column:
    """Superscripts as plain digits and signs."""
    return F.translate(c, _ASCII_FROM, _ASCII_TO)


def value_of(number: Column) -> Column:
    """A plain number, or one times a power of ten; any dash before the power is a minus."""
    mantissa = F.regexp_extract(number, "^([0-9.]+)", 1).try_cast("double")
    power = F.regexp_extract(number, r"(?:10\s*\^?\s*[-−–]?\s*|[eE][-−]?)([0-9]+)$", 1).try_cast("int")
    scaled = number.rlike(r"[×x]\s*10|[eE]")
    minus = number.rlike(r"(?:10\s*\^?\s*|[eE])[-−–]")
    return F.when(scaled, mantissa * F.pow(F.lit(10.0), F.when(minus, -power).otherwise(power))).otherwise(mantissa)


def stated(c: Column, name: str) -> Column:
    """(value, unit, form) of the first form of a constant that a text has, null where it has none."""
    arms = []
    for form, p, n, u in FORMS[name]:
        found = F.struct(value_of(F.regexp_extract(c, p, n)).alias("value"), F.trim(F.regexp_extract(c, p, u)).alias("unit"), F.lit(form).alias("form"))
        arms.append(F.when(c.rlike(p), found))
    return F.coalesce(*arms)


def method_priority(c: Column) -> Column:
    t = F.lower(c)
    return F.coalesce(*[F.when(t.contains(k), F.lit(v)) for k, v in METHOD_PRIORITY.items()], F.lit(5))


def _constants(s, d):
    """Per paper and constant the value of the best method, then of the first sentence."""
    t = table(s, d, "sentences").where("text IS NOT NULL").select("paper_id", "sent_key", plain_signs(F.col("text")).alias("t"))
    both = t.select("paper_id", "sent_key", method_priority(F.col("t")).alias("priority"), F.expr("inline(array(" + "named_struct('parameter', 'Km', 't', t), named_struct('parameter', 'Vmax', 't', t)))"))
    got = both.withColumn("s", F.when(F.col("parameter") == "Km", stated(F.col("t"), "Km")).otherwise(stated(F.col("t"), "Vmax"))).where("s.value IS NOT NULL")
    best = F.min_by(F.struct("sent_key", "s"), F.struct("priority", "sent_key")).alias("b")
    return got.groupBy("paper_id", "parameter").agg(best, F.count("*").alias("n_statements")).select("paper_id", "parameter", "b.sent_key", "b.s.value", "b.s.unit", "b.s.form", "n_statements")


def _sql() -> str:
    rank = "CASE " + " ".join(f"WHEN contains(lower(t), {quote(k)}) THEN {v}" for k, v in METHOD_PRIORITY.items()) + " ELSE 5 END"
    arms = []
    for name, forms in FORMS.items():
        for i, (form, p, n, u) in enumerate(forms):
            q = quote(sql_pattern(p))
            arms.append(f"SELECT paper_id, sent_key, t, '{name}' AS parameter, {i} AS ord, '{form}' AS form, regexp_extract(t, {q}, {n}) AS number, trim(regexp_extract(t, {q}, {u}), ' ') AS unit FROM s WHERE regexp_matches(t, {q})")
    value = (
        r"CASE WHEN regexp_matches(number, '[×x]\s*10|[eE]') THEN try_cast(regexp_extract(number, '^([0-9.]+)', 1) AS DOUBLE) * pow(10.0, (CASE WHEN regexp_matches(number, '(?:10\s*\^?\s*|[eE])[-−–]') THEN -1 ELSE 1 END) * "
        r"try_cast(regexp_extract(number, '(?:10\s*\^?\s*[-−–]?\s*|[eE][-−]?)([0-9]+)$', 1) AS INTEGER)) ELSE try_cast(regexp_extract(number, '^([0-9.]+)', 1) AS DOUBLE) END"
    )
    return (
        f"WITH s AS (SELECT paper_id, sent_key, translate(text, '{_ASCII_FROM}', '{_ASCII_TO}') AS t FROM sentences WHERE text IS NOT NULL), every_form AS (" + " UNION ALL ".join(arms) + "), "
        f"first_form AS (SELECT *, {value} AS value, {rank} AS priority FROM every_form QUALIFY row_number() OVER (PARTITION BY sent_key, parameter ORDER BY ord) = 1) "
        "SELECT paper_id, parameter, sent_key, value, unit, form, n_statements FROM (SELECT *, count(*) OVER (PARTITION BY paper_id, parameter) AS n_statements, row_number() OVER (PARTITION BY paper_id, parameter ORDER BY priority, sent_key) AS r FROM first_form WHERE value IS NOT NULL) WHERE r = 1"
    )


QUERIES["ext02_constants_with_units"] = _constants
ORACLE["ext02_constants_with_units"] = _sql()
