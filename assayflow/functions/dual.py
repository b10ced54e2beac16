"""Small builders for Spark columns and for the SQL text that checks them.

Patterns are plain enough for both regular-expression engines: no look-around, no word
boundary, lower-case text instead of case-insensitive matching.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

B = "(?:^|[^a-z0-9])"
E = "(?:[^a-z0-9]|$)"


def word(*alternatives: str) -> str:
    """Any of the alternatives as whole words of lower-case text."""
    return f"{B}(?:{'|'.join(alternatives)}){E}"


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def hit(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(pattern), F.lit(False))


def sql_pattern(pattern: str) -> str:
    """A pattern for RE2, whose word boundary knows ASCII letters only: letters of any script bound a word."""
    pattern = re.sub(r"\\b(?=$|\||\)|\.\*)", r"(?:$|[^\\pL\\pN_])", pattern)
    return pattern.replace("\\b", "(?:^|[^\\pL\\pN_])")


def sql_hit(expr: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({expr}, {quote(sql_pattern(pattern))}), false)"


def replace_all(c: Column, steps: list[tuple[str, str]]) -> Column:
    """Replacements in order; a group is written \\1 in the replacement."""
    for pattern, to in steps:
        c = F.regexp_replace(c, pattern, to.replace("$", "\\$").replace("\\1", "$1").replace("\\2", "$2").replace("\\3", "$3"))
    return c


def sql_replace_all(expr: str, steps: list[tuple[str, str]]) -> str:
    for pattern, to in steps:
        expr = f"regexp_replace({expr}, {quote(pattern)}, {quote(to)}, 'g')"
    return expr


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null where nothing matches."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def extract_all(c: Column, pattern: str, group: int = 1) -> Column:
    """The distinct groups of all matches, none where nothing matches."""
    return F.array_remove(F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), group)), "")


def sql_extract(expr: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({expr}, {quote(pattern)}, {group}), '')"


def first_label(c: Column, bank: dict[str, str], default: str | None) -> Column:
    """The label of the first pattern that matches, in the bank's order."""
    out = None
    for label, pattern in bank.items():
        out = F.when(hit(c, pattern), label) if out is None else out.when(hit(c, pattern), label)
    return out.otherwise(F.lit(default)) if default is not None else out


def sql_first_label(expr: str, bank: dict[str, str], default: str | None) -> str:
    arms = " ".join(f"WHEN {sql_hit(expr, p)} THEN {quote(label)}" for label, p in bank.items())
    return f"CASE {arms} ELSE {quote(default) if default is not None else 'NULL'} END"


def labels(c: Column, bank: dict[str, str]) -> Column:
    """All labels whose pattern matches, in the bank's order, joined by a bar."""
    return F.concat_ws("|", *[F.when(hit(c, p), F.lit(label)) for label, p in bank.items()])


def sql_labels(expr: str, bank: dict[str, str]) -> str:
    return "concat_ws('|', " + ", ".join(f"CASE WHEN {sql_hit(expr, p)} THEN {quote(label)} END" for label, p in bank.items()) + ")"
