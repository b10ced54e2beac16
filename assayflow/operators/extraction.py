"""Value extraction: the first pattern that matches wins, with the pattern kept as method."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions.dual import extract, hit

NUM = "([0-9]+(?:[.][0-9]+)?(?:[eE]-?[0-9]+)?)"
#: (method, pattern with the number in group 1), in order of priority.
KM_PATTERNS = [
    ("equals", f"Km *= *{NUM}"),
    ("named", f"Km *\\([^)]*\\) *(?:was found to be|=)? *{NUM}"),
    ("of", f"Km (?:value )?of {NUM}"),
    ("constant", f"(?:Michaelis constant|米氏常数)[^0-9]*?(?:was|为) *{NUM}"),
    ("bare", f"Km *(?:为)?{NUM}"),
    ("table", f"[|] *Km {NUM}"),
]
VMAX_PATTERNS = [("equals", f"Vmax *= *{NUM}"), ("was", f"Vmax (?:was|of) {NUM}"), ("reached", f"maximal rate .*reached {NUM}"), ("bare", f"Vmax *{NUM}")]
PH_OPTIMUM = f"pH (?:of |values above )?{NUM}"
TEMPERATURE = "([0-9]+(?:[.][0-9]+)?) *°C"
LOD = f"detection limit of {NUM} *([a-zμ]+M|M)"
RANGE = f"linear range extended from {NUM} to {NUM} *([a-zμ]+M|M)"
SIZE = f"(?:[Pp]articles of about|mesurent env[.]|medían aprox[.]|粒径约为|粒子径は約) *{NUM} *nm"
SPACING = f"lattice spacing of {NUM} *Å"


def cascade(c: Column, patterns: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(value, method) of the first pattern that matches."""
    values = [extract(c, p) for _, p in patterns]
    value = F.coalesce(*values).try_cast("double")
    method = F.coalesce(*[F.when(v.isNotNull(), F.lit(name)) for (name, _), v in zip(patterns, values)])
    return value, method


def sql_cascade(expr: str, patterns: list[tuple[str, str]]) -> tuple[str, str]:
    from ..functions.dual import sql_extract

    values = [sql_extract(expr, p) for _, p in patterns]
    return f"try_cast(coalesce({', '.join(values)}) AS DOUBLE)", "coalesce(" + ", ".join(f"CASE WHEN {v} IS NOT NULL THEN '{n}' END" for (n, _), v in zip(patterns, values)) + ")"


def row_cells(c: Column) -> Column:
    """Cells of a row written with bars, trimmed."""
    return F.transform(F.filter(F.split(F.trim(c), r"\|"), lambda x: F.length(F.trim(x)) > 0), lambda x: F.trim(x))


def in_context(c: Column) -> Column:
    return hit(F.lower(c), "lineweaver|double-reciprocal")
