"""Queries of numbers, sources that must agree, roles and sections, with SQL written from the rule."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions import banks
from ..functions.dual import hit, quote, sql_hit
from ..operators import nested, text as tx
from ..runtime import table
from .rules import any_of, sql_any

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE[name] = sql


# ---------------------------------------------------------------- numbers and units

_TIMES = r"^([\d.]+)\s*[×x]\s*10[⁻−–-]?\s*(\d+)"
_MINUS = r"10[⁻−–-]"
_EXP = r"^([\d.]+)\s*[eE]\s*([-−]?\d+)"


def lenient_float(c: Column) -> Column:
    """A number as typed: plain, with "x 10" and a power (negative after any dash), or with an e; null for anything else."""
    t = F.trim(c)
    power = F.regexp_extract(t, _TIMES, 2).try_cast("int")
    times = F.regexp_extract(t, _TIMES, 1).try_cast("double") * F.pow(F.lit(10.0), F.when(t.rlike(_MINUS), -power).otherwise(power))
    exp = F.regexp_extract(t, _EXP, 1).try_cast("double") * F.pow(F.lit(10.0), F.replace(F.regexp_extract(t, _EXP, 2), F.lit("−"), F.lit("-")).try_cast("int"))
    return F.coalesce(F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double")), F.when(t.rlike(_TIMES), times), F.when(t.rlike(_EXP), exp))


_FLOAT_SQL = (
    r"CASE WHEN regexp_matches(t, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN try_cast(t AS DOUBLE) "
    rf"WHEN regexp_matches(t, {quote(_TIMES)}) THEN try_cast(regexp_extract(t, {quote(_TIMES)}, 1) AS DOUBLE) * pow(10.0, (CASE WHEN regexp_matches(t, {quote(_MINUS)}) THEN -1 ELSE 1 END) * try_cast(regexp_extract(t, {quote(_TIMES)}, 2) AS INTEGER)) "
    rf"WHEN regexp_matches(t, {quote(_EXP)}) THEN try_cast(regexp_extract(t, {quote(_EXP)}, 1) AS DOUBLE) * pow(10.0, try_cast(replace(regexp_extract(t, {quote(_EXP)}, 2), '−', '-') AS INTEGER)) END"
)
_add(
    "txt10_lenient_float",
    lambda s, d: table(s, d, "kinetics").where("Km_raw IS NOT NULL").select("kin_id", lenient_float(F.col("Km_raw")).alias("value")),
    f"SELECT kin_id, {_FLOAT_SQL} AS value FROM (SELECT kin_id, trim(Km_raw, ' ') AS t FROM kinetics WHERE Km_raw IS NOT NULL)",
)

# Unit names as written in lower case -> unit.
UNIT_ALIAS = {
    "mM": ["mm", "mmol/l", "mmol l⁻¹", "mmol·l⁻¹", "mmol/liter", "millimolar"],
    "μM": ["um", "μm", "umol/l", "μmol/l", "μmol l⁻¹", "umol/l", "micromolar"],
    "nM": ["nm", "nmol/l", "nmol l⁻¹", "nanomolar"],
    "pM": ["pm", "pmol/l", "pmol l⁻¹", "picomolar"],
    "M": ["mol/l", "mol l⁻¹", "molar"],
    "mg/L": ["mg/l", "mg l⁻¹", "milligram per liter", "mg·l⁻¹"],
    "μg/L": ["ug/l", "μg/l", "μg l⁻¹", "ug l⁻¹", "microgram per liter"],
    "ng/L": ["ng/l", "ng l⁻¹", "nanogram per liter"],
    "s⁻¹": ["s-1", "/s", "per second", "sec⁻¹", "sec-1"],
    "min⁻¹": ["min-1", "/min", "per minute"],
    "M⁻¹s⁻¹": ["m-1 s-1", "m⁻¹·s⁻¹", "m-1·s-1", "/m/s"],
    "nm": ["nanometer", "nanometre"],
    "μm": ["um", "micrometer", "micrometre"],
    "mm": ["millimeter", "millimetre"],
    "°C": ["c", "deg c", "degree celsius", "celsius"],
    "K": ["kelvin"],
    "mg/mL": ["mg/ml", "mg·ml⁻¹", "mg ml⁻¹"],
    "μg/mL": ["ug/ml", "μg/ml", "μg·ml⁻¹", "ug ml⁻¹"],
    "ng/mL": ["ng/ml", "ng·ml⁻¹"],
    "pg/mL": ["pg/ml", "pg·ml⁻¹"],
    "g/L": ["g/l", "g·l⁻¹"],
    "U/mg": ["u/mg", "unit/mg", "units/mg"],
    "U/mL": ["u/ml", "unit/ml", "units/ml"],
}


def _aliases(squeezed: bool) -> dict[str, str]:
    """Alias -> unit; the last entry of an alias holds, of aliases equal without spaces the first."""
    every = {a: unit for unit, names in UNIT_ALIAS.items() for a in names}
    if not squeezed:
        return every
    out: dict[str, str] = {}
    for a, unit in every.items():
        out.setdefault(a.replace(" ", ""), unit)
    return out


def unit_alias(c: Column) -> Column:
    """The unit meant by a name, spaces and middle dots aside; a unit without an alias stays as it is."""
    low = F.trim(c)
    for a, b in ((" ", ""), ("·", ""), ("⁻¹", "-1"), ("⁻²", "-2")):
        low = F.replace(low, F.lit(a), F.lit(b))
    low = F.lower(low)
    maps = [F.create_map(*[F.lit(x) for kv in _aliases(q).items() for x in kv]) for q in (False, True)]
    return F.when(c == "", c).otherwise(F.coalesce(F.element_at(maps[0], low), F.element_at(maps[1], low), c))


_U = "lower(replace(replace(replace(replace(trim(u, ' '), ' ', ''), '·', ''), '⁻¹', '-1'), '⁻²', '-2'))"
_ALIAS_ROWS = "(VALUES " + ", ".join(f"({i}, {quote(a)}, {quote(unit)})" for i, (a, unit) in enumerate((a, u) for u, names in UNIT_ALIAS.items() for a in names)) + ")"
_add(
    "map11_unit_alias",
    lambda s, d: table(s, d, "kinetics").where("Km_unit IS NOT NULL").select("kin_id", unit_alias(F.col("Km_unit")).alias("unit")),
    f"SELECT kin_id, CASE WHEN u = '' THEN u ELSE coalesce((SELECT arg_max(e.v, e.ord) FROM {_ALIAS_ROWS} e(ord, k, v) WHERE e.k = {_U}), "
    f"(SELECT arg_max(e.v, e.ord) FROM {_ALIAS_ROWS} e(ord, k, v) WHERE e.k = (SELECT arg_min(g.k, g.ord) FROM {_ALIAS_ROWS} g(ord, k, v) WHERE replace(g.k, ' ', '') = {_U})), u) END AS unit FROM (SELECT kin_id, Km_unit AS u FROM kinetics WHERE Km_unit IS NOT NULL)",
)

# ---------------------------------------------------------------- sources that must agree

# Magnitudes a value may have.
MAGNITUDE = {"Km": (1e-12, 10.0), "Vmax": (1e-15, 1e8), "kcat": (1e-6, 1e10), "kcat_Km": (1e-3, 1e12)}


def agree(a: Column, b: Column, tolerance: float = 0.5) -> Column:
    """Two values differ by at most the tolerance's share of the larger; null agrees with nothing."""
    top = F.greatest(F.abs(a), F.abs(b))
    return F.coalesce((top == 0) | (F.abs(a - b) <= tolerance * top), F.lit(False))


def truncated(rule: Column, reply: Column) -> Column:
    """The digits of one value are the beginning of the other's, as when a power of ten was lost."""
    plain = F.format_string("%.6f", F.abs(rule))
    mantissa = F.split_part(F.format_string("%.6e", F.abs(reply)), F.lit("e"), F.lit(1))
    whole_r, whole_l = F.floor(rule).cast("string"), F.floor(F.abs(reply)).cast("string")
    ratio = F.try_divide(rule, reply)
    lost = (rule >= 1) & (reply < 1) & whole_r.startswith(whole_l) & (F.length(whole_r) <= F.length(whole_l) + 1) & ((ratio > 1e4) | (ratio < 1e-4))
    return F.coalesce((rule != reply) & (mantissa.startswith(F.left(plain, F.lit(4))) | plain.startswith(F.left(mantissa, F.lit(4))) | F.coalesce(lost, F.lit(False))), F.lit(False))


def reconciled(name: str, rule: Column, llm: Column, vlm: Column) -> Column:
    """(value, source, confidence, needs_review, reason) of up to three sources.

    One source alone is weak; agreeing sources are sure and the rule's value goes first;
    else a lost power of ten or an impossible rule value gives the word to the text model,
    and any other conflict stays with the rule, for review.
    """
    low, high = MAGNITUDE[name]
    n = rule.isNotNull().cast("int") + llm.isNotNull().cast("int") + vlm.isNotNull().cast("int")
    first, source = F.coalesce(rule, llm, vlm), F.when(rule.isNotNull(), "rule").when(llm.isNotNull(), "llm").when(vlm.isNotNull(), "vlm")
    rl, rv, lv = agree(rule, llm), agree(rule, vlm), agree(llm, vlm)
    inside = lambda c: F.abs(c).between(low, high)

    def out(value: Column, src: Column, conf: Column | str, review: Column | bool, reason: str) -> Column:
        as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
        return F.struct(value.cast("double").alias("value"), as_col(src).cast("string").alias("source"), as_col(conf).alias("confidence"), as_col(review).alias("needs_review"), F.lit(reason).alias("reason"))

    both = rule.isNotNull() & llm.isNotNull()
    return (
        F.when(n == 0, out(F.lit(None), F.lit("none"), "low", True, "no_source"))
        .when(n == 1, out(first, source, F.when(rule.isNotNull(), "medium").otherwise("low"), rule.isNull(), "single_source"))
        .when((n == 2) & (rl | rv | lv), out(first, source, "high", False, "two_sources_agree"))
        .when((n == 2) & both & truncated(rule, llm), out(llm, F.lit("llm"), "medium", True, "truncation_detected"))
        .when((n == 2) & both & ~inside(rule) & inside(llm), out(llm, F.lit("llm"), "medium", True, "rule_outside_magnitude_range"))
        .when(n == 2, out(first, source, "low", True, "conflict_unresolved"))
        .when(rl & rv, out(rule, F.lit("rule"), "high", False, "three_sources_agree"))
        .when(rl | rv, out(rule, F.lit("rule"), "high", False, "pair_agree"))
        .when(lv, out(llm, F.lit("llm"), "high", False, "pair_agree"))
        .when(truncated(rule, llm), out(llm, F.lit("llm"), "medium", True, "truncation_detected_3src"))
        .otherwise(out(rule, F.lit("rule"), "low", True, "conflict_unresolved_3src"))
    )


def _three_sources(s, d):
    """Per paper and parameter the values of the rules, the text model and the image model (the lowest record of each), reconciled."""
    records = table(s, d, "records")
    k = [F.col(f"main_activity.kinetics.{n}").alias(n) for n in MAGNITUDE]
    got = nested.canonical_records(table(s, d, "raw_records"), records.schema).select("record_id", *k)
    got = got.join(table(s, d, "raw_records").select("record_id", "paper_id", "reply_from"), "record_id").where("reply_from IN ('text_model', 'image_model')")
    rows = records.select("record_id", "paper_id", F.lit("rules").alias("reply_from"), *k).unionByName(got.select("record_id", "paper_id", "reply_from", *MAGNITUDE))
    long = rows.select("record_id", "paper_id", "reply_from", F.expr("inline(array(" + ", ".join(f"named_struct('parameter', '{n}', 'v', {n})" for n in MAGNITUDE) + "))")).where("v IS NOT NULL")
    pick = lambda who: F.min_by(F.when(F.col("reply_from") == who, F.col("v")), F.when(F.col("reply_from") == who, F.col("record_id")))
    wide = long.groupBy("paper_id", "parameter").agg(pick("rules").alias("rule"), pick("text_model").alias("llm"), pick("image_model").alias("vlm"))
    out = None
    for n in MAGNITUDE:
        one = wide.where(F.col("parameter") == n).select("paper_id", "parameter", reconciled(n, F.col("rule"), F.col("llm"), F.col("vlm")).alias("r")).select("paper_id", "parameter", "r.*")
        out = one if out is None else out.unionByName(one)
    return out


_add("val06_sources_reconciled", _three_sources)


def _agreeing_pairs(s, d):
    """The values of one quantity in a paper's text and table, whether they agree and whether a power of ten was lost."""
    k = table(s, d, "kinetics").where("Km > 0").groupBy("paper_id", "source").agg(F.min_by("Km", "kin_id").alias("v"))
    text, tab = k.where("source = 'text'").select("paper_id", F.col("v").alias("a")), k.where("source = 'table'").select("paper_id", F.col("v").alias("b"))
    return text.join(tab, "paper_id").select("paper_id", agree(F.col("a"), F.col("b")).alias("agree"), truncated(F.col("a"), F.col("b")).alias("truncated"))


_ONE = "(SELECT paper_id, arg_min(Km, kin_id) AS v FROM kinetics WHERE Km > 0 AND source = '{}' GROUP BY 1)"
_add(
    "val07_truncated_digits",
    _agreeing_pairs,
    "SELECT paper_id, abs(a - b) <= 0.5 * greatest(a, b) AS agree, a <> b AND (starts_with(m, left(p, 4)) OR starts_with(p, left(m, 4)) OR (a >= 1 AND b < 1 AND starts_with(CAST(CAST(floor(a) AS BIGINT) AS VARCHAR), '0') AND a / b > 1e4)) AS truncated "
    f"FROM (SELECT paper_id, x.v AS a, y.v AS b, printf('%.6f', x.v) AS p, split_part(printf('%.6e', y.v), 'e', 1) AS m FROM {_ONE.format('text')} x JOIN {_ONE.format('table')} y USING (paper_id))",
)


def _limits(s, d):
    """Detection limits and linear ranges that say nothing without their analyte or unit."""
    a = F.col("a")
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    apps = table(s, d, "records").select("record_id", F.posexplode("applications").alias("ord", "a")).where("a IS NOT NULL")
    lod = F.when(blank(a["detection_limit"]), None).when(blank(a["target_analyte"]), "LOD_missing_target_analyte").when(blank(a["detection_limit_unit"]), "LOD_missing_unit")
    rng = F.when(blank(a["linear_range"]), None).when(blank(a["target_analyte"]), "linear_range_missing_target_analyte").when(~hit(a["linear_range"], r"[A-Za-zμµ%]"), "linear_range_missing_unit")
    return apps.select("record_id", "ord", lod.alias("lod"), rng.alias("range")).where("lod IS NOT NULL OR range IS NOT NULL")


_BLANK = lambda c: f"coalesce(trim({c}, ' ') = '', true)"
_add(
    "val03_limit_warnings",
    _limits,
    f"SELECT * FROM (SELECT record_id, CAST(ord - 1 AS INTEGER) AS ord, CASE WHEN {_BLANK('a.detection_limit')} THEN NULL WHEN {_BLANK('a.target_analyte')} THEN 'LOD_missing_target_analyte' WHEN {_BLANK('a.detection_limit_unit')} THEN 'LOD_missing_unit' END AS lod, "
    f"CASE WHEN {_BLANK('a.linear_range')} THEN NULL WHEN {_BLANK('a.target_analyte')} THEN 'linear_range_missing_target_analyte' WHEN NOT regexp_matches(a.linear_range, '[A-Za-zμµ%]') THEN 'linear_range_missing_unit' END AS range "
    "FROM (SELECT record_id, unnest(applications) AS a, generate_subscripts(applications, 1) AS ord FROM records) WHERE a IS NOT NULL) WHERE lod IS NOT NULL OR range IS NOT NULL",
)


def adjusted_confidence(confidence: Column, rate: Column, suspects: Column) -> Column:
    """Low below a rate of 0.5; below 0.8, or with suspects, high falls to medium."""
    return F.when(rate < 0.5, "low").when((confidence == "high") & ((rate < 0.8) | (suspects > 0)), "medium").otherwise(confidence)


def _verified(s, d):
    """Records with the share of their values found in the evidence of their paper, and the confidence that follows."""
    k = table(s, d, "kinetics").where("Km > 0 AND _evidence_Km IS NOT NULL").select("paper_id", F.col("_evidence_Km").contains(F.regexp_replace(F.col("Km").cast("string"), r"\.0$", "")).alias("ok"))
    rate = k.groupBy("paper_id").agg(F.round(F.avg(F.col("ok").cast("int")), 3).alias("rate"), F.count_if(~F.col("ok")).alias("suspects"))
    r = table(s, d, "records").select("record_id", "paper_id", F.col("diagnostics.confidence").alias("confidence"), F.coalesce("diagnostics.needs_review", F.lit(False)).alias("review")).join(rate, "paper_id")
    adjusted = adjusted_confidence(F.col("confidence"), F.col("rate"), F.col("suspects"))
    return r.select("record_id", adjusted.alias("confidence"), (F.col("review") | (F.col("rate") < 0.8) | (F.col("suspects") > 0)).alias("needs_review"))


_add("val21_adjusted_confidence", _verified)


def synchronised(kinetics: Column, entries: Column) -> Column:
    """The list with the primary entry in front unless it is listed; the primary alone where there is no list; as it is without primary values."""
    has = F.lit(False)
    for n in MAGNITUDE:
        has = has | kinetics[n].isNotNull()
    listed = F.exists(entries, lambda x: x.eqNullSafe(kinetics))
    some = F.coalesce(F.size(entries), F.lit(0)) > 0
    return F.when(F.coalesce(has, F.lit(False)), F.when(~some, F.array(kinetics)).when(F.coalesce(listed, F.lit(False)), entries).otherwise(F.array_insert(entries, 1, kinetics))).otherwise(entries)


def _synchronised(s, d):
    a = F.col("main_activity")
    r = table(s, d, "records").select("record_id", synchronised(a["kinetics"], a["kinetics_list"]).alias("l"))
    first = F.get("l", F.lit(0))
    return r.select("record_id", F.coalesce(F.size("l"), F.lit(0)).alias("n"), first["Km"].alias("first_Km"), first["substrate"].alias("first_substrate")).withColumn("n", F.greatest("n", F.lit(0)))


_K, _L = "main_activity.kinetics", "main_activity.kinetics_list"
_HAS = " OR ".join(f"{_K}.{n} IS NOT NULL" for n in MAGNITUDE)
_add(
    "set08_primary_first",
    _synchronised,
    f"SELECT record_id, CAST(coalesce(len(l), 0) AS INTEGER) AS n, l[1].Km AS first_Km, l[1].substrate AS first_substrate FROM (SELECT record_id, CASE WHEN NOT ({_HAS}) THEN {_L} WHEN coalesce(len({_L}), 0) = 0 THEN [{_K}] WHEN len(list_filter({_L}, lambda x: x IS NOT DISTINCT FROM {_K})) > 0 THEN {_L} ELSE list_prepend({_K}, {_L}) END AS l FROM records)",
)

# ---------------------------------------------------------------- roles, sections, fragments

_SHORT_WORDS = r"(?i)\b(km|vmax|kcat|tmb|abts|opd|sers|uv-?vis|nanozyme|detection\s+limit|linear\s+range|specificity|sensitivity|selectivity)\b"
_LONG_WORDS = r"(?i)\b(km|vmax|kcat|tmb|abts|opd|sers|uv-?vis|nanozyme|detection\s+limit|linear\s+range|specificity|sensitivity|selectivity|k\s*cat|k\s*m|k\s*i)\b"
_CITED_START = r"^\s*(\[\d+(?:,\d+)*\]|\d+\s*[-,]\s*\d+)"
_HANGING = [r"(?i)\b(and|or|with|for|to|of|than|using)\s*$", r"(?i)\bshowed a\s*$"]


def is_incomplete(c: Column) -> Column:
    """A fragment: empty, a short text that begins with a citation, short without a term of the field, few words without an end, or one that breaks off; a word with a digit is never one."""
    t = F.trim(F.regexp_replace(c, r"\s+", " "))
    return (
        F.when(t.isNull() | (t == ""), True)
        .when(t.rlike(_CITED_START) & (F.length(t) < 160), True)
        .when(F.lower(t).rlike(r"[a-z]{2,}\d"), False)
        .when((F.length(t) < 30) & ~t.rlike(_LONG_WORDS), True)
        .when((F.size(F.split(t, " ")) <= 8) & ~t.rlike("[.!?]$") & ~t.rlike(_SHORT_WORDS), True)
        .otherwise(any_of(t, _HANGING))
    )


_add(
    "flt04_incomplete_sentence",
    lambda s, d: table(s, d, "sentences").select("sent_key", is_incomplete(F.col("text")).alias("incomplete")),
    rf"SELECT sent_key, CASE WHEN coalesce(t, '') = '' THEN true WHEN regexp_matches(t, '{_CITED_START}') AND length(t) < 160 THEN true WHEN regexp_matches(lower(t), '[a-z][a-z]\d') THEN false WHEN length(t) < 30 AND NOT {sql_hit('t', _LONG_WORDS)} THEN true "
    rf"WHEN length(t) - length(replace(t, ' ', '')) < 8 AND NOT regexp_matches(t, '[.!?]$') AND NOT {sql_hit('t', _SHORT_WORDS)} THEN true ELSE {sql_any('t', _HANGING)} END AS incomplete FROM (SELECT sent_key, trim(regexp_replace(text, '\s+', ' ', 'g'), ' ') AS t FROM sentences)",
)
_FORMULA = [r"\b[A-Za-z0-9()]+(?:[@/][A-Za-z0-9()\-]+)+\b", r"\b[A-Z][a-z]?(?:[-–][A-Z][a-z]?\d+){1,3}\b", r"\b(?:[A-Z][a-z]?\d+){2,}(?:[-/][A-Za-z0-9()]+)*\b"]
_add(
    "flt15_formula_like",
    lambda s, d: table(s, d, "sentences").where("text IS NOT NULL").select("sent_key", any_of(F.col("text"), _FORMULA).alias("formula_like")),
    f"SELECT sent_key, {sql_any('text', _FORMULA)} AS formula_like FROM sentences WHERE text IS NOT NULL",
)
_METHODS = [
    r"(?i)\b(prepared|synthesi[sz]ed|fabricated|loaded|embedded|encapsulated|doped|incubat(?:ed|ion)|stirred|centrifuged|washed)\b",
    r"(?i)\b(measured|recorded|acquired|collected|characterized|performed|monitored|obtained from)\b",
]
_EVIDENCE = ["system", "activity", "assay", "kinetics", "structure", "mechanism", "comparison", "application", "supplementary"]


def retagged(section: Column, source_kind: Column, text: Column, tag_text: Column) -> Column:
    """The section that a sentence with evidence really belongs to: an introduction's caption or result is ``results_like``, its procedure ``experimental``."""
    tags = F.split(tag_text, r"\|")
    has = lambda names: F.arrays_overlap(tags, F.array(*[F.lit(n) for n in names]))
    sec, caption = F.coalesce(section, F.lit("unknown")), F.coalesce(source_kind == "caption", F.lit(False))
    return (
        F.when(~has(_EVIDENCE), sec)
        .when((sec == "introduction") & caption, "results_like")
        .when(sec == "introduction", F.when(any_of(text, _METHODS) & ~has(["comparison", "application", "paper"]), "experimental").otherwise("results_like"))
        .when((sec == "unknown") & caption, "results_like")
        .otherwise(sec)
    )


_TAG_LIST = "list_filter([" + ", ".join(f"CASE WHEN {sql_hit('lower(text)', p)} THEN {quote(k)} END" for k, p in banks.VALUE_TAGS.items()) + "], lambda x: x IS NOT NULL)"
_HAS_ANY = lambda names: "list_has_any(tags, [" + ", ".join(quote(n) for n in names) + "])"
_add(
    "flt14_section_retag",
    lambda s, d: table(s, d, "sentences").where("text IS NOT NULL").select("sent_key", retagged(F.col("section"), F.col("source_kind"), F.col("text"), tx.tags(F.col("text"))).alias("section")),
    f"SELECT sent_key, CASE WHEN NOT {_HAS_ANY(_EVIDENCE)} THEN sec WHEN sec = 'introduction' AND cap THEN 'results_like' WHEN sec = 'introduction' AND {sql_any('text', _METHODS)} AND NOT {_HAS_ANY(['comparison', 'application', 'paper'])} THEN 'experimental' WHEN sec = 'introduction' OR (sec = 'unknown' AND cap) THEN 'results_like' ELSE sec END AS section "
    f"FROM (SELECT sent_key, text, coalesce(section, 'unknown') AS sec, coalesce(source_kind = 'caption', false) AS cap, {_TAG_LIST} AS tags FROM sentences WHERE text IS NOT NULL)",
)
_add(
    "flt19_primary_role",
    lambda s, d: table(s, d, "sentences").where("text IS NOT NULL").select("sent_key", tx.tags(F.col("text")).alias("t")).select("sent_key", F.coalesce(tx.primary_role(F.col("t")), F.when(F.col("t").contains("background"), "background"), F.lit("other")).alias("role")),
    "SELECT sent_key, CASE " + " ".join(f"WHEN list_contains(tags, {quote(r)}) THEN {quote(r)}" for r in ["application", "comparison", "mechanism", "structure", "activity", "system", "kinetics", "assay", "paper", "supplementary", "background"]) + f" ELSE 'other' END AS role FROM (SELECT sent_key, {_TAG_LIST} AS tags FROM sentences WHERE text IS NOT NULL)",
)
# Sections and figure types by the words they hold, first match.
SECTION_WORDS = {
    "synthesis": ["synthesis", "preparation", "fabrication", "synthesized"],
    "characterization": ["characteriz", "sem ", "tem ", "xrd", "xps", "raman", "ftir"],
    "activity": ["peroxidase-like", "oxidase-like", "catalase-like", "enzyme-like", "catalytic activity"],
    "kinetics": ["michaelis", "kinetic", "km ", "vmax", "lineweaver"],
    "application": ["detection", "sensing", "sensor", "lod", "linear range"],
    "conclusion": ["conclusion", "conclud", "summary"],
    "introduction": ["introduction", "background", "prior work"],
}
FIGURE_WORDS = {"kinetics": ["kinetic", "michaelis", "lineweaver", "km", "vmax"], "morphology": ["sem", "tem", "xrd", "morphology", "afm"], "application": ["detection", "sensing", "sensor", "lod", "calibration"]}
KINETICS_WORDS = ["km", "vmax", "kcat", "michaelis", "kinetic", "michaelis-menten"]


def by_words(c: Column, bank: dict[str, list[str]], default: str) -> Column:
    """The first label one of whose words occurs in a lower-case text."""
    arms = []
    for label, words in bank.items():
        any_word = F.lit(False)
        for w in words:
            any_word = any_word | c.contains(w)
        arms.append(F.when(any_word, F.lit(label)))
    return F.coalesce(*arms, F.lit(default))


def sql_by_words(expr: str, bank: dict[str, list[str]], default: str) -> str:
    rows = "(VALUES " + ", ".join(f"({i}, {quote(k)}, {quote(w)})" for i, (k, ws) in enumerate(bank.items()) for w in ws) + ")"
    return f"coalesce((SELECT arg_min(e.k, e.ord) FROM {rows} e(ord, k, w) WHERE contains({expr}, e.w)), {quote(default)})"


_add(
    "flt27_section_guess",
    lambda s, d: table(s, d, "blocks").where("text IS NOT NULL").select("block_key", by_words(F.left(F.lower("text"), F.lit(500)), SECTION_WORDS, "unknown").alias("section")),
    f"SELECT block_key, {sql_by_words('t', SECTION_WORDS, 'unknown')} AS section FROM (SELECT block_key, left(lower(text), 500) AS t FROM blocks WHERE text IS NOT NULL)",
)
_add(
    "map16_figure_type",
    lambda s, d: table(s, d, "figures").where("caption_text IS NOT NULL").select("fig_key", by_words(F.lower("caption_text"), FIGURE_WORDS, "other").alias("type")),
    f"SELECT fig_key, {sql_by_words('t', FIGURE_WORDS, 'other')} AS type FROM (SELECT fig_key, lower(caption_text) AS t FROM figures WHERE caption_text IS NOT NULL)",
)
_add(
    "flt31_kinetics_context",
    lambda s, d: table(s, d, "sentences").where("text IS NOT NULL").select("sent_key", (by_words(F.lower("text"), {"yes": KINETICS_WORDS}, "no") == "yes").alias("kinetics_context")),
    f"SELECT sent_key, len(list_filter({KINETICS_WORDS}, lambda w: contains(lower(text), w))) > 0 AS kinetics_context FROM sentences WHERE text IS NOT NULL",
)

# Words that may describe a shape, and words of a sentence about a picture instead.
SHAPES = [
    "nanoparticle", "nanoparticles", "nanosheet", "nanosheets", "nanorod", "nanorods", "nanosphere", "nanospheres", "nanotube", "nanotubes", "nanocluster", "nanoclusters", "nanocube", "nanocubes", "nanowire", "nanowires",
    "nanoflower", "nanoflowers", "core-shell", "core@shell", "hollow", "porous", "cubic", "spherical", "rod", "sheet", "flower", "wire", "tube", "sphere", "prism", "dendritic", "ellipsoidal", "platelet", "belt", "ribbon",
    "dumbbell", "octahedral", "tetrahedral", "spindle", "needle", "flake", "lamellar", "layered", "amorphous", "crystalline", "mesoporous", "yolk-shell", "janus", "dot", "quantum dot", "cluster", "island", "film",
]
PICTURE_WORDS = [
    "figure", "schematic", "illustration", "depicting", "depicts", "showing", "shows", "image", "caption", "scale bar", "entering", "cell", "tumor", "therapy", "mechanism", "pathway", "reaction",
]


def clean_shape(c: Column) -> Column:
    """A description of shape: null without a shape word or beyond 100 characters; of a sentence about a picture only the shape words."""
    t = F.trim(c)
    low = F.lower(t)
    words = F.filter(F.split(low, r"\s+"), lambda w: w.isin(SHAPES))
    about = by_words(low, {"yes": PICTURE_WORDS}, "no") == "yes"
    return F.when((F.length(t) <= 100) & (by_words(low, {"yes": SHAPES}, "no") == "yes"), F.when(about, F.nullif(F.array_join(words, ", "), F.lit(""))).otherwise(t))


_add(
    "txt18_shape_cleanup",
    lambda s, d: table(s, d, "records").where("selected_nanozyme.morphology IS NOT NULL").select("record_id", clean_shape(F.col("selected_nanozyme.morphology")).alias("shape")),
    f"SELECT record_id, CASE WHEN length(t) <= 100 AND len(list_filter({SHAPES}, lambda w: contains(lower(t), w))) > 0 THEN CASE WHEN len(list_filter({PICTURE_WORDS}, lambda w: contains(lower(t), w))) > 0 "
    rf"THEN nullif(array_to_string(list_filter(regexp_split_to_array(lower(t), '\s+'), lambda w: list_contains({SHAPES}, w)), ', '), '') ELSE t END END AS shape FROM (SELECT record_id, trim(selected_nanozyme.morphology, ' ') AS t FROM records WHERE selected_nanozyme.morphology IS NOT NULL)",
)
