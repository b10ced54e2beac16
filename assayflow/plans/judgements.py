"""Queries of attribution, consistency, conflict and layout rules, with SQL written from the rule."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions import banks, fixed
from ..functions.dual import hit, quote, sql_hit
from ..operators import nested, ordered as od, text as tx
from ..runtime import table
from .rules import any_of, enzyme_conflict_key, sql_any

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE[name] = sql


def _strings(*names: str) -> Column:
    return F.array(*[F.lit(n) for n in names])


# ---------------------------------------------------------------- names

_PREFIXES = ["nano", "the ", "a ", "nano-sized ", "nanosized "]
_ENDINGS = [" nanoparticles", " nanosheets", " nanorods", " nanotubes", " nanospheres", " nanozyme", " nanozymes", " catalyst", " nps"]


def variants(name: Column) -> Column:
    """All writings under which a name may appear: parts around @ and /, without prefix or ending, without spaces and hyphens."""
    n = F.lower(F.trim(name))
    parts = lambda sign: F.filter(F.transform(F.split(n, sign), lambda p: F.trim(p)), lambda p: p != "")
    some = [F.when(n.contains(sign), parts(sign)).otherwise(F.array().cast("array<string>")) for sign in ("@", "/")]
    cut = [F.when(n.startswith(p), F.substring(n, len(p) + 1, 10_000)) for p in _PREFIXES] + [F.when(n.endswith(e), F.left(n, F.length(n) - len(e))) for e in _ENDINGS]
    compact = F.replace(F.replace(n, F.lit(" "), F.lit("")), F.lit("-"), F.lit(""))
    return F.when(n != "", F.array_distinct(F.concat(F.array(n), *some, F.array_compact(F.array(*cut, compact)))))


def sql_variants(expr: str) -> str:
    n = f"lower(trim({expr}, ' '))"
    parts = lambda sign: f"CASE WHEN contains({n}, '{sign}') THEN list_filter(list_transform(string_split({n}, '{sign}'), lambda p: trim(p, ' ')), lambda p: p <> '') ELSE [] END"
    cut = [f"CASE WHEN starts_with({n}, {quote(p)}) THEN [substr({n}, {len(p) + 1})] ELSE [] END" for p in _PREFIXES] + [f"CASE WHEN suffix({n}, {quote(e)}) THEN [left({n}, length({n}) - {len(e)})] ELSE [] END" for e in _ENDINGS]
    return f"CASE WHEN {n} <> '' THEN list_distinct(flatten([[{n}], {parts('@')}, {parts('/')}, {', '.join(cut)}, [replace(replace({n}, ' ', ''), '-', '')]])) END"


def _names(s, d):
    """Per paper: the material of its lowest record with a name, and the names of all its records."""
    r = table(s, d, "records").where("selected_nanozyme.name IS NOT NULL AND trim(selected_nanozyme.name) <> ''").select("paper_id", "record_id", F.col("selected_nanozyme.name").alias("name"))
    return r.groupBy("paper_id").agg(F.min_by("name", "record_id").alias("selected"), F.collect_set(F.lower(F.trim("name"))).alias("names")).select("paper_id", "selected", variants(F.col("selected")).alias("variants"), "names")


def others(names: Column, own: Column) -> Column:
    """All candidate names that are no writing of the selected one."""
    return F.array_except(names, own)


_NAMES_SQL = (
    f"(SELECT paper_id, selected, {sql_variants('selected')} AS variants, names FROM (SELECT paper_id, arg_min(selected_nanozyme.name, record_id) AS selected, list(DISTINCT lower(trim(selected_nanozyme.name, ' '))) AS names FROM records "
    "WHERE trim(selected_nanozyme.name, ' ') <> '' GROUP BY 1))"
)
_add(
    "map23_other_candidates",
    lambda s, d: _names(s, d).select("paper_id", F.array_join(F.array_sort("variants"), "|").alias("variants"), F.array_join(F.array_sort(others(F.col("names"), F.col("variants"))), "|").alias("others")),
    f"SELECT paper_id, array_to_string(list_sort(variants), '|') AS variants, coalesce(array_to_string(list_sort(list_filter(names, lambda x: NOT list_contains(variants, x))), '|'), '') AS others FROM {_NAMES_SQL}",
)


def bare_name(name: Column) -> Column:
    """The name without its last nano- ending; unchanged where nothing else is left."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(name, fixed.NAME_SUFFIX, "")), F.lit("")), name)


_add(
    "map20_bare_material_name",
    lambda s, d: table(s, d, "records").where("selected_nanozyme.name <> ''").select("record_id", bare_name(F.col("selected_nanozyme.name")).alias("name")),
    f"SELECT record_id, coalesce(nullif(trim(regexp_replace(name, {quote(fixed.NAME_SUFFIX)}, ''), ' '), ''), name) AS name FROM (SELECT record_id, selected_nanozyme.name AS name FROM records) WHERE name <> ''",
)


def compatible(a: Column, b: Column) -> Column:
    """Two names mean one material: equal or contained without spaces and hyphens, or equal without the letters of an ending."""
    x, y = (F.replace(F.replace(F.lower(c), F.lit("-"), F.lit("")), F.lit(" "), F.lit("")) for c in (a, b))
    same = (x == y) | x.contains(y) | y.contains(x)
    for e in fixed.COMPATIBLE_SUFFIXES:
        letters = "[" + "".join(sorted(set(e))) + "]+$"
        cut = F.regexp_replace(x, letters, "")
        same = same | ((cut == F.regexp_replace(y, letters, "")) & (cut != ""))
    return same


_SAME = "x = y OR contains(x, y) OR contains(y, x)" + "".join(f" OR (rtrim(x, {quote(e)}) = rtrim(y, {quote(e)}) AND rtrim(x, {quote(e)}) <> '')" for e in fixed.COMPATIBLE_SUFFIXES)


def _replies(s, d):
    """Each reply with the values of its paper's lowest rule record."""
    records = table(s, d, "records")
    got = nested.canonical_records(table(s, d, "raw_records"), records.schema).where("selected_nanozyme IS NOT NULL OR main_activity IS NOT NULL")
    cols = lambda p: [F.col("selected_nanozyme.name").alias(f"{p}_name"), F.col("main_activity.enzyme_like_type").alias(f"{p}_enzyme"), *[F.col(f"main_activity.kinetics.{k}").alias(f"{p}_{k}") for k in ("Km", "Vmax", "kcat")]]
    first = records.groupBy("paper_id").agg(F.min("record_id").alias("record_id")).join(records, ["paper_id", "record_id"]).select("paper_id", *cols("rule"))
    return got.select("record_id", "paper_id", *cols("reply")).join(first, "paper_id")


def conflicts() -> Column:
    """Names of the fields in which a reply contradicts the rules: name, enzyme type, or a value more than a hundred times off."""
    issues = [F.when((F.col("rule_name") != "") & (F.col("reply_name") != "") & ~compatible(F.col("rule_name"), F.col("reply_name")), "name")]
    issues.append(F.when(enzyme_conflict_key(F.col("rule_enzyme")) != enzyme_conflict_key(F.col("reply_enzyme")), "enzyme_like_type"))
    for k in ("Km", "Vmax", "kcat"):
        ratio = F.try_divide(F.col(f"reply_{k}"), F.col(f"rule_{k}"))
        issues.append(F.when((ratio != 0) & ((ratio > 100) | (ratio < 0.01)), k))
    return F.array_compact(F.array(*issues))


def _conflict_query(s, d):
    r = _replies(s, d).withColumn("issues", conflicts())
    severity = F.when(F.arrays_overlap("issues", _strings("name", "enzyme_like_type")), "high").when(F.size("issues") > 0, "medium").otherwise("none")
    return r.select("record_id", F.array_join("issues", "|").alias("issues"), severity.alias("severity"), F.lit("rule").alias("resolved_by"))


_add("val17_reply_conflicts", _conflict_query)


def _name_pairs(s, d):
    """The names of the other records of each paper against its selected one."""
    n = _names(s, d)
    return n.select("paper_id", "selected", F.explode("names").alias("name")).select("paper_id", "name", compatible(F.col("selected"), F.col("name")).alias("compatible"))


_add(
    "map22_compatible_names",
    _name_pairs,
    f"SELECT paper_id, name, {_SAME} AS compatible FROM (SELECT paper_id, name, replace(replace(lower(selected), '-', ''), ' ', '') AS x, replace(replace(name, '-', ''), ' ', '') AS y FROM (SELECT paper_id, selected, unnest(names) AS name FROM {_NAMES_SQL}))",
)


_SAID = r"(?i)\bKm\b|\bVmax\b"


def _checkpoint(s, d):
    """Per record: the next step and the warnings, from the record and whether its paper speaks of kinetics and applications."""
    t = F.col("text")
    said = table(s, d, "sentences").where("text IS NOT NULL").groupBy("paper_id").agg(F.max(t.rlike(_SAID)).alias("kin"), F.max(hit(F.lower("text"), banks.APPLICATION_SIGNAL)).alias("app"))
    r = table(s, d, "records").join(said, "paper_id", "left")
    k = F.col("main_activity.kinetics")
    name = F.coalesce(F.col("selected_nanozyme.name"), F.lit(""))
    warnings = F.array_compact(
        F.array(
            F.when(F.coalesce(F.col("main_activity.enzyme_like_type"), F.lit("")) == "", "missing_enzyme_type"),
            F.when(k["Km"].isNull() & k["Vmax"].isNull() & F.coalesce("kin", F.lit(False)), "kinetics_mentioned_but_not_extracted"),
            F.when((F.coalesce(F.size("applications"), F.lit(0)) <= 0) & F.coalesce("app", F.lit(False)), "application_text_but_no_applications"),
        )
    )
    action = F.when(name == "", "trigger_re_extraction").when(F.size(warnings) > 0, "continue_with_warnings").otherwise("continue")
    return r.select("record_id", action.alias("action"), F.when(name == "", "").otherwise(F.array_join(warnings, "|")).alias("warnings"))


_add(
    "val17_rule_checkpoint",
    _checkpoint,
    "SELECT record_id, CASE WHEN nameless THEN 'trigger_re_extraction' WHEN w <> '' THEN 'continue_with_warnings' ELSE 'continue' END AS action, CASE WHEN nameless THEN '' ELSE w END AS warnings FROM (SELECT record_id, coalesce(selected_nanozyme.name, '') = '' AS nameless, "
    "concat_ws('|', CASE WHEN coalesce(main_activity.enzyme_like_type, '') = '' THEN 'missing_enzyme_type' END, CASE WHEN main_activity.kinetics.Km IS NULL AND main_activity.kinetics.Vmax IS NULL AND coalesce(kin, false) THEN 'kinetics_mentioned_but_not_extracted' END, "
    "CASE WHEN coalesce(len(applications), 0) = 0 AND coalesce(app, false) THEN 'application_text_but_no_applications' END) AS w "
    rf"FROM records LEFT JOIN (SELECT paper_id, bool_or({sql_hit('text', _SAID)}) AS kin, bool_or({sql_hit('lower(text)', banks.APPLICATION_SIGNAL)}) AS app FROM sentences WHERE text IS NOT NULL GROUP BY 1) USING (paper_id))",
)

# ---------------------------------------------------------------- attribution

_VERBS = ["showed", "exhibited", "displayed", "demonstrated", "had", "possessed", "achieved", "reached", "produced", "was", "is", "were", "are", "has", "have"]
_AGAINST = ["compared with ", "compared to ", "unlike ", "in contrast to ", "different from "]


def names_any(text: Column, names: Column) -> Column:
    return F.coalesce(F.exists(names, lambda v: (F.length(v) >= 2) & text.contains(v)), F.lit(False))


def is_subject(text: Column, own: Column) -> Column:
    """A writing of the selected material opens the sentence, or a verb follows it after "compared with ..."."""

    def one(v: Column) -> Column:
        at = F.instr(text, v)
        before = F.rtrim(F.left(text, at - 1))
        after = F.substr(text, at)
        ends = F.lit(False)
        for p in _AGAINST:
            ends = ends | before.contains(p)
        verbs = F.lit(False)
        for w in _VERBS:
            verbs = verbs | after.contains(w)
        starts = F.lit(False)
        for w in _VERBS:
            starts = starts | v.startswith(w)
        return (F.length(v) >= 2) & ((at == 1) | ((at > 1) & ((before.rlike("[,.;!?]$") & starts) | (ends & verbs))))

    return F.coalesce(F.exists(own, one), F.lit(False))


def attribution(text: Column, own: Column, other: Column) -> Column:
    """The reason by which a lower-case sentence is or is not about the selected material."""
    sel, oth = names_any(text, own), names_any(text, other)
    here, prev = text.rlike(fixed.THIS_WORK), text.rlike(fixed.PREVIOUS_WORK)
    contrast = text.rlike("|".join(m.replace(".", "[.]") for m in fixed.CONTRAST_MARKERS))
    return (
        F.when(sel & ~oth, F.when(contrast, "mentions_selected_but_contrast").otherwise("mentions_selected_only"))
        .when(
            sel & oth,
            F.when(here & contrast, "selected_with_this_work_marker_amid_contrast").when(contrast & is_subject(F.trim(text), own), "selected_is_subject_in_contrast").when(contrast, "contrast_context_mentions_both").otherwise("mentions_both_no_contrast"),
        )
        .when(oth, F.when(here, "this_work_marker_without_explicit_name").when(prev, "previous_work_reference").otherwise("mentions_other_only"))
        .otherwise(F.when(here, "this_work_marker_generic").when(prev, "previous_work_generic").otherwise("no_material_mentioned"))
    )


_NOT_OWN = ["contrast_context_mentions_both", "previous_work_reference", "mentions_other_only", "previous_work_generic"]
_HIGH, _LOW = ["mentions_selected_only", "previous_work_reference"], ["empty_input", "mentions_both_no_contrast", "no_material_mentioned"]


def _attributed(s, d):
    """Every sentence with the reason, whether it belongs to the selected material, and how sure that is."""
    n = _names(s, d).select("paper_id", "variants", others(F.col("names"), F.col("variants")).alias("others"))
    t = table(s, d, "sentences").select("sent_key", "paper_id", F.lower("text").alias("t")).join(n, "paper_id", "left")
    reason = F.when(F.col("t").isNull() | (F.col("t") == "") | F.col("variants").isNull(), "empty_input").otherwise(attribution(F.col("t"), F.col("variants"), F.col("others")))
    r = F.col("reason")
    return t.select("sent_key", reason.alias("reason")).select("sent_key", "reason", (~r.isin(_NOT_OWN)).alias("belongs"), F.when(r.isin(_HIGH), "high").when(r.isin(_LOW), "low").otherwise("medium").alias("confidence"))


_ANY = lambda names: f"len(list_filter({names}, lambda v: length(v) >= 2 AND contains(t, v))) > 0"
_LIST = lambda xs: "[" + ", ".join(quote(x) for x in xs) + "]"
_BEFORE = "rtrim(left(u, instr(u, v) - 1))"
_FOLLOWED = f"(regexp_matches({_BEFORE}, '[,.;!?]$') AND len(list_filter({_LIST(_VERBS)}, lambda w: starts_with(v, w))) > 0)"
_AGAINST_SQL = f"(len(list_filter({_LIST(_AGAINST)}, lambda p: contains({_BEFORE}, p))) > 0 AND len(list_filter({_LIST(_VERBS)}, lambda w: contains(substr(u, instr(u, v)), w))) > 0)"
_SUBJECT = f"len(list_filter(variants, lambda v: length(v) >= 2 AND (starts_with(u, v) OR (instr(u, v) > 1 AND ({_FOLLOWED} OR {_AGAINST_SQL}))))) > 0"
_add(
    "val12_attribution",
    _attributed,
    f"""
WITH j AS (SELECT sent_key, lower(text) AS t, variants, list_filter(names, lambda x: NOT list_contains(variants, x)) AS others FROM sentences LEFT JOIN {_NAMES_SQL} USING (paper_id)),
f AS (SELECT *, trim(t, ' ') AS u, {_ANY('variants')} AS sel, {_ANY('others')} AS oth, {sql_hit('t', fixed.THIS_WORK)} AS here, {sql_hit('t', fixed.PREVIOUS_WORK)} AS prev, len(list_filter({_LIST(fixed.CONTRAST_MARKERS)}, lambda m: contains(t, m))) > 0 AS con FROM j),
r AS (SELECT sent_key, CASE WHEN t IS NULL OR t = '' OR variants IS NULL THEN 'empty_input'
  WHEN sel AND NOT oth AND con THEN 'mentions_selected_but_contrast' WHEN sel AND NOT oth THEN 'mentions_selected_only'
  WHEN sel AND here AND con THEN 'selected_with_this_work_marker_amid_contrast' WHEN sel AND con AND {_SUBJECT} THEN 'selected_is_subject_in_contrast' WHEN sel AND con THEN 'contrast_context_mentions_both' WHEN sel THEN 'mentions_both_no_contrast'
  WHEN oth AND here THEN 'this_work_marker_without_explicit_name' WHEN oth AND prev THEN 'previous_work_reference' WHEN oth THEN 'mentions_other_only'
  WHEN here THEN 'this_work_marker_generic' WHEN prev THEN 'previous_work_generic' ELSE 'no_material_mentioned' END AS reason FROM f)
SELECT sent_key, reason, NOT list_contains({_LIST(_NOT_OWN)}, reason) AS belongs, CASE WHEN list_contains({_LIST(_HIGH)}, reason) THEN 'high' WHEN list_contains({_LIST(_LOW)}, reason) THEN 'low' ELSE 'medium' END AS confidence FROM r
""",
)

# ---------------------------------------------------------------- consistency of a record


def _first_number(c: Column) -> Column:
    return F.regexp_extract(c, r"([\d.]+)", 1).try_cast("double")


def inconsistencies() -> Column:
    """Warnings of a record: units of another kind, impossible efficiency, pH and heat against enzyme and method, several substrates, uses that don't go with the enzyme."""
    k, a, sel = F.col("main_activity.kinetics"), F.col("main_activity"), F.col("selected_nanozyme")
    bare = lambda c: F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit(""))
    conc = bare(k["Km_unit"]).rlike("^(" + "|".join(fixed.CONCENTRATION_START) + ")")
    rate = F.lit(False)
    for part in fixed.RATE_PART:
        rate = rate | bare(k["Vmax_unit"]).contains(part)
    eff = F.try_divide(k["kcat"], k["Km"])
    ph, enzyme = a["pH_profile"]["optimal_pH"], F.coalesce(a["enzyme_like_type"], F.lit(""))
    method, heat = F.lower(sel["synthesis_method"]), _first_number(sel["synthesis_conditions"]["temperature"])
    subs = F.array_distinct(F.filter(F.transform(a["kinetics_list"], lambda x: F.lower(F.trim(x["substrate"]))), lambda x: x != ""))
    uses = F.element_at(F.create_map(*[x for e, u in fixed.ENZYME_USES.items() for x in (F.lit(e), _strings(*u))]), F.lower(F.trim(enzyme)))
    wrong = F.exists(F.transform("applications", lambda x: F.lower(F.trim(x["application_type"]))), lambda t: (t != "") & ~F.array_contains(uses, t))
    rules = [
        ((k["Km_unit"] != "") & ~conc, "Km_unit_not_concentration"),
        ((k["Vmax_unit"] != "") & ~rate, "Vmax_unit_not_rate"),
        ((k["kcat"] != 0) & (k["Km"] > 0) & ((eff < 1e-3) | (eff > 1e12)), "kcat_Km_unreasonable"),
        (enzyme.contains("catalase-like") & (ph < 4), "catalase_like_low_pH"),
        (enzyme.contains("peroxidase-like") & (ph > 9), "peroxidase_like_high_pH"),
        ((method.contains("hydrothermal") | method.contains("solvothermal")) & (heat < 80), "hydrothermal_low_temperature"),
        ((method.contains("calcination") | method.contains("annealing")) & (heat < 300), "calcination_low_temperature"),
        ((F.size(a["kinetics_list"]) > 1) & (F.size(subs) > 1), "multiple_kinetics_substrates"),
        (wrong, "app_type_incompatible_with_enzyme"),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), w) for c, w in rules]))


_K = "main_activity.kinetics."
_BARE = lambda c: f"replace(lower(trim({c}, ' ')), ' ', '')"
_HEAT = "try_cast(regexp_extract(selected_nanozyme.synthesis_conditions.temperature, '([0-9.]+)', 1) AS DOUBLE)"
_RULES_SQL = [
    (f"{_K}Km_unit <> '' AND NOT (" + " OR ".join(f"starts_with({_BARE(_K + 'Km_unit')}, {quote(p)})" for p in fixed.CONCENTRATION_START) + ")", "Km_unit_not_concentration"),
    (f"{_K}Vmax_unit <> '' AND NOT (" + " OR ".join(f"contains({_BARE(_K + 'Vmax_unit')}, {quote(p)})" for p in fixed.RATE_PART) + ")", "Vmax_unit_not_rate"),
    (f"{_K}kcat <> 0 AND {_K}Km > 0 AND NOT ({_K}kcat / {_K}Km BETWEEN 1e-3 AND 1e12)", "kcat_Km_unreasonable"),
    ("contains(main_activity.enzyme_like_type, 'catalase-like') AND main_activity.pH_profile.optimal_pH < 4", "catalase_like_low_pH"),
    ("contains(main_activity.enzyme_like_type, 'peroxidase-like') AND main_activity.pH_profile.optimal_pH > 9", "peroxidase_like_high_pH"),
    (f"regexp_matches(lower(selected_nanozyme.synthesis_method), 'hydrothermal|solvothermal') AND {_HEAT} < 80", "hydrothermal_low_temperature"),
    (f"regexp_matches(lower(selected_nanozyme.synthesis_method), 'calcination|annealing') AND {_HEAT} < 300", "calcination_low_temperature"),
    ("len(main_activity.kinetics_list) > 1 AND len(list_distinct(list_filter(list_transform(main_activity.kinetics_list, lambda x: lower(trim(x.substrate, ' '))), lambda x: x <> ''))) > 1", "multiple_kinetics_substrates"),
    (
        "len(list_filter(list_transform(applications, lambda x: lower(trim(x.application_type, ' '))), lambda t: t <> '' AND NOT list_contains(CASE lower(trim(main_activity.enzyme_like_type, ' ')) "
        + " ".join(f"WHEN {quote(e)} THEN {_LIST(u)}" for e, u in fixed.ENZYME_USES.items()) + " END, t))) > 0",
        "app_type_incompatible_with_enzyme",
    ),
]
_add(
    "val24_output_consistency",
    lambda s, d: table(s, d, "records").select("record_id", F.array_join(inconsistencies(), "|").alias("warnings")),
    "SELECT record_id, concat_ws('|', " + ", ".join(f"CASE WHEN {c} THEN {quote(w)} END" for c, w in _RULES_SQL) + ") AS warnings FROM records",
)

# ---------------------------------------------------------------- layout


def heading_collapsed(c: Column) -> Column:
    """Three or more capitals written apart are one word: "A B S T R A C T" is ABSTRACT."""
    runs = F.regexp_extract_all(c, F.lit(fixed.SPACED_CAPITALS), 0)
    return F.aggregate(runs, c, lambda acc, r: F.replace(acc, r, F.replace(r, F.lit(" "), F.lit(""))))


def is_header_footer(c: Column) -> Column:
    t = F.trim(c)
    return F.coalesce(t == "", F.lit(True)) | any_of(t, fixed.HEADER_FOOTER)


_add(
    "lay06_header_footer",
    lambda s, d: table(s, d, "blocks").select("block_key", is_header_footer(F.col("text")).alias("header_footer")),
    f"SELECT block_key, coalesce(trim(text, ' ') = '', true) OR {sql_any("trim(text, ' ')", fixed.HEADER_FOOTER)} AS header_footer FROM blocks",
)


def contents_marks(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.rlike(fixed.CONTENTS_HEADING), "heading").when(t.rlike(fixed.CONTENTS_ENTRY), "entry")


_add(
    "lay13_contents_marks",
    lambda s, d: table(s, d, "blocks").where("text IS NOT NULL").groupBy(F.coalesce(contents_marks(F.col("text")), F.lit("none")).alias("mark")).agg(F.count("*").alias("n")),
    f"SELECT coalesce(CASE WHEN regexp_matches(trim(text, ' '), {quote(fixed.CONTENTS_HEADING)}) THEN 'heading' WHEN regexp_matches(trim(text, ' '), {quote(fixed.CONTENTS_ENTRY)}) THEN 'entry' END, 'none') AS mark, count(*) AS n FROM blocks WHERE text IS NOT NULL GROUP BY 1",
)


def _contents_pages(s, d):
    """Pages of supplements that hold a table of contents: a heading or four entries; with two entries also beside such a page."""
    mark = contents_marks(F.col("text"))
    kinds = table(s, d, "papers").where("document_kind = 'supplementary'").select("paper_id")
    pages = table(s, d, "blocks").where("text IS NOT NULL AND page IS NOT NULL").groupBy("paper_id", "page").agg(F.count_if((mark == "heading") & (F.col("kind") == "heading")).alias("headings"), F.count_if(mark == "entry").alias("entries"))
    pages = pages.join(kinds, "paper_id", "left_semi").withColumn("sure", (F.col("headings") > 0) | (F.col("entries") >= 4))
    beside = pages.where("sure").select("paper_id", F.explode(F.array(F.col("page") - 1, F.col("page") + 1)).alias("page")).distinct().withColumn("beside", F.lit(True))
    return pages.join(beside, ["paper_id", "page"], "left").select("paper_id", "page", "headings", "entries", (F.col("sure") | ((F.col("entries") >= 2) & F.coalesce("beside", F.lit(False)))).alias("contents"))


_add(
    "lay12_contents_pages",
    _contents_pages,
    f"WITH p AS (SELECT paper_id, page, count_if(regexp_matches(trim(text, ' '), {quote(fixed.CONTENTS_HEADING)}) AND kind = 'heading') AS headings, count_if(NOT regexp_matches(trim(text, ' '), {quote(fixed.CONTENTS_HEADING)}) AND regexp_matches(trim(text, ' '), {quote(fixed.CONTENTS_ENTRY)})) AS entries "
    "FROM blocks JOIN papers USING (paper_id) WHERE document_kind = 'supplementary' AND text IS NOT NULL AND page IS NOT NULL GROUP BY 1, 2) "
    "SELECT paper_id, page, headings, entries, headings > 0 OR entries >= 4 OR (entries >= 2 AND EXISTS (SELECT 1 FROM p q WHERE q.paper_id = p.paper_id AND abs(q.page - p.page) = 1 AND (q.headings > 0 OR q.entries >= 4))) AS contents FROM p",
)
_add(
    "lay14_collapsed_headings",
    lambda s, d: table(s, d, "blocks").where("kind = 'heading' AND text IS NOT NULL").select("block_key", heading_collapsed(F.col("text")).alias("heading")),
    f"SELECT block_key, list_reduce(list_prepend(text, regexp_extract_all(text, {quote(fixed.SPACED_CAPITALS)})), lambda acc, r: replace(acc, r, replace(r, ' ', ''))) AS heading FROM blocks WHERE kind = 'heading' AND text IS NOT NULL",
)


def _table_captions(s, d):
    """For each paper's page with rows of a text table in its blocks the nearest table caption at most two pages away; the same page first, then the earlier block.

    Captions are spread over five pages each, so the join is on equality.
    """
    b = table(s, d, "blocks").where("text IS NOT NULL AND page IS NOT NULL")
    caps = b.where(F.lower("text").rlike(r"^\s*table\s+s?\d+")).select("paper_id", "page", F.col("block_key").alias("caption_key"))
    spread = caps.select("paper_id", "caption_key", F.col("page").alias("cp"), F.explode(F.array(*[F.col("page") + i for i in range(-2, 3)])).alias("page"))
    at = b.where("kind = 'paragraph'").select("paper_id", "page").distinct()
    return at.join(spread, ["paper_id", "page"]).groupBy("paper_id", "page").agg(F.min_by("caption_key", F.struct(F.abs(F.col("cp") - F.col("page")), F.col("caption_key"))).alias("caption_key"), F.min(F.abs(F.col("cp") - F.col("page"))).alias("distance"))


_add(
    "jon06_table_caption_within_two_pages",
    _table_captions,
    r"SELECT p.paper_id, p.page, arg_min(c.block_key, (abs(c.page - p.page), c.block_key)) AS caption_key, min(abs(c.page - p.page)) AS distance FROM (SELECT DISTINCT paper_id, page FROM blocks WHERE kind = 'paragraph' AND text IS NOT NULL AND page IS NOT NULL) p "
    r"JOIN blocks c ON c.paper_id = p.paper_id AND abs(c.page - p.page) <= 2 WHERE c.text IS NOT NULL AND regexp_matches(lower(c.text), '^\s*table\s+s?\d+') GROUP BY 1, 2",
)

# ---------------------------------------------------------------- context around recalled evidence

_DROPPED = ["boilerplate", "author_info", "reference_tail", "reference_entry", "figure_ocr_fragment"]
_NEAR = r"(?i)\b(?:K\s*m|V\s*m|Km|Vmax|Michaelis|Lineweaver|kinetic parameters?)\b|\brespectively\b"


def context_window(s, d):
    """Sentences kept around recalled ones: the whole block of two to eight sentences, and both neighbours of an anchor that names a kinetic value or ends with "respectively".

    Neighbours are found by position within the paper; a dropped sentence gives no context.
    """
    t = F.col("text")
    rows = table(s, d, "sentences").where("text IS NOT NULL").select(
        "paper_id", "sent_key", "block_id", hit(F.lower("text"), "|".join(banks.HARD_RECALL.values())).alias("anchor"), t.rlike(_NEAR).alias("wide"), F.coalesce(tx.drop_reason(t), F.lit("")).isin(_DROPPED).alias("dropped")
    )
    blocks = rows.where("block_id IS NOT NULL").groupBy("paper_id", "block_id").agg(F.count("*").alias("n_block"), F.max("anchor").alias("block_anchor")).where("block_anchor AND n_block BETWEEN 2 AND 8")
    rows = od.with_neighbours(rows, "paper_id", "sent_key", F.col("anchor") & F.col("wide")).join(blocks, ["paper_id", "block_id"], "left")
    near = F.coalesce("prev", F.lit(False)) | F.coalesce("next", F.lit(False))
    by_block = F.col("block_anchor").isNotNull()
    why = F.when(F.col("anchor"), "anchor").when(~F.col("dropped") & by_block, "block").when(~F.col("dropped") & near, "neighbour")
    return rows.select("paper_id", "sent_key", why.alias("why")).where("why IS NOT NULL")


def _context_sql() -> str:
    from .texts import _DROP

    anchor = sql_hit("lower(text)", "|".join(banks.HARD_RECALL.values()))
    return (
        f"WITH r AS (SELECT paper_id, sent_key, block_id, {anchor} AS anchor, {sql_hit('text', _NEAR)} AS wide, list_contains({_LIST(_DROPPED)}, coalesce({_DROP}, '')) AS dropped, row_number() OVER (PARTITION BY paper_id ORDER BY sent_key) AS n FROM sentences WHERE text IS NOT NULL), "
        "b AS (SELECT paper_id, block_id, count(*) AS size, bool_or(anchor) AS has FROM r WHERE block_id IS NOT NULL GROUP BY 1, 2) "
        "SELECT paper_id, sent_key, why FROM (SELECT r.paper_id, sent_key, CASE WHEN anchor THEN 'anchor' WHEN dropped THEN NULL WHEN has AND size BETWEEN 2 AND 8 THEN 'block' "
        "WHEN EXISTS (SELECT 1 FROM r q WHERE q.paper_id = r.paper_id AND q.n IN (r.n - 1, r.n + 1) AND q.anchor AND q.wide) THEN 'neighbour' END AS why FROM r LEFT JOIN b ON b.paper_id = r.paper_id AND b.block_id = r.block_id) WHERE why IS NOT NULL"
    )


_add("win01_recall_context", context_window, _context_sql())

# ---------------------------------------------------------------- replies


def reply_text(reply: Column) -> Column:
    """The text of a provider's reply: a choice's content or reasoning, else the first named field that is not blank; null where there is none.

    A reply whose ``choices`` are missing or null is invalid and has no text.
    """
    pick = [F.nullif(F.get_json_object(reply, f"$.choices[0].{m}.{c}"), F.lit("")) for c in ("content", "reasoning_content") for m in ("message", "delta")]
    fields = [F.nullif(F.trim(F.get_json_object(reply, f"$.{f}")), F.lit("")) for f in fixed.REPLY_FIELDS]
    return F.coalesce(*pick, F.when(F.get_json_object(reply, "$.choices").startswith("["), F.coalesce(*fields)))


_add("jsn05_reply_text", lambda s, d: table(s, d, "raw_records").select("record_id", F.coalesce(reply_text(F.col("record_json")), F.col("record_json")).alias("body")))


# What keeps a short writing from being an alias, and the endings of abbreviations.
_NO_ALIAS = ["mgml", "mg/kg", "mmol", "nm", "μm", "ml", "figure", "fig.", "fig ", "table", "scheme", "ref", "suppl", "esm", "si ", "s1", "s2", "s3", "s4", "s5", "s6", "s7", "s8", "s9"]
_STOP_WORDS = [
    "of", "in", "the", "and", "or", "for", "with", "from", "by", "at", "to", "a", "an", "is", "are", "was", "were", "be", "been", "has", "have", "had", "not", "but", "as", "on", "it", "this", "that", "which", "can", "will",
    "may", "also", "than", "into",
]
_ABBREVIATED = ["sazyyme", "sae", "nanozyme", "nanozymes", "nanoparticle", "nanoparticles", "nps", "nanosheet", "nanosheets"]
_NUMERIC_START = r"^[0-9]|^[0-9\s\-+.,/]+$"
_ELEMENT_ONLY = r"^[A-Z][a-z]?[0-9]*(?:O[0-9]*)?$|^[a-z]?[0-9]+$"


def _count(c: Column, cls: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{cls}]", ""))


def valid_alias(c: Column) -> Column:
    """A writing of 2 to 30 signs and at least two letters that is no number, unit, label or stop word."""
    no = F.lit(False)
    for w in _NO_ALIAS:
        no = no | c.contains(w)
    return F.length(c).between(2, 30) & ~c.rlike(_NUMERIC_START) & ~no & ~c.isin(_STOP_WORDS) & (_count(c, " ") <= 4) & (_count(c, "\\p{L}") >= 2)


def could_be_alias(c: Column) -> Column:
    """More than one sign, and no bare element, oxide or number."""
    return ~c.rlike(_ELEMENT_ONLY) & (F.length(c) > 1)


def likely_abbreviation(c: Column) -> Column:
    """Up to ten signs with capitals for two fifths of the letters and digits, capitals with a plural s, or a usual ending."""
    bare = F.length(F.regexp_replace(c, "[ \\-/]", ""))
    upper = _count(c, "A-Z")
    plural = c.endswith("s") & (F.length(c) >= 3) & F.left(c, F.length(c) - 1).rlike("[A-Z]") & ~F.left(c, F.length(c) - 1).rlike("[a-z]")
    ending = F.lit(False)
    for e in _ABBREVIATED:
        ending = ending | F.lower(c).endswith(e)
    return ((F.length(c) <= 10) & (upper >= bare * 0.4)) | plural | ending


def _alias_query(s, d):
    n = table(s, d, "records").where("selected_nanozyme.name IS NOT NULL").select("record_id", F.col("selected_nanozyme.name").alias("n"))
    return n.select("record_id", valid_alias(F.lower("n")).alias("valid"), could_be_alias(F.col("n")).alias("possible"), likely_abbreviation(F.col("n")).alias("abbreviation"))


_LOWER_N = "lower(n)"
_add(
    "flt30_alias_predicates",
    _alias_query,
    f"SELECT record_id, length({_LOWER_N}) BETWEEN 2 AND 30 AND NOT regexp_matches({_LOWER_N}, {quote(_NUMERIC_START)}) AND len(list_filter({_LIST(_NO_ALIAS)}, lambda w: contains({_LOWER_N}, w))) = 0 AND NOT list_contains({_LIST(_STOP_WORDS)}, {_LOWER_N}) "
    f"AND length({_LOWER_N}) - length(replace({_LOWER_N}, ' ', '')) <= 4 AND length(regexp_replace({_LOWER_N}, '[^\\pL]', '', 'g')) >= 2 AS valid, NOT regexp_matches(n, {quote(_ELEMENT_ONLY)}) AND length(n) > 1 AS possible, "
    "(length(n) <= 10 AND length(regexp_replace(n, '[^A-Z]', '', 'g')) >= 0.4 * length(replace(replace(replace(n, ' ', ''), '-', ''), '/', ''))) OR (suffix(n, 's') AND length(n) >= 3 AND regexp_matches(left(n, length(n) - 1), '[A-Z]') AND NOT regexp_matches(left(n, length(n) - 1), '[a-z]')) "
    f"OR len(list_filter({_LIST(_ABBREVIATED)}, lambda e: suffix({_LOWER_N}, e))) > 0 AS abbreviation FROM (SELECT record_id, selected_nanozyme.name AS n FROM records WHERE selected_nanozyme.name IS NOT NULL)",
)

# Fields of former schemas that a record must not have.
FORBIDDEN_FIELDS = ["nanozyme_systems", "catalytic_activities", "benchmark_records", "assay_graph", "systems_count", "activities_count", "single_record_assembler", "system_name"]


def forbidden_fields(json: Column) -> Column:
    """The forbidden fields of a record at its top, in its parts, and in the parts of those or the objects of its lists; empty for what is no object."""
    keys = lambda j: F.coalesce(F.json_object_keys(j), F.array().cast("array<string>"))
    parts = lambda j: F.coalesce(F.map_values(F.from_json(j, "map<string,string>")), F.array().cast("array<string>"))
    items = lambda j: F.coalesce(F.from_json(F.when(j.startswith("["), j), "array<string>"), F.array().cast("array<string>"))
    one = F.filter(parts(json), lambda p: p.isNotNull())
    two = F.filter(F.flatten(F.transform(one, lambda p: F.concat(F.when(p.startswith("{"), parts(p)).otherwise(F.array().cast("array<string>")), items(p)))), lambda p: p.isNotNull())
    found = F.concat(keys(json), F.flatten(F.transform(one, keys)), F.flatten(F.transform(two, keys)))
    return F.array_intersect(F.array(*[F.lit(f) for f in FORBIDDEN_FIELDS]), found)


_add("set01_forbidden_fields", lambda s, d: table(s, d, "raw_records").select("record_id", F.array_join(forbidden_fields(F.col("record_json")), "|").alias("forbidden")))
