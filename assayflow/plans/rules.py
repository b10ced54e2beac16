"""Queries of the record, table and figure rules, with SQL written from the rule and not from the query.

Lookups are literal maps or ordered conditions inside one projection, so they add no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions import fixed
from ..functions.dual import hit, quote, sql_hit, sql_pattern
from ..runtime import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE[name] = sql


def any_of(c: Column, patterns: list[str]) -> Column:
    return hit(c, "|".join(f"(?:{p})" for p in patterns))


def sql_any(expr: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(sql_hit(expr, p) for p in patterns) + ")"


def first_kind(c: Column, bank: dict[str, list[str]]) -> Column:
    """The first label of a bank one of whose patterns matches."""
    return F.coalesce(*[F.when(any_of(c, patterns), F.lit(label)) for label, patterns in bank.items()])


def sql_first_kind(expr: str, bank: dict[str, list[str]]) -> str:
    return "CASE " + " ".join(f"WHEN {sql_any(expr, p)} THEN {quote(k)}" for k, p in bank.items()) + " END"


def literal_map(m: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in m.items() for x in kv])


def sql_rows(m: dict[str, str]) -> str:
    """The entries of a map as (ord, k, v) rows."""
    return "(VALUES " + ", ".join(f"({i}, {quote(k)}, {quote(v)})" for i, (k, v) in enumerate(m.items())) + ")"


# ---------------------------------------------------------------- enzyme and assay names


def enzyme_underscore(raw: Column) -> Column:
    """The underscore name: exact, else the first entry contained in the name or containing it, else by the enzyme named; ``unknown`` for none, ``other`` for another."""
    key = F.lower(F.trim(raw))
    contained = F.coalesce(*[F.when(key.contains(k) | F.lit(k).contains(key), F.lit(v)) for k, v in fixed.ENZYME_UNDERSCORE.items()])
    return F.when(raw.isNull() | (raw == ""), F.lit("unknown")).otherwise(F.coalesce(F.element_at(literal_map(fixed.ENZYME_UNDERSCORE), key), contained, F.when(key.contains("dismutase"), "superoxide_dismutase_like"), F.lit("other")))


def sql_enzyme_underscore(raw: str) -> str:
    """As a lookup in the list: exact entries first, then the earliest that contains or is contained."""
    rows = sql_rows(fixed.ENZYME_UNDERSCORE)
    key = f"lower(trim({raw}, ' '))"
    return (
        f"CASE WHEN {raw} IS NULL OR {raw} = '' THEN 'unknown' ELSE coalesce((SELECT arg_min(e.v, e.ord) FROM {rows} e(ord, k, v) WHERE e.k = {key}), "
        f"(SELECT arg_min(e.v, e.ord) FROM {rows} e(ord, k, v) WHERE contains({key}, e.k) OR contains(e.k, {key})), CASE WHEN contains({key}, 'dismutase') THEN 'superoxide_dismutase_like' END, 'other') END"
    )


_add(
    "map02_enzyme_underscore",
    lambda s, d: table(s, d, "records").select("record_id", enzyme_underscore(F.col("main_activity.enzyme_like_type")).alias("enzyme")),
    f"SELECT record_id, {sql_enzyme_underscore('raw')} AS enzyme FROM (SELECT record_id, main_activity.enzyme_like_type AS raw FROM records)",
)


def _final_names() -> dict[str, str]:
    """Every writing that leads to a final name: with underscores, as it is, and its short forms."""
    out: dict[str, str] = {}
    for name, short in fixed.ENZYME_FINAL.items():
        for k in (name.replace("-", "_"), name, *short):
            out[k] = name
    return out


def enzyme_final(raw: Column) -> Column:
    names = literal_map(_final_names())
    low = F.lower(raw)
    found = F.coalesce(F.element_at(names, raw), F.element_at(names, F.replace(low, F.lit(" "), F.lit("_"))), F.element_at(names, F.replace(low, F.lit(" "), F.lit("-"))))
    return F.when(found.isNotNull(), found).otherwise(F.replace(raw, F.lit("_"), F.lit("-")))


def _final_query(s, d):
    r = table(s, d, "records").select("record_id", F.col("main_activity.enzyme_like_type").alias("raw")).where("raw <> ''").withColumn("enzyme", enzyme_final(F.col("raw")))
    return r.select("record_id", "enzyme", F.when(F.col("enzyme") != F.col("raw"), F.concat("raw", F.lit(" -> "), "enzyme")).alias("change"))


_FINAL_ROWS = sql_rows(_final_names())
_FIND = lambda key: f"(SELECT max(e.v) FROM {_FINAL_ROWS} e(ord, k, v) WHERE e.k = {key})"
_add(
    "map04_enzyme_final_name",
    _final_query,
    f"SELECT record_id, enzyme, CASE WHEN enzyme <> raw THEN raw || ' -> ' || enzyme END AS change FROM (SELECT record_id, raw, coalesce({_FIND('raw')}, {_FIND("replace(lower(raw), ' ', '_')")}, {_FIND("replace(lower(raw), ' ', '-')")}, replace(raw, '_', '-')) AS enzyme "
    "FROM (SELECT record_id, main_activity.enzyme_like_type AS raw FROM records) WHERE raw <> '')",
)


def enzyme_conflict_key(raw: Column) -> Column:
    t = F.translate(F.lower(raw), " _", "--")
    return F.when(raw != "", F.coalesce(F.element_at(literal_map(fixed.ENZYME_CONFLICT), t), t))


_KEY_SQL = "replace(replace(lower(raw), ' ', '-'), '_', '-')"
_add(
    "map05_enzyme_conflict_key",
    lambda s, d: table(s, d, "records").select("record_id", enzyme_conflict_key(F.col("main_activity.enzyme_like_type")).alias("enzyme_key")),
    "SELECT record_id, CASE WHEN raw <> '' THEN CASE " + " ".join(f"WHEN {_KEY_SQL} = {quote(k)} THEN {quote(v)}" for k, v in fixed.ENZYME_CONFLICT.items()) + f" ELSE {_KEY_SQL} END END AS enzyme_key FROM (SELECT record_id, main_activity.enzyme_like_type AS raw FROM records)",
)


def assay_method(raw: Column) -> Column:
    key = F.lower(F.trim(raw))
    part = F.coalesce(*[F.when(key.contains(k), F.lit(v)) for k, v in fixed.ASSAY_METHOD.items()])
    return F.coalesce(F.element_at(literal_map(fixed.ASSAY_METHOD), key), part, F.lit("other"))


_ASSAY_ROWS = sql_rows(fixed.ASSAY_METHOD)


def sql_assay(raw: str) -> str:
    key = f"lower(trim({raw}, ' '))"
    return f"coalesce((SELECT min(e.v) FROM {_ASSAY_ROWS} e(ord, k, v) WHERE e.k = {key}), (SELECT arg_min(e.v, e.ord) FROM {_ASSAY_ROWS} e(ord, k, v) WHERE contains({key}, e.k)), 'other')"


def signal_type(raw: Column) -> Column:
    low = F.lower(F.trim(raw))
    return F.coalesce(*[F.when(low.contains(x) | F.lit(x).contains(low), F.lit(x)) for x in fixed.SIGNAL_TYPES], raw)


def _activity(s, d):
    """The activity of each record in the closed vocabularies, with its kinetic candidates."""
    a = F.col("main_activity")
    entries = F.filter(F.coalesce(a["kinetics_list"], F.array()), lambda k: k.isNotNull())
    n = F.size(F.filter(entries, lambda k: k["Km"].isNotNull())) + F.size(F.filter(entries, lambda k: k["Vmax"].isNotNull()))
    return table(s, d, "records").where("main_activity IS NOT NULL").select(
        "record_id", enzyme_underscore(a["enzyme_like_type"]).alias("enzyme"), assay_method(a["assay_method"]).alias("assay"), F.when(a["signal"] != "", signal_type(a["signal"])).alias("signal"), n.alias("n_candidates")
    )


_SIGNAL_SQL = "CASE WHEN sig <> '' THEN coalesce(" + ", ".join(f"CASE WHEN contains(lower(trim(sig, ' ')), {quote(x)}) OR contains({quote(x)}, lower(trim(sig, ' '))) THEN {quote(x)} END" for x in fixed.SIGNAL_TYPES) + ", sig) END"
_add(
    "val29_activity_build",
    _activity,
    f"SELECT record_id, {sql_enzyme_underscore('raw')} AS enzyme, {sql_assay('assay_raw')} AS assay, {_SIGNAL_SQL} AS signal, CAST(len(list_filter(l, lambda k: k.Km IS NOT NULL)) + len(list_filter(l, lambda k: k.Vmax IS NOT NULL)) AS INTEGER) AS n_candidates "
    "FROM (SELECT record_id, main_activity.enzyme_like_type AS raw, main_activity.assay_method AS assay_raw, main_activity.signal AS sig, coalesce(main_activity.kinetics_list, []) AS l FROM records WHERE main_activity IS NOT NULL)",
)
_add(
    "map19_enzyme_keywords",
    lambda s, d: s.createDataFrame([(i, k, v) for i, (k, v) in enumerate(fixed.ENZYME_UNDERSCORE.items())], "ord int, keyword string, enzyme string"),
    f"SELECT CAST(ord AS INTEGER) AS ord, k AS keyword, v AS enzyme FROM {sql_rows(fixed.ENZYME_UNDERSCORE)} e(ord, k, v)",
)

# ---------------------------------------------------------------- applications


def _apps(s, d):
    return table(s, d, "records").select("record_id", "paper_id", "main_activity", "selected_nanozyme", F.posexplode("applications").alias("ord", "a")).where("a IS NOT NULL")


_APPS_SQL = "(SELECT record_id, CAST(ord - 1 AS INTEGER) AS ord, a FROM (SELECT record_id, unnest(applications) AS a, generate_subscripts(applications, 1) AS ord FROM records) WHERE a IS NOT NULL)"


def application_type(desc: Column, raw: Column) -> Column:
    return F.coalesce(first_kind(F.lower(F.concat_ws(" ", F.coalesce(desc, F.lit("")), F.coalesce(raw, F.lit("")))), fixed.APPLICATION), F.lit("other"))


_add(
    "map07_application_by_pattern",
    lambda s, d: _apps(s, d).select("record_id", "ord", application_type(F.col("a.notes"), F.col("a.application_type")).alias("kind")),
    f"SELECT record_id, ord, coalesce({sql_first_kind('t', fixed.APPLICATION)}, 'other') AS kind FROM (SELECT record_id, ord, lower(coalesce(a.notes, '') || ' ' || coalesce(a.application_type, '')) AS t FROM {_APPS_SQL})",
)


def analyte_of(desc: Column) -> Column:
    """The first known analyte a description names, else what stands after "detection of"."""
    low = F.lower(desc)
    known = F.coalesce(*[F.when(low.contains(x), F.lit(x)) for x in fixed.ANALYTES])
    return F.coalesce(known, F.nullif(F.trim(F.regexp_extract(desc, fixed.DETECTED, 1)), F.lit("")))


def _application(s, d):
    """Each application completed from its notes, the first of each (type, analyte, method) of a record."""
    a = F.col("a")
    notes = F.coalesce(a["notes"], F.lit(""))
    built = _apps(s, d).select(
        "record_id", "ord", application_type(a["notes"], a["application_type"]).alias("kind"), F.coalesce(F.nullif(a["target_analyte"], F.lit("")), analyte_of(notes)).alias("analyte"),
        F.coalesce(F.nullif(a["method"], F.lit("")), first_kind(notes, fixed.METHOD_NAMED)).alias("method"), F.coalesce(F.nullif(a["sample_type"], F.lit("")), first_kind(notes, fixed.SAMPLE_NAMED)).alias("sample"),
        F.nullif(F.trim(F.concat_ws(" ", F.nullif(a["detection_limit"], F.lit("")), F.nullif(a["detection_limit_unit"], F.lit("")))), F.lit("")).alias("detection_limit"),
    )
    key = [F.col("record_id"), F.coalesce("kind", F.lit("")), F.coalesce("analyte", F.lit("")), F.coalesce("method", F.lit(""))]
    rest = F.min_by(F.struct("ord", "kind", "analyte", "method", "sample", "detection_limit"), "ord").alias("r")
    return built.groupBy(key[0], *[k.alias(f"_k{i}") for i, k in enumerate(key[1:])]).agg(rest).select("record_id", "r.*")


_KNOWN_SQL = "coalesce(" + ", ".join(f"CASE WHEN contains(lower(n), {quote(x)}) THEN {quote(x)} END" for x in fixed.ANALYTES) + f", nullif(trim(regexp_extract(n, {quote(fixed.DETECTED)}, 1), ' '), ''))"
_add(
    "val27_application_build",
    _application,
    f"WITH b AS (SELECT record_id, ord, coalesce({sql_first_kind('t', fixed.APPLICATION)}, 'other') AS kind, coalesce(nullif(a.target_analyte, ''), {_KNOWN_SQL}) AS analyte, coalesce(nullif(a.method, ''), {sql_first_kind('n', fixed.METHOD_NAMED)}) AS method, "
    f"coalesce(nullif(a.sample_type, ''), {sql_first_kind('n', fixed.SAMPLE_NAMED)}) AS sample, nullif(trim(concat_ws(' ', nullif(a.detection_limit, ''), nullif(a.detection_limit_unit, '')), ' '), '') AS detection_limit "
    f"FROM (SELECT record_id, ord, a, coalesce(a.notes, '') AS n, lower(coalesce(a.notes, '') || ' ' || coalesce(a.application_type, '')) AS t FROM {_APPS_SQL})) "
    "SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY record_id, kind, coalesce(analyte, ''), coalesce(method, '') ORDER BY ord) = 1",
)


def is_analyte(term: Column) -> Column:
    t = F.lower(F.trim(term))
    return F.coalesce(t.isin(fixed.ANALYTES) | term.rlike(fixed.ANALYTE_VERB) | t.endswith(" cells"), F.lit(False))


_TERMS_SQL = "(SELECT record_id, unnest(list_distinct(list_concat(coalesce(main_activity.substrates, []), list_transform(coalesce(applications, []), lambda a: a.target_analyte)))) AS term FROM records)"
_add(
    "flt29_known_terms",
    lambda s, d: table(s, d, "records").select("record_id", F.explode(F.array_distinct(F.concat(F.coalesce("main_activity.substrates", F.array().cast("array<string>")), F.coalesce(F.transform("applications", lambda a: a["target_analyte"]), F.array().cast("array<string>"))))).alias("term"))
    .where("term <> ''").select("record_id", "term", is_analyte(F.col("term")).alias("analyte"), F.lower(F.trim("term")).isin(fixed.SUBSTRATES).alias("substrate")),
    f"SELECT record_id, term, list_contains({fixed.ANALYTES}, t) OR {sql_hit('term', fixed.ANALYTE_VERB)} OR suffix(t, ' cells') AS analyte, list_contains({[x.replace(chr(39), chr(39)) for x in fixed.SUBSTRATES if chr(39) not in x]}, t) AS substrate FROM (SELECT record_id, term, lower(trim(term, ' ')) AS t FROM {_TERMS_SQL} WHERE term <> '')",
)

# ---------------------------------------------------------------- tables


def table_type(text: Column) -> Column:
    """The type most of whose patterns match; a tie goes to the earlier one, none is ``general_table``."""
    scores = [(label, sum((hit(text, p).cast("int") for p in patterns), F.lit(0))) for label, patterns in fixed.TABLE_TYPE.items()]
    best = F.greatest(*[x for _, x in scores])
    return F.when(best == 0, F.lit("general_table")).otherwise(F.coalesce(*[F.when(x == best, F.lit(label)) for label, x in scores]))


def sql_table_type(expr: str) -> str:
    """As rows of (ord, type, hits), the best by hits and order."""
    arms = " UNION ALL ".join(f"SELECT {i} AS ord, {quote(k)} AS kind, " + " + ".join(f"CAST({sql_hit(expr, p)} AS INTEGER)" for p in ps) + " AS hits" for i, (k, ps) in enumerate(fixed.TABLE_TYPE.items()))
    return f"coalesce((SELECT arg_max(kind, hits * 100 - ord) FROM ({arms}) WHERE hits > 0), 'general_table')"


_add(
    "map14_table_type_by_score",
    lambda s, d: table(s, d, "blocks").where("kind = 'caption' AND text IS NOT NULL").select("block_key", table_type(F.col("text")).alias("type")),
    f"SELECT block_key, {sql_table_type('text')} AS type FROM blocks WHERE kind = 'caption' AND text IS NOT NULL",
)


def _table_rows(s, d):
    """Rows of text tables: the kinetic entries read from a table, their cells, and the paper's material."""
    cells = F.coalesce("_evidence_Km", "_evidence_Vmax", "_evidence_kcat", "_evidence_kcat_Km")
    k = table(s, d, "kinetics").where("source = 'table'").select("kin_id", "paper_id", cells.alias("row")).where("row LIKE '|%'")
    chosen = table(s, d, "records").groupBy("paper_id").agg(F.min_by(F.lower(F.trim("selected_nanozyme.name")), "record_id").alias("selected"))
    return k.join(chosen, "paper_id", "left").withColumn("material", F.lower(F.trim(F.split_part("row", F.lit("|"), F.lit(2)))))


def _filtered_rows(s, d):
    """Table rows that belong to the work itself: this-work rows of a comparison, or rows of the selected material."""
    rows = _table_rows(s, d).withColumn("type", table_type(F.col("row")))
    own = any_of(F.col("row"), fixed.THIS_WORK_ROW)
    same = F.coalesce((F.col("selected") != "") & (F.col("material") != "") & (F.col("material").contains(F.col("selected")) | F.col("selected").contains(F.col("material"))), F.lit(False))
    keep = F.when(F.col("type") == "comparison_table", own | same).otherwise(F.col("type") != "general_table")
    return rows.select("kin_id", "type", own.alias("this_work"), same.alias("same_material"), keep.alias("kept"))


_ROWS_SQL = (
    "(SELECT kin_id, row, lower(trim(split_part(row, '|', 2), ' ')) AS material, selected FROM (SELECT kin_id, paper_id, coalesce(_evidence_Km, _evidence_Vmax, _evidence_kcat, _evidence_kcat_Km) AS row FROM kinetics WHERE source = 'table') k "
    "LEFT JOIN (SELECT paper_id, lower(trim(selected_nanozyme.name, ' ')) AS selected FROM records r WHERE record_id = (SELECT min(record_id) FROM records q WHERE q.paper_id = r.paper_id AND q.selected_nanozyme.name IS NOT NULL)) USING (paper_id) WHERE row LIKE '|%')"
)
_add(
    "val25_table_rows_of_this_work",
    _filtered_rows,
    f"SELECT kin_id, type, this_work, same_material, CASE WHEN type = 'comparison_table' THEN this_work OR same_material ELSE type <> 'general_table' END AS kept FROM (SELECT kin_id, {sql_table_type('row')} AS type, {sql_any('row', fixed.THIS_WORK_ROW)} AS this_work, "
    f"coalesce(selected <> '' AND material <> '' AND (contains(material, selected) OR contains(selected, material)), false) AS same_material FROM {_ROWS_SQL})",
)


def table_priority(kind: Column, text: Column, rows: Column, supplement: Column) -> Column:
    """Base of the type, 3 for a decimal number, 2 each for three and six rows, 2 beyond 300 characters; minus 1 in a supplement unless of high value."""
    high = kind.isin("kinetics_table", "sensing_performance_table")
    score = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in fixed.TABLE_BASE.items() for x in kv]), kind), F.lit(2.0))
    for cond, points in ((hit(text, r"\d+\.\d+"), 3.0), (rows >= 3, 2.0), (rows >= 6, 2.0), (F.length(text) > 300, 2.0), (supplement & ~high, -1.0)):
        score = score + F.when(cond, points).otherwise(0.0)
    return F.round(score, 2)


def _tables(s, d):
    """One text table per paper, with a priority; those of 7 and more are all kept, of 4 to 7 the best four, below the best."""
    rows = _table_rows(s, d)
    t = rows.groupBy("paper_id").agg(F.count("*").alias("n_rows"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("kin_id", "row"))), lambda x: x["row"]), "\n").alias("text"))
    supplement = table(s, d, "papers").select("paper_id", (F.col("document_kind") == "supplementary").alias("supplement"))
    t = t.join(supplement, "paper_id", "left").withColumn("supplement", F.coalesce("supplement", F.lit(False))).withColumn("type", table_type(F.col("text")))
    p = table_priority(F.col("type"), F.col("text"), F.col("n_rows"), F.col("supplement"))
    return t.select("paper_id", "type", "n_rows", p.alias("priority")).withColumn("band", F.when(F.col("priority") >= 7, "high").when(F.col("priority") >= 4, "medium").otherwise("low"))


_TEXT_TYPE = sql_table_type("text")
_add(
    "srt05_table_bands",
    _tables,
    f"SELECT paper_id, type, n_rows, priority, CASE WHEN priority >= 7 THEN 'high' WHEN priority >= 4 THEN 'medium' ELSE 'low' END AS band FROM (SELECT paper_id, type, n_rows, CAST(round((CASE type {' '.join(f'WHEN {quote(k)} THEN {v}' for k, v in fixed.TABLE_BASE.items())} END) "
    f"+ CASE WHEN {sql_hit('text', '[0-9]+[.][0-9]+')} THEN 3 ELSE 0 END + CASE WHEN n_rows >= 3 THEN 2 ELSE 0 END + CASE WHEN n_rows >= 6 THEN 2 ELSE 0 END + CASE WHEN length(text) > 300 THEN 2 ELSE 0 END "
    "- CASE WHEN document_kind = 'supplementary' AND type NOT IN ('kinetics_table', 'sensing_performance_table') THEN 1 ELSE 0 END, 2) AS DOUBLE) AS priority "
    f"FROM (SELECT paper_id, document_kind, n_rows, text, {_TEXT_TYPE} AS type FROM (SELECT k.paper_id, any_value(document_kind) AS document_kind, count(*) AS n_rows, string_agg(row, chr(10) ORDER BY kin_id) AS text FROM (SELECT kin_id, paper_id, coalesce(_evidence_Km, _evidence_Vmax, _evidence_kcat, _evidence_kcat_Km) AS row FROM kinetics WHERE source = 'table') k JOIN papers USING (paper_id) WHERE row LIKE '|%' GROUP BY 1)))",
)

# ---------------------------------------------------------------- figures


def _kinds(c: Column) -> dict[str, Column]:
    return {k: any_of(F.lower(c), p) for k, p in fixed.CAPTION_KIND.items()}


def agreement(caption: Column, figure_type: Column) -> Column:
    """How far caption and type agree: per kind that either names 1 if both do, else 0.3, averaged; 0.5 where none is named, 0 without caption."""
    t = F.lower(F.coalesce(figure_type, F.lit("")))
    total, score = F.lit(0), F.lit(0.0)
    for kind, says in _kinds(caption).items():
        typed = F.lit(False)
        for part in fixed.TYPE_KIND[kind]:
            typed = typed | t.contains(part)
        total = total + (says | typed).cast("int")
        score = score + F.when(says & typed, 1.0).when(says | typed, 0.3).otherwise(0.0)
    return F.when(F.coalesce(caption, F.lit("")) == "", 0.0).when(total == 0, 0.5).otherwise(F.round(score / total, 4))


def _agreement_query(s, d):
    """Captions against the kind of values the paper's figures gave."""
    kind = table(s, d, "kinetics").where("source = 'figure_candidate'").select("paper_id").distinct().withColumn("figure_type", F.lit("kinetics"))
    f = table(s, d, "figures").join(kind, "paper_id", "left").select("fig_key", agreement(F.col("caption_text"), F.col("figure_type")).alias("agreement"))
    return f.withColumn("low_confidence", F.col("agreement") < 0.4)


_SAYS = {k: sql_any("lower(caption_text)", p) for k, p in fixed.CAPTION_KIND.items()}
_add(
    "val26_caption_agreement",
    _agreement_query,
    "SELECT fig_key, agreement, agreement < 0.4 AS low_confidence FROM (SELECT fig_key, CAST(CASE WHEN coalesce(caption_text, '') = '' THEN 0 WHEN NOT (k OR a OR m OR t) THEN 0.5 ELSE round((CASE WHEN k AND t THEN 1.0 WHEN k OR t THEN 0.3 ELSE 0 END + CASE WHEN a THEN 0.3 ELSE 0 END + CASE WHEN m THEN 0.3 ELSE 0 END) "
    f"/ (CAST(k OR t AS INTEGER) + CAST(a AS INTEGER) + CAST(m AS INTEGER)), 4) END AS DOUBLE) AS agreement FROM (SELECT fig_key, caption_text, {_SAYS['kinetics']} AS k, {_SAYS['application']} AS a, {_SAYS['morphology']} AS m, "
    "EXISTS (SELECT 1 FROM kinetics q WHERE q.paper_id = f.paper_id AND q.source = 'figure_candidate') AS t FROM figures f))",
)


def _caption_values(s, d):
    """Every Km and Vmax that a caption gives with its unit, in order."""
    c = table(s, d, "figures").select("fig_key", F.col("caption_text").alias("t"))
    out = None
    for name, pattern in (("Km", fixed.CAPTION_KM), ("Vmax", fixed.CAPTION_VMAX)):
        pairs = F.arrays_zip(F.regexp_extract_all("t", F.lit(pattern), 1).alias("value"), F.regexp_extract_all("t", F.lit(pattern), 2).alias("unit"))
        one = c.select("fig_key", F.lit(name).alias("parameter"), F.posexplode(pairs).alias("ord", "p")).select("fig_key", "parameter", "ord", F.expr("try_cast(p.value AS double)").alias("value"), F.trim("p.unit").alias("unit"))
        out = one if out is None else out.unionByName(one)
    return out


_add(
    "ext23_caption_values",
    _caption_values,
    " UNION ALL ".join(
        f"SELECT fig_key, '{n}' AS parameter, CAST(ord - 1 AS INTEGER) AS ord, CAST(v AS DOUBLE) AS value, trim(u, ' ') AS unit FROM (SELECT fig_key, unnest(regexp_extract_all(caption_text, {quote(p)}, 1)) AS v, unnest(regexp_extract_all(caption_text, {quote(p)}, 2)) AS u, "
        f"generate_subscripts(regexp_extract_all(caption_text, {quote(p)}, 1), 1) AS ord FROM figures)"
        for n, p in (("Km", fixed.CAPTION_KM), ("Vmax", fixed.CAPTION_VMAX))
    ),
)

# ---------------------------------------------------------------- physical properties


def physical(text: Column, name: str) -> Column:
    """Value and unit by the first pattern that matches."""
    return F.coalesce(*[F.when(text.rlike(p), F.concat_ws(" ", F.regexp_extract(text, p, 1), F.regexp_extract(text, p, 2))) for p in fixed.PHYSICAL[name]])


def _physical(s, d):
    """Per paper the first sentence that gives each property."""
    t = table(s, d, "sentences").where("text IS NOT NULL")
    values = t.select("paper_id", "sent_key", *[physical(F.col("text"), n).alias(n) for n in fixed.PHYSICAL])
    return values.where(" OR ".join(f"{n} IS NOT NULL" for n in fixed.PHYSICAL)).groupBy("paper_id").agg(*[F.min_by(n, F.when(F.col(n).isNotNull(), F.col("sent_key"))).alias(n) for n in fixed.PHYSICAL])


def _sql_physical(n: str) -> str:
    arms = " ".join(f"WHEN {sql_hit('text', p)} THEN regexp_extract(text, {quote(sql_pattern(p))}, 1) || ' ' || regexp_extract(text, {quote(sql_pattern(p))}, 2)" for p in fixed.PHYSICAL[n])
    return f"(SELECT paper_id, arg_min(v, sent_key) AS {n} FROM (SELECT paper_id, sent_key, CASE {arms} END AS v FROM sentences) WHERE v IS NOT NULL GROUP BY 1)"


_add(
    "ext16_physical_properties",
    _physical,
    f"SELECT paper_id, surface_area, zeta_potential, pore_size FROM {_sql_physical('surface_area')} FULL JOIN {_sql_physical('zeta_potential')} USING (paper_id) FULL JOIN {_sql_physical('pore_size')} USING (paper_id)",
)
