"""Queries of the string and sentence operators, over whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import banks
from ..functions.dual import extract, first_label, hit, labels, quote, sql_extract, sql_first_label, sql_hit, sql_labels, sql_replace_all
from ..operators import text as tx
from ..runtime import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE[name] = sql


def _sentences(s, d):
    return table(s, d, "sentences")


_CLEAN = f"trim({sql_replace_all('text', [('-[ \\t]*\\n[ \\t]*', ''), ('[ \\t\\r\\n]+', ' ')])}, ' ')"
_SEARCH = f"trim({sql_replace_all('lower(text)', [('[^a-z0-9 ]', ' '), (' +', ' ')])}, ' ')"
_add(
    "txt01_cleanup_and_search_text",
    lambda s, d: _sentences(s, d).select("sent_key", tx.basic_cleanup(F.col("text")).alias("clean"), tx.search_text(F.col("text")).alias("search")),
    f"SELECT sent_key, {_CLEAN} AS clean, {_SEARCH} AS search FROM sentences",
)
_add(
    "txt08_ocr_notation_repair",
    lambda s, d: _sentences(s, d).select("sent_key", tx.ocr_repair(F.col("text")).alias("repaired")),
    f"SELECT sent_key, {sql_replace_all('text', tx.OCR_STEPS)} AS repaired FROM sentences",
)


def _sql_number(c: str) -> str:
    plain = f"translate({c}, '⁰¹²³⁴⁵⁶⁷⁸⁹⁻−', '0123456789--')"
    m = f"try_cast(replace({sql_extract(c, '(-?[0-9]+([.,][0-9]+)?)')}, ',', '.') AS DOUBLE)"
    e = f"coalesce(try_cast({sql_extract(plain, '[0-9] *[x×*] *10 *\\^?(-?[0-9]+)')} AS INTEGER), try_cast({sql_extract(plain, '[0-9][eE](-?[0-9]+)')} AS INTEGER), 0)"
    return f"({m} * pow(10.0::DOUBLE, {e}))"


_add(
    "txt09_number_parse",
    lambda s, d: table(s, d, "kinetics").select("kin_id", F.round(tx.parse_number(F.col("Km_raw")), 6).alias("value"), tx.exponent(F.col("Km_raw")).alias("power")),
    f"SELECT kin_id, round({_sql_number('Km_raw')}, 6) AS value, CAST(coalesce(try_cast({sql_extract("translate(Km_raw, '⁰¹²³⁴⁵⁶⁷⁸⁹⁻−', '0123456789--')", '[0-9] *[x×*] *10 *\\^?(-?[0-9]+)')} AS INTEGER), try_cast({sql_extract("translate(Km_raw, '⁰¹²³⁴⁵⁶⁷⁸⁹⁻−', '0123456789--')", '[0-9][eE](-?[0-9]+)')} AS INTEGER), 0) AS INTEGER) AS power FROM kinetics",
)


def _sql_split(c: str) -> str:
    g = c
    for a in tx.ABBREVIATIONS:
        g = f"replace({g}, '{a} ', '{a}' || chr(2))"
    return f"list_filter(list_transform(string_split(regexp_replace({g}, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)), lambda p: replace(p, chr(2), ' ')), lambda p: length(p) > 5)"


_add(
    "txt11_sentence_split",
    lambda s, d: _sentences(s, d).where("text IS NOT NULL").select("sent_key", F.posexplode(tx.split_sentences(F.col("text"))).alias("ord", "sentence")),
    f"SELECT sent_key, CAST(ord - 1 AS INTEGER) AS ord, sentence FROM (SELECT sent_key, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS ord FROM (SELECT sent_key, {_sql_split('text')} AS parts FROM sentences WHERE text IS NOT NULL))",
)
_add("txt12_greedy_chunks", lambda s, d: table(s, d, "blocks").where("text IS NOT NULL").select("block_key", F.posexplode(tx.greedy_pack(tx.split_sentences(F.col("text")), 300)).alias("chunk", "chunk_text")))
_CITE = [(" *\\[[0-9]{1,3}([,-][0-9]{1,3})*\\]", ""), (" *[(（]?(see|cf\\.) +(Fig|Sec|Table)[^)）.]*[)）]?", "")]
_add(
    "txt13_citation_strip",
    lambda s, d: _sentences(s, d).select("sent_key", tx.strip_citations(F.col("text")).alias("plain")),
    f"SELECT sent_key, trim({sql_replace_all('text', _CITE)}, ' ') AS plain FROM sentences",
)
_add(
    "txt14_table_markdown",
    lambda s, d: table(s, d, "reference_terms").select(
        "term_id", F.concat(F.lit("| "), F.concat_ws(" | ", F.col("field"), F.col("canonical"), F.array_join("aliases", "; ")), F.lit(" |\n|"), F.repeat(F.lit("---|"), 3)).alias("markdown")
    ),
    "SELECT term_id, '| ' || concat_ws(' | ', field, canonical, array_to_string(aliases, '; ')) || ' |' || chr(10) || '|' || repeat('---|', 3) AS markdown FROM reference_terms",
)
_add(
    "txt15_name_repair",
    lambda s, d: table(s, d, "records").select("record_id", tx.clean_name(F.col("selected_nanozyme.name")).alias("name"), tx.name_stem(F.col("selected_nanozyme.name")).alias("stem")),
    f"SELECT record_id, nullif(trim({sql_replace_all('lower(selected_nanozyme.name)', tx.NAME_STEPS)}, ' '), '') AS name, trim({sql_replace_all('lower(selected_nanozyme.name)', tx.SUFFIX_STEPS)}, ' ') AS stem FROM records",
)
_add(
    "txt17_authors",
    lambda s, d: table(s, d, "papers").select("paper_id", tx.first_author(F.col("author")).alias("first_author"), F.when(F.col("author").isNull(), 0).otherwise(F.size(F.split("author", ";"))).alias("n_authors")),
    f"SELECT paper_id, nullif(trim({sql_replace_all("string_split(author, ';')[1]", [('^[A-Z]\\. *', ''), ('[*†0-9]+$', '')])}, ' '), '') AS first_author, CAST(CASE WHEN author IS NULL THEN 0 ELSE len(string_split(author, ';')) END AS INTEGER) AS n_authors FROM papers",
)
_add(
    "txt19_doi_and_year",
    lambda s, d: table(s, d, "papers").select("paper_id", tx.clean_doi(F.col("doi")).alias("doi_clean"), tx.clean_year(F.col("year")).alias("year_clean")),
    f"SELECT paper_id, {sql_extract('lower(trim(doi))', '(10\\.[0-9]{4,9}/[^ \"<>]*[a-z0-9])')} AS doi_clean, try_cast({sql_extract('year', '(19[5-9][0-9]|20[0-3][0-9])')} AS INTEGER) AS year_clean FROM papers",
)
_SENT = ", ".join(quote(x) for x in banks.SENTINELS)
_add(
    "txt20_sentinels_to_null",
    lambda s, d: table(s, d, "records").select("record_id", tx.to_null(F.col("main_activity.enzyme_like_type")).alias("enzyme"), tx.to_null(F.col("main_activity.assay_method")).alias("assay"), tx.to_null(F.col("selected_nanozyme.synthesis_method")).alias("synthesis")),
    "SELECT record_id, " + ", ".join(f"CASE WHEN lower(trim({c}, ' ')) IN ({_SENT}) THEN NULL ELSE trim({c}, ' ') END AS {n}" for c, n in (("main_activity.enzyme_like_type", "enzyme"), ("main_activity.assay_method", "assay"), ("selected_nanozyme.synthesis_method", "synthesis"))) + " FROM records",
)
_COMP = "regexp_replace(trim(selected_nanozyme.composition, ' '), '^([A-Z][a-z]?)-doped +|^hollow +', '', 'g')"
_add(
    "txt21_composition_parts",
    lambda s, d: table(s, d, "records").select("record_id", tx.composition_parts(F.col("selected_nanozyme.composition")).alias("p")).select("record_id", "p.core", "p.shell", "p.support", "p.dopant"),
    f"SELECT record_id, {sql_extract(_COMP, '^([^@/ ]+)')} AS core, {sql_extract(_COMP, '@([^@/ ]+)')} AS shell, {sql_extract(_COMP, '/([^@/ ]+)')} AS support, {sql_extract('selected_nanozyme.composition', '^([A-Z][a-z]?)-doped')} AS dopant FROM records",
)
_STEM = "regexp_replace(title, '[^A-Za-z0-9_.-]+', '_', 'g')"
_add(
    "txt22_safe_stem",
    lambda s, d: table(s, d, "papers").select("paper_id", tx.safe_stem(F.col("title")).alias("stem")),
    f"SELECT paper_id, CASE WHEN length({_STEM}) > 40 THEN substr({_STEM}, 1, 31) || '_' || substr(md5(title), 1, 8) ELSE {_STEM} END AS stem FROM papers",
)

# ---------------------------------------------------------------- predicates, tags, scores
_DROP = sql_first_label("lower(coalesce(text, ''))", banks.DROP_REASON, None)
_add(
    "flt02_drop_reason",
    lambda s, d: _sentences(s, d).select("sent_key", tx.drop_reason(F.col("text")).alias("reason")),
    f"SELECT sent_key, {_DROP} AS reason FROM sentences",
)
_FRAG = "^[^a-zA-Z]{0,3}$|^([a-zA-Z0-9]{1,2} ){3,}"
_add(
    "flt03_fragment_predicates",
    lambda s, d: _sentences(s, d).where("text IS NOT NULL").select(
        "sent_key", hit(F.col("text"), _FRAG).alias("fragment"), (~hit(F.col("text"), "[.!?。！？।؟”\"“»)]$")).alias("incomplete"), F.round(F.length(F.regexp_replace("text", "[^A-Za-z0-9]", "")) / F.length("text"), 4).alias("alnum_share")
    ),
    f"SELECT sent_key, {sql_hit('text', _FRAG)} AS fragment, NOT {sql_hit('text', '[.!?。！？।؟”\"“»)]$')} AS incomplete, round(length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) / length(text), 4) AS alnum_share FROM sentences WHERE text IS NOT NULL",
)
_REFS = ["et al", "[0-9]{4}", "doi", "vol", "journal|annals|letters|reports", "[0-9]+[-–][0-9]+"]
_add(
    "flt05_reference_features",
    lambda s, d: _sentences(s, d).select("sent_key", sum((hit(F.lower("text"), p).cast("int") for p in _REFS), F.lit(0)).alias("n_features")),
    "SELECT sent_key, CAST(" + " + ".join(f"CAST({sql_hit('lower(text)', p)} AS INTEGER)" for p in _REFS) + " AS INTEGER) AS n_features FROM sentences",
)
_add(
    "flt08_hard_recall",
    lambda s, d: _sentences(s, d).select("sent_key", labels(F.lower("text"), banks.HARD_RECALL).alias("recall")),
    f"SELECT sent_key, {sql_labels('lower(text)', banks.HARD_RECALL)} AS recall FROM sentences",
)
_SIGNALS = {"kinetics": banks.KINETICS_SIGNAL, "activity": banks.ACTIVITY_SIGNAL, "application": banks.APPLICATION_SIGNAL, "material": banks.MATERIAL_SIGNAL}
_add(
    "flt10_signals",
    lambda s, d: _sentences(s, d).select("sent_key", tx.signal_label(F.col("text")).alias("signal")),
    f"SELECT sent_key, replace({sql_labels('lower(text)', _SIGNALS)}, '|', '+') AS signal FROM sentences",
)
_add(
    "flt11_caption_type",
    lambda s, d: table(s, d, "figures").select("fig_key", first_label(F.lower("caption_text"), banks.CAPTION_TYPE, "other").alias("caption_type")),
    f"SELECT fig_key, {sql_first_label('lower(caption_text)', banks.CAPTION_TYPE, 'other')} AS caption_type FROM figures",
)
_TAGS = sql_labels("lower(text)", banks.VALUE_TAGS)
_ROLE = "coalesce(" + ", ".join(f"CASE WHEN contains('|' || tags || '|', '|{r}|') THEN '{r}' END" for r in banks.PRIMARY_ROLE) + ")"
_add(
    "flt13_value_tags_and_role",
    lambda s, d: _sentences(s, d).select("sent_key", tx.tags(F.col("text")).alias("tags")).select("sent_key", "tags", tx.primary_role(F.col("tags")).alias("role")),
    f"SELECT sent_key, tags, {_ROLE} AS role FROM (SELECT sent_key, {_TAGS} AS tags FROM sentences)",
)
_MAP = lambda m: "MAP {" + ", ".join(f"{quote(k)}: {v!r}::DOUBLE" for k, v in m.items()) + "}"
_KW = f"coalesce(list_sum(list_transform(regexp_extract_all(lower(text), {quote('(' + '|'.join(banks.KEYWORD_WEIGHT) + ')')}, 1), lambda k: ({_MAP(banks.KEYWORD_WEIGHT)})[k])), 0.0)"
_SCORE = (
    f"round(({_KW} + CAST({sql_hit('text', banks.NUMBER_WITH_UNIT)} AS INTEGER) * 3.0 + CAST({sql_hit('text', banks.RANGE_WITH_UNIT)} AS INTEGER) * 2.0) * coalesce(({_MAP(banks.SECTION_FACTOR)})[coalesce(section, 'unknown')], 1.0)"
    " * CASE WHEN length(text) < 15 THEN 0.5 WHEN length(text) > 500 THEN 0.8 ELSE 1.0 END, 2)"
)
_add(
    "flt17_sentence_score",
    lambda s, d: _sentences(s, d).where("text IS NOT NULL").select("sent_key", tx.sentence_score(F.col("text"), F.col("section")).alias("kw_score")),
    f"SELECT sent_key, CAST({_SCORE} AS DOUBLE) AS kw_score FROM sentences WHERE text IS NOT NULL",
)
_HAS = lambda *names: "list_has_any(tags, [" + ", ".join(quote(n) for n in names) + "])"
_PRIO = (
    f"round(kw_score + coalesce(list_sum(list_transform(tags, lambda t: coalesce(({_MAP(banks.TAG_BONUS)})[t], 0.0))), 0.0) + greatest(len(list_intersect(tags, {banks.SELECTION_ROLES})) - 1, 0) * 0.8"
    f" + CASE WHEN contains_numeric AND {_HAS('kinetics', 'comparison', 'application', 'activity', 'assay')} THEN 1.2 ELSE 0 END"
    + "".join(
        f" + CASE WHEN {sql_hit('lower(text)', p)} AND NOT {_HAS(t)} THEN {n} ELSE 0 END"
        for p, t, n in ((banks.KINETICS_SIGNAL, "kinetics", 1.5), (banks.MATERIAL_SIGNAL, "system", 0.5), ("|".join(banks.ENZYME.values()), "activity", 0.8), ("|".join(banks.APPLICATION_TYPE.values()), "application", 0.8))
    )
    + f" + CASE WHEN {sql_hit('lower(text)', banks.NEGATIVE_ACTIVITY)} THEN 2.5 ELSE 0 END + coalesce(({_MAP(banks.SECTION_BONUS)})[coalesce(section, 'unknown')], 0.0), 2)"
)
_add(
    "flt18_sentence_priority",
    lambda s, d: _sentences(s, d).where("text IS NOT NULL")
    .select("sent_key", "section", "text", "contains_numeric", tx.sentence_score(F.col("text"), F.col("section")).alias("s"), tx.tags(F.col("text")).alias("t"))
    .select("sent_key", tx.sentence_priority(F.col("s"), F.col("t"), F.col("section"), F.col("text"), F.col("contains_numeric")).alias("priority")),
    f"SELECT sent_key, CAST({_PRIO} AS DOUBLE) AS priority FROM (SELECT sent_key, section, text, contains_numeric, {_SCORE} AS kw_score, list_filter(string_split({_TAGS}, '|'), lambda t: t <> '') AS tags FROM sentences WHERE text IS NOT NULL)",
)
_SUBS = "(tmb|abts|opd|h2o2|guaiacol|catechol|pyrogallol)"
_ANA = "(glucose|cysteine|lactate|dopamine|glutathione|uric acid|ascorbic acid|mercury ions)"
_add(
    "flt20_mentions",
    lambda s, d: _sentences(s, d).where("text IS NOT NULL").select(
        "sent_key", labels(F.lower("text"), banks.ENZYME).alias("enzymes"),
        F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_SUBS), 1))), "|").alias("substrates"), F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_ANA), 1))), "|").alias("analytes"),
    ),
    f"SELECT sent_key, {sql_labels('lower(text)', banks.ENZYME)} AS enzymes, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '{_SUBS}', 1))), '|') AS substrates, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '{_ANA}', 1))), '|') AS analytes FROM sentences WHERE text IS NOT NULL",
)
_RECALL = sql_labels("lower(text)", banks.HARD_RECALL)
_add(
    "flt21_gate_counts",
    lambda s, d: _sentences(s, d)
    .select("paper_id", tx.drop_reason(F.col("text")).alias("reason"), labels(F.lower("text"), banks.HARD_RECALL).alias("recall"))
    .select("paper_id", F.when(F.col("reason").isNull(), "kept").when(F.col("recall") != "", F.concat("reason", F.lit("_hard_recall_rescued"))).otherwise(F.col("reason")).alias("outcome"))
    .groupBy("paper_id", "outcome").agg(F.count("*").alias("n")),
    f"SELECT paper_id, CASE WHEN reason IS NULL THEN 'kept' WHEN recall <> '' THEN reason || '_hard_recall_rescued' ELSE reason END AS outcome, count(*) AS n FROM (SELECT paper_id, {_DROP} AS reason, {_RECALL} AS recall FROM sentences) GROUP BY 1, 2",
)
_NAME_OK = "[A-Z][a-z]?[0-9]|[A-Z][a-z]?[A-Z]|@|/|-doped|[a-z]+ blue"
_STOPS = ", ".join(quote(x) for x in banks.STOP_NAMES)
_add(
    "flt24_candidate_validity",
    lambda s, d: table(s, d, "records").where("selected_nanozyme.name IS NOT NULL").select(
        "record_id", (~F.lower(F.trim("selected_nanozyme.name")).isin(banks.STOP_NAMES) & (F.length("selected_nanozyme.name") > 2) & hit(F.col("selected_nanozyme.name"), _NAME_OK)).alias("valid"), hit(F.col("selected_nanozyme.name"), "^[A-Z][a-z]?$").alias("bare_element")
    ),
    f"SELECT record_id, lower(trim(selected_nanozyme.name, ' ')) NOT IN ({_STOPS}) AND length(selected_nanozyme.name) > 2 AND {sql_hit('selected_nanozyme.name', _NAME_OK)} AS valid, {sql_hit('selected_nanozyme.name', '^[A-Z][a-z]?$')} AS bare_element FROM records WHERE selected_nanozyme.name IS NOT NULL",
)
_add(
    "flt25_this_work_rows",
    lambda s, d: table(s, d, "kinetics").where("_evidence_Km LIKE '|%'").select("kin_id", hit(F.lower("_evidence_Km"), banks.THIS_WORK).alias("this_work"), hit(F.lower("_evidence_Km"), "ref\\. *[0-9]").alias("cited")),
    f"SELECT kin_id, {sql_hit('lower(_evidence_Km)', banks.THIS_WORK)} AS this_work, {sql_hit('lower(_evidence_Km)', 'ref\\. *[0-9]')} AS cited FROM kinetics WHERE _evidence_Km LIKE '|%'",
)
_CU, _RU = (", ".join(quote(x) for x in u) for u in (banks.CONCENTRATION_UNITS, banks.RATE_UNITS))
_add(
    "flt28_unit_class",
    lambda s, d: table(s, d, "kinetics").select(
        "kin_id", F.when(F.col("Km_unit").isin(banks.CONCENTRATION_UNITS), "concentration").when(F.col("Km_unit").isin(banks.RATE_UNITS), "rate").when(F.col("Km_unit").isNotNull(), "other").alias("km_class"),
        F.when(F.col("Vmax_unit").isin(banks.RATE_UNITS), "rate").when(F.col("Vmax_unit").isin(banks.CONCENTRATION_UNITS), "concentration").when(F.col("Vmax_unit").isNotNull(), "other").alias("vmax_class"),
    ),
    f"SELECT kin_id, CASE WHEN Km_unit IN ({_CU}) THEN 'concentration' WHEN Km_unit IN ({_RU}) THEN 'rate' WHEN Km_unit IS NOT NULL THEN 'other' END AS km_class, CASE WHEN Vmax_unit IN ({_RU}) THEN 'rate' WHEN Vmax_unit IN ({_CU}) THEN 'concentration' WHEN Vmax_unit IS NOT NULL THEN 'other' END AS vmax_class FROM kinetics",
)
_add(
    "flt16_assay_section_context",
    lambda s, d: _sentences(s, d).select("sent_key", first_label(F.lower("text"), banks.ASSAY_LABEL, None).alias("assay"), first_label(F.substring(F.lower("text"), 1, 500), banks.SECTION_GUESS, "unknown").alias("guess"), hit(F.lower("text"), banks.KINETICS_SIGNAL).alias("kinetics_context")),
    f"SELECT sent_key, {sql_first_label('lower(text)', banks.ASSAY_LABEL, None)} AS assay, {sql_first_label('substr(lower(text), 1, 500)', banks.SECTION_GUESS, 'unknown')} AS guess, {sql_hit('lower(text)', banks.KINETICS_SIGNAL)} AS kinetics_context FROM sentences",
)
_add(
    "flt32_sentence_lines",
    lambda s, d: _sentences(s, d).where("text IS NOT NULL").select("sent_key", F.concat(F.lit("["), F.col("sentence_id"), F.lit("|p"), F.coalesce(F.col("page").cast("string"), F.lit("?")), F.lit("|"), F.coalesce("section", F.lit("unknown")), F.lit("] "), F.col("text")).alias("line")),
    "SELECT sent_key, '[' || sentence_id || '|p' || coalesce(CAST(page AS VARCHAR), '?') || '|' || coalesce(section, 'unknown') || '] ' || text AS line FROM sentences WHERE text IS NOT NULL",
)
_add(
    "flt29_analyte_or_substrate",
    lambda s, d: table(s, d, "records").selectExpr("record_id", "posexplode(applications) AS (ord, a)").select("record_id", "ord", hit(F.lower("a.target_analyte"), _ANA).alias("is_analyte"), hit(F.lower("a.target_analyte"), _SUBS).alias("is_substrate")),
    f"SELECT record_id, CAST(ord - 1 AS INTEGER) AS ord, {sql_hit('lower(a.target_analyte)', _ANA)} AS is_analyte, {sql_hit('lower(a.target_analyte)', _SUBS)} AS is_substrate FROM (SELECT record_id, unnest(applications) AS a, generate_subscripts(applications, 1) AS ord FROM records)",
)
