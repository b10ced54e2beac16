"""Queries of dictionary lookups and value extraction, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import banks
from ..functions.dual import extract, extract_all, first_label, hit, quote, sql_extract, sql_first_label, sql_hit, sql_replace_all
from ..operators import extraction as ex, lookups as lk
from ..runtime import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE[name] = sql


_ALIASES = "CASE lower(trim(v, ' ')) " + " ".join(f"WHEN {quote(a)} THEN {quote(b)}" for a, b in banks.ENZYME_ALIAS.items()) + " END"
_BARE = sql_replace_all("lower(trim(v, ' '))", [(" *\\([a-z]+\\) *", " "), (" +", "-")])
_KNOWN = ", ".join(quote(k) for k in banks.ENZYME)
_add(
    "map01_enzyme_canonical",
    lambda s, d: lk.canonical_enzyme(table(s, d, "records").select("record_id", F.col("main_activity.enzyme_like_type").alias("v")), "v").select("record_id", "canonical"),
    f"SELECT record_id, coalesce({_ALIASES}, CASE WHEN {_BARE} IN ({_KNOWN}) THEN {_BARE} END, {sql_first_label("lower(trim(v, ' '))", banks.ENZYME, None)}) AS canonical FROM (SELECT record_id, main_activity.enzyme_like_type AS v FROM records)",
)
_add(
    "map03_compound_enzymes",
    lambda s, d: table(s, d, "sentences").select("sent_key", F.array_join(F.transform(F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)-like"), 1))), lambda x: F.concat(x, F.lit("-like"))), " + ").alias("enzymes")),
    "SELECT sent_key, array_to_string(list_transform(list_sort(list_distinct(regexp_extract_all(lower(text), '([a-z]+)-like', 1))), lambda x: x || '-like'), ' + ') AS enzymes FROM sentences",
)
_add(
    "map06_application_type",
    lambda s, d: table(s, d, "papers").select("paper_id", lk.application_type(F.col("title")).alias("application"), first_label(F.lower("title"), banks.SAMPLE_TYPE, None).alias("sample")),
    f"SELECT paper_id, {sql_first_label('lower(title)', banks.APPLICATION_TYPE, 'other')} AS application, {sql_first_label('lower(title)', banks.SAMPLE_TYPE, None)} AS sample FROM papers",
)
_add(
    "map08_method_and_sample",
    lambda s, d: table(s, d, "sentences").select("sent_key", first_label(F.lower("text"), banks.METHOD, None).alias("method"), first_label(F.lower("text"), banks.SAMPLE_TYPE, None).alias("sample")),
    f"SELECT sent_key, {sql_first_label('lower(text)', banks.METHOD, None)} AS method, {sql_first_label('lower(text)', banks.SAMPLE_TYPE, None)} AS sample FROM sentences",
)
_add(
    "map09_assay_method",
    lambda s, d: table(s, d, "records").select("record_id", first_label(F.lower("main_activity.assay_method"), banks.METHOD, "other").alias("assay")),
    f"SELECT record_id, {sql_first_label('lower(main_activity.assay_method)', banks.METHOD, 'other')} AS assay FROM records",
)
_UNIT = lambda c: f"trim({sql_replace_all(c, banks.UNIT_STEPS)}, ' ')"
_add(
    "map10_unit_normaliser",
    lambda s, d: table(s, d, "kinetics").select("kin_id", lk.normal_unit(F.col("Km_unit")).alias("km_unit"), lk.normal_unit(F.col("Vmax_unit")).alias("vmax_unit")),
    f"SELECT kin_id, {_UNIT('Km_unit')} AS km_unit, {_UNIT('Vmax_unit')} AS vmax_unit FROM kinetics",
)
_FWD = "CASE u " + " ".join(f"WHEN {quote(a)} THEN {f!r}::DOUBLE" for a, b, f in banks.UNIT_FACTORS if b == "mM") + " END"
_REV = "CASE u " + " ".join(f"WHEN {quote(b)} THEN {f!r}::DOUBLE" for a, b, f in banks.UNIT_FACTORS if a == "mM") + " END"
_add(
    "map12_unit_conversion",
    lambda s, d: lk.convert(table(s, d, "kinetics").select("kin_id", F.col("Km").alias("v"), lk.normal_unit(F.col("Km_unit")).alias("u")), "v", "u", "mM").select("kin_id", F.round("converted", 9).alias("km_mm")),
    f"SELECT kin_id, round(coalesce(CASE WHEN u = 'mM' THEN v END, v * ({_FWD}), v / ({_REV})), 9) AS km_mm FROM (SELECT kin_id, Km AS v, {_UNIT('Km_unit')} AS u FROM kinetics)",
)
_add(
    "map13_unit_change_log",
    lambda s, d: table(s, d, "kinetics").select("kin_id", F.explode(F.expr("array(named_struct('field', 'Km_unit', 'was', Km_unit), named_struct('field', 'Vmax_unit', 'was', Vmax_unit))")).alias("c"))
    .select("kin_id", "c.field", "c.was", lk.normal_unit(F.col("c.was")).alias("now")).where("was <> now"),
    f"SELECT kin_id, field, was, {_UNIT('was')} AS now FROM (SELECT kin_id, 'Km_unit' AS field, Km_unit AS was FROM kinetics UNION ALL SELECT kin_id, 'Vmax_unit', Vmax_unit FROM kinetics) WHERE was <> {_UNIT('was')}",
)


def _sql_table_class(c: str) -> str:
    scores = [f"len(regexp_extract_all({c}, {quote(p)}, 0))" for p in banks.TABLE_TYPE.values()]
    top = f"greatest({', '.join(scores)})"
    return f"CASE WHEN {top} <= 0 OR {top} IS NULL THEN 'general' " + " ".join(f"WHEN {s} = {top} THEN '{n}'" for n, s in zip(banks.TABLE_TYPE, scores)) + " END"


_add(
    "map14_table_class",
    lambda s, d: table(s, d, "blocks").where("text IS NOT NULL").select("block_key", lk.table_class(F.col("text")).alias("class")),
    f"SELECT block_key, {_sql_table_class('lower(text)')} AS class FROM blocks WHERE text IS NOT NULL",
)
_KIND = "^ *(fig|figure|abb|scheme|table)[.a-z]* *(s?[0-9]+)"
_add(
    "map17_caption_label",
    lambda s, d: table(s, d, "figures").select("fig_key", F.when(extract(F.lower("caption_text"), _KIND).isin("fig", "figure", "abb"), "figure").otherwise(extract(F.lower("caption_text"), _KIND)).alias("kind"), F.upper(extract(F.lower("caption_text"), _KIND, 2)).alias("number")),
    f"SELECT fig_key, CASE WHEN {sql_extract('lower(caption_text)', _KIND)} IN ('fig', 'figure', 'abb') THEN 'figure' ELSE {sql_extract('lower(caption_text)', _KIND)} END AS kind, upper({sql_extract('lower(caption_text)', _KIND, 2)}) AS number FROM figures",
)
_add(
    "map18_source_class",
    lambda s, d: table(s, d, "kinetics").groupBy(lk.source_class(F.col("source")).alias("class")).agg(F.count("*").alias("n"), F.count("Km").alias("n_km")),
    "SELECT CASE WHEN source = 'text' THEN 'text' WHEN source = 'table' THEN 'table' WHEN source = 'figure_caption' THEN 'caption' WHEN starts_with(source, 'figure') THEN 'figure' ELSE 'unknown' END AS class, count(*) AS n, count(Km) AS n_km FROM kinetics GROUP BY 1",
)
_LOWN = "lower(trim(selected_nanozyme.name, ' '))"
_add(
    "map21_name_variants",
    lambda s, d: table(s, d, "records").where("selected_nanozyme.name IS NOT NULL").select("record_id", F.array_join(F.array_sort(lk.name_variants(F.col("selected_nanozyme.name"))), "|").alias("variants"), lk.compatible(F.col("selected_nanozyme.name"), F.col("paper.title")).alias("in_title")),
    f"SELECT record_id, array_to_string(list_sort(list_distinct(list_filter(list_concat(list_concat([{_LOWN}], string_split_regex({_LOWN}, '[@/]')), [regexp_replace({_LOWN}, '[ -]', '', 'g')]), lambda x: length(x) > 1))), '|') AS variants, "
    "coalesce(length(x) > 0 AND length(y) > 0 AND (contains(x, y) OR contains(y, x)), false) AS in_title FROM (SELECT *, regexp_replace(lower(trim(selected_nanozyme.name, ' ')), '^(hollow|[a-z]+-doped) +', '', 'g') AS x, regexp_replace(lower(trim(paper.title, ' ')), '^(hollow|[a-z]+-doped) +', '', 'g') AS y FROM records) WHERE selected_nanozyme.name IS NOT NULL",
)

# ---------------------------------------------------------------- extraction cascades
_KMV, _KMM = ex.sql_cascade("_evidence_Km", ex.KM_PATTERNS)
_VMV, _VMM = ex.sql_cascade("_evidence_Vmax", ex.VMAX_PATTERNS)


def _kinetics_values(s, d):
    km, km_m = ex.cascade(F.col("_evidence_Km"), ex.KM_PATTERNS)
    vm, vm_m = ex.cascade(F.col("_evidence_Vmax"), ex.VMAX_PATTERNS)
    return table(s, d, "kinetics").select("kin_id", km.alias("km"), km_m.alias("km_method"), vm.alias("vmax"), vm_m.alias("vmax_method"))


_add("ext01_kinetics_cascade", _kinetics_values, f"SELECT kin_id, {_KMV} AS km, {_KMM} AS km_method, {_VMV} AS vmax, {_VMM} AS vmax_method FROM kinetics")
_add(
    "ext04_measurement_method",
    lambda s, d: table(s, d, "kinetics").select("kin_id", ex.in_context(F.concat_ws(" ", "_evidence_Km", "_evidence_Vmax")).alias("double_reciprocal"), hit(F.lower(F.concat_ws(" ", "_evidence_Km", "_evidence_Vmax")), "initial rate|steady-state").alias("initial_rate")),
    f"SELECT kin_id, {sql_hit("lower(concat_ws(' ', _evidence_Km, _evidence_Vmax))", 'lineweaver|double-reciprocal')} AS double_reciprocal, {sql_hit("lower(concat_ws(' ', _evidence_Km, _evidence_Vmax))", 'initial rate|steady-state')} AS initial_rate FROM kinetics",
)
_CELLS = "list_transform(list_filter(string_split(trim(_evidence_Km, ' '), '|'), lambda x: length(trim(x, ' ')) > 0), lambda x: trim(x, ' '))"
_add(
    "ext05_table_row_parse",
    lambda s, d: table(s, d, "kinetics").where("_evidence_Km LIKE '|%'").select("kin_id", ex.row_cells(F.col("_evidence_Km")).alias("c")).select("kin_id", F.get("c", F.lit(0)).alias("material"), F.get("c", F.lit(1)).alias("substrate_cell"), extract(F.get("c", F.lit(2)), f"Km {ex.NUM}").try_cast("double").alias("km"), F.size("c").alias("n_cells")),
    f"SELECT kin_id, c[1] AS material, c[2] AS substrate_cell, try_cast({sql_extract('c[3]', f'Km {ex.NUM}')} AS DOUBLE) AS km, CAST(len(c) AS INTEGER) AS n_cells FROM (SELECT kin_id, {_CELLS} AS c FROM kinetics WHERE _evidence_Km LIKE '|%')",
)
_add(
    "ext07_first_value_per_parameter",
    lambda s, d: table(s, d, "kinetics").groupBy("paper_id").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("entry_no", "kin_id"))).alias(f"first_{c.lower()}") for c in ("Km", "Vmax", "kcat", "kcat_Km")]),
    "SELECT paper_id, " + ", ".join(f"arg_min({c}, CAST(entry_no AS BIGINT) * 1000000000 + kin_id) FILTER ({c} IS NOT NULL) AS first_{c.lower()}" for c in ("Km", "Vmax", "kcat", "kcat_Km")) + " FROM kinetics GROUP BY paper_id",
)
_add(
    "ext08_derived_kcat",
    lambda s, d: table(s, d, "kinetics").select("kin_id", F.round(F.coalesce("kcat", F.when((F.col("Km_unit") == "mM") & F.col("kcat_Km_unit").isin("M^-1 s^-1", "M-1 s-1") & (F.col("Km") > 0) & (F.col("kcat_Km") > 0), F.col("kcat_Km") * F.col("Km") / 1000)), 6).alias("kcat_or_derived")),
    "SELECT kin_id, round(coalesce(kcat, CASE WHEN Km_unit = 'mM' AND kcat_Km_unit IN ('M^-1 s^-1', 'M-1 s-1') AND Km > 0 AND kcat_Km > 0 THEN kcat_Km * Km / 1000 END), 6) AS kcat_or_derived FROM kinetics",
)
_PHS = "pH (?:of |values above )?([0-9]+(?:[.][0-9]+)?)"
_add(
    "ext11_ph_and_temperature",
    lambda s, d: table(s, d, "sentences").select("sent_key", F.when(extract(F.col("text"), _PHS).try_cast("double").between(0, 14), extract(F.col("text"), _PHS).try_cast("double")).alias("ph"), extract(F.col("text"), ex.TEMPERATURE).try_cast("double").alias("temperature")),
    f"SELECT sent_key, CASE WHEN try_cast({sql_extract('text', _PHS)} AS DOUBLE) BETWEEN 0 AND 14 THEN try_cast({sql_extract('text', _PHS)} AS DOUBLE) END AS ph, try_cast({sql_extract('text', ex.TEMPERATURE)} AS DOUBLE) AS temperature FROM sentences",
)
_SYN = [(name, p) for name, p in banks.SYNTHESIS.items()]


def _votes(s, d):
    arms = [F.when(hit(F.lower("text"), p), F.struct(F.lit(n).alias("method"), F.lit(i).alias("ord"))) for i, (n, p) in enumerate(_SYN)]
    votes = table(s, d, "sentences").select("paper_id", F.explode(F.array_compact(F.array(*arms))).alias("v")).groupBy("paper_id", "v.method", "v.ord").agg(F.count("*").alias("n"))
    return votes.groupBy("paper_id").agg(F.max_by("method", F.struct("n", -F.col("ord"))).alias("method"), F.max("n").alias("votes"))


_add(
    "ext14_synthesis_votes",
    _votes,
    "SELECT paper_id, arg_max(method, n * 100 - ord) AS method, max(n) AS votes FROM (SELECT paper_id, method, ord, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT paper_id, '{n}' AS method, {i} AS ord FROM sentences WHERE {sql_hit('lower(text)', p)}" for i, (n, p) in enumerate(_SYN)) + ") GROUP BY 1, 2, 3) GROUP BY paper_id",
)
_add(
    "ext15_size_and_spacing",
    lambda s, d: table(s, d, "sentences").select("sent_key", extract(F.col("text"), ex.SIZE).try_cast("double").alias("size_nm"), extract(F.col("text"), ex.SPACING).try_cast("double").alias("spacing")),
    f"SELECT sent_key, try_cast({sql_extract('text', ex.SIZE)} AS DOUBLE) AS size_nm, try_cast({sql_extract('text', ex.SPACING)} AS DOUBLE) AS spacing FROM sentences",
)


def _morphology(s, d):
    arms = [F.when(F.lower("text").contains(m), F.struct(F.lit(m).alias("term"), F.when(F.col("source_kind") == "caption", 2).otherwise(1).alias("w"))) for m in banks.MORPHOLOGY]
    from pyspark.sql import Window as W

    v = table(s, d, "sentences").select("paper_id", F.explode(F.array_compact(F.array(*arms))).alias("v")).groupBy("paper_id", "v.term").agg(F.sum("v.w").alias("votes"))
    top = v.withColumn("top", F.max("votes").over(W.partitionBy("paper_id"))).where("votes >= 0.5 * top")
    return top.withColumn("rank", F.row_number().over(W.partitionBy("paper_id").orderBy(F.desc("votes"), "term"))).where("rank <= 3").select("paper_id", "term", "votes", "rank")


_add(
    "ext17_morphology_votes",
    _morphology,
    "SELECT paper_id, term, votes, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY votes DESC, term) AS rank FROM (SELECT *, max(votes) OVER (PARTITION BY paper_id) AS top FROM (SELECT paper_id, term, CAST(sum(w) AS BIGINT) AS votes FROM ("
    + " UNION ALL ".join(f"SELECT paper_id, '{m}' AS term, CASE WHEN source_kind = 'caption' THEN 2 ELSE 1 END AS w FROM sentences WHERE contains(lower(text), '{m}')" for m in banks.MORPHOLOGY)
    + ") GROUP BY 1, 2)) WHERE votes >= 0.5 * top) WHERE rank <= 3",
)
_add(
    "ext19_sensing_values",
    lambda s, d: table(s, d, "sentences").select(
        "sent_key", extract(F.col("text"), ex.LOD).try_cast("double").alias("lod"), extract(F.col("text"), ex.LOD, 2).alias("lod_unit"), extract(F.col("text"), ex.RANGE).try_cast("double").alias("range_low"), extract(F.col("text"), ex.RANGE, 2).try_cast("double").alias("range_high")
    ),
    f"SELECT sent_key, try_cast({sql_extract('text', ex.LOD)} AS DOUBLE) AS lod, {sql_extract('text', ex.LOD, 2)} AS lod_unit, try_cast({sql_extract('text', ex.RANGE)} AS DOUBLE) AS range_low, try_cast({sql_extract('text', ex.RANGE, 2)} AS DOUBLE) AS range_high FROM sentences",
)
_MECH = {"radical": "radical", "vacancy": "vacanc", "ping-pong": "ping-pong", "electron transfer": "electron transfer", "inhibition": "inhibition"}
_SIGN = {"absorbance": "absorbance", "fluorescence": "fluorescence", "colour": "colou?r"}
_BUF = "(acetate|phosphate|tris|citrate|hepes) buffer"
_add(
    "ext20_assay_signal_buffer_mechanism",
    lambda s, d: table(s, d, "sentences").select("sent_key", first_label(F.lower("text"), _SIGN, None).alias("signal"), extract(F.lower("text"), _BUF).alias("buffer"), first_label(F.lower("text"), _MECH, None).alias("mechanism")),
    f"SELECT sent_key, {sql_first_label('lower(text)', _SIGN, None)} AS signal, {sql_extract('lower(text)', _BUF)} AS buffer, {sql_first_label('lower(text)', _MECH, None)} AS mechanism FROM sentences",
)
_add(
    "ext25_numbers_in_text",
    lambda s, d: table(s, d, "sentences").where("text IS NOT NULL").select("sent_key", F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit("([0-9]+([.][0-9]+)?)"), 1))), " ").alias("numbers")),
    "SELECT sent_key, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '([0-9]+([.][0-9]+)?)', 1))), ' ') AS numbers FROM sentences WHERE text IS NOT NULL",
)
_NAME = "((?:N-doped |hollow )?(?:Au@|Pt/)?(?:[A-Z][A-Za-z]*[0-9][A-Za-z0-9]*|CuO|CuS|Prussian blue|IrOx|Fe-N-C|Cu-N-C)(?:@SiO2|@C|/rGO|-PEG)?)"
_add(
    "ext27_material_recall",
    lambda s, d: table(s, d, "papers").select("paper_id", F.lit("title").alias("source"), F.explode(extract_all(F.col("title"), _NAME)).alias("name"))
    .unionByName(table(s, d, "figures").select("paper_id", F.lit("caption").alias("source"), F.explode(extract_all(F.col("caption_text"), _NAME)).alias("name")))
    .unionByName(table(s, d, "sentences").select("paper_id", F.lit("text").alias("source"), F.explode(extract_all(F.col("text"), _NAME)).alias("name")))
    .groupBy("paper_id", "name").agg(F.array_join(F.array_sort(F.collect_set("source")), "|").alias("sources"), F.count("*").alias("n_evidence")),
    "SELECT paper_id, name, array_to_string(list_sort(list(DISTINCT source)), '|') AS sources, count(*) AS n_evidence FROM ("
    + " UNION ALL ".join(f"SELECT paper_id, '{n}' AS source, unnest(list_distinct(regexp_extract_all({c}, {quote(_NAME)}, 1))) AS name FROM {t}" for n, c, t in (("title", "title", "papers"), ("caption", "caption_text", "figures"), ("text", "text", "sentences")))
    + ") GROUP BY 1, 2",
)
_add(
    "ext28_paper_metadata",
    lambda s, d: table(s, d, "papers").select("paper_id", extract(F.col("year"), "((?:19|20)[0-9][0-9])").try_cast("int").alias("year_number"), F.coalesce(F.nullif(F.trim("journal"), F.lit("")), F.lit("unknown")).alias("journal_name"), (F.length("title") > 20).alias("long_title")),
    f"SELECT paper_id, try_cast({sql_extract('year', '((?:19|20)[0-9][0-9])')} AS INTEGER) AS year_number, coalesce(nullif(trim(journal, ' '), ''), 'unknown') AS journal_name, length(title) > 20 AS long_title FROM papers",
)
_add(
    "ext30_supporting_text",
    lambda s, d: table(s, d, "sentences").where("text IS NOT NULL").select("paper_id", "sent_key", F.explode(F.array_compact(F.array(*[F.when(hit(F.lower("text"), p), F.lit(n)) for n, p in (("kinetics", banks.KINETICS_SIGNAL), ("application", banks.APPLICATION_SIGNAL), ("activity", banks.ACTIVITY_SIGNAL))]))).alias("category")).groupBy("paper_id", "category").agg(F.count("*").alias("n"), F.min("sent_key").alias("first_key")),
    "SELECT paper_id, category, count(*) AS n, min(sent_key) AS first_key FROM (" + " UNION ALL ".join(f"SELECT paper_id, sent_key, '{n}' AS category FROM sentences WHERE {sql_hit('lower(text)', p)}" for n, p in (("kinetics", banks.KINETICS_SIGNAL), ("application", banks.APPLICATION_SIGNAL), ("activity", banks.ACTIVITY_SIGNAL))) + ") GROUP BY 1, 2",
)
