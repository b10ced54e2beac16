"""Queries of joins, aggregates, ranking, sets, ordered operators and validation, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import banks
from ..functions.dual import extract, hit, quote, sql_extract, sql_hit, sql_labels
from ..operators import ordered as od, relations as rel, text as tx
from ..runtime import table
from .texts import _DROP

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE[name] = sql


_PRIO = "CASE source " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in banks.SOURCE_PRIORITY.items()) + " ELSE 0 END"

# ---------------------------------------------------------------- joins
_add(
    "jon01_records_to_gold",
    lambda s, d: table(s, d, "papers").select("paper_id", "title").join(table(s, d, "records").groupBy("paper_id").agg(F.min("record_id").alias("record_id"), F.count("*").alias("n_records")), "paper_id", "left").select("paper_id", "record_id", F.coalesce("n_records", F.lit(0)).alias("n_records"), F.col("record_id").isNull().alias("missing")),
    "SELECT paper_id, record_id, coalesce(n, 0) AS n_records, record_id IS NULL AS missing FROM papers LEFT JOIN (SELECT paper_id, min(record_id) AS record_id, count(*) AS n FROM records GROUP BY 1) USING (paper_id)",
)
_add("jon01_unmatched_papers", lambda s, d: table(s, d, "papers").join(table(s, d, "records"), "paper_id", "left_anti").select("paper_id", "doi"), "SELECT paper_id, doi FROM papers p WHERE NOT EXISTS (SELECT 1 FROM records r WHERE r.paper_id = p.paper_id)")


def _best_match(s, d):
    """Each application finds its best partner among the applications of the paper's other records."""
    a = table(s, d, "records").selectExpr("record_id", "paper_id", "posexplode_outer(applications) AS (ord, a)").where("a IS NOT NULL").select("record_id", "paper_id", "ord", F.col("a.target_analyte").alias("analyte"), F.col("a.application_type").alias("kind"))
    # score 5 for analyte and type, 3 for the analyte, 2 for the type: one key each
    arms = ", ".join(f"named_struct('score', {n}, 'an', {an}, 'ki', {ki})" for n, an, ki in ((5, "analyte", "kind"), (3, "analyte", "CAST(NULL AS string)"), (2, "CAST(NULL AS string)", "kind")))
    keyed = a.selectExpr("record_id", "paper_id", "ord", f"inline(array({arms}))").where("(an IS NOT NULL OR score = 2) AND (ki IS NOT NULL OR score = 3)")
    # the two lowest records of a key hold the lowest one other than any record
    order = W.partitionBy("paper_id", "score", "an", "ki").orderBy("record_id")
    low = keyed.select("paper_id", "score", "an", "ki", "record_id").distinct().withColumn("n", F.row_number().over(order)).where("n <= 2").select(F.col("paper_id").alias("p"), F.col("score").alias("sc"), F.col("an").alias("a2"), F.col("ki").alias("k2"), F.col("record_id").alias("other"))
    j = keyed.join(low, (F.col("paper_id") == F.col("p")) & (F.col("score") == F.col("sc")) & F.col("an").eqNullSafe(F.col("a2")) & F.col("ki").eqNullSafe(F.col("k2")) & (F.col("record_id") != F.col("other")))
    return j.groupBy("record_id", "ord").agg(F.max("score").alias("score"), F.min_by("other", F.struct(-F.col("score"), F.col("other"))).alias("partner"))


_add(
    "jon02_best_application_match",
    _best_match,
    "WITH a AS (SELECT record_id, paper_id, CAST(ord - 1 AS INTEGER) AS ord, a.target_analyte AS analyte, a.application_type AS kind FROM (SELECT record_id, paper_id, unnest(applications) AS a, generate_subscripts(applications, 1) AS ord FROM records) WHERE a IS NOT NULL), "
    "j AS (SELECT x.record_id, x.ord, y.record_id AS other, coalesce(CAST(x.analyte = y.analyte AS INTEGER), 0) * 3 + coalesce(CAST(x.kind = y.kind AS INTEGER), 0) * 2 AS score FROM a x JOIN a y ON x.paper_id = y.paper_id AND x.record_id <> y.record_id) "
    "SELECT record_id, ord, max(score) AS score, arg_min(other, (-score, other)) AS partner FROM j WHERE score >= 2 GROUP BY 1, 2",
)
_FIG = "figs?[.] *(s?[0-9]+)"


def _figure_context(s, d):
    """Sentences within one page that name the figure; the first by key. The page join expands the figure side by three rows."""
    fig = table(s, d, "figures").where("caption_text IS NOT NULL AND page IS NOT NULL").select("fig_key", "paper_id", F.explode(F.array(F.col("page") - 1, F.col("page"), F.col("page") + 1)).alias("page"), extract(F.lower("caption_text"), "^ *(?:fig|figure)[.a-z]* *(s?[0-9]+)").alias("label")).where("label IS NOT NULL")
    sen = table(s, d, "sentences").select("paper_id", "page", "sent_key", extract(F.lower("text"), _FIG).alias("label")).where("label IS NOT NULL")
    return fig.join(sen, ["paper_id", "page", "label"]).groupBy("fig_key").agg(F.count("*").alias("n_sentences"), F.min("sent_key").alias("first_sentence"))


_add(
    "jon07_figure_band_join",
    _figure_context,
    f"SELECT fig_key, count(*) AS n_sentences, min(sent_key) AS first_sentence FROM (SELECT fig_key, paper_id, page, {sql_extract('lower(caption_text)', '^ *(?:fig|figure)[.a-z]* *(s?[0-9]+)')} AS label FROM figures) f JOIN (SELECT paper_id, page, sent_key, {sql_extract('lower(text)', _FIG)} AS label FROM sentences) t ON f.paper_id = t.paper_id AND f.label = t.label AND abs(f.page - t.page) <= 1 GROUP BY 1",
)
_add(
    "jon05_nearest_block",
    lambda s, d: table(s, d, "figures").where("bbox IS NOT NULL").select("fig_key", "paper_id", "page", F.get("bbox", F.lit(1)).alias("fy"))
    .join(table(s, d, "blocks").where("bbox IS NOT NULL AND kind = 'caption'").select("paper_id", "page", "block_key", F.get("bbox", F.lit(1)).alias("by")), ["paper_id", "page"])
    .groupBy("fig_key").agg(F.min_by("block_key", F.struct(F.abs(F.col("fy") - F.col("by")), F.col("block_key"))).alias("nearest"), F.round(F.min(F.abs(F.col("fy") - F.col("by"))), 4).alias("distance")),
    "SELECT fig_key, arg_min(block_key, (d, block_key)) AS nearest, round(min(d), 4) AS distance FROM (SELECT f.fig_key, b.block_key, abs(f.bbox[2] - b.bbox[2]) AS d FROM figures f JOIN blocks b ON f.paper_id = b.paper_id AND f.page = b.page WHERE f.bbox IS NOT NULL AND b.bbox IS NOT NULL AND b.kind = 'caption') GROUP BY 1",
)
_LABELLED = r"(?:^|[^a-z])(?:(?:figs|figures)[.]? *s?[0-9]+(?: *(?:,|and|&) *s?[0-9]+)*|(?:fig|abb)[.a-z]* *s?[0-9]+)"
_CAPTION = r"(?:^|\n) *(?:fig|abb)[.a-z]* *(s?[0-9]+)"


def _body_context(s, d):
    """Up to three body sentences of each figure: those that name its label, else those of its page.

    In order two with a kinetics signal, one with an activity signal and the first two, equal texts once. They are
    chosen once for each label and page, so figures join only the chosen ones.
    """
    t = F.lower("text")
    labels = F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(t, F.lit(_LABELLED), 0), lambda x: F.regexp_extract_all(x, F.lit("s?[0-9]+"), 0))))
    roles = F.array_compact(F.array(F.when(hit(t, banks.KINETICS_SIGNAL), 0), F.when(hit(t, banks.ACTIVITY_SIGNAL), 1), F.lit(2)))
    sen = table(s, d, "sentences").where("text IS NOT NULL AND NOT source_kind <=> 'caption'").select("paper_id", "sent_key", "text", roles.alias("roles"), F.array_compact(F.array_append(F.transform(labels, lambda x: F.concat(F.lit("label "), x)), F.concat(F.lit("page "), F.col("page").cast("string")))).alias("keys"))
    keyed = sen.select("paper_id", "sent_key", "text", "roles", F.explode("keys").alias("key")).select("paper_id", "key", "sent_key", "text", F.explode("roles").alias("role"))
    first = keyed.withColumn("n", F.row_number().over(W.partitionBy("paper_id", "key", "role").orderBy("sent_key"))).where("n <= 2 AND NOT (role = 1 AND n = 2)")
    chosen = first.groupBy("paper_id", "key").agg(F.array_sort(F.collect_list(F.struct("role", "n", "sent_key", "text"))).alias("c")).select("paper_id", "key", F.expr("slice(filter(c, (x, i) -> NOT exists(slice(c, 1, i), y -> y.text = x.text)), 1, 3).sent_key").alias("c"))
    fig = table(s, d, "figures").select("fig_key", "paper_id", F.posexplode(F.array(F.concat(F.lit("label "), extract(F.lower("caption_text"), _CAPTION)), F.concat(F.lit("page "), F.col("page").cast("string")))).alias("fallback", "key")).where("key IS NOT NULL")
    return fig.join(chosen, ["paper_id", "key"]).groupBy("fig_key", "paper_id").agg(F.min_by("c", "fallback").alias("c")).select("fig_key", "paper_id", F.posexplode("c").alias("rank", "sent_key")).withColumn("rank", F.col("rank") + 1)


# figure by figure: sentences that name it, else those of its page; two of kinetics, one of activity, the first two; equal texts once; three
_BODY_SQL = f"""
WITH fig AS (SELECT fig_key, paper_id, page, {sql_extract("lower(coalesce(caption_text, ''))", _CAPTION)} AS label FROM figures),
sen AS (
  SELECT paper_id, sent_key, page, text, {sql_hit("lower(text)", banks.KINETICS_SIGNAL)} AS kin, {sql_hit("lower(text)", banks.ACTIVITY_SIGNAL)} AS act,
    list_distinct(flatten(list_transform(regexp_extract_all(lower(text), {quote(_LABELLED)}), lambda x: regexp_extract_all(x, 's?[0-9]+')))) AS labels
  FROM sentences WHERE text IS NOT NULL AND source_kind IS DISTINCT FROM 'caption'),
named AS (SELECT fig_key, f.paper_id, sent_key, text, kin, act FROM fig f JOIN (SELECT *, unnest(labels) AS label FROM sen) s ON f.paper_id = s.paper_id AND f.label = s.label),
paged AS (SELECT fig_key, f.paper_id, sent_key, text, kin, act FROM fig f JOIN sen s ON f.paper_id = s.paper_id AND f.page = s.page WHERE NOT EXISTS (SELECT 1 FROM named n WHERE n.fig_key = f.fig_key)),
related AS (
  SELECT *, row_number() OVER (PARTITION BY fig_key ORDER BY sent_key) AS n_any, row_number() OVER (PARTITION BY fig_key, kin ORDER BY sent_key) AS n_kin, row_number() OVER (PARTITION BY fig_key, act ORDER BY sent_key) AS n_act
  FROM (SELECT * FROM named UNION ALL SELECT * FROM paged)),
picked AS (
  SELECT fig_key, paper_id, sent_key, text, n_kin AS ord FROM related WHERE kin AND n_kin <= 2 UNION ALL
  SELECT fig_key, paper_id, sent_key, text, 2 + n_act FROM related WHERE act AND n_act = 1 UNION ALL
  SELECT fig_key, paper_id, sent_key, text, 3 + n_any FROM related WHERE n_any <= 2),
once AS (SELECT fig_key, paper_id, text, arg_min(sent_key, ord) AS sent_key, min(ord) AS ord FROM picked GROUP BY 1, 2, 3)
SELECT fig_key, paper_id, CAST(rank AS INTEGER) AS rank, sent_key FROM (SELECT *, row_number() OVER (PARTITION BY fig_key ORDER BY ord) AS rank FROM once) WHERE rank <= 3
"""
_add(
    "jon08_body_context_top3",
    _body_context,
    _BODY_SQL,
)
_add(
    "jon09_name_in_title",
    lambda s, d: table(s, d, "records").select("record_id", "paper_id", F.lower("selected_nanozyme.name").alias("n")).join(table(s, d, "papers").select("paper_id", F.lower("title").alias("t")), "paper_id").where("length(n) > 2 AND contains(t, n)").select("record_id", "paper_id"),
    "SELECT record_id, r.paper_id FROM records r JOIN papers p USING (paper_id) WHERE length(selected_nanozyme.name) > 2 AND contains(lower(title), lower(selected_nanozyme.name))",
)
_add("jon10_uncaptioned_figures", lambda s, d: (lambda f: f.where("caption_text IS NULL").join(f.where("caption_text IS NOT NULL").select("paper_id", "page").distinct(), ["paper_id", "page"], "left_anti").select("fig_key"))(table(s, d, "figures")), "SELECT fig_key FROM figures f WHERE caption_text IS NULL AND NOT EXISTS (SELECT 1 FROM figures g WHERE g.caption_text IS NOT NULL AND g.paper_id = f.paper_id AND g.page = f.page)")
_add(
    "jon12_alias_cooccurrence",
    lambda s, d: table(s, d, "sentences").where("text IS NOT NULL").join(table(s, d, "records").where("selected_nanozyme.name IS NOT NULL").groupBy("paper_id").agg(F.min(F.lower("selected_nanozyme.name")).alias("n")), "paper_id").groupBy("paper_id", "n").agg(F.count_if(F.lower("text").contains(F.col("n"))).alias("n_with"), F.count("*").alias("n_all")).where("n_with > 0"),
    "SELECT paper_id, n, count_if(contains(lower(text), n)) AS n_with, count(*) AS n_all FROM sentences JOIN (SELECT paper_id, min(lower(selected_nanozyme.name)) AS n FROM records WHERE selected_nanozyme.name IS NOT NULL GROUP BY 1) USING (paper_id) WHERE text IS NOT NULL GROUP BY 1, 2 HAVING n_with > 0",
)
_FIELDS = ("Km", "Vmax", "kcat", "kcat_Km")
_PAIRS = ", ".join(f"named_struct('a', '{a}', 'b', '{b}', 'x', _evidence_{a}, 'y', _evidence_{b})" for i, a in enumerate(_FIELDS) for b in _FIELDS[i + 1 :])
_add(
    "jon13_field_pairs",
    lambda s, d: table(s, d, "kinetics").selectExpr("kin_id", f"inline(array({_PAIRS}))").where("x IS NOT NULL AND y IS NOT NULL").groupBy("a", "b").agg(F.count("*").alias("n"), F.sum(F.when(F.abs(F.length("x") - F.length("y")) > 20, 1).otherwise(0)).alias("n_apart")),
    "SELECT a, b, count(*) AS n, CAST(sum(CASE WHEN abs(length(x) - length(y)) > 20 THEN 1 ELSE 0 END) AS BIGINT) AS n_apart FROM ("
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, _evidence_{a} AS x, _evidence_{b} AS y FROM kinetics" for a, b in (("Km", "Vmax"), ("Km", "kcat"), ("Km", "kcat_Km"), ("Vmax", "kcat"), ("Vmax", "kcat_Km"), ("kcat", "kcat_Km")))
    + ") WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2",
)
_add(
    "jon14_supplement_to_main",
    lambda s, d: (lambda p: p.where("document_kind <> 'main'").select("paper_id", "doi").join(p.where("document_kind = 'main' AND doi IS NOT NULL").groupBy("doi").agg(F.min("paper_id").alias("main_id")), "doi").select("paper_id", "main_id"))(table(s, d, "papers")),
    "SELECT p.paper_id, m.main_id FROM papers p JOIN (SELECT doi, min(paper_id) AS main_id FROM papers WHERE document_kind = 'main' AND doi IS NOT NULL GROUP BY 1) m USING (doi) WHERE p.document_kind <> 'main'",
)
_NUMS = "regexp_extract_all(_evidence_Km, '([0-9]+(?:[.][0-9]+)?(?:[eE]-?[0-9]+)?)', 1)"
_add(
    "jon15_numeric_back_check",
    lambda s, d: table(s, d, "kinetics").where("Km > 0 AND _evidence_Km IS NOT NULL").select("kin_id", F.expr("regexp_extract_all(_evidence_Km, '([0-9]+(?:[.][0-9]+)?(?:[eE]-?[0-9]+)?)', 1)").alias("n"), "Km")
    .select("kin_id", F.expr("CASE WHEN exists(n, x -> abs(try_cast(x AS double) - Km) / Km <= 0.05D) THEN 'verified' WHEN exists(n, x -> abs(try_cast(x AS double) - Km) / Km <= 0.15D) THEN 'close' ELSE 'suspect' END").alias("status")),
    f"SELECT kin_id, CASE WHEN len(list_filter({_NUMS}, lambda x: abs(try_cast(x AS DOUBLE) - Km) / Km <= 0.05)) > 0 THEN 'verified' WHEN len(list_filter({_NUMS}, lambda x: abs(try_cast(x AS DOUBLE) - Km) / Km <= 0.15)) > 0 THEN 'close' ELSE 'suspect' END AS status FROM kinetics WHERE Km > 0 AND _evidence_Km IS NOT NULL",
)
_add(
    "jon16_text_back_check",
    lambda s, d: table(s, d, "kinetics").where("_evidence_Km IS NOT NULL AND substrate IS NOT NULL").select("kin_id", F.expr("contains(lower(_evidence_Km), lower(substrate))").alias("found")),
    "SELECT kin_id, contains(lower(_evidence_Km), lower(substrate)) AS found FROM kinetics WHERE _evidence_Km IS NOT NULL AND substrate IS NOT NULL",
)

# ---------------------------------------------------------------- aggregates
_EVAL_G = "SELECT paper_id, min(journal) AS a, min(lang) AS b FROM papers GROUP BY 1"


def _evaluation(s, d):
    gold = table(s, d, "papers").select("paper_id", "title", "journal", F.col("author").alias("authors"))
    got = table(s, d, "records").groupBy("paper_id").agg(F.min(F.col("paper.title")).alias("title"), F.min(F.col("paper.journal")).alias("journal"), F.min(F.col("paper.authors")).alias("authors"))
    return rel.evaluate(gold, got, "paper_id", ["title", "journal", "authors"])


_GE = "WITH g AS (SELECT paper_id, title, journal, author AS authors FROM papers), e AS (SELECT paper_id, min(paper.title) AS title, min(paper.journal) AS journal, min(paper.authors) AS authors FROM records GROUP BY 1), l AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS field, lower(trim(g.{f}, ' ')) AS g, lower(trim(e.{f}, ' ')) AS e FROM g JOIN e USING (paper_id)" for f in ("title", "journal", "authors")
) + ") SELECT field, CASE WHEN g IS NULL THEN 'skip' WHEN e IS NULL THEN 'miss' WHEN g = e THEN 'exact' WHEN contains(g, e) OR contains(e, g) THEN 'partial' ELSE 'wrong' END AS match, count(*) AS n FROM l GROUP BY 1, 2"
_add("agg01_field_evaluation", _evaluation, _GE)
_add(
    "agg02_precision_by_field",
    lambda s, d: _evaluation(s, d).where("match <> 'skip'").groupBy("field").agg(F.round(F.sum(F.when(F.col("match") == "exact", F.col("n")).otherwise(0)) / F.sum("n"), 4).alias("precision"), F.sum("n").alias("n_evaluable")),
    f"SELECT field, round(sum(CASE WHEN match = 'exact' THEN n ELSE 0 END) / sum(n), 4) AS precision, CAST(sum(n) AS BIGINT) AS n_evaluable FROM ({_GE}) WHERE match <> 'skip' GROUP BY 1",
)
_add(
    "agg03_numeric_comparison",
    lambda s, d: table(s, d, "records").where("main_activity.kinetics.Km > 0").select("record_id", "paper_id", F.col("main_activity.kinetics.Km").alias("e")).join(table(s, d, "kinetics").where("Km > 0").groupBy("paper_id").agg(F.min("Km").alias("g")), "paper_id").select("record_id", F.round(F.abs(F.col("e") - F.col("g")) / F.col("g"), 4).alias("err")).select("record_id", "err", F.when(F.col("err") < 0.1, "exact").when(F.col("err") < 0.5, "approximate").otherwise("wrong").alias("match")),
    "SELECT record_id, err, CASE WHEN err < 0.1 THEN 'exact' WHEN err < 0.5 THEN 'approximate' ELSE 'wrong' END AS match FROM (SELECT record_id, round(abs(main_activity.kinetics.Km - g) / g, 4) AS err FROM records JOIN (SELECT paper_id, min(Km) AS g FROM kinetics WHERE Km > 0 GROUP BY 1) USING (paper_id) WHERE main_activity.kinetics.Km > 0)",
)
_add(
    "agg04_batch_statistics",
    lambda s, d: table(s, d, "kinetics").where("Km > 0").groupBy("source").agg(F.count("*").alias("n"), F.round(F.avg("Km"), 4).alias("mean"), F.round(F.median("Km"), 4).alias("median"), F.min("Km").alias("low"), F.max("Km").alias("high"), F.round(F.coalesce(F.stddev_samp("Km"), F.lit(0.0)), 4).alias("sd")),
    "SELECT source, count(*) AS n, round(avg(Km), 4) AS mean, round(median(Km), 4) AS median, min(Km) AS low, max(Km) AS high, round(coalesce(stddev_samp(Km), 0), 4) AS sd FROM kinetics WHERE Km > 0 GROUP BY 1",
)
_COVER = {"name": "selected_nanozyme.name", "enzyme": "main_activity.enzyme_like_type", "km": "main_activity.kinetics.Km", "vmax": "main_activity.kinetics.Vmax", "synthesis": "selected_nanozyme.synthesis_method", "mechanism": "main_activity.mechanism", "size": "selected_nanozyme.size"}
_add(
    "agg05_field_coverage",
    lambda s, d: table(s, d, "records").selectExpr("inline(array(" + ", ".join(f"named_struct('field', '{n}', 'filled', {p} IS NOT NULL)" for n, p in _COVER.items()) + "))").groupBy("field").agg(F.round(F.avg(F.col("filled").cast("int")) * 100, 1).alias("rate"), F.count("*").alias("n")),
    "SELECT field, round(avg(CAST(filled AS INTEGER)) * 100, 1) AS rate, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS field, {p} IS NOT NULL AS filled FROM records" for n, p in _COVER.items()) + ") GROUP BY 1",
)
_add("agg04_top_warnings", lambda s, d: table(s, d, "records").selectExpr("explode(diagnostics.warnings) AS w").groupBy(F.split("w", ":")[0].alias("warning")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "warning").limit(10), "SELECT string_split(w, ':')[1] AS warning, count(*) AS n FROM (SELECT unnest(diagnostics.warnings) AS w FROM records) GROUP BY 1 ORDER BY n DESC, warning LIMIT 10")
_add(
    "agg06_pattern_hits",
    lambda s, d: table(s, d, "sentences").select(F.explode(F.array_compact(F.array(*[F.when(hit(F.lower("text"), p), F.lit(n)) for n, p in banks.HARD_RECALL.items()]))).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n")),
    "SELECT pattern, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT {quote(n)} AS pattern FROM sentences WHERE {sql_hit('lower(text)', p)}" for n, p in banks.HARD_RECALL.items()) + ") GROUP BY 1",
)
_add(
    "agg07_block_contexts",
    lambda s, d: table(s, d, "sentences").groupBy("paper_id", "block_id").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("page")).cast("array<string>"), ",").alias("pages"), F.array_join(F.array_sort(F.collect_set("section")), ",").alias("sections"), F.bool_or("contains_numeric").alias("any_numeric")),
    "SELECT paper_id, block_id, count(*) AS n, coalesce(array_to_string(list_sort(list(DISTINCT page) FILTER (page IS NOT NULL)), ','), '') AS pages, coalesce(array_to_string(list_sort(list(DISTINCT section) FILTER (section IS NOT NULL)), ','), '') AS sections, bool_or(contains_numeric) AS any_numeric FROM sentences GROUP BY 1, 2",
)
_add(
    "agg08_document_hints",
    lambda s, d: table(s, d, "sentences").groupBy("paper_id").agg(F.count("*").alias("n"), F.count_if("contains_keyword").alias("n_keyword"), F.count_if("contains_numeric").alias("n_numeric"), F.count_distinct("section").alias("n_sections"), F.sum(F.round(F.col("score") * 1000).cast("bigint")).alias("sum_score")),
    "SELECT paper_id, count(*) AS n, count_if(contains_keyword) AS n_keyword, count_if(contains_numeric) AS n_numeric, count(DISTINCT section) AS n_sections, CAST(sum(CAST(round(score * 1000) AS BIGINT)) AS BIGINT) AS sum_score FROM sentences GROUP BY 1",
)
_add(
    "agg09_unique_merge",
    lambda s, d: table(s, d, "records").select("record_id", F.array_join(F.array_distinct(F.filter(F.concat(F.coalesce("selected_nanozyme.metal_elements", F.array().cast("array<string>")), F.coalesce("selected_nanozyme.dopants_or_defects", F.array().cast("array<string>"))), lambda x: F.coalesce(x, F.lit("")) != "")), "|").alias("merged")),
    "SELECT record_id, coalesce((SELECT string_agg(x, '|' ORDER BY i) FROM (SELECT x, min(i) AS i FROM (SELECT unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT list_concat(coalesce(selected_nanozyme.metal_elements, []), coalesce(selected_nanozyme.dopants_or_defects, [])) AS l)) WHERE coalesce(x, '') <> '' GROUP BY x)), '') AS merged FROM records",
)
_add(
    "agg14_verification_rate",
    lambda s, d: QUERIES["jon15_numeric_back_check"](s, d).join(table(s, d, "kinetics").select("kin_id", "source"), "kin_id").groupBy("source").agg(F.round(F.count_if(F.col("status") == "verified") / F.count("*"), 3).alias("rate")),
    f"SELECT source, round(count_if(status = 'verified') / count(*), 3) AS rate FROM ({ORACLE['jon15_numeric_back_check']}) JOIN kinetics USING (kin_id) GROUP BY 1",
)
_add(
    "agg15_multi_source_consistency",
    lambda s, d: table(s, d, "kinetics").where("Km > 0 AND Km_unit IS NOT NULL").groupBy("paper_id", "substrate", "Km_unit").agg(F.count("*").alias("n"), F.max("Km").alias("hi"), F.min("Km").alias("lo"), F.median("Km").alias("mid")).where("n > 1 AND (hi - lo) / hi > 0.3D"),
    "SELECT paper_id, substrate, Km_unit, count(*) AS n, max(Km) AS hi, min(Km) AS lo, median(Km) AS mid FROM kinetics WHERE Km > 0 AND Km_unit IS NOT NULL GROUP BY 1, 2, 3 HAVING n > 1 AND (hi - lo) / hi > 0.3",
)
_add("agg16_figure_summary", lambda s, d: table(s, d, "figures").groupBy("paper_id").agg(F.count("*").alias("n"), F.count("caption_text").alias("n_captioned"), F.count("bbox").alias("n_boxed")), "SELECT paper_id, count(*) AS n, count(caption_text) AS n_captioned, count(bbox) AS n_boxed FROM figures GROUP BY 1")
_add(
    "agg17_adaptive_budget",
    lambda s, d: table(s, d, "sentences").groupBy("paper_id").agg(F.max("page").alias("pages"), F.count_if(hit(F.lower("text"), banks.APPLICATION_SIGNAL)).alias("apps")).select("paper_id", F.when(F.col("pages") <= 6, 10).otherwise(42 + F.when(F.col("apps") >= 2, 2).otherwise(0)).alias("sentences_max"), F.when(F.col("pages") <= 6, 2400).otherwise(9000 + F.when(F.col("apps") >= 2, 500).otherwise(0)).alias("chars_max")),
    f"SELECT paper_id, CAST(CASE WHEN pages <= 6 THEN 10 ELSE 42 + CASE WHEN apps >= 2 THEN 2 ELSE 0 END END AS INTEGER) AS sentences_max, CAST(CASE WHEN pages <= 6 THEN 2400 ELSE 9000 + CASE WHEN apps >= 2 THEN 500 ELSE 0 END END AS INTEGER) AS chars_max FROM (SELECT paper_id, max(page) AS pages, count_if({sql_hit('lower(text)', banks.APPLICATION_SIGNAL)}) AS apps FROM sentences GROUP BY 1)",
)
_add(
    "agg18_first_non_empty",
    lambda s, d: table(s, d, "records").groupBy("paper_id").agg(F.min_by("selected_nanozyme.morphology", F.when(F.coalesce("selected_nanozyme.morphology", F.lit("")) != "", F.col("record_id"))).alias("morphology"), F.min_by("main_activity.mechanism", F.when(F.coalesce("main_activity.mechanism", F.lit("")) != "", F.col("record_id"))).alias("mechanism")),
    "SELECT paper_id, arg_min(selected_nanozyme.morphology, record_id) FILTER (coalesce(selected_nanozyme.morphology, '') <> '') AS morphology, arg_min(main_activity.mechanism, record_id) FILTER (coalesce(main_activity.mechanism, '') <> '') AS mechanism FROM records GROUP BY 1",
)
_add("agg20_first_abstract_block", lambda s, d: table(s, d, "blocks").where("section = 'abstract' AND text IS NOT NULL").groupBy("paper_id").agg(F.substring(F.min_by("text", "block_key"), 1, 2000).alias("abstract")), "SELECT paper_id, substr(arg_min(text, block_key), 1, 2000) AS abstract FROM blocks WHERE section = 'abstract' AND text IS NOT NULL GROUP BY 1")
_add("agg02_rollup_groups", lambda s, d: table(s, d, "kinetics").rollup("source", "substrate").agg(F.count("*").alias("n"), F.count("Km").alias("n_km")), "SELECT source, substrate, count(*) AS n, count(Km) AS n_km FROM kinetics GROUP BY ROLLUP (source, substrate)")

# ---------------------------------------------------------------- ranking
_CAND = "SELECT paper_id, lower(selected_nanozyme.name) AS name, count(*) * 5 + max(CASE WHEN selected_nanozyme.selection_reason = 'title' THEN 8 ELSE 0 END) AS score FROM records WHERE selected_nanozyme.name IS NOT NULL GROUP BY 1, 2"


def _main_candidate(s, d):
    c = table(s, d, "records").where("selected_nanozyme.name IS NOT NULL").groupBy("paper_id", F.lower("selected_nanozyme.name").alias("name")).agg((F.count("*") * 5 + F.max(F.when(F.col("selected_nanozyme.selection_reason") == "title", 8).otherwise(0))).alias("score"))
    w = W.partitionBy("paper_id").orderBy(F.desc("score"), "name")
    return c.withColumn("rank", F.row_number().over(w)).withColumn("second", F.lead("score").over(w)).where("rank = 1").select("paper_id", "name", "score", F.coalesce(F.col("score") - F.col("second") <= 4, F.lit(False)).alias("ambiguous"))


_add("srt01_main_candidate", _main_candidate, f"SELECT paper_id, name, score, coalesce(score - second <= 4, false) AS ambiguous FROM (SELECT *, row_number() OVER w AS rank, lead(score) OVER w AS second FROM ({_CAND}) WINDOW w AS (PARTITION BY paper_id ORDER BY score DESC, name)) WHERE rank = 1")
_add("srt03_main_activity", lambda s, d: table(s, d, "records").where("main_activity.enzyme_like_type IS NOT NULL").groupBy("paper_id", F.lower("main_activity.enzyme_like_type").alias("e")).agg(F.count("*").alias("n"), F.min("record_id").alias("first")).groupBy("paper_id").agg(F.max_by("e", F.struct("n", -F.col("first"))).alias("activity"), F.max("n").alias("votes")), "SELECT paper_id, arg_max(e, n * 1000000000000 - first) AS activity, max(n) AS votes FROM (SELECT paper_id, lower(main_activity.enzyme_like_type) AS e, count(*) AS n, min(record_id) AS first FROM records WHERE main_activity.enzyme_like_type IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
_add("srt04_first_valid_by_priority", lambda s, d: rel.first_valid(table(s, d, "kinetics"), "Km"), f"SELECT paper_id, value, source AS value_source, n_valid FROM (SELECT paper_id, Km AS value, source, count(*) OVER (PARTITION BY paper_id) AS n_valid, row_number() OVER (PARTITION BY paper_id ORDER BY {_PRIO} DESC, entry_no, kin_id) AS r FROM kinetics WHERE Km > 0) WHERE r = 1")
_add(
    "srt05_table_quota",
    lambda s, d: rel.top_per_paper(table(s, d, "kinetics").where("source = 'table'").select("paper_id", "kin_id", (F.when(F.col("Km").isNotNull(), 10).otherwise(2) + F.when(F.col("Vmax").isNotNull(), 3).otherwise(0) + F.when(F.length("_evidence_Km") > 60, 2).otherwise(0)).alias("score")), "score", "kin_id", 8).select("paper_id", "kin_id", "score", F.when(F.col("score") >= 7, "high").when(F.col("score") >= 4, "middle").otherwise("low").alias("band")),
    "SELECT paper_id, kin_id, CAST(score AS INTEGER) AS score, CASE WHEN score >= 7 THEN 'high' WHEN score >= 4 THEN 'middle' ELSE 'low' END AS band FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY score DESC, kin_id) AS r FROM (SELECT paper_id, kin_id, CASE WHEN Km IS NOT NULL THEN 10 ELSE 2 END + CASE WHEN Vmax IS NOT NULL THEN 3 ELSE 0 END + CASE WHEN length(_evidence_Km) > 60 THEN 2 ELSE 0 END AS score FROM kinetics WHERE source = 'table')) WHERE r <= 8",
)
_add("srt08_figure_tasks_top8", lambda s, d: rel.top_per_paper(table(s, d, "figures").where("caption_text IS NOT NULL").select("paper_id", "fig_key", hit(F.lower("caption_text"), banks.CAPTION_TYPE["kinetics_caption"]).cast("int").alias("score")), "score", "fig_key", 8).select("paper_id", "fig_key", "rank"), f"SELECT paper_id, fig_key, CAST(r AS INTEGER) AS rank FROM (SELECT paper_id, fig_key, row_number() OVER (PARTITION BY paper_id ORDER BY CAST({sql_hit('lower(caption_text)', banks.CAPTION_TYPE['kinetics_caption'])} AS INTEGER) DESC, fig_key) AS r FROM figures WHERE caption_text IS NOT NULL) WHERE r <= 8")
_BUCKETS = {"kinetics": banks.KINETICS_SIGNAL, "application": banks.APPLICATION_SIGNAL, "activity": banks.ACTIVITY_SIGNAL, "material": banks.MATERIAL_SIGNAL}


def _buckets(s, d):
    rows = table(s, d, "sentences").where("text IS NOT NULL").select("paper_id", "sent_key", F.lower(F.trim("text")).alias("t"), F.explode(F.array_compact(F.array(*[F.when(hit(F.lower("text"), p), F.lit(n)) for n, p in _BUCKETS.items()]))).alias("bucket"))
    once = rows.groupBy("paper_id", "bucket", "t").agg(F.min("sent_key").alias("sent_key"))
    return once.withColumn("rank", F.row_number().over(W.partitionBy("paper_id", "bucket").orderBy("sent_key"))).where("rank <= 20").select("paper_id", "bucket", "sent_key", "rank")


_add("srt09_evidence_buckets", _buckets, "SELECT paper_id, bucket, sent_key, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY paper_id, bucket ORDER BY sent_key) AS rank FROM (SELECT paper_id, bucket, t, min(sent_key) AS sent_key FROM (" + " UNION ALL ".join(f"SELECT paper_id, sent_key, lower(trim(text, ' ')) AS t, '{n}' AS bucket FROM sentences WHERE text IS NOT NULL AND {sql_hit('lower(text)', p)}" for n, p in _BUCKETS.items()) + ") GROUP BY 1, 2, 3)) WHERE rank <= 20")
_add("srt11_reading_order_ids", lambda s, d: od.running_count(table(s, d, "blocks").select("paper_id", "page", "block_key"), "paper_id", "block_key", F.lit(1), lead=("page",)).select("paper_id", "block_key", F.format_string("S%04d", F.col("total")).alias("reading_id")), "SELECT paper_id, block_key, printf('S%04d', row_number() OVER (PARTITION BY paper_id ORDER BY page NULLS FIRST, block_key)) AS reading_id FROM blocks")
_add("srt12_title_choice", lambda s, d: table(s, d, "blocks").where("kind IN ('metadata', 'heading') AND text IS NOT NULL").groupBy("paper_id").agg(F.max_by("text", F.struct(F.when(F.length("text").between(20, 200), 2).otherwise(0) + F.when(F.col("kind") == "metadata", 1).otherwise(0), -F.col("block_key"))).alias("title_guess")), "SELECT paper_id, arg_max(text, (CASE WHEN length(text) BETWEEN 20 AND 200 THEN 2 ELSE 0 END + CASE WHEN kind = 'metadata' THEN 1 ELSE 0 END) * 1000000000000 - block_key) AS title_guess FROM blocks WHERE kind IN ('metadata', 'heading') AND text IS NOT NULL GROUP BY 1")

# ---------------------------------------------------------------- sets and ordered operators
_add("set02_unique_evidence", lambda s, d: table(s, d, "kinetics").where("_evidence_Km IS NOT NULL").groupBy("paper_id", F.lower(F.trim("_evidence_Km")).alias("evidence")).agg(F.min("kin_id").alias("first"), F.count("*").alias("n")), "SELECT paper_id, lower(trim(_evidence_Km, ' ')) AS evidence, min(kin_id) AS first, count(*) AS n FROM kinetics WHERE _evidence_Km IS NOT NULL GROUP BY 1, 2")
_add("set03_application_null_fill", lambda s, d: table(s, d, "records").selectExpr("record_id", "posexplode(applications) AS (ord, a)").where("a IS NOT NULL").groupBy("record_id", "a.application_type", "a.target_analyte").agg(F.min_by("a.method", F.when(F.col("a.method").isNotNull(), F.col("ord"))).alias("method"), F.min_by("a.detection_limit", F.when(F.col("a.detection_limit").isNotNull(), F.col("ord"))).alias("lod")), "SELECT record_id, a.application_type AS application_type, a.target_analyte AS target_analyte, arg_min(a.method, ord) FILTER (a.method IS NOT NULL) AS method, arg_min(a.detection_limit, ord) FILTER (a.detection_limit IS NOT NULL) AS lod FROM (SELECT record_id, unnest(applications) AS a, generate_subscripts(applications, 1) AS ord FROM records) WHERE a IS NOT NULL GROUP BY 1, 2, 3")
_add("set04_application_first", lambda s, d: table(s, d, "records").selectExpr("record_id", "posexplode(applications) AS (ord, a)").where("a IS NOT NULL").groupBy("record_id", "a.application_type", "a.target_analyte", "a.method").agg(F.min("ord").alias("ord")), "SELECT record_id, a.application_type AS application_type, a.target_analyte AS target_analyte, a.method AS method, CAST(min(ord) - 1 AS INTEGER) AS ord FROM (SELECT record_id, unnest(applications) AS a, generate_subscripts(applications, 1) AS ord FROM records) WHERE a IS NOT NULL GROUP BY 1, 2, 3, 4")
_add(
    "set05_set_precision_recall",
    lambda s, d: table(s, d, "records").select("record_id", F.array_distinct(F.array_compact(F.coalesce("selected_nanozyme.metal_elements", F.array().cast("array<string>")))).alias("a"), F.array_distinct(F.array_compact(F.coalesce("selected_nanozyme.composition_structured.dopants", F.array().cast("array<string>")))).alias("b")).where("size(a) > 0 AND size(b) > 0").select("record_id", F.round(F.size(F.array_intersect("a", "b")) / F.size("a"), 4).alias("precision"), F.round(F.size(F.array_intersect("a", "b")) / F.size("b"), 4).alias("recall")),
    "SELECT record_id, round(len(list_intersect(a, b)) / len(a), 4) AS precision, round(len(list_intersect(a, b)) / len(b), 4) AS recall FROM (SELECT record_id, list_distinct(coalesce(selected_nanozyme.metal_elements, [])) AS a, list_distinct(coalesce(selected_nanozyme.composition_structured.dopants, [])) AS b FROM records) WHERE len(a) > 0 AND len(b) > 0",
)
_add("set06_warning_dedup", lambda s, d: table(s, d, "records").where("diagnostics.warnings IS NOT NULL").select("record_id", F.array_join(F.array_sort(F.array_distinct("diagnostics.warnings")), "|").alias("warnings")), "SELECT record_id, array_to_string(list_sort(list_distinct(diagnostics.warnings)), '|') AS warnings FROM records WHERE diagnostics.warnings IS NOT NULL")
_add("set07_value_union", lambda s, d: table(s, d, "kinetics").where("Km IS NOT NULL").select("paper_id", "source", F.col("Km").alias("value")).unionByName(table(s, d, "records").where("main_activity.kinetics.Km IS NOT NULL").select("paper_id", F.lit("record").alias("source"), F.col("main_activity.kinetics.Km").alias("value"))).groupBy("paper_id", "source").agg(F.count("*").alias("n"), F.min("value").alias("low")), "SELECT paper_id, source, count(*) AS n, min(value) AS low FROM (SELECT paper_id, source, Km AS value FROM kinetics WHERE Km IS NOT NULL UNION ALL SELECT paper_id, 'record', main_activity.kinetics.Km FROM records WHERE main_activity.kinetics.Km IS NOT NULL) GROUP BY 1, 2")
_add("set08_kinetics_list_sync", lambda s, d: table(s, d, "records").where("main_activity.kinetics IS NOT NULL").select("record_id", F.expr("exists(main_activity.kinetics_list, x -> x.Km <=> main_activity.kinetics.Km AND x.substrate <=> main_activity.kinetics.substrate)").alias("listed")).select("record_id", F.coalesce("listed", F.lit(False)).alias("listed")), "SELECT record_id, coalesce(len(list_filter(main_activity.kinetics_list, lambda x: x.Km IS NOT DISTINCT FROM main_activity.kinetics.Km AND x.substrate IS NOT DISTINCT FROM main_activity.kinetics.substrate)) > 0, false) AS listed FROM records WHERE main_activity.kinetics IS NOT NULL")
_RECALL = f"coalesce({sql_labels('lower(text)', banks.HARD_RECALL)} <> '', false)"
_WSQL = "(PARTITION BY paper_id ORDER BY sent_key ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"


def _context(s, d):
    rows = table(s, d, "sentences").select("paper_id", "sent_key", hit(F.lower("text"), "|".join(banks.HARD_RECALL.values())).alias("anchor"))
    kept = F.col("anchor") | F.coalesce("prev", F.lit(False)) | F.coalesce("next", F.lit(False))
    return od.with_neighbours(rows, "paper_id", "sent_key", F.col("anchor")).select("paper_id", "sent_key", "anchor", kept.alias("kept"))


_add("win01_context_expansion", _context, f"SELECT paper_id, sent_key, anchor, max(anchor) OVER {_WSQL} AS kept FROM (SELECT paper_id, sent_key, {sql_hit('lower(text)', '|'.join(banks.HARD_RECALL.values()))} AS anchor FROM sentences)")
_add("win02_section_carry", lambda s, d: od.carried(table(s, d, "blocks").select("paper_id", "block_key", "section"), "paper_id", "block_key", F.col("section")).select("paper_id", "block_key", "carried"), "SELECT paper_id, block_key, last_value(section IGNORE NULLS) OVER (PARTITION BY paper_id ORDER BY block_key ROWS UNBOUNDED PRECEDING) AS carried FROM blocks")
_add("win03_gate_after_marker", lambda s, d: od.after_first(table(s, d, "blocks").select("paper_id", "block_key", "text"), "paper_id", "block_key", F.lower("text").rlike("^(conclusions?|references?)")).select("paper_id", "block_key", "after"), "SELECT paper_id, block_key, max(coalesce(regexp_matches(lower(text), '^(conclusions?|references?)'), false)) OVER (PARTITION BY paper_id ORDER BY block_key ROWS UNBOUNDED PRECEDING) AS after FROM blocks")
_add("lay03_paragraph_runs", lambda s, d: rel.paragraph_runs(table(s, d, "blocks")), "WITH p AS (SELECT *, bbox[1] AS l FROM blocks WHERE kind = 'paragraph' AND bbox IS NOT NULL), q AS (SELECT *, CASE WHEN coalesce(page = lag(page) OVER w AND coalesce(section = lag(section) OVER w, false) AND abs(l - lag(l) OVER w) < 40, false) THEN 0 ELSE 1 END AS nw FROM p WINDOW w AS (PARTITION BY paper_id ORDER BY block_key)), r AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY paper_id ORDER BY block_key ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM q) SELECT paper_id, run, count(*) AS n_blocks, min(block_key) AS first_block, min(l) AS x0, max(bbox[3]) AS x1, min(bbox[2]) AS y0, max(bbox[4]) AS y1 FROM r GROUP BY 1, 2")
_HEADSEC = {"abstract": "^abstract", "introduction": "^introduction", "experimental": "^(materials|methods|experimental|preparation)", "results": "^(results|characterization|steady|detection)", "conclusion": "^conclusion"}
_add("lay08_heading_sections", lambda s, d: table(s, d, "blocks").where("kind = 'heading'").select("block_key", F.coalesce(*[F.when(hit(F.lower("text"), p), F.lit(n)) for n, p in _HEADSEC.items()], F.lit("unknown")).alias("sec")), "SELECT block_key, coalesce(" + ", ".join(f"CASE WHEN {sql_hit('lower(text)', p)} THEN '{n}' END" for n, p in _HEADSEC.items()) + ", 'unknown') AS sec FROM blocks WHERE kind = 'heading'")
_add("lay10_document_kind", lambda s, d: table(s, d, "papers").select("paper_id", F.when(hit(F.lower("title"), "review"), "review").when(F.col("document_kind").isNotNull(), F.col("document_kind")).otherwise("main").alias("kind")), f"SELECT paper_id, CASE WHEN {sql_hit('lower(title)', 'review')} THEN 'review' WHEN document_kind IS NOT NULL THEN document_kind ELSE 'main' END AS kind FROM papers")
_add("lay12_page_profile", lambda s, d: table(s, d, "blocks").groupBy("paper_id", "page").agg(F.count("*").alias("n"), F.count_if(F.col("kind") == "heading").alias("headings"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("chars")).where("n >= 2"), "SELECT paper_id, page, count(*) AS n, count_if(kind = 'heading') AS headings, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS chars FROM blocks GROUP BY 1, 2 HAVING n >= 2")
_add("lay15_ocr_decision", lambda s, d: table(s, d, "blocks").groupBy("paper_id").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("chars"), F.count_distinct("page").alias("pages"), F.count_if("ocr").alias("scanned")).select("paper_id", F.concat_ws(";", F.when(F.col("n") < 5, "few_blocks"), F.when(F.col("chars") < 500, "few_chars"), F.when(F.col("scanned") > F.col("n") / 2, "scanned")).alias("reasons"), "pages"), "SELECT paper_id, concat_ws(';', CASE WHEN n < 5 THEN 'few_blocks' END, CASE WHEN chars < 500 THEN 'few_chars' END, CASE WHEN scanned > n / 2 THEN 'scanned' END) AS reasons, pages FROM (SELECT paper_id, count(*) AS n, sum(coalesce(length(text), 0)) AS chars, count(DISTINCT page) AS pages, count_if(ocr) AS scanned FROM blocks GROUP BY 1)")
_add("lay16_blocks_to_sentences", lambda s, d: table(s, d, "blocks").where("text IS NOT NULL").select("block_key", F.posexplode(F.when(F.col("kind").isin("heading", "metadata"), F.array("text")).otherwise(tx.split_sentences(F.col("text")))).alias("ord", "sentence")).select("block_key", "ord", F.length("sentence").alias("chars")), None)
_add("lay17_image_identity", lambda s, d: table(s, d, "figures").select("fig_key", F.coalesce("image_kid_id", F.concat_ws("::", F.col("paper_id").cast("string"), F.coalesce(F.col("page").cast("string"), F.lit("p")), F.coalesce(F.get("bbox", F.lit(0)).cast("bigint").cast("string"), F.lit("b")))).alias("uid")), "SELECT fig_key, coalesce(image_kid_id, concat_ws('::', CAST(paper_id AS VARCHAR), coalesce(CAST(page AS VARCHAR), 'p'), coalesce(CAST(CAST(trunc(bbox[1]) AS BIGINT) AS VARCHAR), 'b'))) AS uid FROM figures")
_add("jon04_box_geometry", lambda s, d: table(s, d, "figures").where("bbox IS NOT NULL").select("fig_key", F.round(F.get("bbox", F.lit(2)) - F.get("bbox", F.lit(0)), 3).alias("width"), F.round(F.get("bbox", F.lit(3)) - F.get("bbox", F.lit(1)), 3).alias("height")), "SELECT fig_key, round(bbox[3] - bbox[1], 3) AS width, round(bbox[4] - bbox[2], 3) AS height FROM figures WHERE bbox IS NOT NULL")

# ---------------------------------------------------------------- validation
_R = lambda c, p: "CASE WHEN {c} IS NULL THEN 'skip' WHEN {c} < {0!r} OR {c} > {1!r} THEN 'demote' WHEN {c} < {2!r} OR {c} > {3!r} THEN 'flag' ELSE 'ok' END".format(*banks.RANGES[p], c=c)
_add("val01_kinetics_validation", lambda s, d: table(s, d, "kinetics").select("kin_id", *[rel.range_status(F.col(c), c).alias(f"{c.lower()}_status") for c in banks.RANGES], (F.col("Km").isNotNull() & F.col("Km_unit").isNull()).alias("unit_missing"), F.coalesce(F.col("source").startswith("figure"), F.lit(False)).alias("figure_review")), "SELECT kin_id, " + ", ".join(f"{_R(c, c)} AS {c.lower()}_status" for c in banks.RANGES) + ", Km IS NOT NULL AND Km_unit IS NULL AS unit_missing, coalesce(starts_with(source, 'figure'), false) AS figure_review FROM kinetics")
_add("val04_record_warnings", lambda s, d: table(s, d, "records").select("record_id", F.concat_ws("|", F.when(F.col("main_activity.kinetics.Km") < 0, "Km_negative"), F.when(F.col("main_activity.kinetics.Vmax") < 0, "Vmax_negative"), F.when(F.col("main_activity.kinetics.Km").isNull() & F.col("main_activity.kinetics.Vmax").isNull(), "no_kinetics_found"), F.when(F.col("main_activity.kinetics.Km").isNotNull() & F.col("main_activity.kinetics.Km_unit").isNull(), "Km_unit_missing")).alias("warnings")), "SELECT record_id, concat_ws('|', CASE WHEN main_activity.kinetics.Km < 0 THEN 'Km_negative' END, CASE WHEN main_activity.kinetics.Vmax < 0 THEN 'Vmax_negative' END, CASE WHEN main_activity.kinetics.Km IS NULL AND main_activity.kinetics.Vmax IS NULL THEN 'no_kinetics_found' END, CASE WHEN main_activity.kinetics.Km IS NOT NULL AND main_activity.kinetics.Km_unit IS NULL THEN 'Km_unit_missing' END) AS warnings FROM records")
_TRI = "SELECT paper_id, min(Km) FILTER (source = 'text') AS a, min(Km) FILTER (source = 'table') AS b, min(Km) FILTER (starts_with(source, 'figure')) AS c FROM kinetics WHERE Km > 0 GROUP BY 1"


def _reconcile(s, d):
    k = table(s, d, "kinetics").where("Km > 0")
    w = k.groupBy("paper_id").agg(F.min(F.when(F.col("source") == "text", F.col("Km"))).alias("a"), F.min(F.when(F.col("source") == "table", F.col("Km"))).alias("b"), F.min(F.when(F.col("source").startswith("figure"), F.col("Km"))).alias("c"))
    near = lambda x, y: F.coalesce(F.abs(F.col(x) - F.col(y)) / F.greatest(x, y) <= 0.5, F.lit(False))
    n = sum((F.col(x).isNotNull().cast("int") for x in "abc"), F.lit(0))
    return w.select("paper_id", F.coalesce("a", "b", "c").alias("value"), F.when(n == 1, F.when(F.col("a").isNotNull(), "medium").otherwise("low")).when(near("a", "b") | near("a", "c") | near("b", "c"), "high").otherwise("low").alias("confidence"), n.alias("n_sources"))


_NEAR = lambda x, y: f"coalesce(abs({x} - {y}) / greatest({x}, {y}) <= 0.5, false)"
_NS = "(CAST(a IS NOT NULL AS INTEGER) + CAST(b IS NOT NULL AS INTEGER) + CAST(c IS NOT NULL AS INTEGER))"
_add("val06_three_source_reconciliation", _reconcile, f"SELECT paper_id, coalesce(a, b, c) AS value, CASE WHEN {_NS} = 1 THEN CASE WHEN a IS NOT NULL THEN 'medium' ELSE 'low' END WHEN {_NEAR('a', 'b')} OR {_NEAR('a', 'c')} OR {_NEAR('b', 'c')} THEN 'high' ELSE 'low' END AS confidence, {_NS} AS n_sources FROM ({_TRI})")
_add("val08_record_backfill", lambda s, d: table(s, d, "records").select("record_id", "paper_id", F.col("main_activity.kinetics.Km").alias("own")).join(rel.first_valid(table(s, d, "kinetics"), "Km").select("paper_id", "value"), "paper_id", "left").select("record_id", F.coalesce("own", "value").alias("km"), F.when(F.col("own").isNotNull(), "record").when(F.col("value").isNotNull(), "kinetics").otherwise("none").alias("origin")), f"SELECT record_id, coalesce(main_activity.kinetics.Km, value) AS km, CASE WHEN main_activity.kinetics.Km IS NOT NULL THEN 'record' WHEN value IS NOT NULL THEN 'kinetics' ELSE 'none' END AS origin FROM records LEFT JOIN (SELECT paper_id, value FROM ({ORACLE['srt04_first_valid_by_priority']})) USING (paper_id)")
_ATT = "CASE WHEN coalesce(contains(lower(text), n), false) AND {c} THEN 'yes_medium' WHEN coalesce(contains(lower(text), n), false) THEN 'yes_high' WHEN {m} THEN 'yes_low' WHEN {p} THEN 'no_medium' ELSE 'unknown_low' END".format(c=sql_hit("lower(text)", banks.CONTRAST), m=sql_hit("lower(text)", banks.THIS_WORK), p=sql_hit("lower(text)", banks.PREVIOUS_WORK))
_add("val12_sentence_attribution", lambda s, d: table(s, d, "sentences").join(table(s, d, "records").where("selected_nanozyme.name IS NOT NULL").groupBy("paper_id").agg(F.min(F.lower("selected_nanozyme.name")).alias("n")), "paper_id", "left").select("sent_key", rel.attribution(F.col("text"), F.col("n")).alias("belongs")), f"SELECT sent_key, {_ATT} AS belongs FROM sentences LEFT JOIN (SELECT paper_id, min(lower(selected_nanozyme.name)) AS n FROM records WHERE selected_nanozyme.name IS NOT NULL GROUP BY 1) USING (paper_id)")
_add("val15_consistency_rules", lambda s, d: table(s, d, "records").select("record_id", F.concat_ws("|", F.when(F.col("main_activity.pH_profile.optimal_pH") > 14, "pH_out_of_range"), F.when((F.col("main_activity.enzyme_like_type") == "peroxidase-like") & (F.col("main_activity.pH_profile.optimal_pH") > 8), "pH_unusual"), F.when(extract(F.col("selected_nanozyme.synthesis_conditions.temperature"), "([0-9]+)").try_cast("int") > 1200, "temperature_high"), F.when(extract(F.col("selected_nanozyme.size"), "([0-9]+)").try_cast("int") > 1000, "size_large")).alias("notes")), f"SELECT record_id, concat_ws('|', CASE WHEN main_activity.pH_profile.optimal_pH > 14 THEN 'pH_out_of_range' END, CASE WHEN main_activity.enzyme_like_type = 'peroxidase-like' AND main_activity.pH_profile.optimal_pH > 8 THEN 'pH_unusual' END, CASE WHEN try_cast({sql_extract('selected_nanozyme.synthesis_conditions.temperature', '([0-9]+)')} AS INTEGER) > 1200 THEN 'temperature_high' END, CASE WHEN try_cast({sql_extract('selected_nanozyme.size', '([0-9]+)')} AS INTEGER) > 1000 THEN 'size_large' END) AS notes FROM records")
_add("val20_demotion", lambda s, d: QUERIES["jon15_numeric_back_check"](s, d).where("status = 'suspect'").join(table(s, d, "kinetics").select("kin_id", "paper_id", "Km"), "kin_id").select("kin_id", "paper_id", F.lit(None).cast("double").alias("km_kept"), F.col("Km").alias("km_demoted")), f"SELECT kin_id, paper_id, CAST(NULL AS DOUBLE) AS km_kept, Km AS km_demoted FROM ({ORACLE['jon15_numeric_back_check']}) JOIN kinetics USING (kin_id) WHERE status = 'suspect'")
_STAT = "CASE WHEN selected_nanozyme.name IS NOT NULL AND main_activity.enzyme_like_type IS NOT NULL AND (main_activity.kinetics.Km IS NOT NULL OR main_activity.kinetics.Vmax IS NOT NULL) THEN 'complete' WHEN selected_nanozyme.name IS NOT NULL THEN 'partial' ELSE 'failed' END"
_add("val22_diagnostics", lambda s, d: table(s, d, "records").select("record_id", F.expr(_STAT).alias("st"), F.expr("main_activity.enzyme_like_type IS NOT NULL").alias("act")).select("record_id", "st", F.when(F.col("st") == "complete", "high").when((F.col("st") == "partial") & F.col("act"), "medium").otherwise("low").alias("confidence"), (F.col("st") != "complete").alias("needs_review")), f"SELECT record_id, st, CASE WHEN st = 'complete' THEN 'high' WHEN st = 'partial' AND main_activity.enzyme_like_type IS NOT NULL THEN 'medium' ELSE 'low' END AS confidence, st <> 'complete' AS needs_review FROM (SELECT *, {_STAT} AS st FROM records)")
_add("val31_enzyme_subtype", lambda s, d: table(s, d, "records").select("record_id", F.lower("main_activity.enzyme_like_type").alias("e")).where("e IS NOT NULL").select("record_id", F.when(F.col("e").contains("glutathione") | F.col("e").contains("halo"), "subtype").when(F.col("e").contains("peroxidase") | F.col("e").contains("oxidase"), "parent").otherwise("other").alias("level")), "SELECT record_id, CASE WHEN contains(e, 'glutathione') OR contains(e, 'halo') THEN 'subtype' WHEN contains(e, 'peroxidase') OR contains(e, 'oxidase') THEN 'parent' ELSE 'other' END AS level FROM (SELECT record_id, lower(main_activity.enzyme_like_type) AS e FROM records) WHERE e IS NOT NULL")

# ---------------------------------------------------------------- JSON fields and sinks expressed as tables
_add("jsn05_event_properties", lambda s, d: table(s, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.v").alias("v")), None)
_add("snk09_skip_existing", lambda s, d: table(s, d, "raw_records").join(table(s, d, "records").select("paper_id").distinct(), "paper_id", "left_anti").select("record_id", "paper_id"), "SELECT record_id, paper_id FROM raw_records r WHERE NOT EXISTS (SELECT 1 FROM records x WHERE x.paper_id = r.paper_id)")
_add("snk08_cache_key", lambda s, d: table(s, d, "papers").select("paper_id", F.substring(F.md5(F.concat_ws("|", F.coalesce("doi", F.lit("")), F.coalesce("source_file", F.lit("")))), 1, 16).alias("cache_key")), "SELECT paper_id, substr(md5(concat_ws('|', coalesce(doi, ''), coalesce(source_file, ''))), 1, 16) AS cache_key FROM papers")
_add("snk10_process_ledger", lambda s, d: table(s, d, "papers").groupBy("parse_status", "document_kind").agg(F.count("*").alias("n")), "SELECT parse_status, document_kind, count(*) AS n FROM papers GROUP BY 1, 2")
_add("snk12_correction_diff", lambda s, d: table(s, d, "papers").select("paper_id", F.col("title").alias("a")).join(table(s, d, "records").groupBy("paper_id").agg(F.min("paper.title").alias("b")), "paper_id", "full_outer").where("NOT (a <=> b)").select("paper_id", "a", "b"), "SELECT coalesce(p.paper_id, r.paper_id) AS paper_id, title AS a, b FROM papers p FULL OUTER JOIN (SELECT paper_id, min(paper.title) AS b FROM records GROUP BY 1) r ON p.paper_id = r.paper_id WHERE title IS DISTINCT FROM b")
_add("src19_flat_summary", lambda s, d: table(s, d, "records").select("record_id", F.col("selected_nanozyme.name").alias("name"), F.when(F.col("applications").isNull(), 0).otherwise(F.size("applications")).alias("n_apps"), F.coalesce(F.expr("exists(applications, a -> a.detection_limit IS NOT NULL)"), F.lit(False)).alias("has_lod")), "SELECT record_id, selected_nanozyme.name AS name, CAST(CASE WHEN applications IS NULL THEN 0 ELSE len(applications) END AS INTEGER) AS n_apps, coalesce(len(list_filter(applications, lambda a: a.detection_limit IS NOT NULL)) > 0, false) AS has_lod FROM records")
