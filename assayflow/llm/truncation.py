"""Problem 7: text cut off by field limits or mid-transfer.

Method: per source and column, histograms of the length in characters and in bytes are
tested for spikes: a length whose texts without terminal punctuation exceed those of the
lengths around it by far. The present limit makes the spike at the maximum; a limit that a
source had before leaves one below it, which is found alike. Values at a spike length without terminal punctuation are flagged (``limit_chars``,
``limit_bytes``); what ends as its kind must (a full stop, a closed table row or bracket) is
spared. That decides every value at a limit, and no other rule reads it.

Values of any other length have no spike to be found by. They are flagged as ``transfer``
where they visibly lack their end (an open table row or bracket, a replacement character,
an ellipsis, a word or clause that the corpus only ever continues). What is a whole remark
although it has no full stop is learned from the corpus: for the last word and its two
predecessors it is counted how often the text ends there, goes on, or has a longer word
there. All counts are grouped with map-side combine; the join back is on the (context,
word) key of the few values that end without punctuation.

Cost at scale: the cells are read and judged once and written, with their text, to the
shared folder; histograms have one row per source, column and length, whatever the table.

Defined results: null and blank cells are no case; a whole table row, caption or remark is
none, however it ends; repeated rows are reported each and counted each; null source is a
source of its own; very long texts are read whole; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import materialise

FIELDS = ("_evidence_Km", "_evidence_Vmax", "_evidence_kcat")

_CONC = r"(?:[mμµunp]?M|[mμµun]?mol(?:/[mμ]?L| ?·?L(?:\^-1|-1|⁻¹)| ?·?dm(?:\^-3|-3|⁻³)| ?·?m(?:\^-3|-3|⁻³))|(?:milli|micro|nano)?molar|[mμµun]?g(?:/m?L| ?m?L(?:\^-1|-1|⁻¹))|% w/v|a\.u\.)"
_PER_TIME = r"(?:/(?:s|sec|min|h)| ?·?(?:s|sec|min|h)(?:\^-1|-1|⁻¹)| per (?:second|minute|hour))"
#: A complete value with its unit at the end, by column.
_VALUE_END = {
    "_evidence_Km": rf"\d\)? ?(?:[×x]? ?10\S+ |E-?\d+ )?{_CONC}$",
    "_evidence_Vmax": rf"\d\)? ?(?:[×x]? ?10\S+ |E-?\d+ )?(?:{_CONC}{_PER_TIME}|U/mg|U mg(?:\^-1|-1|⁻¹)|ΔA{_PER_TIME}|OD{_PER_TIME}|[mμµun]?mol/min/mg)$",
    "_evidence_kcat": rf"\d\)? ?(?:[×x]? ?10\S+ |E-?\d+ )?(?:(?:s|sec|min|h)(?:\^-1|-1|⁻¹)|1/s|/s|per second)$",
}
_TERMINAL = r"[.!?。！？؟।]['\"”’»)\]]*$"
#: A full stop that ends no sentence: an abbreviation, or the point of a number whose unit is missing.
_OPEN_STOP = (
    r"(?:\b(?:ca|approx|Fig|Figs|Eq|e\.g|i\.e|vs|cf|No|resp|Dr|Prof|a)\.$)"
    r"|(?:(?:\bpH|[=≈:~]|\bwas|\bof|\bbe|\breached|\bKm|\bVmax|\bkcat|为|\)) ?\d+\.$)"
)
_SENTENCE_BREAK = r"(?:(?<!\b(?:Dr|Prof|St|Mr|Ms|Mrs|Fig|Figs|Eq|Ref|No|Vol|\p{Lu}))\. +\p{Lu})|[。！？]."
_LEAD = r"^(?:Fig(?:ure|s)?\.? ?S?\d+[a-z]?\.?|Table \d+\.?) *"


def _norm(c: Column) -> Column:
    """Digits to one sign, so that values do not tell texts apart."""
    return F.regexp_replace(c, r"\d+(?:[.,]\d+)?(?:[eE][-+]?\d+)?", "#")


def cells(kinetics: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "kin_id") -> DataFrame:
    """One row per non-blank cell with the structural signs of a missing end."""
    has = set(kinetics.columns)
    arms = ", ".join(f"named_struct('field', '{f}', 'text', CAST(`{f}` AS string))" for f in fields if f in has)
    source = F.col("source").cast("string") if "source" in has else F.lit(None).cast("string")
    if not arms:
        return kinetics.select(F.col(key).alias("kin_id"), source.alias("source"), F.lit("").alias("field"), F.lit("").alias("text")).limit(0)
    long = kinetics.select(F.col(key).alias("kin_id"), source.alias("source"), F.expr(f"array({arms})").alias("c")).selectExpr("kin_id", "source", "inline(c)")
    return long.where("length(trim(text)) > 0")


def with_signs(long: DataFrame) -> DataFrame:
    """Adds n_chars, n_bytes, shape (row, bracket, prose) and end: ``whole``, ``cut`` or ``open`` (undecided)."""
    text = F.col("text")
    t = F.rtrim(text)
    n_of = lambda sign: F.length(t) - F.length(F.translate(t, sign, ""))
    balanced = (n_of("(") == n_of(")")) & (n_of("[") == n_of("]"))
    shape = F.when(t.startswith("|"), "row").when(t.startswith("["), "bracket").otherwise("prose")
    broken = t.rlike("(?:\\uFFFD|…|\\.\\.\\.)$")
    value_end = F.lit(False)
    for f, pattern in _VALUE_END.items():
        value_end = F.when(F.col("field") == f, t.rlike(pattern)).otherwise(value_end)
    prose = (
        F.when(t.rlike(_TERMINAL) & ~t.rlike(_OPEN_STOP), F.when(balanced, "whole").otherwise("cut"))
        .when(t.rlike(_OPEN_STOP), "cut")
        .when(F.regexp_replace(t, _LEAD, "").rlike(_SENTENCE_BREAK), "cut")
        .when(~balanced, "cut")
        .when(t.endswith(")"), "whole")
        .when(F.length(t) - F.length(F.regexp_replace(t, "[\\u3040-\\u30ff\\u4e00-\\u9fff]", "")) >= 5, "cut")
        .when(t.rlike("^Fig") & value_end, "whole")
        .otherwise("open")
    )
    row_end = F.when(t.endswith("|") & (F.size(F.split(t, r"\|")) > 4), "whole").otherwise("cut")
    bracket_end = F.when(t.endswith("]") & balanced, "whole").otherwise("cut")
    end = F.when(broken, "cut").when(shape == "row", row_end).when(shape == "bracket", bracket_end).otherwise(prose)
    return long.select(
        "*", F.length(text).alias("n_chars"), F.octet_length(text).alias("n_bytes"), shape.alias("shape"), end.alias("end"), t.rlike(_TERMINAL).alias("terminal")
    )


def _words() -> Column:
    return F.split(F.trim(_norm(F.col("text"))), r"\s+")


def _last_words(long: DataFrame) -> DataFrame:
    """Adds word, the last one, and context, the two before it."""
    words = _words()
    n = F.size(words)
    context = F.concat_ws(" ", F.when(n > 2, F.element_at(words, -3)), F.when(n > 1, F.element_at(words, -2)))
    return long.select("*", context.alias("context"), F.element_at(words, -1).alias("word"))


def learned_ends(prose: DataFrame, ends: DataFrame) -> DataFrame:
    """(context, word, learned_whole) of every undecided ending: the corpus ends there more often than it goes on.

    ``prose`` has the texts, ``ends`` the distinct (context, word) to judge. Only words in
    their contexts are counted, and of all other words only how often they occur and end.
    """
    grams = prose.select(_words().alias("w")).selectExpr(
        "inline(transform(sequence(1, size(w)), i -> named_struct('context', concat_ws(' ', IF(i > 2, get(w, i - 3), NULL), IF(i > 1, get(w, i - 2), NULL)), 'word', w[i - 1], 'last', i = size(w))))"
    )
    in_context = grams.join(ends.select("context").distinct(), "context", "left_semi")
    counts = in_context.groupBy("context", "word").agg(F.count_if("last").alias("n_end"), F.count_if(~F.col("last")).alias("n_on"))
    # a longer word in the same context: each word gives its proper prefixes, joined on equality
    longer = (
        counts.where("length(word) > 1")
        .selectExpr("context", "explode(transform(sequence(1, length(word) - 1), k -> substr(word, 1, k))) AS word", "n_end + n_on AS n")
        .groupBy("context", "word")
        .agg(F.sum("n").alias("n_longer"))
    )
    # rare endings also ask whether any context has a longer word with this beginning
    anywhere = (
        prose.select(_words().alias("w"))
        .selectExpr("posexplode(w) AS (i, word)", "size(w) AS n")
        .groupBy("word")
        .agg(F.count_if(F.expr("i = n - 1")).alias("e"), F.count("*").alias("n"))
        .selectExpr("inline(transform(sequence(1, length(word)), k -> named_struct('word', substr(word, 1, k), 'n_any_longer', IF(k < length(word), n, 0), 'n_any_end', IF(k = length(word), e, 0))))")
        .join(ends.select("word").distinct(), "word", "left_semi")
        .groupBy("word")
        .agg(F.sum("n_any_longer").alias("n_any_longer"), F.sum("n_any_end").alias("n_any_end"))
    )
    known = ends.join(counts, ["context", "word"]).join(longer, ["context", "word"], "left").join(anywhere, "word")
    rare_whole = F.col("word").contains("#") | (F.col("n_any_longer") < F.col("n_any_end"))
    whole = (F.col("n_on") + F.coalesce("n_longer", F.lit(0)) < F.col("n_end")) & ((F.col("n_end") >= 3) | rare_whole)
    return known.select("context", "word", whole.alias("learned_whole"))


def spikes(endless: DataFrame, ratio: float = 5.0, least: int = 5, near: int = 8) -> DataFrame:
    """(source, field, unit, len): lengths where different texts without a proper end pile up.

    ``endless`` holds those texts. ``unit`` is chars or bytes. A spike has at least ``least``
    such texts and ``ratio`` times the mean of the ``near`` lengths on each side of it. A
    remark that is repeated word by word counts once, so it makes no spike.
    """
    hist = (
        endless.selectExpr("source", "field", "text", "inline(array(named_struct('unit', 'chars', 'len', n_chars), named_struct('unit', 'bytes', 'len', n_bytes)))")
        .groupBy("source", "field", "unit", "len")
        .agg(F.count_distinct(F.xxhash64("text")).alias("n"))
    )
    spread = hist.selectExpr(
        "source", "field", "unit", f"inline(transform(sequence(-{near}, {near}), d -> named_struct('len', len + d, 'own', IF(d = 0, n, 0), 'around', IF(d = 0, 0, n))))"
    )
    by_len = spread.groupBy("source", "field", "unit", "len").agg(F.sum("own").alias("own"), F.sum("around").alias("around"))
    return by_len.where((F.col("own") >= least) & (F.col("own") > ratio * F.col("around") / (2 * near))).select("source", "field", "unit", "len")


def at_spikes(rows: DataFrame, peaks: DataFrame) -> DataFrame:
    """Adds at_chars and at_bytes: the row's length is a spike of its source and column."""
    for unit in ("chars", "bytes"):
        p = peaks.where(F.col("unit") == unit).select(F.col("source").alias("_s"), F.col("field").alias("_f"), F.col("len").alias("_n"), F.lit(True).alias(f"at_{unit}"))
        rows = rows.join(p, F.col("source").eqNullSafe(F.col("_s")) & (F.col("field") == F.col("_f")) & (F.col(f"n_{unit}") == F.col("_n")), "left").drop("_s", "_f", "_n")
    return rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("at_chars", "at_bytes")})


def cut_cells(kinetics: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "kin_id") -> DataFrame:
    """(kin_id, source, field, reason) of every cell that lost its end; reason: limit_chars, limit_bytes or transfer."""
    signed = materialise(with_signs(cells(kinetics, fields, key)), "cut-cells")
    endless = _last_words(signed.where("end <> 'whole'").drop("terminal"))
    ends = materialise(endless.where("end = 'open'").select("context", "word").distinct(), "cut-endings")
    learned = learned_ends(signed.where("shape = 'prose'").select("text"), ends)
    rows = endless.join(learned, ["context", "word"], "left").withColumn("learned_whole", (F.col("end") == "open") & F.coalesce("learned_whole", F.lit(False)))
    rows = materialise(rows.select("kin_id", "source", "field", "text", "n_chars", "n_bytes", "learned_whole"), "cut-endless")
    rows = at_spikes(rows, spikes(rows.where("NOT learned_whole")))
    # a length at a spike decides alone: there a text without its end is cut even if the corpus knows that ending
    reason = F.when(F.col("at_chars"), "limit_chars").when(F.col("at_bytes"), "limit_bytes").when(~F.col("learned_whole"), "transfer")
    return rows.select("kin_id", "source", "field", reason.alias("reason")).where("reason IS NOT NULL")


def cut_shares(kinetics: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "kin_id") -> DataFrame:
    """Per source and field: cells, cut cells by reason and the share of cut cells."""
    total = cells(kinetics, fields, key).groupBy("source", "field").agg(F.count("*").alias("n_cells"))
    cut = cut_cells(kinetics, fields, key).groupBy(F.col("source").alias("s"), F.col("field").alias("f")).agg(
        F.count("*").alias("n_cut"), F.count_if(F.col("reason") != "transfer").alias("n_at_limit")
    )
    both = total.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("field") == F.col("f")), "left")
    n = F.coalesce("n_cut", F.lit(0))
    return both.select("source", "field", "n_cells", n.alias("n_cut"), F.coalesce("n_at_limit", F.lit(0)).alias("n_at_limit"), (n / F.col("n_cells")).alias("cut_share"))
