"""String operators: cleanup, repair, parsing of numbers and names, splitting, tagging.

Each operator is a Column built from built-in functions; nulls give null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions import banks
from ..functions.dual import extract, first_label, hit, labels, replace_all

#: Ordered repairs of scientific notation as scanners leave it.
OCR_STEPS = [("[−–]", "-"), ("℃|º *C|˚ *C", "°C"), ("K +m([^a-z]|$)", "Km\\1"), ("V +max", "Vmax"), ("([0-9]) *[x×*] *10 *\\^? *(-?[0-9]+)", "\\1e\\2"), ("([A-Za-z]) - 1([^0-9]|$)", "\\1^-1\\2")]
NAME_STEPS = [("[“”\"]", ""), ("^(the|a|an|as|our|new|novel|proposed) +", ""), ("^(the|a|an|as|our|new|novel|proposed) +", ""), ("^(the|a|an|as|our|new|novel|proposed) +", ""), (" *[,;:.]+$", ""), ("[ \\t]+", " ")]
SUFFIX_STEPS = [(" *(nanosheets|nanorods|nanoparticles|nanotubes|nanozymes?|nanowires)$", "")]
ABBREVIATIONS = ["et al.", "e.g.", "i.e.", "Fig.", "Figs.", "Eq.", "Ref.", "No.", "Dr.", "Prof.", "ca.", "vs.", "cf.", "approx.", "Sec.", "St."]


def basic_cleanup(c: Column) -> Column:
    """Joins words divided at line ends, squeezes white space, trims."""
    return F.trim(replace_all(c, [("-[ \\t]*\\n[ \\t]*", ""), ("[ \\t\\r\\n]+", " ")]))


def search_text(c: Column) -> Column:
    """Lower-case letters and digits with single spaces."""
    return F.trim(replace_all(F.lower(c), [("[^a-z0-9 ]", " "), (" +", " ")]))


def ocr_repair(c: Column) -> Column:
    return replace_all(c, OCR_STEPS)


def mantissa(c: Column) -> Column:
    return F.regexp_replace(extract(c, "(-?[0-9]+([.,][0-9]+)?)"), ",", ".").try_cast("double")


def exponent(c: Column) -> Column:
    """The power of ten of ``3.2 × 10⁻⁸``, ``3.2x10^-8`` or ``3.2E-8``; 0 where none is written."""
    plain = F.translate(c, "⁰¹²³⁴⁵⁶⁷⁸⁹⁻−", "0123456789--")
    return F.coalesce(extract(plain, "[0-9] *[x×*] *10 *\\^?(-?[0-9]+)").try_cast("int"), extract(plain, "[0-9][eE](-?[0-9]+)").try_cast("int"), F.lit(0))


def parse_number(c: Column) -> Column:
    """The first number of a text as a double, with its power of ten; null where there is none."""
    return mantissa(c) * F.pow(F.lit(10.0), exponent(c))


def split_sentences(c: Column) -> Column:
    """Array of sentences; the stop of an abbreviation does not divide; pieces of five characters or fewer drop."""
    guarded = c
    for a in ABBREVIATIONS:
        guarded = F.replace(guarded, F.lit(a + " "), F.lit(a + "\u0002"))
    parts = F.split(F.regexp_replace(guarded, "([.!?]) +", "$1\u0001"), "\u0001")
    return F.filter(F.transform(parts, lambda p: F.translate(p, "\u0002", " ")), lambda p: F.length(p) > 5)


def greedy_pack(pieces: Column, limit: int) -> Column:
    """Pieces packed in order into chunks of at most ``limit`` characters."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, p: Column) -> Column:
        fits = F.length(acc["open"]) + F.length(p) + 1 <= limit
        return F.struct(
            F.when(fits | (acc["open"] == ""), acc["done"]).otherwise(F.array_append(acc["done"], acc["open"])).alias("done"),
            F.when(acc["open"] == "", p).when(fits, F.concat_ws(" ", acc["open"], p)).otherwise(p).alias("open"),
        )

    return F.aggregate(pieces, start, step, lambda a: F.when(a["open"] == "", a["done"]).otherwise(F.array_append(a["done"], a["open"])))


def strip_citations(c: Column) -> Column:
    return F.trim(replace_all(c, [(" *\\[[0-9]{1,3}([,-][0-9]{1,3})*\\]", ""), (" *[(（]?(see|cf\\.) +(Fig|Sec|Table)[^)）.]*[)）]?", "")]))


def clean_name(c: Column) -> Column:
    return F.nullif(F.trim(replace_all(F.lower(c), NAME_STEPS)), F.lit(""))


def name_stem(c: Column) -> Column:
    return F.trim(replace_all(F.lower(c), SUFFIX_STEPS))


def first_author(c: Column) -> Column:
    return F.nullif(F.trim(replace_all(F.element_at(F.split(c, ";"), 1), [("^[A-Z]\\. *", ""), ("[*†0-9]+$", "")])), F.lit(""))


def clean_doi(c: Column) -> Column:
    return extract(F.lower(F.trim(c)), "(10\\.[0-9]{4,9}/[^ \"<>]*[a-z0-9])")


def clean_year(c: Column) -> Column:
    year = extract(c, "(19[5-9][0-9]|20[0-3][0-9])").try_cast("int")
    return F.when(year.between(1950, 2030), year)


def to_null(c: Column) -> Column:
    """Sentinel words of replies become null."""
    return F.when(F.lower(F.trim(c)).isin(banks.SENTINELS), F.lit(None)).otherwise(F.trim(c))


def composition_parts(c: Column) -> Column:
    """core, shell, support and dopant of a composition written like N-doped A@B/C."""
    plain = F.regexp_replace(F.trim(c), "^([A-Z][a-z]?)-doped +|^hollow +", "")
    return F.struct(
        extract(plain, "^([^@/ ]+)").alias("core"), extract(plain, "@([^@/ ]+)").alias("shell"), extract(plain, "/([^@/ ]+)").alias("support"), extract(c, "^([A-Z][a-z]?)-doped").alias("dopant")
    )


def safe_stem(c: Column) -> Column:
    plain = F.regexp_replace(c, "[^A-Za-z0-9_.-]+", "_")
    return F.when(F.length(plain) > 40, F.concat(F.substring(plain, 1, 31), F.lit("_"), F.substring(F.md5(c), 1, 8))).otherwise(plain)


def keyword_score(c: Column) -> Column:
    """Sum of the weights of all keyword occurrences."""
    weights = F.create_map(*[F.lit(x) for kv in banks.KEYWORD_WEIGHT.items() for x in kv])
    found = F.regexp_extract_all(F.lower(c), F.lit("(" + "|".join(banks.KEYWORD_WEIGHT) + ")"), 1)
    return F.aggregate(found, F.lit(0.0), lambda s, k: s + weights[k])


def sentence_score(text: Column, section: Column) -> Column:
    """Keyword weights plus 3 for a number with unit and 2 for a range, times section and length factors.

    A section without a factor of its own counts once, a missing one as ``unknown``.
    """
    factors = F.create_map(*[F.lit(x) for kv in banks.SECTION_FACTOR.items() for x in kv])
    factor = F.coalesce(factors[F.coalesce(section, F.lit("unknown"))], F.lit(1.0))
    base = keyword_score(text) + hit(text, banks.NUMBER_WITH_UNIT).cast("int") * banks.NUMBER_BONUS + hit(text, banks.RANGE_WITH_UNIT).cast("int") * banks.RANGE_BONUS
    least, most = banks.LENGTHS
    length = F.when(F.length(text) < least, 0.5).when(F.length(text) > most, 0.8).otherwise(1.0)
    return F.round(base * factor * length, 2)


def sentence_priority(score: Column, tag_text: Column, section: Column, text: Column, numeric: Column) -> Column:
    """Score, tag and section bonuses, and what speaks for a sentence beside its tags."""
    bonus = F.create_map(*[F.lit(x) for kv in banks.TAG_BONUS.items() for x in kv])
    sections = F.create_map(*[F.lit(x) for kv in banks.SECTION_BONUS.items() for x in kv])
    by_section = F.coalesce(sections[F.coalesce(section, F.lit("unknown"))], F.lit(0.0))
    t = F.lower(text)
    tag_list = F.filter(F.split(tag_text, r"\|"), lambda x: x != "")
    has = lambda *names: F.arrays_overlap(tag_list, F.array(*[F.lit(n) for n in names]))
    roles = F.size(F.filter(tag_list, lambda x: x.isin(banks.SELECTION_ROLES)))
    out = score + F.aggregate(tag_list, F.lit(0.0), lambda s, x: s + F.coalesce(bonus[x], F.lit(0.0))) + F.greatest(roles - 1, F.lit(0)) * 0.8
    extras = [
        (F.coalesce(numeric, F.lit(False)) & has("kinetics", "comparison", "application", "activity", "assay"), 1.2),
        (hit(t, banks.KINETICS_SIGNAL) & ~has("kinetics"), 1.5),
        (hit(t, banks.MATERIAL_SIGNAL) & ~has("system"), 0.5),
        (hit(t, "|".join(banks.ENZYME.values())) & ~has("activity"), 0.8),
        (hit(t, "|".join(banks.APPLICATION_TYPE.values())) & ~has("application"), 0.8),
        (hit(t, banks.NEGATIVE_ACTIVITY), 2.5),
    ]
    for cond, points in extras:
        out = out + cond.cast("int") * points
    return F.round(out + by_section, 2)


def tags(c: Column) -> Column:
    return labels(F.lower(c), banks.VALUE_TAGS)


def primary_role(tag_text: Column) -> Column:
    padded = F.concat(F.lit("|"), tag_text, F.lit("|"))
    return F.coalesce(*[F.when(padded.contains(f"|{r}|"), F.lit(r)) for r in banks.PRIMARY_ROLE])


def drop_reason(c: Column) -> Column:
    return first_label(F.lower(F.coalesce(c, F.lit(""))), banks.DROP_REASON, None)


def signal_label(c: Column) -> Column:
    t = F.lower(c)
    return F.concat_ws("+", *[F.when(hit(t, p), n) for n, p in (("kinetics", banks.KINETICS_SIGNAL), ("activity", banks.ACTIVITY_SIGNAL), ("application", banks.APPLICATION_SIGNAL), ("material", banks.MATERIAL_SIGNAL))])


def numbers(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit("([0-9]+(\\.[0-9]+)?)"), 1))
