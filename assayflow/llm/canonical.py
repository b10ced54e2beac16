"""Problem 2: mapping freely typed values to a canonical list.

Method: a BK-tree over the surface forms of the reference entries under the unrestricted
Damerau-Levenshtein distance, which is a metric; the triangle inequality prunes, and every
form within the threshold is returned. A reference list of at most ``SHARD_ENTRIES`` entries,
which is counted first, is broadcast. A larger one is never collected: its entries are keyed
into shards of that size, each value goes to every shard, a task holds the tree of one shard,
and the shard winners merge by one ``min_by``.

A value is looked up by its contiguous word spans (spaces, hyphens and brackets aside) and
by its rotations ("decomposition, thermal"), so that qualifiers around the term do not
count as errors. Spans and rotations longer than the longest form and its threshold are
within no form's reach and are not built; nothing else bounds them. The threshold grows with
the form: none below five letters, one at five, two from six (``radius``). The cheapest hit
wins: its distance plus a small price for words that are left over. Values that no entry
explains but that the corpus repeats often are terms of their own; a rarer value closer to
such a term than to an entry is unmatched too.

Only distinct values are looked up, once; rows are joined back on (field, value), both sides
pre-aggregated or small, so a value that a third of the rows share costs one lookup.

Defined results: null and blank values give no row; a value without an entry has term_id
-1; ties go to the lower term_id; repeated records give their rows each; very long values
are looked up by all their spans; an empty reference list maps all to -1.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..runtime import materialise

FIELDS = {
    "enzyme_like_type": "main_activity.enzyme_like_type",
    "assay_method": "main_activity.assay_method",
    "synthesis_method": "selected_nanozyme.synthesis_method",
}
SHARD_ENTRIES = 2_000
#: Price of a letter that the hit leaves unexplained.
LEFT_OVER = 0.4
#: A term of its own: at least this many rows and this share of the field's values (so at most 500 per field).
OWN_TERM_ROWS, OWN_TERM_SHARE = 5, 0.002
#: A value this near to such a term, and nearer than to any entry, means that term.
OWN_TERM_RADIUS = 2

_STOP = set("a an and as at by for from in of on or the to under using via with".split())
# Words that qualify any entry and carry no meaning of their own.
_NEUTRAL = set(
    "like mimic mimetic mimicking mimics activity active behaviour behavior properties property nanozyme nanozymes type main assay method methods test "
    "detection readout sensing approach procedure process route step technique based 96 wells two steps dry one pot treatment".split()
)
#: Rule-made variants: (ending or part, other writing).
_SWAPS = [("metric", "metry"), ("escent", "escence"), ("color", "colour"), ("fluoro", "fluori"), ("enzymatic", "enzyme"), ("ization", "isation"), ("vapor", "vapour")]


def tokens(value: str) -> list[str]:
    """Lower-case words of a value; all punctuation separates."""
    text = unicodedata.normalize("NFKC", value).lower()
    return [t for t in re.split(r"[\W_]+", text) if t]


def distance(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance (a metric)."""
    if a == b:
        return 0
    la, lb = len(a), len(b)
    big = la + lb
    last: dict[str, int] = {}
    d = [[big] * (lb + 2) for _ in range(la + 2)]
    for i in range(la + 1):
        d[i + 1][1] = i
    for j in range(lb + 1):
        d[1][j + 1] = j
    for i in range(1, la + 1):
        db = 0
        ca, row, prev = a[i - 1], d[i + 1], d[i]
        for j in range(1, lb + 1):
            k, m = last.get(b[j - 1], 0), db
            if ca == b[j - 1]:
                cost, db = 0, j
            else:
                cost = 1
            best = prev[j] + cost
            if row[j] + 1 < best:
                best = row[j] + 1
            if prev[j + 1] + 1 < best:
                best = prev[j + 1] + 1
            swap = d[k][m] + (i - k - 1) + 1 + (j - m - 1)
            row[j + 1] = swap if swap < best else best
        last[ca] = i
    return d[la + 1][lb + 1]


class BKTree:
    """Words under ``distance``; ``within`` returns every word within a radius."""

    def __init__(self, words: Iterator[str]):
        self.root: list | None = None
        self.size = 0
        for w in words:
            self.add(w)

    def add(self, word: str) -> None:
        if self.root is None:
            self.root, self.size = [word, {}], 1
            return
        node = self.root
        while True:
            d = distance(word, node[0])
            if d == 0:
                return
            if d not in node[1]:
                node[1][d] = [word, {}]
                self.size += 1
                return
            node = node[1][d]

    def within(self, word: str, radius: int) -> list[tuple[int, str]]:
        out, todo = [], [self.root] if self.root else []
        while todo:
            name, children = todo.pop()
            # the length difference bounds the distance from below: no child can be near enough
            if children and abs(len(name) - len(word)) > radius + max(children):
                continue
            if not children and abs(len(name) - len(word)) > radius:
                continue
            d = distance(word, name)
            if d <= radius:
                out.append((d, name))
            todo += [c for e, c in children.items() if d - radius <= e <= d + radius]
        return out


def radius(word: str) -> int:
    """Allowed errors by length: short forms must be exact."""
    n = len(word)
    return 0 if n < 5 else 1 if n < 6 else 2


def surface_forms(names: list[str]) -> dict[str, int]:
    """Space-less writings under which an entry may appear, each with its radius.

    The radius follows the length without qualifying words: an abbreviation stays exact.
    """
    out: dict[str, int] = {}
    todo = [tokens(n) for n in names]
    words: list[list[str]] = []
    for t in todo:
        t = [x for x in t if x not in _STOP]
        words.append(t)
        core = [x for x in t if x != "like"]
        if core and core != t:
            words.append(core)
        if len(t) > 1 and t[-1] == "assisted":
            words.append(t[:-1])
    for t in list(words):
        for a, b in _SWAPS:
            if any(a in x for x in t):
                words.append([x.replace(a, b) for x in t])
    for t in list(words):
        for a, b in _SWAPS:
            if any(a in x for x in t):
                words.append([x.replace(a, b) for x in t])
    for t in words:
        r = radius("".join(x for x in t if x not in _NEUTRAL))
        for i in range(len(t)):
            f = "".join(t[i:] + t[:i])
            if f:
                out[f] = max(r, out.get(f, 0))
    return out


class Matcher:
    """Forms of one field's entries (or of one shard of them)."""

    def __init__(self, entries: list[tuple[int, list[str]]]):
        self.terms: dict[str, int] = {}
        self.radii: dict[str, int] = {}
        for term, names in sorted(entries, reverse=True):
            for f, r in surface_forms(names).items():
                self.terms[f], self.radii[f] = term, r  # the lower term_id keeps a shared form
        self.tree = BKTree(sorted(self.terms))
        self.most = max(self.radii.values(), default=0)
        self.longest = max(map(len, self.terms), default=0) + self.most
        self.least = min((len(f) - r for f, r in self.radii.items() if r), default=0)
        self.cache: dict[str, list[tuple[int, str]]] = {}

    def near(self, word: str) -> list[tuple[int, str]]:
        if word in self.terms:
            return [(0, word)]
        got = self.cache.get(word)
        if got is None:
            got = self.tree.within(word, self.most) if self.least <= len(word) <= self.longest else []
            got = [(d, f) for d, f in got if d <= self.radii[f]]
            if len(self.cache) < 200_000:
                self.cache[word] = got
        return got

    def best(self, value: str) -> tuple[int, float] | None:
        """(term_id, cost) of the cheapest hit, or None."""
        every = [t for t in tokens(value) if t not in _STOP]
        plain = [t for t in tokens(re.sub(r"\([^()]*\)", " ", value)) if t not in _STOP]
        raw = tokens(value)
        found: tuple[float, int] | None = None
        for ts in ([every] if plain == every or not plain else [every, plain]) + ([raw] if raw != every else []):
            if found and ts is raw:
                break  # stop words only help where nothing else does: one may be a misspelt term
            n = len(ts)
            weight = [0 if t in _NEUTRAL else len(t) for t in ts]
            total = sum(weight)
            words = set()
            for i in range(n):
                length = used = 0
                for j in range(i, n):
                    length, used = length + len(ts[j]), used + weight[j]
                    if length > self.longest:
                        break
                    words.add(("".join(ts[i : j + 1]), used))
            core = [t for t in ts if t not in _NEUTRAL]
            if sum(map(len, core)) <= self.longest:
                words |= {("".join(core[k:] + core[:k]), total) for k in range(len(core))}
            for w, used in words:
                for d, f in self.near(w):
                    cost = (d + LEFT_OVER * (total - used), self.terms[f])
                    if found is None or cost < found:
                        found = cost
            if found and found[0] == 0:
                break
        return None if found is None else (found[1], found[0])


def core_of(value: str) -> str:
    """The letters of a value without words that only qualify."""
    return "".join(t for t in tokens(value) if t not in _STOP and t not in _NEUTRAL)


_HIT = "field string, value string, n bigint, core string, term_id int, cost double"


def _hits(values: pd.DataFrame, matchers: dict[str, Matcher]) -> pd.DataFrame:
    rows = []
    for field, value, n in zip(values["field"], values["value"], values["n"]):
        hit = matchers[field].best(value) if field in matchers else None
        rows.append((field, value, n, core_of(value), hit[0] if hit else -1, hit[1] if hit else 1e9))
    return pd.DataFrame(rows, columns=["field", "value", "n", "core", "term_id", "cost"])


def _matchers(entries: list[tuple[str, int, list[str]]]) -> dict[str, Matcher]:
    return {f: Matcher([(t, names) for g, t, names in entries if g == f]) for f in {e[0] for e in entries}}


def lookup(counted: DataFrame, reference: DataFrame) -> DataFrame:
    """(field, value, n, core, term_id, cost): the cheapest entry of every row of ``counted`` (field, value, n)."""
    spark = counted.sparkSession
    entries = reference.where("canonical IS NOT NULL AND term_id IS NOT NULL AND field IS NOT NULL").select(
        "field", F.col("term_id").cast("int").alias("term_id"), F.concat(F.array("canonical"), F.coalesce(F.array_compact("aliases"), F.array().cast("array<string>"))).alias("names")
    )
    size = entries.count()
    tasks = max(2, spark.sparkContext.defaultParallelism)
    if size <= SHARD_ENTRIES:
        shared = spark.sparkContext.broadcast([tuple(r) for r in entries.collect()])

        def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            matchers = _matchers(shared.value)
            for b in batches:
                yield _hits(b, matchers)

        return counted.repartition(tasks, "field", "value").mapInPandas(find, _HIT)
    shards = -(-size // SHARD_ENTRIES)
    parts = max(1, -(-2 * tasks // shards))  # tasks that share a shard's values
    shard = F.pmod(F.xxhash64("field", "term_id"), F.lit(shards)).cast("int")
    keyed = entries.select("*", shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    asked = counted.select("field", "value", "n", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.pmod(F.xxhash64("field", "value"), F.lit(parts)).cast("int").alias("part"))

    def find_in_shard(values: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        return _hits(values, _matchers([(f, int(t), list(n)) for f, t, n in zip(part["field"], part["term_id"], part["names"])]))

    hits = asked.groupBy("shard", "part").cogroup(keyed.groupBy("shard", "part")).applyInPandas(find_in_shard, _HIT)
    return hits.groupBy("field", "value", "n", "core").agg(F.min_by("term_id", F.struct("cost", "term_id")).alias("term_id"), F.min("cost").alias("cost"))


def long_values(records: DataFrame, key: str = "record_id") -> DataFrame:
    """(record_id, field, value) of every value that is not null or blank."""
    arms = ", ".join(f"named_struct('field', '{f}', 'value', CAST({path} AS string))" for f, path in FIELDS.items())
    return records.selectExpr(f"`{key}` AS record_id", f"inline(array({arms}))").where(r"value IS NOT NULL AND value NOT RLIKE '^[\\s\\p{Z}]*$'")


def own_terms(looked_up: DataFrame) -> DataFrame:
    """(field, core) of the terms that no entry explains and the corpus repeats; at most 1 / OWN_TERM_SHARE a field."""
    totals = looked_up.groupBy("field").agg(F.sum("n").alias("total"))
    unmatched = looked_up.where("term_id = -1").groupBy("field", "core").agg(F.sum("n").alias("n"))
    return unmatched.join(totals, "field").where(f"length(core) >= 5 AND n >= {OWN_TERM_ROWS} AND n >= {OWN_TERM_SHARE} * total").select("field", "core")


def map_values(records: DataFrame, reference: DataFrame, key: str = "record_id") -> DataFrame:
    """(record_id, field, value, term_id) of every value; -1 where no entry is meant."""
    values = long_values(records, key)
    counted = values.groupBy("field", "value").agg(F.count("*").alias("n"))
    looked_up = materialise(lookup(counted, reference), "canonical-values")  # looked up once, read three times
    own: dict[str, list[str]] = {}
    for r in own_terms(looked_up).collect():
        own.setdefault(r["field"], []).append(r["core"])

    @F.pandas_udf("boolean")
    def is_own(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        trees = {f: BKTree(sorted(cores)) for f, cores in own.items()}
        for fields, cores, costs in batches:
            yield pd.Series([f in trees and any(d < c for d, _ in trees[f].within(w, OWN_TERM_RADIUS)) for f, w, c in zip(fields, cores, costs)])

    if own:
        unsure = looked_up.where("term_id <> -1 AND cost >= 1")
        term = F.when(is_own("field", "core", "cost"), -1).otherwise(F.col("term_id"))
        mapped = looked_up.where("term_id = -1 OR cost < 1").select("field", "value", "term_id").unionByName(unsure.select("field", "value", term.alias("term_id")))
    else:
        mapped = looked_up.select("field", "value", "term_id")
    return values.join(mapped, ["field", "value"]).select("record_id", "field", "value", "term_id")


def unmatched_report(mapped: DataFrame) -> DataFrame:
    """(field, value, n): values without an entry and how often they occur."""
    return mapped.where("term_id = -1").groupBy("field", "value").agg(F.count("*").alias("n"))
