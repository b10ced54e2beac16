"""Operators with sequential state: trees, greedy budgets, assignment, absorption, chunking, rate limits.

Groups handed to Python are bounded: a page, a block, the distinct names of a paper, or at
most ``HARD_SENTENCES`` candidates per role. Where a key may hold a large share of the rows
(a paper, a user) the rows are ranked and cut relationally first, or streamed in order with
constant state.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import banks
from ..functions.dual import hit
from ..functions.jsonrepair import loads_lenient
from ..runtime import materialise
from . import text as tx

TARGET_SENTENCES, HARD_SENTENCES, TARGET_CHARS, HARD_CHARS, FLOOR = 42, 55, 9000, 12000, -4.0


def by_group(df: DataFrame, keys: list[str], order: list[str], fn: Callable[[tuple, list[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """``fn(key, rows)`` for every group, rows in order; groups are streamed through each partition, one in memory at a time.

    Without a data frame per group this is many times faster on small groups. Columns must
    not be null.
    """
    names = [f.split()[0] for f in schema.split(", ")]
    n = len(keys)
    rest = [c for c in df.columns if c not in keys]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current: tuple | None = None
        rows: list[tuple] = []
        out: list[tuple] = []
        for b in batches:
            for t in b.itertuples(index=False, name=None):
                if t[:n] != current:
                    if rows:
                        out.extend(fn(current, rows))
                    current, rows = t[:n], []
                rows.append(t[n:])
            if len(out) > 5000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if rows:
            out.extend(fn(current, rows))
        yield pd.DataFrame(out, columns=names)

    return df.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


# ------------------------------------------------------------------ trees


def _walk(node: object, path: str = "$", depth: int = 0) -> Iterator[tuple[str, int, str, str | None]]:
    """(path, depth, kind, scalar) in reading order: the node, then its members."""
    kind = "object" if isinstance(node, dict) else "array" if isinstance(node, list) else "null" if node is None else type(node).__name__
    yield path, depth, kind, None if isinstance(node, (dict, list)) or node is None else json.dumps(node, ensure_ascii=False) if not isinstance(node, str) else node
    if depth < 60:
        members = node.items() if isinstance(node, dict) else enumerate(node) if isinstance(node, list) else ()
        for k, v in members:
            yield from _walk(v, f"{path}.{k}" if isinstance(node, dict) else f"{path}[{k}]", depth + 1)


def flatten_tree(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, ord, path, depth, kind, value): every node of each JSON tree in reading order."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, t in zip(b["k"], b["t"]):
                value, _ = loads_lenient(t if isinstance(t, str) else None)
                if value is not None:
                    out += [(k, i, *n) for i, n in enumerate(_walk(value))]
            yield pd.DataFrame(out, columns=["k", "ord", "path", "depth", "kind", "value"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(walk, f"k {kind}, ord int, path string, depth int, kind string, value string").withColumnRenamed("k", key)


def layout_elements(layout: object) -> list[dict]:
    """Elements of a layout tree in reading order: kids, then the kids of table cells, then list items."""
    out: list[dict] = []

    def visit(e: dict) -> None:
        content = e.get("content") or ""
        if e.get("type") and (content or e["type"] in ("image", "picture", "table")):
            out.append({"type": e["type"], "page": e.get("page number"), "bbox": e.get("bounding box"), "text": content})
        for kid in e.get("kids") or []:
            visit(kid)
        for row in e.get("rows") or []:
            for cell in row.get("cells") or []:
                for kid in cell.get("kids") or []:
                    visit(kid)
        for item in e.get("list items") or []:
            visit({"type": "list item"} | item)

    if isinstance(layout, dict):
        for kid in layout.get("kids") or []:
            visit(kid)
    return out


# ------------------------------------------------------------------ greedy evidence budget


def evidence_budget(sentences: DataFrame) -> DataFrame:
    """(paper_id, sent_key, phase): hard-recalled sentences, role minima, then greedy picks by priority and diversity.

    Hard-recalled sentences are kept without a choice. Of the others, those of one role and
    one length are picked or found too long alike, in order of priority, so of each length
    only the best ``HARD_SENTENCES`` per role can ever be picked; those longer than the
    budget never are. So the greedy step sees bounded groups and loses no pick.
    """
    rows = sentences.where("text IS NOT NULL").select(
        "paper_id", "sent_key", F.length("text").alias("size"), tx.tags(F.col("text")).alias("tags"), tx.sentence_score(F.col("text"), F.col("section")).alias("score"), "section", "text", "contains_numeric",
        hit(F.lower("text"), "|".join(banks.HARD_RECALL.values())).alias("recalled"),
    )
    rows = rows.select("paper_id", "sent_key", "size", F.coalesce(tx.primary_role(F.col("tags")), F.lit("none")).alias("role"), tx.sentence_priority(F.col("score"), F.col("tags"), F.col("section"), F.col("text"), F.col("contains_numeric")).alias("priority"), "recalled")
    rows = materialise(rows, "budget-rows")  # scored once, read three times
    kept = rows.where("recalled").select("paper_id", "sent_key", F.lit("recalled").alias("phase"))
    state = rows.where("recalled").groupBy("paper_id").agg(F.count("*").alias("n0"), F.sum("size").alias("c0"), F.array_join(F.array_sort(F.collect_set("role")), "|").alias("roles0"))
    best = rows.where(f"NOT recalled AND priority >= {FLOOR} AND size < {HARD_CHARS}").withColumn("r", F.row_number().over(W.partitionBy("paper_id", "role", "size").orderBy(F.desc("priority"), "sent_key"))).where(f"r <= {HARD_SENTENCES}").drop("r", "recalled")
    cands = best.join(state, "paper_id", "left").select(
        "paper_id", F.negative("priority").alias("down"), "sent_key", "size", "role", F.coalesce("n0", F.lit(0)).alias("n0"), F.coalesce("c0", F.lit(0)).alias("c0"), F.coalesce("roles0", F.lit("")).alias("roles0")
    )

    def pick(key: tuple, rows: list[tuple]) -> list[tuple]:
        n, chars = int(rows[0][4]), int(rows[0][5])
        covered = set(rows[0][6].split("|"))
        counts: dict[str, int] = {}
        pool = [(r[1], r[2], r[3], -r[0]) for r in rows]  # (sent_key, size, role, priority), best first
        out: list[tuple] = []

        def take(i: int, phase: str) -> None:
            nonlocal n, chars
            sent, size, role, _ = pool.pop(i)
            n, chars = n + 1, chars + size + 1
            counts[role] = counts.get(role, 0) + 1
            covered.add(role)
            out.append((key[0], sent, phase))

        for role in banks.ROLE_ORDER:
            if role not in covered and n < HARD_SENTENCES:
                i = next((i for i, c in enumerate(pool) if c[2] == role and chars + c[1] < HARD_CHARS), None)
                if i is not None:
                    take(i, "minimum")
        while pool and n < TARGET_SENTENCES and chars < TARGET_CHARS:
            # the pool is in order of priority: of each role only its first sentence can gain most
            best_i, best_gain, seen = -1, -1e18, set()
            for i, c in enumerate(pool):
                if c[2] in seen:
                    continue
                seen.add(c[2])
                gain = c[3] + (1.5 if c[2] not in covered else 0.0) - (1.8 if c[2] == "kinetics" else 0.75) * counts.get(c[2], 0)
                if gain > best_gain:
                    best_i, best_gain = i, gain
            if chars + pool[best_i][1] >= HARD_CHARS:
                pool.pop(best_i)
                continue
            take(best_i, "greedy")
        return out

    return kept.unionByName(by_group(cands, ["paper_id"], ["down", "sent_key"], pick, "paper_id bigint, sent_key bigint, phase string"))


# ------------------------------------------------------------------ caption assignment


def pair_score(cap: tuple[float, ...], fig: tuple[float, ...], width: float) -> float | None:
    """Score of a caption and an image box (x0, y0, x1, y1) on one page; None beyond the limits."""
    below = cap[1] >= (fig[1] + fig[3]) / 2
    gap = max(0.0, cap[1] - fig[3]) if below else max(0.0, fig[1] - cap[3])
    overlap = max(0.0, min(cap[2], fig[2]) - max(cap[0], fig[0])) / max(1e-9, min(cap[2] - cap[0], fig[2] - fig[0]))
    centre = abs((cap[0] + cap[2]) - (fig[0] + fig[2])) / 2 / max(width, 1e-9)
    if gap > 120 or (overlap < 0.25 and centre > 0.35):
        return None
    return (25 if below else 14) + 30 * overlap - 0.14 * gap - 18 * centre


def assign(caps: list, figs: list, width: float) -> list[tuple[int, int, float]]:
    """Disjoint, non-crossing pairs of greatest total, in vertical order; pairs under 8 are not accepted."""
    n, m = len(caps), len(figs)
    best = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            s = pair_score(caps[i][1], figs[j][1], width)
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + s if s is not None and s >= 8 else 0.0)
    out, i, j = [], 0, 0
    while i < n and j < m:
        s = pair_score(caps[i][1], figs[j][1], width)
        if s is not None and s >= 8 and abs(best[i][j] - best[i + 1][j + 1] - s) < 1e-9:
            out.append((caps[i][0], figs[j][0], round(s, 3)))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


def caption_images(blocks: DataFrame, figures: DataFrame) -> DataFrame:
    """(paper_id, page, block_key, fig_key, score) by page; a page is the largest group."""
    box = lambda side, key, where: where.select("paper_id", "page", F.lit(side).alias("side"), F.col(key).alias("k"), *[F.get("bbox", F.lit(i)).alias(f"b{i}") for i in range(4)])
    both = box("c", "block_key", blocks.where("kind = 'caption' AND bbox IS NOT NULL AND page IS NOT NULL")).unionByName(box("f", "fig_key", figures.where("bbox IS NOT NULL AND page IS NOT NULL")))

    both = both.where(" AND ".join(f"b{i} IS NOT NULL" for i in range(4)))

    def match(key: tuple, rows: list[tuple]) -> list[tuple]:
        boxes = {s: [(r[1], r[2:6]) for r in rows if r[0] == s] for s in "cf"}
        width = max(r[4] for r in rows) or 1.0
        return [(*key, c, f, s) for c, f, s in assign(boxes["c"], boxes["f"], width)]

    return by_group(both, ["paper_id", "page"], ["b1", "b0", "k"], match, "paper_id bigint, page int, block_key bigint, fig_key bigint, score double")


# ------------------------------------------------------------------ names and chunks


def absorb_names(names: DataFrame) -> DataFrame:
    """(paper_id, name, n): a name contained in a longer one of the paper gives it its count; groups hold distinct names."""
    counted = names.groupBy("paper_id", F.lower(F.trim("name")).alias("name")).agg(F.count("*").alias("n"))

    def absorb(key: tuple, rows: list[tuple]) -> list[tuple]:
        kept: list[list] = []
        for _, name, n in rows:
            host = next((k for k in kept if name in k[0]), None)
            if host:
                host[1] += n
            else:
                kept.append([name, n])
        return [(key[0], a, b) for a, b in kept]

    return by_group(counted.select("paper_id", F.negative(F.length("name")).alias("l"), "name", "n"), ["paper_id"], ["l", "name"], absorb, "paper_id bigint, name string, n bigint")


def split_chunks(sentences: DataFrame, limit: int = 6000) -> DataFrame:
    """(paper_id, page, chunk, n, chars): a page's sentences in order; a new chunk at the limit or when the assay changes.

    The sentences of a paper without a page are chunked together, with page null.
    """
    rows = sentences.where("text IS NOT NULL").select("paper_id", F.coalesce("page", F.lit(-1)).alias("page"), "sent_key", F.length("text").alias("size"), tx.first_label(F.lower("text"), banks.ASSAY_LABEL, "").alias("assay"))

    def chunk(key: tuple, sent: list[tuple]) -> list[tuple]:
        out: list[list] = []
        assay = ""
        for _, size, a in sent:
            if not out or out[-1][1] + size > limit or (a and assay and a != assay):
                out.append([0, 0])
                assay = ""
            out[-1][0] += 1
            out[-1][1] += size
            assay = a or assay
        return [(*key, i, n, c) for i, (n, c) in enumerate(out)]

    out = by_group(rows, ["paper_id", "page"], ["sent_key"], chunk, "paper_id bigint, page int, chunk int, n int, chars int")
    return out.withColumn("page", F.nullif("page", F.lit(-1)))


def merge_short_chunks(sizes: list[int], least: int) -> list[int]:
    """Neighbouring chunks merged until none but a lone one is shorter than ``least``."""
    out = list(sizes)
    while len(out) > 1 and min(out) < least:
        i = out.index(min(out))
        j = i - 1 if i and (i == len(out) - 1 or out[i - 1] <= out[i + 1]) else i + 1
        a, b = min(i, j), max(i, j)
        out[a : b + 1] = [out[a] + out[b]]
    return out


# ------------------------------------------------------------------ scientific spelling

_ELEMENTS = set(
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu "
    "Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U".split()
)
_PIECE = re.compile(r"(?:[A-Z][a-z]?)+\Z")
_INDEX = re.compile(r"\d+(?:\.\d+)?\Z|\d*[+-]\Z")
_EXPONENT = re.compile(r"\b(mL|L|M|s|min|h|cm|g|mg|mol) ?[-−–] ?(\d)\b")


def _is_formula(tok: str) -> bool:
    parts = re.findall(r"[A-Z][a-z]?", tok)
    return bool(_PIECE.match(tok)) and all(p in _ELEMENTS for p in parts)


def scientific_spelling(text: str | None) -> str | None:
    """NFC, no soft hyphens, formulas closed up (Fe 3 O 4), charges and unit exponents joined."""
    if text is None:
        return None
    t = unicodedata.normalize("NFC", text).replace("­", "")
    t = re.sub(r"-[ \t]*\n[ \t]*(?=[a-z])", "", t)
    t = _EXPONENT.sub(r"\1^-\2", t)
    toks = t.split(" ")
    out: list[str] = []
    i = 0
    while i < len(toks):
        if _is_formula(toks[i]) and i + 1 < len(toks) and _INDEX.match(toks[i + 1]):
            word, j, indexes = toks[i], i + 1, 0
            while j < len(toks):
                if _INDEX.match(toks[j]) and not word[-1].isdigit() and word[-1] not in "+-":
                    word += toks[j]
                    indexes += 1
                elif _is_formula(toks[j]) and word[-1].isdigit():
                    word += toks[j]
                else:
                    break
                j += 1
            out.append(word)
            i = j
        else:
            out.append(toks[i])
            i += 1
    return " ".join(out)


def spelled(c: Column) -> Column:
    """``scientific_spelling`` as an Arrow-batched column."""

    @F.pandas_udf("string")
    def spell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([scientific_spelling(t if isinstance(t, str) else None) for t in texts], dtype=object)

    return spell(c)


# ------------------------------------------------------------------ rate limits


def token_bucket(events: DataFrame, key: str, ts: str, per_second: float, burst: float, order: str) -> DataFrame:
    """Adds ``allowed``: each event takes a token of its key's bucket if there is one.

    Rows are sorted within partitions and streamed with one bucket of state, so a key that
    holds a large share of the rows needs no more memory than any other.
    """
    kept = events.select(key, ts, order).repartition(key).sortWithinPartitions(key, ts, order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", allowed boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now_key: object = None
        level, last = burst, None
        for b in batches:
            flags = []
            for k, t in zip(b[key], b[ts]):
                if k != now_key or last is None:
                    now_key, level = k, burst
                else:
                    level = min(burst, level + (t - last).total_seconds() * per_second)
                last = t
                ok = level >= 1.0
                level -= ok
                flags.append(bool(ok))
            yield b.assign(allowed=flags)

    return kept.mapInPandas(run, schema)
