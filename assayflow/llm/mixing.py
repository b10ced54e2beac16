"""Problem 9: mixing sources to target weights.

Method: hierarchical budgeting. The leaves of a domain-language-source tree (document kind,
language, source) get the target share of their source in proportion to their tokens;
weights propagate to the root. The wanted total is handed down level by level: a child gets
its share of the weight, but no more than its leaves can give with ``max_repeats`` uses; a
shortage goes to its siblings in proportion to their weights and leaves the node only when
all of them are full, so siblings come before ancestors. A source without documents leaves
its weight to the root.

Each leaf takes whole seeded epochs of its documents and, of the next epoch, the prefix in
the order of a seeded hash whose tokens fit the rest. The prefix is found without sorting a
leaf in one task: hashes fall into ``BUCKETS`` buckets per leaf, the bucket sums are
accumulated (at most ``BUCKETS`` rows per leaf), and only the boundary bucket is ordered.

Sizes are tokens of the mix's public tokenizer. The tree's leaves (kinds x languages x
sources, checked against ``MAX_LEAVES``) are budgeted on the driver; documents never are.

Defined results: documents without a source in the mix, and those of no tokens (null,
empty), are not selected; null language or kind is a leaf of its own; an empty corpus gives
an empty selection and a report with zeros; repeated rows are documents of their own. A
source listed several times in a mix has the sum of its shares and the most of its repeats;
where rows of a mix differ in tokenizer or total, the first name and the largest total hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..runtime import materialise
from . import encoding

LEVELS = ("doc_kind", "lang", "source")
BUCKETS = 4096
MAX_LEAVES = 200_000


def share_out(budget: float, children: list[tuple[float, float]]) -> list[float]:
    """Split ``budget`` over (weight, capacity) children: by weight, never above capacity, shortage to the others."""
    got = [0.0] * len(children)
    rest = min(budget, sum(c for _, c in children))
    open_ = [i for i, (w, c) in enumerate(children) if c > 0 and w > 0]
    while rest > 1e-9 and open_:
        weight = sum(children[i][0] for i in open_)
        step, full = rest, []
        for i in open_:
            part = step * children[i][0] / weight
            room = children[i][1] - got[i]
            take = min(part, room)
            got[i] += take
            rest -= take
            if take >= room - 1e-9:
                full.append(i)
        if not full:
            break
        open_ = [i for i in open_ if i not in full]
    return got


def budgets(leaves: list[tuple[tuple, float, float, float]], total: float) -> dict[tuple, float]:
    """leaves: (path, weight, capacity, size) -> budget of each path, handed down the tree."""
    out: dict[tuple, float] = {}

    def down(part: list, depth: int, budget: float) -> None:
        if not part:
            return
        if depth == len(part[0][0]):
            out[part[0][0]] = min(budget, part[0][2])
            return
        groups: dict = {}
        for leaf in part:
            groups.setdefault(leaf[0][depth], []).append(leaf)
        names = sorted(groups, key=lambda x: (x is None, str(x)))
        given = share_out(budget, [(sum(x[1] for x in groups[g]), sum(x[2] for x in groups[g])) for g in names])
        for g, b in zip(names, given):
            down(groups[g], depth + 1, b)

    down(leaves, 0, total)
    return out


def sizes(documents: DataFrame, tokenizers: list[str], directory: str | None = None) -> DataFrame:
    """(doc_id, tokenizer, n_tokens) by the corpus encoder, or by the library of another public tokenizer."""
    out = None
    for name in tokenizers:
        if name == "byte_bpe_50k":
            one = encoding.token_counts(documents, name, directory)
        else:
            one = _library_counts(documents, name, directory)
        one = one.withColumn("tokenizer", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def _library_counts(documents: DataFrame, name: str, directory: str | None) -> DataFrame:
    import os

    where = directory or encoding.TOKENIZER_DIR
    file = next((f for f in (f"{name}.json", f"{name}.model", f"{name}.tiktoken") if os.path.exists(os.path.join(where, f))), None)
    if file is None:
        raise ValueError(f"no public tokenizer {name}")
    path = os.path.join(where, file)

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.encode_special_tokens = True
            size = lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]
        elif path.endswith(".model"):
            import sentencepiece

            t = sentencepiece.SentencePieceProcessor(model_file=path)
            size = lambda texts: [len(x) for x in t.encode(texts, num_threads=1)]
        else:
            import base64

            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
            t = tiktoken.Encoding("own", pat_str=encoding.SPLIT, mergeable_ranks=ranks, special_tokens={})
            size = lambda texts: [len(t.encode_ordinary(x)) for x in texts]
        for texts in batches:
            yield pd.Series(size(list(texts)), dtype="int32")

    return documents.select("doc_id", count(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("n_tokens"))


def _leaf_table(sized: DataFrame) -> DataFrame:
    return sized.groupBy("tokenizer", *LEVELS).agg(F.sum(F.col("n_tokens").cast("bigint")).alias("size"), F.count("*").alias("n_docs"))


def _targets(targets: DataFrame) -> DataFrame:
    """Targets without the rows that name no mix, source or tokenizer; a null number asks for nothing, null repeats for one use."""
    return targets.where("mix_name IS NOT NULL AND source IS NOT NULL AND tokenizer IS NOT NULL").select(
        "mix_name", "source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(1)).alias("max_repeats"), F.coalesce("total_ratio", F.lit(0.0)).alias("total_ratio"), "tokenizer"
    )


def plan(sized: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaf plan, source plan): uses and rest of every leaf, and the wanted tokens of every source."""
    spark = sized.sparkSession
    stats = _leaf_table(sized).limit(MAX_LEAVES + 1).collect()
    if len(stats) > MAX_LEAVES:
        raise ValueError(f"the tree has more than {MAX_LEAVES} leaves")
    mixes: dict[str, list] = {}
    for r in _targets(targets).collect():
        mixes.setdefault(r["mix_name"], []).append(r)
    leaf_rows, source_rows = [], []
    for mix, rows in mixes.items():
        tok = min(r["tokenizer"] for r in rows)
        mine = [s for s in stats if s["tokenizer"] == tok]
        total = max(r["total_ratio"] for r in rows) * sum(s["size"] for s in mine)
        by_source: dict[str, dict] = {}
        for r in rows:
            known = by_source.setdefault(r["source"], {"target_share": 0.0, "max_repeats": 0})
            known["target_share"] += r["target_share"]
            known["max_repeats"] = max(known["max_repeats"], r["max_repeats"])
        size_of: dict = {}
        for s in mine:
            if s["source"] in by_source:
                size_of[s["source"]] = size_of.get(s["source"], 0) + s["size"]
        leaves = []
        for s in mine:
            r = by_source.get(s["source"])
            if r is not None and s["size"] > 0:
                leaves.append((tuple(s[x] for x in LEVELS), r["target_share"] * s["size"] / size_of[s["source"]], float(s["size"] * r["max_repeats"]), float(s["size"])))
        given = budgets(leaves, total)
        for path, _, _, size in leaves:
            most = by_source[path[2]]["max_repeats"]
            epochs = min(most, int((given[path] + 1e-6) // size))
            rest = 0 if epochs >= most else int(round(given[path] - epochs * size))
            leaf_rows.append((mix, tok, *path, epochs, rest, most))
        for name, r in by_source.items():
            source_rows.append((mix, name, r["target_share"], r["max_repeats"], float(total), float(sum(b for p, b in given.items() if p[2] == name))))
    leaf = "mix_name string, tokenizer string, doc_kind string, lang string, source string, epochs int, rest bigint, max_repeats int"
    return spark.createDataFrame(leaf_rows, leaf), spark.createDataFrame(
        source_rows, "mix_name string, source string, target_share double, max_repeats int, wanted_total double, budget double"
    )


def sized_documents(documents: DataFrame, targets: DataFrame, directory: str | None = None) -> DataFrame:
    """(doc_id, levels, tokenizer, n_tokens) of every document with tokens, written once."""
    names = sorted(r[0] for r in _targets(targets).select("tokenizer").distinct().collect())
    if not names:
        names = ["byte_bpe_50k"]
    counts = sizes(documents, names, directory)
    levels = documents.select("doc_id", *[F.col(x).cast("string").alias(x) for x in LEVELS])
    return materialise(levels.join(counts, "doc_id"), "mix-sizes")


def select(sized: DataFrame, leaf_plan: DataFrame, seed: int = 11) -> DataFrame:
    """(mix_name, doc_id, source, lang, doc_kind, n_tokens, uses) of every selected document."""
    on = (sized["tokenizer"] == leaf_plan["tokenizer"]) & (sized["source"] == leaf_plan["source"])
    for x in ("lang", "doc_kind"):
        on = on & sized[x].eqNullSafe(leaf_plan[x])
    rows = sized.where("n_tokens > 0").join(leaf_plan, on).select(
        "mix_name", "doc_id", sized["source"], sized["lang"], sized["doc_kind"], F.col("n_tokens").cast("bigint").alias("n_tokens"), "epochs", "rest", "max_repeats"
    )
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "mix_name", "epochs", "doc_id")).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    leaf = ["mix_name", "source", "lang", "doc_kind"]
    per_bucket = rows.where("rest > 0").groupBy(*leaf, "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    before = F.sum("in_bucket").over(W.partitionBy(*leaf).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    per_bucket = per_bucket.withColumn("before", F.coalesce(before, F.lit(0)))
    cond = (rows["bucket"] == per_bucket["bucket"]) & (rows["mix_name"] == per_bucket["mix_name"]) & (rows["source"] == per_bucket["source"])
    for x in ("lang", "doc_kind"):
        cond = cond & rows[x].eqNullSafe(per_bucket[x])
    joined = rows.join(per_bucket, cond, "left").select(rows["*"], "before", "in_bucket")
    whole = (F.col("rest") > 0) & (F.col("before") + F.col("in_bucket") <= F.col("rest"))
    edge = (F.col("rest") > 0) & (F.col("before") < F.col("rest")) & ~whole
    settled = joined.where(~F.coalesce(edge, F.lit(False))).withColumn("uses", F.col("epochs") + F.coalesce(whole, F.lit(False)).cast("int"))
    inner = F.sum("n_tokens").over(W.partitionBy(*leaf, "bucket").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, 0))
    # a document belongs to the prefix if the larger part of it still fits
    last = joined.where(edge).withColumn("upto", F.col("before") + inner).withColumn("uses", F.col("epochs") + (F.col("upto") - F.col("n_tokens") / 2 <= F.col("rest")).cast("int")).drop("upto")
    names = ["mix_name", "doc_id", "source", "lang", "doc_kind", "n_tokens", "uses"]
    return settled.select(names).unionByName(last.select(names)).where("uses > 0")


def report(selected: DataFrame, source_plan: DataFrame) -> DataFrame:
    """Per mix and source: target and actual share, tokens, documents, most uses and what was missing."""
    got = selected.groupBy("mix_name", "source").agg(
        F.sum(F.col("n_tokens") * F.col("uses")).alias("tokens"), F.count("*").alias("n_docs"), F.max("uses").alias("most_uses")
    )
    total = got.groupBy("mix_name").agg(F.sum("tokens").alias("mix_tokens"))
    out = source_plan.join(got, ["mix_name", "source"], "left").join(total, "mix_name", "left")
    tokens = F.coalesce("tokens", F.lit(0))
    return out.select(
        "mix_name", "source", "target_share", F.coalesce(tokens / F.col("mix_tokens"), F.lit(0.0)).alias("actual_share"), tokens.alias("tokens"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"),
        F.coalesce("most_uses", F.lit(0)).alias("most_uses"), "max_repeats", "wanted_total", F.greatest(F.lit(0.0), F.col("target_share") * F.col("wanted_total") - tokens).alias("missing"),
    )


def mix(documents: DataFrame, targets: DataFrame, directory: str | None = None, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """(selection, report) of every mix."""
    sized = sized_documents(documents, targets, directory)
    leaf_plan, source_plan = plan(sized, targets)
    chosen = select(sized, leaf_plan, seed)
    return chosen, report(chosen, source_plan)
