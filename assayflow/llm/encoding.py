"""Problem 8: encoding of the whole corpus with a public byte-level BPE tokenizer.

Method: corpus-level merge replay. The texts are pre-split into words; the distinct words
of the corpus are encoded once. Per task, over all of its distinct words (in turns of
``REPLAY_WORDS``, which bounds the memory), an inverted index from token pair to positions
drives the merges in rank order: all places of a pair are merged together and only the touched neighbours enter the index again. A pair that a merge creates
always has a later rank than that merge, so one pass over the ranks is exact.

The ids go back to the texts by chunks: documents are hashed into chunks of about
``CHUNK_CHARS`` characters, each chunk lists its distinct words, the word table is joined
on the word, and a cogroup per chunk rewrites the chunk's texts with its own dictionary.
So the shuffle carries every chunk's distinct words instead of every token; a chunk's size
is bounded, except that a text longer than a chunk is a unit of its own; a hot word has one
row per chunk and the join can split it.

Defined results: null, and empty texts, have an empty list of ids; text that looks like a
special token is ordinary text; every row has its list, repeated rows too; extra columns
are ignored. The tokenizer's file is a parameter; it is read on the driver and sent as it
is (under 2 MB).
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from ..runtime import materialise

TOKENIZER_DIR = os.environ.get("ASSAYFLOW_TOKENIZERS", "/opt/tokenizers")
CHUNK_CHARS = 2_000_000
REPLAY_WORDS = 500_000
#: The published split of byte-level BPE; white space is spelled out because libraries differ on control characters.
_SPACE = r"\t-\r \x85\xa0  -     　"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


def byte_letters() -> dict[int, str]:
    """Byte -> the letter that stands for it in the vocabulary: printable bytes are themselves, the rest count up from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return out


class Merges:
    """Vocabulary and merge ranks of a byte-level BPE file."""

    def __init__(self, raw: str):
        model = json.loads(raw)["model"]
        vocab = model["vocab"]
        self.byte_ids = [vocab[c] for _, c in sorted(byte_letters().items())]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))


def replay(words: list[str], merges: Merges) -> list[list[int]]:
    """Ids of every word: all merges over all words at once, in rank order."""
    sym: list[int] = []
    starts = []
    ids = merges.byte_ids
    for w in words:
        starts.append(len(sym))
        sym += [ids[b] for b in w.encode("utf-8", "surrogatepass")]
        sym.append(-1)  # the end of a word stops every pair
    n = len(sym)
    nxt = list(range(1, n + 1))
    prv = list(range(-1, n - 1))
    pairs = merges.pairs
    index: dict[tuple[int, int], list[int]] = {}
    for i in range(n - 1):
        index.setdefault((sym[i], sym[i + 1]), []).append(i)
    index = {p: at for p, at in index.items() if p in pairs}
    heap = [(pairs[p][0], p) for p in index]
    heapq.heapify(heap)
    while heap:
        _, pair = heapq.heappop(heap)
        at = index.pop(pair, None)
        if at is None:
            continue
        a, b = pair
        new = pairs[pair][1]
        at.sort()
        for i in at:
            j = nxt[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue  # one of the two was merged meanwhile
            k = nxt[j]
            sym[i], sym[j] = new, -2
            nxt[i] = k
            if k < n:
                prv[k] = i
            for left, right in ((prv[i], i), (i, k)):
                if left >= 0 and right < n:
                    p = (sym[left], sym[right])
                    if p in pairs:
                        known = index.get(p)
                        if known is None:
                            index[p] = [left]
                            heapq.heappush(heap, (pairs[p][0], p))
                        else:
                            known.append(left)
    out = []
    for s in starts:
        one, i = [], s
        while sym[i] != -1:
            one.append(sym[i])
            i = nxt[i]
        out.append(one)
    return out


def _read(name: str, directory: str | None) -> str:
    with open(os.path.join(directory or TOKENIZER_DIR, f"{name}.json"), encoding="utf-8") as f:
        return f.read()


def encode(documents: DataFrame, tokenizer: str = "byte_bpe_50k", directory: str | None = None, key: str = "doc_id") -> DataFrame:
    """(doc_id, ids) of every document."""
    spark = documents.sparkSession
    raw = spark.sparkContext.broadcast(_read(tokenizer, directory))
    texts = documents.select(F.col(key).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chars = texts.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    n_chunks = int(max(1, spark.sparkContext.defaultParallelism, -(-chars // CHUNK_CHARS)))
    chunked = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.col("text")), F.lit(n_chunks)).cast("int"))

    def list_words(pdf: pd.DataFrame) -> pd.DataFrame:
        split = regex.compile(SPLIT).findall
        seen: set[str] = set()
        for t in pdf["text"]:
            seen.update(split(t))
        return pd.DataFrame({"chunk": np.int32(pdf["chunk"].iloc[0]), "word": list(seen)}, columns=["chunk", "word"]).astype({"chunk": "int32", "word": object})

    words = materialise(chunked.groupBy("chunk").applyInPandas(list_words, "chunk int, word string"), "encoding-words")

    def encode_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merges, held = None, []

        def turn() -> pd.DataFrame:
            nonlocal merges
            merges = merges or Merges(raw.value)
            out = pd.DataFrame({"word": held, "ids": replay(held, merges)})
            held.clear()
            return out

        for b in batches:
            held += list(b["word"])
            if len(held) >= REPLAY_WORDS:
                yield turn()
        if held:
            yield turn()

    distinct = words.select("word").distinct()
    table = distinct.mapInPandas(encode_words, "word string, ids array<int>")
    dictionary = words.join(table, "word")

    def rewrite(docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        ids = {w: np.asarray(i, dtype=np.int32) for w, i in zip(known["word"], known["ids"])}
        split = regex.compile(SPLIT).findall
        empty = np.zeros(0, dtype=np.int32)
        out = []
        for t in docs["text"]:
            parts = [ids[w] for w in split(t)]
            out.append(np.concatenate(parts) if parts else empty)
        return pd.DataFrame({"doc_id": docs["doc_id"], "ids": out})

    key_type = texts.schema["doc_id"].dataType.simpleString()
    return chunked.groupBy("chunk").cogroup(dictionary.groupBy("chunk")).applyInPandas(rewrite, f"doc_id {key_type}, ids array<int>")


def token_counts(documents: DataFrame, tokenizer: str = "byte_bpe_50k", directory: str | None = None, key: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens) of every document."""
    return encode(documents, tokenizer, directory, key).select("doc_id", F.size("ids").alias("n_tokens"))
