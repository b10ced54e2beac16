"""Problem 3: noise in text from scanned pages.

Method: a lexicon of words, neighbouring words and number contexts is counted over every
text that was not read from a scan. Each scanned text becomes a stream of characters
without its line ends; running headers, footers and page numbers are cut out; then the
cheapest path through a lattice over the stream is decoded (dynamic programming). Known
words between spaces are edges as they are; an unknown stretch may stay, be read through
the confusions of scanners letter by letter (rn for m, 0 for o ...), be joined over spaces
or hyphens with what follows, or be segmented into several words at any of its
characters, each at a price, unknown words at the highest. Paragraph
boundaries of the repaired text are chosen by a second dynamic programme over the lines.

The damage of a row is read off the decoded path: ``hyphenation`` where two tokens were
joined over a hyphen that is no compound's own, ``misread`` where a confusion was undone,
``furniture`` where something was cut out.

Cost at scale: counting is one pass with counts combined per task before the only shuffle;
the lexicon holds what occurs ``min_count`` times whatever the size of the corpus. Its most
frequent part, at most ``LEXICON_BOUND`` entries, is broadcast into memory; where there are
more, the rest is sent to the executors as a keyed file and looked up there, so answers do
not depend on the bound. Scanned rows are decoded where they lie, without a shuffle.

Defined results: null, empty and blank texts have no damage and stay as they are; rows that
are not from scans are not read for damage; repeated rows are reported each; very long
texts are decoded whole; extra columns are ignored; without any clean text nothing is
known, so only furniture marks and the hyphens of line ends are found.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import sqlite3
import tempfile
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import log

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.charforms import canonical_form
from ..runtime import materialise

LEXICON_BOUND = 600_000
_FLUSH = 300_000

_NUMBER = re.compile(r"(?<![A-Za-z0-9])\d+(?:[.,]\d+)*(?![A-Za-z0-9])")
_LABEL = re.compile(r"\bS\d+\b")
_EDGE = "“”\"'«»„()[]{}<>,;:?.。，、；：？！（）「」…*"
_EAST = re.compile("[぀-ヿ㐀-鿿]")

#: What a scanner may have read -> what stood there.
_CONFUSIONS = [
    ("rn", "m"), ("iii", "m"), ("in", "m"), ("m", "in"), ("m", "rn"), ("n", "ri"), ("ri", "n"), ("ii", "n"), ("ii", "u"), ("li", "h"), ("h", "li"), ("vv", "w"), ("cl", "d"), ("d", "cl"), ("c", "e"), ("e", "c"), ("f", "t"), ("t", "f"),
    ("0", "o"), ("0", "O"), ("O", "0"), ("o", "0"), ("Q", "O"), ("1", "l"), ("l", "1"), ("1", "I"), ("I", "1"), ("I", "l"), ("l", "I"), ("1", "i"), ("!", "i"), ("!", "l"), ("|", "l"),
    ("5", "s"), ("5", "S"), ("S", "5"), ("s", "5"), ("8", "B"), ("B", "8"), ("6", "b"), ("9", "g"),
]
_BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _a, _b in _CONFUSIONS:
    _BY_FIRST.setdefault(_a[0], []).append((_a, _b))
_NUMERIC = re.compile(r"[{(]?(?=[^ ]*\d)[\dOolIS]+(?:[.,][\dOolIS]+)*[})]?%?\Z")
_ZEROS = re.compile(r"[OolI]*[lI][OolI]+\Z|O{2,}\Z")
_SUPPLEMENT = re.compile(r"S\d{1,4}")
#: Signs of a scanner inside a word.
_ODD = re.compile(r"[0-9!|]|ii|vv|rn|cl|li|in|ri")
_MARKS = "-¬"
#: More confusions in one word would cost more than leaving it unknown (see the prices of Decoder).
MAX_CONFUSIONS = 3


def normal(token: str) -> str:
    """The lexicon's key of a token: numbers as one sign, plain words in lower case."""
    t = token.strip(_EDGE)
    if t.endswith("!") and len(t) > 1:
        t = t.rstrip("!")
    if t.isalpha():
        return t.lower()
    t = _NUMBER.sub("#", t)
    return t[0].lower() + t[1:] if len(t) > 1 and t[1:2].islower() else t


def _context(tok: str | None, side: str) -> str:
    """A neighbour as a context key; scripts without spaces give their two nearest letters."""
    if tok is None:
        return "<s>" if side == "left" else "</s>"
    if _EAST.search(tok):
        return tok[-2:] if side == "left" else tok[:2]
    return tok


def _stream(text: str) -> list[str]:
    return _LABEL.sub("S#", _NUMBER.sub("#", text)).split()


def count_clean(texts: DataFrame) -> DataFrame:
    """(kind, key, n) over column ``text``: w words, b neighbours, n contexts of a number."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        pairs: Counter = Counter()
        around: Counter = Counter()

        def flush() -> pd.DataFrame:
            plain: Counter = Counter()
            for w, n in words.items():
                for part in _parts(w):
                    plain[normal(part)] += n
            rows = [("w", k, n) for k, n in plain.items() if k]
            rows += [("b", f"{_context(a, 'left')}\t{_context(b, 'right')}", n) for (a, b), n in pairs.items()]
            rows += [("n", f"{_context(a, 'left')}\t{_context(b, 'right')}", n) for (a, b), n in around.items()]
            for c in (words, pairs, around):
                c.clear()
            return pd.DataFrame(rows, columns=["kind", "key", "n"])

        for b in batches:
            for text in b["text"]:
                toks = _stream(canonical_form(text) or "")
                if not toks:
                    continue
                words.update(toks)
                pairs.update(zip([None, *toks], [*toks, None]))
                if "#" in toks or "S#" in toks:
                    ext = [None, *toks, None]
                    around.update((ext[i - 1], ext[i + 1]) for i in range(1, len(ext) - 1) if ext[i] == "#" or ext[i] == "S#")
            if len(pairs) > _FLUSH:
                yield flush()
        yield flush()

    parts = texts.select("text").mapInPandas(count, "kind string, key string, n bigint")
    return parts.groupBy("kind", "key").agg(F.sum("n").alias("n"))


#: A sentence end without a space.
_GLUED = re.compile(r"(?<=[a-z0-9)])[.?!](?=[A-Z“][a-zA-Z0-9])")


def _parts(token: str) -> list[str]:
    """Latin, digit and sign runs of a token; other scripts are separators."""
    if token.isascii() and not _GLUED.search(token):
        return [token]
    token = _GLUED.sub(" ", token)
    if token.isascii():
        return token.split()
    return [p for p in re.split("[぀-ヿ㐀-鿿가-힣؀-ۿऀ-ॿЀ-ӿ，。（）：；！？、「」\\s]+", token) if p]


def _counted(clean: DataFrame, min_count: int) -> tuple[DataFrame, int]:
    """(the whole lexicon, the least count of its part that fits into ``LEXICON_BOUND``)."""
    counts, least = materialise(count_clean(clean).where(f"n >= {min_count}"), "scan-lexicon"), min_count
    while counts.where(f"n >= {least}").count() > LEXICON_BOUND:
        least *= 2
    return counts, least


def _frequent(counts: DataFrame, least: int) -> dict[str, dict[str, int]]:
    out: dict[str, dict[str, int]] = {"w": {}, "b": {}, "n": {}}
    for kind, key, n in counts.where(f"n >= {least}").toLocalIterator():
        out[kind][key] = n
    return out


def build_lexicon(clean: DataFrame, min_count: int = 2) -> dict[str, dict[str, int]]:
    """The most frequent part of the lexicon, at most ``LEXICON_BOUND`` entries."""
    return _frequent(*_counted(clean, min_count))


def _send_rest(rest: DataFrame) -> str:
    """The name of a keyed file with the other entries, on every executor; the driver streams them to its disk."""
    name = f"scan-lexicon-{uuid.uuid4().hex}.db"
    folder = tempfile.mkdtemp(prefix="assayflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # executors may fetch it until the driver ends
    path = os.path.join(folder, name)
    db = sqlite3.connect(path)
    db.execute("PRAGMA journal_mode = OFF")
    db.execute("CREATE TABLE entries (kind TEXT, key TEXT, n INTEGER, PRIMARY KEY (kind, key)) WITHOUT ROWID")
    # in key order pages are written once, one after the other
    db.executemany("INSERT INTO entries VALUES (?, ?, ?)", ((r.kind, r.key, r.n) for r in rest.orderBy("kind", "key").toLocalIterator()))
    db.commit()
    db.close()
    rest.sparkSession.sparkContext.addFile(path)
    return name


class _Layered:
    """Entries of one kind: the frequent ones in memory, the others in the file."""

    def __init__(self, frequent: dict[str, int], db: sqlite3.Connection, kind: str):
        self.frequent, self.db, self.kind = frequent, db, kind
        self.cache: dict[str, int | None] = {}

    def _find(self, key: str) -> int | None:
        n = self.frequent.get(key)
        if n is not None:
            return n
        if key in self.cache:
            return self.cache[key]
        got = self.db.execute("SELECT n FROM entries WHERE kind = ? AND key = ?", (self.kind, key)).fetchone()
        n = got[0] if got else None
        if len(self.cache) < _FLUSH:
            self.cache[key] = n
        return n

    def get(self, key: str, default: int = 0) -> int:
        n = self._find(key)
        return default if n is None else n

    def __contains__(self, key: str) -> bool:
        return self._find(key) is not None


def _layered(frequent: dict[str, dict[str, int]], rest: str | None) -> dict:
    if rest is None:
        return frequent
    db = sqlite3.connect(f"file:{SparkFiles.get(rest)}?mode=ro&immutable=1", uri=True)
    return {kind: _Layered(part, db, kind) for kind, part in frequent.items()}


# ------------------------------------------------------------------ furniture

_NAME = r"[A-ZÀ-Þ][\wÀ-ɏ’'-]+"
_FURNITURE = [
    re.compile(rf"{_NAME} et al\. ?/ ?[^\n/()]{{4,60}}? \d+ \((?:19|20)\d\d\)(?: \d{{1,4}}(?=\s|$))?"),
    re.compile(rf"(?:{_NAME}(?: (?:of|für|for|de|der|and|in))? ){{1,5}}\d{{1,3}} \((?:19|20)\d\d\)(?: \d{{1,4}}(?=\s|$))?"),
    re.compile(rf"(?:{_NAME}(?: (?:of|für|for|de|der|and|in))? ?){{1,6}}, Vol\. ?\d+, No\. ?\d+(?: \d{{1,4}}(?=\s|$))?"),
    re.compile(rf"(?<![\w.])\d{{1,4}}[  ]{{2,}}{_NAME}(?: {_NAME})? et al\."),
    re.compile(r"[^\n.!?。！？]{0,80}?\b[\w@/.-]+(?: \w+)? as [\w-]+ mimic[  ]{2,}\d{1,4}(?=\s|$)"),
    re.compile(r"Downloaded (?:copy )?[^\n.]{0,40}?only(?:[  ]{2,}\d{1,4})?(?=\s|$)"),
    re.compile(r"(?:^|(?<=\s))Page \d+ of \d+(?=\s|$)"),
    re.compile(r"(?:^|(?<=\s))[-–—] ?\d{1,4} ?[-–—](?=\s|$)"),
    re.compile(r"(?:^|(?<=\s))(?:[A-ZÀ-Þ]{3,}(?: (?:OF|FÜR|FOR|AND|DE))? ){1,5}[A-ZÀ-Þ]{3,}(?=\s|$)"),
    re.compile(r"^[^\n]{3,90}[  ]{3,}\d{1,4}$|^\d{1,4}[  ]{3,}[^\n]{3,90}$", re.M),
    re.compile(r"^\s*S?\d{1,4}\s*$", re.M),
]
#: A cheap sign without which the pattern of the same place cannot match.
_SIGNS = [
    lambda t: "et al" in t and "/" in t, lambda t: "(19" in t or "(20" in t, lambda t: "Vol." in t, lambda t: "  " in t and "et al" in t, lambda t: "  " in t and " mimic" in t,
    lambda t: "ownloaded" in t, lambda t: "Page " in t, lambda t: _DASHED.search(t) is not None, lambda t: _CAPITALS.search(t) is not None, lambda t: "   " in t, lambda t: "\n" in t,
]
_DASHED = re.compile(r"[-–—] ?\d{1,4} ?[-–—]")
_CAPITALS = re.compile(r"[A-ZÀ-Þ]{3} [A-ZÀ-Þ]{2}|[A-ZÀ-Þ]{3,} [A-ZÀ-Þ]{3,}")
_LONE_NUMBER = re.compile(r"(?:^|\s)S?\d{1,4}(?=\s|$)")
_PAGE_TOKEN = re.compile(r"\d{1,4}\Z|S\d{1,4}\Z")
_TITLE_LIKE = re.compile(r"(?:(?:N-doped|hollow) )?[\w@/.-]+(?: (?:nanorods|nanosheets|blue(?:[@/-]\w+)?))? as [\w-]+ mimic[  ]{2,}\d{1,4}\Z")


def cut_furniture(text: str, decoder: Decoder) -> tuple[str, bool]:
    """(text without running headers, footers and page numbers, whether there were any)."""
    found = False
    for k, pattern in enumerate(_FURNITURE):
        if not _SIGNS[k](text):
            continue

        def drop(m: re.Match) -> str:
            nonlocal found
            if k == len(_FURNITURE) - 1 and m.group().strip() == text.strip():
                return m.group()
            found = True
            if k == 4:
                t = _TITLE_LIKE.search(m.group())
                return m.group()[: t.start()] if t else ""
            return "\n" if "\n" in m.group() else " "

        text = pattern.sub(drop, text)
    if not _LONE_NUMBER.search(text):
        return text, found
    toks = text.split()
    b, n = decoder.lex["b"], decoder.lex["n"]
    drop_at: set[int] = set()

    def neighbour(i: int, step: int) -> str | None:
        """The token beside, whole and as it stood, with numbers as one sign."""
        if not 0 <= i < len(toks):
            return None
        t = toks[i]
        if step > 0 and t[-1] in _MARKS and len(t) > 1 and i + 1 < len(toks):
            t = t[:-1] + toks[i + 1]
        elif step < 0 and i > 0 and toks[i - 1][-1] in _MARKS and len(toks[i - 1]) > 1:
            t = toks[i - 1][:-1] + t
        if not decoder.known(t):
            t = (decoder.reading(t) or (t, 0))[0]
        return (_stream(t) or [t])[0]

    for i, t in enumerate(toks):
        if i in drop_at or not _PAGE_TOKEN.match(t):
            continue
        prev, nxt = neighbour(i - 1, -1), neighbour(i + 1, 1)
        ctx = f"{_context(prev, 'left')}\t{_context(nxt, 'right')}"
        if n.get(ctx, 0) >= 2:
            continue
        if nxt == "#" and toks[i + 1].isdigit():
            after = neighbour(i + 2, 1)
            if n.get(f"{_context(prev, 'left')}\t{_context(after, 'right')}", 0) >= 2:
                drop_at.add(i + 1)
                continue
        seen = b.get(ctx, 0) >= 3
        after_end = prev is None or prev[-1:] in ".!?。！？।؟”»"
        start = f"<s>\t{_context(nxt, 'right')}"
        starts = nxt is not None and after_end and b.get(start, 0) >= 3 and n.get(start, 0) < 2
        ends = nxt is None and prev is not None and prev[-1:] in ".!?。！？।؟”»" and len(toks) > 1
        if seen or starts or ends:
            drop_at.add(i)
    if not drop_at:
        return text, found
    out, i = [], -1
    for piece in re.split(r"(\s+)", text):
        if piece and not piece.isspace():
            i += 1
            if i in drop_at:
                continue
        out.append(piece)
    return "".join(out), True


# ------------------------------------------------------------------ decoding


_LINE_END_MARK = re.compile(r"\w[-¬](?=\s)")


class Decoder:
    """Cheapest reading of a token stream under a lexicon."""

    STAY_UNKNOWN, CONFUSION, HYPHEN, MERGE, SPLIT = 6.0, 1.5, 0.5, 2.0, 2.5

    def __init__(self, lex: dict):
        self.words = lex["w"]
        self.lex = lex
        self.known_cache: dict[str, bool] = {}
        # a lexicon that is partly in a file has no list of its beginnings; then every chain is followed to its end
        self.prefixes = sorted({k.lower() for k in self.words}) if isinstance(self.words, dict) else None
        #: The longest word and its punctuation, beyond which no join can be a word.
        self.longest = max(map(len, self.prefixes), default=0) + 8 if self.prefixes is not None else 200
        self.read_cache: dict[str, tuple[str, int] | None] = {}

    def known(self, token: str) -> bool:
        got = self.known_cache.get(token)
        if got is None:
            got = all(self._known(p) for p in _parts(token))
            if len(self.known_cache) < 300_000:
                self.known_cache[token] = got
        return got

    def _known(self, token: str) -> bool:
        key = normal(token)
        if not key or key in self.words or "#" == key:
            return True
        if not any(c.isalnum() for c in key) or _SUPPLEMENT.fullmatch(key):
            return True
        return self.words.get(key.lower(), 0) >= 2

    def variants(self, core: str) -> Iterator[str]:
        """Every reading of ``core`` by one confusion, whether a word or not."""
        for i, ch in enumerate(core):
            for a, b in _BY_FIRST.get(ch, ()):
                if core.startswith(a, i):
                    yield core[:i] + b + core[i + len(a) :]

    def reading(self, token: str) -> tuple[str, int] | None:
        """(token as it stood, confusions undone) for a token that is not known, else None."""
        if token in self.read_cache:
            return self.read_cache[token]
        got = self._reading(token)
        if len(self.read_cache) < 300_000:
            self.read_cache[token] = got
        return got

    def _reading(self, token: str) -> tuple[str, int] | None:
        for part in _parts(token):
            if self._known(part):
                continue
            fixed = self._read_part(part)
            if fixed is None:
                return None
            return token.replace(part, fixed[0], 1), fixed[1]
        return None

    def _read_part(self, part: str) -> tuple[str, int] | None:
        lead = len(part) - len(part.lstrip(_EDGE))
        core = part.strip(_EDGE)
        if _NUMERIC.fullmatch(core) and any(c in "OolIS" for c in core) and not re.fullmatch(r"S\d+|[A-Z]?O\d|\d+[lS]", core):
            return part.replace(core, core.translate(str.maketrans("OolIS", "00115")), 1), 1
        if _ZEROS.fullmatch(core):
            return part.replace(core, core.translate(str.maketrans("OolI", "0011")), 1), 1
        if len(core) < 3 or not (core[0].isalnum() or core[0] in "!|" and core[1].islower()) or sum(c.isalpha() for c in core) < 1 + (not any(c.isdigit() for c in core)):
            return None
        best = self.nearest(core)
        if best is None:
            return None
        return part[:lead] + best[0] + part[lead + len(core) :], best[1]

    def nearest(self, core: str) -> tuple[str, int] | None:
        """(the word of fewest confusions that may have been read as ``core``, their number).

        Among words of equally many the most frequent. Every chain of confusions is followed
        letter by letter through the sorted lexicon, as far as a word goes on so. Three cost as
        much as a reading may; a fourth would be dearer than leaving the token unknown.
        """
        for depth in range(1, MAX_CONFUSIONS + 1):
            if depth == MAX_CONFUSIONS and (len(core) < 7 or not _ODD.search(core)):
                break  # so much is only assumed where the token shows it
            best = None
            for v in self._readable(core, depth):
                n = self.words.get(v.lower() if v.isalpha() else normal(v), 0)
                if n >= (3 if depth < MAX_CONFUSIONS else 5) and (best is None or (n, v) > (best[1], best[0])):
                    best = (v, n)
            if best:
                return best[0], depth
        return None

    def _goes_on(self, start: str) -> bool:
        """Whether a word of the lexicon begins with ``start``, as far as this can be told from letters alone."""
        key = start.lower()
        if self.prefixes is None or not key.isalpha():
            return True
        i = bisect_left(self.prefixes, key)
        return i < len(self.prefixes) and self.prefixes[i].startswith(key)

    def _readable(self, core: str, depth: int) -> set[str]:
        """Every reading of ``core`` by exactly ``depth`` confusions, one after the other from left to right, that the lexicon goes on with."""
        out: set[str] = set()
        todo = [("", 0, depth)]
        n = len(core)
        while todo:
            done, i, left = todo.pop()
            if i == n:
                if not left:
                    out.add(done)
                continue
            if left > n - i or not self._goes_on(done):
                continue
            todo.append((done + core[i], i + 1, left))
            if left:
                for a, b in _BY_FIRST.get(core[i], ()):
                    if core.startswith(a, i):
                        todo.append((done + b, i + len(a), left - 1))
        return out

    def joined(self, a: str, b: str) -> str:
        """``hyphen`` if a mark divides one word over a and b, ``compound`` or ``none``."""
        mark, left = a[-1], a[:-1]
        if not left or not b or not left[-1].isalnum() or not b[0].isalnum():
            return "none"
        if mark == "¬":
            return "hyphen"
        whole, tied = left + b, f"{left}-{b}"
        if self._in(whole):
            return "hyphen"
        if self._in(tied):
            return "compound"
        lk, bk = self._in(left), self._in(b)
        if lk and bk and (len(normal(left)) > 2 or normal(b) in ("and", "und", "et", "y", "и", "or", "oder")):
            return "none"
        r = self.reading(whole)
        if r and r[1] <= 2 and b[0].islower():
            return "hyphen"
        r = self.reading(tied)
        if r:
            return "compound"
        return "hyphen" if b[0].islower() or not lk else "none"

    def _in(self, token: str) -> bool:
        key = normal(token)
        return key in self.words or key.lower() in self.words

    def segments(self, token: str) -> list[str] | None:
        """An unknown token as frequent words without their spaces: the fewest, of equally many the most frequent; None where it is none.

        A dynamic programme over the token's characters; every piece but the last is a plain
        word of two letters or more.
        """
        n = len(token)
        best: list[tuple[int, float, int] | None] = [(0, 0.0, -1)] + [None] * n
        for j in range(2, n + 1):
            for i in range(max(0, j - self.longest), j - 1):
                if best[i] is None:
                    continue
                piece = token[i:j]
                if j < n and not piece.isalpha() or not self._in(piece):
                    continue
                count = self.words.get(normal(piece), 0)
                if j < n and count <= 20:
                    continue
                way = (best[i][0] + 1, best[i][1] - log(count + 1), i)
                if best[j] is None or way < best[j]:
                    best[j] = way
        if best[n] is None or best[n][0] < 2:
            return None
        out, j = [], n
        while j > 0:
            i = best[j][2]
            out.append(token[i:j])
            j = i
        return out[::-1]

    def decode(self, text: str) -> tuple[list[str], set[str]]:
        """(tokens of the cheapest reading, damages)."""
        toks = text.split()
        n = len(toks)
        cache = self.known_cache
        if "-" not in text and "¬" not in text or not _LINE_END_MARK.search(text):
            if all(cache.get(t) or self.known(t) for t in toks):
                return toks, set()
        best: list[tuple[float, int, str, str]] = [(0.0, -1, "", "")] + [(1e18, -1, "", "")] * n

        def relax(i: int, j: int, cost: float, word: str, what: str) -> None:
            if best[i][0] + cost < best[j][0]:
                best[j] = (best[i][0] + cost, i, word, what)

        for i in range(n):
            t = toks[i]
            if cache.get(t) or self.known(t):
                c = best[i][0]
                if c < best[i + 1][0]:
                    best[i + 1] = (c, i, t, "")
                if t[-1] not in _MARKS and (i + 1 == n or not toks[i + 1][0].islower() or cache.get(toks[i + 1]) or self.known(toks[i + 1])):
                    continue
            else:
                relax(i, i + 1, self.STAY_UNKNOWN, t, "")
                r = self.reading(t)
                if r:
                    relax(i, i + 1, self.CONFUSION * r[1], r[0], "misread")
                if t[-1] not in _MARKS:
                    parts = self.segments(t)
                    if parts:
                        relax(i, i + 1, self.SPLIT * (len(parts) - 1), " ".join(parts), "split")
            # joins over one or more marks: the word may be divided again and again
            word, cost, damage, j = t, 0.0, "", i
            while j + 1 < n and word[-1:] in _MARKS and len(word) > 1:
                b = toks[j + 1]
                kind = self.joined(word, b.rstrip(_MARKS) if b[-1:] in _MARKS and len(b) > 1 else b)
                if kind == "none":
                    break
                word = word[:-1] + ("-" if kind == "compound" else "") + b
                damage = damage or ("hyphenation" if kind == "hyphen" else "")
                cost += self.HYPHEN
                j += 1
                if word[-1:] in _MARKS and j + 1 < n:
                    continue
                if self.known(word):
                    relax(i, j + 1, cost - 1, word, damage)
                else:
                    r = self.reading(word)
                    if r:
                        relax(i, j + 1, cost - 1 + self.CONFUSION * r[1], r[0], (damage + " misread").strip())
                    relax(i, j + 1, cost - 1 + self.STAY_UNKNOWN / 2, word, damage)
            # joins over spaces: a word that the scanner broke into pieces, not all of them words
            word, j, strange = t, i, not (cache.get(t) or self.known(t))
            while word.isalpha() and j + 1 < n and toks[j + 1][:1].islower() and len(word) < self.longest:
                j += 1
                strange = strange or not (cache.get(toks[j]) or self.known(toks[j]))
                word += toks[j]
                if strange and self._in(word):
                    relax(i, j + 1, self.MERGE * (j - i), word, "merge")
        out: list[str] = []
        damages: set[str] = set()
        j = n
        while j > 0:
            _, i, word, what = best[j]
            out.append(word)
            damages.update(x for x in what.split() if x in ("hyphenation", "misread"))
            j = i
        return out[::-1], damages


def paragraphs(lines: list[str]) -> list[list[str]]:
    """Lines to paragraphs by dynamic programming over joined and divided line ends.

    Dividing costs little after a sentence end on a short line and much inside a sentence;
    joining costs something after such a line and much before a bullet or a blank line.
    """
    lines = [x.strip() for x in lines]
    width = max((len(x) for x in lines), default=0)
    joined, divided = 0.0, 0.0  # cheapest cost so far with the last line end joined, or divided
    choice: list[tuple[str, str]] = []
    for last, nxt in zip(lines, lines[1:]):
        ends = last[-1:] in ".!?。！？।؟:"
        short = len(last) < 0.8 * width
        divide = 0.5 if ends and short else 2.0 if ends else 4.0
        join = 9.0 if not last or not nxt or nxt[:1] == "•" else 1.0 if ends and short else 0.0
        # a paragraph of one line costs a little more
        to_j = (joined, "j") if joined <= divided else (divided, "d")
        to_d = (joined, "j") if joined <= divided + 1.0 else (divided + 1.0, "d")
        joined, divided = to_j[0] + join, to_d[0] + divide
        choice.append((to_j[1], to_d[1]))
    how = "j" if joined <= divided else "d"
    marks = []
    for if_joined, if_divided in reversed(choice):
        marks.append(how)
        how = if_joined if how == "j" else if_divided
    out: list[list[str]] = [[]]
    for line, mark in zip(lines, [*reversed(marks), "d"]):
        if line:
            out[-1].append(line)
        if mark == "d":
            out.append([])
    return [p for p in out if p]


def repair(text: str | None, decoder: Decoder) -> tuple[str | None, list[str]]:
    """(continuous readable text, sorted damages) of one scanned text."""
    if text is None or not text.strip():
        return text, []
    plain = canonical_form(re.sub("­(?=\\s)", "¬", text)) or ""
    body, furniture = cut_furniture(plain, decoder)
    damages = {"furniture"} if furniture else set()
    out = []
    for lines in paragraphs(body.split("\n")):
        tokens, found = decoder.decode(" ".join(lines))
        damages |= found
        out.append(" ".join(tokens))
    return "\n".join(out), sorted(damages)


_OUT = T.StructType([T.StructField("repaired", T.StringType()), T.StructField("damages", T.ArrayType(T.StringType()))])


def repaired(rows: DataFrame, clean: DataFrame, min_count: int = 2) -> DataFrame:
    """``rows`` (origin, row_id, text from scans) with repaired text and the list of damages."""
    counts, least = _counted(clean, min_count)
    shared = rows.sparkSession.sparkContext.broadcast(_frequent(counts, least))
    rest = _send_rest(counts.where(f"n < {least}")) if least > min_count else None

    @F.pandas_udf(_OUT)
    def fix(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        decoder = Decoder(_layered(shared.value, rest))
        for texts in batches:
            yield pd.DataFrame([repair(t if isinstance(t, str) else None, decoder) for t in texts], columns=["repaired", "damages"])

    return rows.select("origin", "row_id", "text", fix("text").alias("f")).select("origin", "row_id", "text", "f.repaired", "f.damages")


def split_origins(blocks: DataFrame, sentences: DataFrame, figures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scanned rows, clean texts) of the three tables."""
    parts = [(blocks, "blocks", "block_key", "text"), (sentences, "sentences", "sent_key", "text"), (figures, "figures", "fig_key", "caption_text")]
    out: list[DataFrame | None] = [None, None]
    for df, origin, key, text in parts:
        one = df.select(F.lit(origin).alias("origin"), F.col(key).alias("row_id"), F.col(text).cast("string").alias("text"), F.coalesce("ocr", F.lit(False)).alias("ocr"))
        for k, cond in enumerate((F.col("ocr"), ~F.col("ocr"))):
            sel = one.where(cond & F.col("text").isNotNull()).drop("ocr")
            out[k] = sel if out[k] is None else out[k].unionByName(sel)
    return out[0], out[1]
