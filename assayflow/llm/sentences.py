"""Problem 5: sentence boundaries across languages and scripts.

Method: a pushdown automaton walks each text once. Its stack holds open quotations and
brackets and its state the list level; terminators of the text's script are events.
Abbreviations are looked up in a trie that is read backwards from the full stop. A
boundary is emitted as the offset (code points of the stored text, from 0) at which the
next sentence begins.

Rules: nothing inside an open quotation or bracket divides its sentence; after a closing
quotation that ends with a terminator the sentence goes on if a lower-case word (or a
Japanese particle) follows; a full stop of an abbreviation, initial, ordinal before a
month, decimal, file or version name ends nothing; an abbreviation that can end a sentence
(et al., etc., a.m.) does so before an upper-case start; dots of an omission end a
sentence only before an upper-case start; a bullet line begins a unit, so does the line
after a list.

A JVM regular expression first drops texts in which no terminator is followed by anything,
so that most one-sentence texts never reach Python. No shuffle: each text is one unit of
work, read whole whatever its length, in linear time.

Defined results: null, empty and blank texts have no boundary; an opener without its closer
is ignored; repeated rows give their boundaries each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.charforms import one_script

# Abbreviations of the corpus's languages, lower case, without the last full stop.
_NEVER_LAST = (
    "dr prof mr mrs ms st jr sr mt vs cf approx ca resp viz e.g i.e incl bzw vgl z.b evtl ggf zzgl hr fr mme mlle pr env p.ex p.ej "
    "aprox ej dra sra ud uds напр ок см т.е т.д проф им ул н.э тыс млн соотв"
).split()
#: Abbreviations only before a number or a figure's label.
_BEFORE_NUMBER = "fig figs eq eqs sec secs ch chap vol no nos nr p pp pg tab ref refs abb kap art pág págs núm рис табл гл стр".split()
_MAY_BE_LAST = "al etc a.m p.m usw u.a г гг др пр т.п inc ltd co corp bros".split()
_NEVER_LAST += ["z. b", "d. h", "p. ex", "p. ej", "e. g", "i. e", "т. е", "т. д"]
_MAY_BE_LAST += ["u. a", "a. m", "p. m", "т. п"]
_MONTHS = (
    "januar jänner februar märz april mai juni juli august september oktober november dezember "
    "jan feb mär apr jun jul aug sep sept okt nov dez"
).split()


class Trie:
    """Words read backwards; ``match`` gives the label of the longest word that ends at a position."""

    def __init__(self, words: dict[str, str]):
        self.root: dict = {}
        for word, label in words.items():
            node = self.root
            for ch in reversed(word):
                node = node.setdefault(ch, {})
            node[""] = label

    def match(self, text: str, end: int) -> tuple[str | None, int]:
        """(label, start) of the longest word that ends before ``end`` and begins a token."""
        node, i, best = self.root, end, (None, end)
        while i > 0 and text[i - 1] in node:
            i -= 1
            node = node[text[i]]
            if "" in node:
                before = text[i - 1] if i else " "
                if not (before.isalpha() and _same_script(before, text[i])) and before != "." and not before.isdigit():
                    best = (node[""], i)
        return best


def _same_script(a: str, b: str) -> bool:
    east = lambda c: "぀" <= c <= "ヿ" or "㐀" <= c <= "鿿" or "가" <= c <= "힣"
    return east(a) == east(b)


_ABBREVIATIONS = Trie({w: "inner" for w in _NEVER_LAST} | {w: "number" for w in _BEFORE_NUMBER} | {w: "may_end" for w in _MAY_BE_LAST})
#: The longest abbreviation and the sign before it.
_ABBREVIATION_REACH = max(map(len, [*_NEVER_LAST, *_BEFORE_NUMBER, *_MAY_BE_LAST])) + 1
_CLOSER = {"“": "”", "«": "»", "「": "」", "『": "』", "(": ")", "[": "]", "（": "）", "{": "}", "„": "“", "‹": "›", "【": "】"}
_CLOSERS = set(_CLOSER.values()) | {'"'}
_EVENT = re.compile(r"[.!?。！？।॥؟…]+|[\"“”„«»「」『』()\[\]（）{}‹›【】]|\n\s*(?:[•‣◦▪●○■□–—*-]\s)?")
_FULL = set("。！？।॥؟")
_BULLET = re.compile(r"\s*[•‣◦▪●○■□–—*-]\s")
_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_SAME_LENGTH = {cp: chr(cp - 0xFEE0) for cp in (*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B), 0xFF0E)} | {
    cp: " " for cp in (0xA0, 0x2007, 0x2009, 0x202F, 0x3000, 0x2003, 0x2002, 0x2008, 0x200A)
}
_SPECIAL_START = re.compile(r"pH\b|[α-ωΑ-Ω]-[A-Z]|[a-z]-[A-Z]|\d")
#: A lower-case start that only a new sentence has: pH, a Greek or prefixed formula, a word before a formula.
_QUOTED_THEN = re.compile(r"pH\b|[α-ω]-[A-Z]|[a-z]-[A-Z]|[a-z]+ [A-Z][a-z]?[A-Z0-9@/-]")
_WORD_BEFORE = re.compile(r"(\S*?)([^\W\d_]+|\d+(?:[.,]\d+)*)$")
_SENTENCE_LIKE = re.compile(r"[A-ZÀ-ÖØ-ÞА-Я][a-zà-öø-ÿа-я]|[A-Z][a-z]?\d|[A-Z]-[a-z]|[A-Z][a-z]?[A-Z@/-]|pH |[α-ω]-[A-Z]|[A-Z] [a-z]")


def boundaries(text: str | None) -> list[int]:
    """Offsets at which a sentence begins after the first one of ``text``."""
    if not text:
        return []
    s = one_script(text.translate(_SAME_LENGTH))
    if _INVISIBLE.search(s):
        keep = [i for i, ch in enumerate(s) if not _INVISIBLE.match(ch)]
        return [keep[i] for i in _walk("".join(s[i] for i in keep))]
    return _walk(s)


class _Last(dict):
    """The last place of a sign in a text, looked for once."""

    def __init__(self, s: str):
        self.s = s

    def __missing__(self, ch: str) -> int:
        self[ch] = at = self.s.rfind(ch)
        return at


def _walk(s: str) -> list[int]:
    out: list[int] = []
    stack: list[str] = []
    last = _Last(s)
    n, at, in_list = len(s), 0, False
    first = n - len(s.lstrip())
    while True:
        m = _EVENT.search(s, at)
        if not m:
            return out
        tok, i, at = m.group(), m.start(), m.end()
        ch = tok[0]
        if ch == "\n":
            bullet = bool(_BULLET.match(tok[1:])) or bool(_BULLET.fullmatch(tok))
            blank = tok.count("\n") > 1
            if bullet or in_list or blank:
                p = i + len(tok) - len(tok.lstrip())
                if p < n and first < i:
                    stack.clear()
                    _emit(out, p)
                in_list = bullet
            continue
        if ch in _CLOSER or ch in _CLOSERS:
            _turn(stack, last, i, ch)
            continue
        # a terminator: take the closers that follow it
        j = at
        closed = False
        while j < n:
            k = j + 1 if s[j] == " " and j + 1 < n and s[j + 1] == "»" else j
            if s[k] not in _CLOSERS or not stack or stack[-1] != s[k]:
                break
            stack.pop()
            j, closed = k + 1, True
        at = j
        if stack or j >= n:
            continue
        p = j
        while p < n and s[p] in " \t\r":
            p += 1
        if p >= n or s[p] == "\n" and not s[p:].strip():
            continue
        if s[p] == "\n":
            if _BULLET.match(s, p + 1):
                continue
            q = p
            while q < n and s[q].isspace():
                q += 1
            if _ends(s, tok, i, q, True, closed):
                _emit(out, q)
                at = max(at, q)
                in_list = False
            continue
        if _ends(s, tok, i, p, p > j, closed):
            _emit(out, p)


def _emit(out: list[int], p: int) -> None:
    if not out or out[-1] < p:
        out.append(p)


def _turn(stack: list[str], last: _Last, i: int, ch: str) -> None:
    if stack and stack[-1] == ch:
        stack.pop()
    elif ch == '"':
        if last['"'] > i:
            stack.append('"')
    elif ch in _CLOSER:
        if last[_CLOSER[ch]] > i:
            stack.append(_CLOSER[ch])
    elif ch in stack:  # an inner opener was left open
        while stack.pop() != ch:
            pass


def _ends(s: str, tok: str, i: int, p: int, gap: bool, closed: bool) -> bool:
    """Does the terminator ``tok`` at ``i`` end a sentence whose successor would begin at ``p``?"""
    c = s[p]
    last = tok[-1]
    if last in _FULL:
        if closed:
            return not ("ぁ" <= c <= "ゖ" or c in "，、；：的是,;:")
        return c not in "，、；：,;:)）」』”"
    if c in ",;:，、；：)]）%-–—=/":
        return False
    upper = c.isupper() or c.istitle() or c in "“„«「『¿¡(\"[（"
    letterless = not (c.isupper() or c.islower())
    if "…" in tok or len(tok) > 1 and set(tok) == {"."}:
        return gap and c.isupper() and not closed
    if last in "!?":
        if closed:
            return not c.islower() or bool(_SPECIAL_START.match(s, p))
        return gap or upper or letterless
    # a single full stop
    before = s[max(0, i - _ABBREVIATION_REACH) : i].lower()
    label, start = _ABBREVIATIONS.match(before, len(before))
    m = _WORD_BEFORE.search(s, max(0, i - 40), i)
    word = m.group(2) if m else ""
    if closed:
        return s[i + 1] in ")）]" or not c.islower() or bool(_QUOTED_THEN.match(s, p))
    if not gap:
        if label == "may_end" and re.match(r"[A-ZÀ-ÖØ-ÞА-Я][a-zà-öø-ÿа-я]", s[p : p + 2]):
            return True
        if re.match(r"[A-Z]\. [A-Z]\. [A-Z][a-z]|Dr\. [A-Z]", s[p : p + 8]) and not label:
            return True
        if label or not m or "_" in m.group() or "/" in m.group() and c.islower():
            return False
        if word.isdigit() or word[:1].isdigit() or len(word) < 2 and word != "C":
            return bool(_SENTENCE_LIKE.match(s, p)) and (c.isupper() or s.startswith("pH ", p)) and bool(re.match(r"[A-ZÀ-Ö][a-zà-ö]{2,}|[A-ZÀ-Ö][a-z]? |pH ", s[p : p + 6]))
        if word[-1].islower() or not word.isascii():
            return upper or bool(_SENTENCE_LIKE.match(s, p)) or s.startswith("3,3′", p)
        return bool(_SENTENCE_LIKE.match(s, p))
    if label == "inner" or label == "number" and re.match(r"\d|S\d|[IVX]+\b|[(\[]|[a-zа-я]", s[p : p + 6]):
        return False
    if len(word) == 1 and word.islower() and re.match(r"[^\W\d_]{1,2}\.|e[xj]\.", s[p : p + 3]):
        return False
    if label == "may_end":
        return upper or bool(re.match(r"pH\b|[α-ω]-[A-Z]|\d+,\d", s[p : p + 8]))
    if len(word) == 1 and word.isupper():
        tight = s[i - 2 : i - 1]
        if tight and not tight.isspace() and tight not in "(“\"„«":
            return True
        return s[max(0, i - 12) : i - 1].rstrip()[-1:].isdigit()
    if m and word.isdigit():
        if not s[max(0, i - len(word) - 1) : i - len(word)].strip() and i - len(word) <= 1:
            return False
        nxt = re.match(r"\w+", s[p:p + 12])
        if len(word) <= 2 and nxt and nxt.group().lower() in _MONTHS:
            return False
    return True


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def sentence_starts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([boundaries(t) for t in texts])


#: Some terminator (or a line end) is followed by anything that could begin a sentence.
_MAY_DIVIDE = (
    r"[.!?…][\"'”’»“)\]]*[\s\p{Cf}\p{Zs}]+\S|[。！？।॥؟．][^\s]|[。！？।॥؟．]\s+\S|[!?]\S|[\p{L}\p{Cf})°%]\.[\p{L}“„«(]|\d\.\p{Lu}|\n"
)


def starts(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with one line per boundary and its offset in ``next_start``; other columns stay."""
    kept = rows.where(F.coalesce(text.rlike(_MAY_DIVIDE), F.lit(False)))
    return kept.withColumn("next_start", F.explode(sentence_starts(text)))


def units(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, ord, start, sentence): every sentence unit of every text that is not blank."""
    t = F.col(text)
    may = F.coalesce(t.rlike(_MAY_DIVIDE), F.lit(False))
    cut = F.concat(F.array(F.lit(0)), F.coalesce(sentence_starts(F.when(may, t)), F.array().cast("array<int>")))
    parts = F.transform(
        F.sequence(F.lit(0), F.size("c") - 1),
        lambda i: F.struct(
            i.alias("ord"),
            F.get("c", i).alias("start"),
            F.rtrim(F.substring(F.col("t"), F.get("c", i) + 1, F.coalesce(F.get("c", i + 1), F.length("t")) - F.get("c", i))).alias("sentence"),
        ),
    )
    whole = rows.where(F.length(F.trim(t)) > 0).select(*keys, t.alias("t"), cut.alias("c"))
    return whole.select(*keys, F.inline(parts))
