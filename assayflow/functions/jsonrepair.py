"""Reading JSON replies that are not quite JSON.

``loads_lenient`` parses the unmodified text first and repairs only on failure: prose and
code fences around the object, single quotes, bare keys, Python and JavaScript literals,
comments, trailing commas, raw control characters and a missing end. A hand-written
reader walks the text once, so the work is linear in its length. Of duplicate keys the
last value that is not null counts.
"""

from __future__ import annotations

import json
import re

_NUMBER = re.compile(r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?")
_BARE = re.compile(r"[^\s,:\[\]{}\"']+")
_LITERALS = {"null": None, "none": None, "nan": None, "undefined": None, "nil": None, "true": True, "false": False}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}
MAX_DEPTH = 200


def _pairs(pairs: list[tuple[str, object]]) -> dict:
    out: dict = {}
    for k, v in pairs:
        if v is not None or k not in out:
            out[k] = v
    return out


class _Reader:
    def __init__(self, text: str):
        self.s, self.i, self.n = text, 0, len(text)

    def skip(self) -> None:
        s, n = self.s, self.n
        while self.i < n:
            ch = s[self.i]
            if ch.isspace() or ch == "﻿":
                self.i += 1
            elif s.startswith("//", self.i):
                end = s.find("\n", self.i)
                self.i = n if end < 0 else end
            elif s.startswith("/*", self.i):
                end = s.find("*/", self.i)
                self.i = n if end < 0 else end + 2
            else:
                return

    def value(self, depth: int = 0):
        self.skip()
        if self.i >= self.n or depth > MAX_DEPTH:
            self.i = self.n if depth > MAX_DEPTH else self.i
            return None
        ch = self.s[self.i]
        if ch == "{":
            return self.mapping(depth)
        if ch == "[":
            return self.sequence(depth)
        if ch in "\"'“”":
            return self.string(ch)
        m = _NUMBER.match(self.s, self.i)
        if m and (m.end() == self.n or self.s[m.end()] in ",]} \n\r\t"):
            self.i = m.end()
            word = m.group()
            return float(word) if re.search(r"[.eE]", word) else int(word)
        m = _BARE.match(self.s, self.i)
        if not m:
            self.i += 1
            return None
        self.i = m.end()
        word = m.group()
        return _LITERALS.get(word.lower(), word)

    def string(self, quote: str) -> str:
        close = {"“": "”"}.get(quote, quote)
        out, s = [], self.s
        self.i += 1
        while self.i < self.n:
            ch = s[self.i]
            if ch == "\\" and self.i + 1 < self.n:
                nxt = s[self.i + 1]
                if nxt == "u" and re.match(r"[0-9a-fA-F]{4}", s[self.i + 2 : self.i + 6]):
                    out.append(chr(int(s[self.i + 2 : self.i + 6], 16)))
                    self.i += 6
                    continue
                out.append(_ESCAPES.get(nxt, nxt))
                self.i += 2
                continue
            if ch == close:
                rest = s[self.i + 1 : self.i + 40].lstrip()
                if not rest or rest[0] in ",:]}" or quote != "'":
                    self.i += 1
                    break
            out.append(ch)
            self.i += 1
        return "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace")

    def mapping(self, depth: int) -> dict:
        self.i += 1
        out: list[tuple[str, object]] = []
        while True:
            self.skip()
            if self.i >= self.n:
                break
            ch = self.s[self.i]
            if ch == "}":
                self.i += 1
                break
            if ch in ",;]":
                self.i += 1
                continue
            before = self.i
            key = self.string(ch) if ch in "\"'“" else self.value(depth + 1)
            self.skip()
            if self.i < self.n and self.s[self.i] in ":=":
                self.i += 1
                if self.i >= self.n:
                    break
                out.append((str(key), self.value(depth + 1)))
            elif self.i == before:
                self.i += 1
        return _pairs(out)

    def sequence(self, depth: int) -> list:
        self.i += 1
        out: list = []
        while True:
            self.skip()
            if self.i >= self.n:
                break
            ch = self.s[self.i]
            if ch == "]":
                self.i += 1
                break
            if ch in ",;":
                self.i += 1
                continue
            if ch == "}":
                break
            out.append(self.value(depth + 1))
        return out


def loads_lenient(text: str | None) -> tuple[object, str]:
    """(value, how): how is ``ok`` for plain JSON, ``repaired``, or ``failed`` (value None)."""
    if text is None or not text.strip():
        return None, "failed"
    try:
        return json.loads(text, object_pairs_hook=_pairs), "ok"
    except (ValueError, RecursionError):
        pass
    starts = [i for i in (text.find("{"), text.find("[")) if i >= 0]
    if not starts:
        return None, "failed"
    at = min(starts)
    if text[at] == "[" and "{" in text and not re.match(r"\[\s*(?:[{\[\"'\d-]|null|true|false|\])", text[at:]):
        at = text.find("{")
    try:
        return json.JSONDecoder(object_pairs_hook=_pairs).raw_decode(text, at)[0], "repaired"
    except (ValueError, RecursionError):
        pass
    try:
        return _Reader(text[at:]).value(), "repaired"
    except RecursionError:
        return None, "failed"
