"""One consistent written form for characters that only look alike.

``canonical_form`` is pure Python and works on one string. The form: NFC; apart from line
breaks only U+0020 as space; no invisible characters; letters, digits and katakana of
normal width; no joined letters, radicals or sign doubles; every letter from the script
its word is written in; mu is U+03BC. Super- and subscripts, dashes, quotation marks,
distinct Greek letters and the usual East Asian punctuation stay.
"""

from __future__ import annotations

import re
import unicodedata

# Pairs of letters that look the same in Latin and Cyrillic, and Latin and Greek.
CYRILLIC_TO_LATIN = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y",
    "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
}
GREEK_TO_LATIN = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "υ": "u", "ν": "v", "ι": "i", "ϲ": "c", "ϳ": "j",
}
#: Greek letters that keep their meaning when they stand alone.
GREEK_ALONE = set("υνι")
LATIN_TO_CYRILLIC = {v: k for k, v in CYRILLIC_TO_LATIN.items() if "А" <= k <= "я"}
# Signs with a double, and letters with a second code point.
DOUBLES = {
    "µ": "μ", "˚": "°", "℃": "°C", "℉": "°F", "∆": "Δ",
    "∙": "·", "⋅": "·", "∕": "/", "⁄": "/", "∶": ":", "∣": "|",
    "ſ": "s", "ɑ": "a", "ɡ": "g", ";": ";", "·": "·",
}


def _compat_table() -> dict[int, str]:
    """Characters replaced wherever they stand, with their ordinary form."""
    ranges = [
        (0x0132, 0x0134), (0x0149, 0x014A), (0x01C4, 0x01CD), (0x01F1, 0x01F4), (0x03D0, 0x03D7), (0x03F0, 0x03F6),
        (0x2126, 0x2127), (0x212A, 0x212C), (0x2160, 0x2180), (0x2E80, 0x2FD6), (0x3371, 0x33E0), (0xFB00, 0xFB07),
        (0xFB13, 0xFB18), (0xFB50, 0xFDD0), (0xFE70, 0xFEFD), (0xFF10, 0xFF1A), (0xFF21, 0xFF3B), (0xFF41, 0xFF5B),
        (0xFF65, 0xFFDD), (0x1D400, 0x1D800),
    ]
    out = {}
    for a, b in ranges:
        for cp in range(a, b):
            plain = unicodedata.normalize("NFKC", chr(cp))
            if plain != chr(cp):
                out[cp] = plain
    out.update({ord(k): v for k, v in DOUBLES.items()})
    visible_format = {*range(0x0600, 0x0606), 0x06DD, 0x070F, 0x08E2, 0x110BD, 0x110CD}
    for cp in range(0x110000):
        cat = unicodedata.category(chr(cp))
        if cat == "Zs":
            out[cp] = " "
        elif cat == "Cf" and cp not in visible_format:
            out[cp] = ""
        elif cat == "Cc" and cp not in (0x0A, 0x0D, 0x85):
            out[cp] = ""
    for cp in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)):
        out[cp] = ""
    out[0x09] = " "
    return out


_COMPAT = _compat_table()
#: Java/Python regex class of characters after which a text surely has the form already.
PLAIN_CLASS = (
    "\\n\\r\\x20-\\x7E¡«°±²³·¹»¿À-Ö×Ø-öø-ÿ"
    "α-δμΔΩ‐-―‘-„…′″⁰⁴-⁾₀-₎−"
    "、。〈-】ぁ-ゖァ-ヿ一-鿿가-힣"
    "؟،ء-يऄ-हऽ-॔।-९ऀ-ः"
)
PLAIN = re.compile(f"[{PLAIN_CLASS}]*\\Z")
_WORD = re.compile(r"[^\W_]+(?:[̀-ͯ]+[^\W_]*)*")
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ɏḀ-ỿ]")
_CYRILLIC = re.compile("[Ѐ-ԯ]")
_GREEK = re.compile("[Ͱ-Ͽἀ-῿]")
_EAST = re.compile("[぀-ヿ㐀-鿿가-힣]")
_WIDE_SIGN = re.compile("[！-／：-＠［-｀｛-～]")
_TIGHT = set("％＋．／＝－＠＃＜＞＆＊＄＿＾｜")


def _ascii(ch: str) -> bool:
    return ch.isascii() and ch.isalnum()


def _narrow_signs(s: str) -> str:
    """Wide ASCII signs: narrow in a text without East Asian letters or tight to a Latin token."""
    if not _WIDE_SIGN.search(s):
        return s
    east = bool(_EAST.search(s))
    out = list(s)
    for m in _WIDE_SIGN.finditer(s):
        i = m.start()
        ch = s[i]
        if not east or (ch in _TIGHT and i and _ascii(out[i - 1])):
            out[i] = chr(ord(ch) - 0xFEE0)
    return "".join(out)


def one_script(s: str) -> str:
    """Every letter from the script its word is written in; the length stays."""
    cyr, gre = _CYRILLIC.search(s), _GREEK.search(s)
    if not cyr and not gre:
        return s
    lat_n = cyr_n = 0
    for ch in s:
        if _LATIN.match(ch):
            lat_n += ch not in LATIN_TO_CYRILLIC
        elif _CYRILLIC.match(ch):
            cyr_n += ch not in CYRILLIC_TO_LATIN
    russian = cyr_n > 0

    def fix(m: re.Match) -> str:
        w = m.group()
        if w.isascii():
            if not (cyr and russian):
                return w
            return w
        has_c, has_g, has_l = _CYRILLIC.search(w), _GREEK.search(w), _LATIN.search(w)
        if has_c:
            strict_l = any(_LATIN.match(c) and c not in LATIN_TO_CYRILLIC for c in w)
            strict_c = any(_CYRILLIC.match(c) and c not in CYRILLIC_TO_LATIN for c in w)
            if strict_c and not strict_l:
                if has_l:
                    w = "".join(LATIN_TO_CYRILLIC.get(c, c) for c in w)
            elif strict_l and not strict_c:
                w = "".join(CYRILLIC_TO_LATIN.get(c, c) for c in w)
            elif not strict_l and not strict_c:
                if not russian:
                    w = "".join(CYRILLIC_TO_LATIN.get(c, c) for c in w)
                elif has_l:
                    n_c = len(_CYRILLIC.findall(w))
                    n_l = len(_LATIN.findall(w))
                    digits = any(c.isdigit() for c in w)
                    if n_l > n_c or digits or not any(c.islower() for c in w):
                        w = "".join(CYRILLIC_TO_LATIN.get(c, c) for c in w)
                    else:
                        w = "".join(LATIN_TO_CYRILLIC.get(c, c) for c in w)
        if has_g:
            letters = [c for c in w if c.isalpha()]
            if has_l or _LATIN.search(w):
                w = "".join(GREEK_TO_LATIN.get(c, c) for c in w)
            elif all(c in GREEK_TO_LATIN for c in letters) and not (len(letters) == 1 and letters[0] in GREEK_ALONE):
                w = "".join(GREEK_TO_LATIN.get(c, c) for c in w)
        return w

    return _WORD.sub(fix, s)


_ORDINAL = re.compile("(?<=\\d)( ?)º(?=\\s*[CF](?![A-Za-z]))|(?<![A-Za-z.\\d])º(?=\\s*[CF](?![A-Za-z]))")


def canonical_form(s: str | None) -> str | None:
    """``s`` in its consistent form; null stays null, the empty string stays empty."""
    if s is None or PLAIN.match(s):
        return s
    t = unicodedata.normalize("NFC", s.translate(_COMPAT))
    if "º" in t:
        t = _ORDINAL.sub(lambda m: (m.group(1) or "") + "°", t)
    t = one_script(_narrow_signs(t))
    return unicodedata.normalize("NFC", t)
