"""Reading physical units and converting to one common unit per quantity.

A unit is read as a product of powers of amount (mol), volume (L) and time (s) with an
exact rational factor, so that every spelling of the same unit gives the same pair.
"""

from __future__ import annotations

import re
from fractions import Fraction
from functools import lru_cache

from .charforms import canonical_form

#: (mol, L, s) powers of the quantities that are converted, and the common unit's size in base units.
QUANTITIES = {
    "Km": ((1, -1, 0), Fraction(1, 10**9)),  # nanomol per litre
    "Vmax": ((1, -1, -1), Fraction(1, 10**12)),  # picomol per litre and second
    "kcat_Km": ((-1, 1, -1), Fraction(1)),  # litre per mol and second
}
COMMON_UNIT = {"Km": "nmol/L", "Vmax": "pmol/L/s", "kcat_Km": "L/mol/s"}
_PREFIX = {"": 0, "m": -3, "μ": -6, "u": -6, "n": -9, "p": -12, "f": -15, "k": 3, "c": -2, "d": -1}
_WORD_PREFIX = {"": 0, "milli": -3, "micro": -6, "nano": -9, "pico": -12, "kilo": 3}
_TIME = {"s": 1, "sec": 1, "secs": 1, "second": 1, "seconds": 1, "min": 60, "mins": 60, "minute": 60, "minutes": 60, "h": 3600, "hr": 3600, "hrs": 3600, "hour": 3600, "hours": 3600}
_SUP = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺−–", "0123456789-+--")


def _ten(n: int) -> Fraction:
    return Fraction(10) ** n


@lru_cache(maxsize=4096)
def _symbol(name: str) -> tuple[Fraction, tuple[int, int, int], int] | None:
    """(factor, (mol, L, s), length power) of one unit symbol."""
    if name in _TIME:
        return Fraction(_TIME[name]), (0, 0, 1), 0
    for stem, dims in (("M", (1, -1, 0)), ("mol", (1, 0, 0)), ("L", (0, 1, 0)), ("l", (0, 1, 0))):
        if name.endswith(stem) and name[: -len(stem)] in _PREFIX:
            return _ten(_PREFIX[name[: -len(stem)]]), dims, 0
    if name in ("m", "dm", "cm", "mm", "μm", "um"):
        return _ten(_PREFIX[name[:-1]]), (0, 0, 0), 1
    low = name.lower()
    for stem, dims in (("molar", (1, -1, 0)), ("moles", (1, 0, 0)), ("mole", (1, 0, 0)), ("liters", (0, 1, 0)), ("litres", (0, 1, 0)), ("liter", (0, 1, 0)), ("litre", (0, 1, 0))):
        if low.endswith(stem) and low[: -len(stem)] in _WORD_PREFIX:
            return _ten(_WORD_PREFIX[low[: -len(stem)]]), dims, 0
    if low != name and low.endswith("mol") and low[:-3] in _PREFIX:
        return _ten(_PREFIX[low[:-3]]), (1, 0, 0), 0
    return None


_MULT = re.compile(r"\s*(?:[×xX*·]\s*)?10\s*\^?\s*\(?([-+]?\d+)\)?(?![\d.])\s*|\s*[eE]([-+]?\d+)\s*")
_TOKEN = re.compile(r"\s*(?:(/|\bper\b)|([·*•×.])|(\()|(\))|([A-Za-zμ]+)(?:\^?\(?([-+]?\d+)\)?(?!\d))?)")


@lru_cache(maxsize=100_000)
def read_unit(text: str, whole: bool = True) -> tuple[Fraction, tuple[int, int, int]] | None:
    """(factor to base units, powers) of ``text``; with ``whole=False`` of its longest unit prefix.

    None where the text is no such unit.
    """
    s = (canonical_form(text) or "").translate(_SUP).strip()
    factor, at = Fraction(1), 0
    m = _MULT.match(s)
    if m:
        factor = _ten(int(m.group(1) or m.group(2)))
        at = m.end()
    dims, length = [0, 0, 0], 0
    sign, group, stack, seen = 1, 1, [], False
    while at < len(s):
        t = _TOKEN.match(s, at)
        if not t:
            break
        slash, dot, opened, closed, name, power = t.groups()
        if slash:
            if not seen:
                break
            sign = -1
        elif dot:
            if not seen or dot == "." and (at + 1 >= len(s) or not s[at + 1].isalpha()):
                break
        elif opened:
            if not (seen and sign == -1):
                break
            stack.append(group)
            group, sign = group * sign, 1
        elif closed:
            if not stack:
                break
            group, sign = stack.pop(), 1
        else:
            sym = _symbol(name)
            if sym is None:
                break
            p = int(power or 1) * sign * group
            if abs(p) > 9:
                return None
            factor *= sym[0] ** p
            for k in range(3):
                dims[k] += sym[1][k] * p
            length += sym[2] * p
            seen, sign = True, 1
        at = t.end()
    rest = s[at:].strip()
    if not seen or (whole and rest) or (not whole and rest[:1] in ("-", "^", "/", "+", "%")):
        return None
    if length % 3:
        return None
    dims[1] += length // 3
    factor *= Fraction(1000) ** (length // 3)
    return factor, (dims[0], dims[1], dims[2])


_NUM = re.compile(
    r"(?<![A-Za-z0-9_.])([-+]?(?:\d{1,3}(?:,\d{3})+\.\d+|\d+[.,]\d+|\d+|\.\d+))"
    r"(?:\s*\)?\s*(?:±|\+/-|\+-)\s*(\d+(?:[.,]\d+)?))?\s*\)?"
    r"(\s*[×xX*·]\s*10\s*\^?\s*\(?[-+]?\d+\)?(?![\d.])|\s*[eE][-+]?\d+(?!\d))?"
)


def _decimal(word: str) -> Fraction:
    if "," in word:
        word = word.replace(",", "") if "." in word else word.replace(",", ".")
    return Fraction(word)


def numbers_with_rest(text: str):
    """Every number of ``text``: (mantissa, power of ten, text after the mantissa, text after the power, start)."""
    s = (canonical_form(text) or "").translate(_SUP)
    for m in _NUM.finditer(s):
        try:
            mant = _decimal(m.group(1))
        except (ValueError, ZeroDivisionError):
            continue
        power = 0
        if m.group(3):
            power = int(_POWER.search(m.group(3)).group(1))
        if abs(power) > 40:
            continue
        if power and m.group(2):
            # the power is the uncertainty's own where only then it is a sensible share of the number
            share = _decimal(m.group(2)) / abs(mant) if mant else Fraction(0)
            if not Fraction(1, 1000) <= share <= 1 and Fraction(1, 1000) <= share * _ten(power) <= 1:
                yield mant, 0, s[m.end() :], s[m.end() :], m.start()
                continue
        yield mant, power, s[m.end(1) :], s[m.end() :], m.start()


_POWER = re.compile(r"(?:10\s*\^?\s*\(?|[eE])([-+]?\d+)")
_AFTER_MANTISSA = re.compile(r"(?:\s*\)?\s*(?:±|\+/-|\+-)\s*\d+(?:[.,]\d+)?)?\s*\)?")


def _close(a: Fraction, b: Fraction) -> bool:
    return abs(a - b) <= abs(b) * Fraction(1, 200)


def unit_after(number: Fraction, text: str | None, label: re.Pattern | None) -> tuple[Fraction, tuple[int, int, int]] | None:
    """The unit written behind ``number`` in ``text``, else behind the first number after ``label``.

    A power of ten between number and unit belongs to the unit where the number is the
    mantissa alone.
    """
    if not text:
        return None
    found = list(numbers_with_rest(text))
    for mant, power, after_mant, after_power, _ in found:
        if power and _close(mant, number):
            tail = after_mant[_AFTER_MANTISSA.match(after_mant).end() :]
            return read_unit(tail, whole=False)
        if _close(mant * _ten(power), number):
            return read_unit(after_power, whole=False)
    if label is None:
        return read_unit(found[0][3], whole=False) if found else None
    m = label.search((canonical_form(text) or "").translate(_SUP))
    if m:
        for _, _, _, after_power, start in found:
            if start >= m.end():
                return read_unit(after_power, whole=False)
    return None


LABELS = {
    "Km": re.compile(r"K_?m(?![A-Za-z])|Michaelis|米氏常数"),
    "Vmax": re.compile(r"V_?max|maximal rate|最大反应速率", re.IGNORECASE),
    "kcat_Km": re.compile(r"kcat ?/ ?Km|efficiency|催化效率", re.IGNORECASE),
}


def number_of(value: float | None, raw: str | None, unit: str | None) -> Fraction | None:
    """The column's number, else the first of ``raw``.

    Where ``raw`` shows a power of ten that the unit column also holds, the number is the mantissa.
    """
    if value is not None and value == value:
        return Fraction(repr(float(value))) if abs(value) != float("inf") else None
    if not raw:
        return None
    for mant, power, _, _, _ in numbers_with_rest(raw):
        if power and unit and unit.strip():
            m = _MULT.match((canonical_form(unit) or "").translate(_SUP).strip())
            if m and int(m.group(1) or m.group(2)) == power:
                return mant
        return mant * _ten(power)
    return None


def blank(text: str | None) -> bool:
    return text is None or not (canonical_form(text) or "").strip()


def read_quantity(quantity: str, value: float | None, unit: str | None, raw: str | None, evidence: str | None):
    """(number, factor or None, unit_from or None, status) of one quantity of a row.

    status: ``stated``, ``no_value``, ``not_positive``, ``not_convertible`` (a unit of another
    kind), ``no_unit``.
    """
    number = number_of(value, raw, unit)
    if number is None:
        return None, None, None, "no_value"
    if number <= 0:
        return number, None, None, "not_positive"
    want, _ = QUANTITIES[quantity]
    if not blank(unit):
        got = read_unit(unit)
        if got and got[1] == want:
            return number, got[0], "column", "stated"
        return number, None, "column", "not_convertible"
    for origin, text, label in (("raw", raw, None), ("evidence", evidence, LABELS[quantity])):
        got = unit_after(number, text, label)
        if got:
            if got[1] == want:
                return number, got[0], origin, "stated"
            if origin == "raw":
                return number, None, origin, "not_convertible"
    return number, None, None, "no_unit"


def to_common(quantity: str, number: Fraction, factor: Fraction) -> int | None:
    """The number in the common unit, rounded half up; None beyond 64 bits."""
    x = number * factor / QUANTITIES[quantity][1]
    n = (2 * x.numerator + x.denominator) // (2 * x.denominator)
    return n if abs(n) < 2**63 else None
