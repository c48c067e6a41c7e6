"""Postal addresses as typed by people, taken apart into their components."""

from __future__ import annotations

import re
from typing import NamedTuple

from landloom.llm.words import CITY_END, DIRECTION_FORM, FEATURE, STATE_FORM, STREET_FORM, UNIT, plain

_SEGMENT = re.compile(r"[,;\n\r\t|]+|\s[-–]\s")
_TOKEN = re.compile(r"#|[A-Z0-9]+(?:-[0-9]+)?|%")
_CARE = re.compile(r"^\s*(?:C/O|C/0|ATTN|%|CARE OF\b)")
_ZIP = re.compile(r"^\d{5}(?:-\d{4})?$")
_UNITS, _ENDS, _FEATURES = frozenset(UNIT), frozenset(CITY_END), frozenset(FEATURE)
_DOTTED = re.compile(r"\b([A-Z])\.\s?(?=[A-Z]\b)")
_JOINED = re.compile(r"^(FM|CR)(\d+)$")
# Each with what a text must hold, white space left out, for the pattern to be found in it.
_PHRASES = [(signs, re.compile(p), r) for signs, p, r in (
    (("BOX", "POB"), r"\bP\s*O\s*BOX\b|\bPOB\b|\bPOST OFFICE BOX\b|\bP\s*O\s*B\b", "BOX"), (("MARKET", "FM"), r"\bFARM (?:TO|2) MARKET(?: ROAD| RD)?\b|\bF\s+M\b|\bFM (?:ROAD|RD)\b", "FM"),
    (("CR", "COUNTYR", "CNTYR", "COR"), r"\b(?:COUNTY|CNTY|CO) (?:ROAD|RD)\b|\bC\s+R\b(?=\s*\d)", "CR"), (("NEWMEXICO", "NM"), r"\bNEW MEXICO\b|\bN M\b(?=\s*(?:\d|$))", "NM"), (("NEWYORK",), r"\bNEW YORK\b", "NY"),
)]


class Address(NamedTuple):
    """Components as canonical text; an empty string is a part left out."""

    number: str
    direction: str
    street: str
    kind: str
    unit: str
    city: str
    state: str
    zip: str

    @property
    def parts(self) -> int:
        """How many of: number with street or box, unit, city, state, zip."""
        return bool(self.number and self.street) + bool(self.unit) + bool(self.city) + bool(self.state) + bool(self.zip)


NOTHING = Address("", "", "", "", "", "", "", "")


def _place(tokens: list[str]) -> tuple[list[str], str, str]:
    """Take zip and state from the end of a segment: the rest, state, zip."""
    code = state = ""
    rest = list(tokens)
    if rest and _ZIP.match(rest[-1]) and (len(rest) > 1 and rest[-2] not in ("BOX", "FM", "CR", "#") or len(rest) == 1):
        if len(rest) == 1 or rest[-2] in STATE_FORM or not rest[0].isdigit() and rest[-2] not in STREET_FORM and rest[-2] not in _FEATURES:
            code = rest.pop()[:5]
    if rest and rest[-1] in STATE_FORM and (len(rest) > 1 or code or len(tokens) == 1):
        state = STATE_FORM[rest.pop()]
    return rest, state, code


def parse(text: str) -> Address:
    """Parse one address; what cannot be read is left out, and no input raises."""
    t = plain(text)
    if "." in t:
        t = _DOTTED.sub(r"\1", t).replace(".", " ")
    t = t.replace("'", "")
    close = "".join(t.split())
    for signs, pattern, to in _PHRASES:
        if any(x in close for x in signs):
            t = pattern.sub(to, t)
    number = direction = street = kind = unit = city = state = code = ""
    for segment in _SEGMENT.split(t):
        if _CARE.match(segment):
            continue
        tokens = _TOKEN.findall(segment)
        if not tokens:
            continue
        split = []
        for x in tokens:
            m = x[0] in "FC" and _JOINED.match(x)
            split += m.groups() if m else (x,)
        for k in range(1, len(split) - 1):  # place first, street after it without a comma
            if split[k][0].isdigit() and split[k - 1] in STATE_FORM and _ZIP.match(split[k]) and split[k - 1] not in STREET_FORM:
                state, code = state or STATE_FORM[split[k - 1]], code or split[k][:5]
                city, split = city or " ".join(split[:k - 1]), split[k + 1:]
                break
            if 0 < k and split[k] in STATE_FORM and split[k + 1].isdigit() and len(split[k + 1]) < 5 and len(split) > k + 2 and split[0].isalpha() and split[0] not in ("BOX", "FM", "CR") and not any(x.isdigit() for x in split[:k]):
                state, city, split = state or STATE_FORM[split[k]], city or " ".join(split[:k]), split[k + 1:]
                break
        rest, st, zp = _place(split)
        state, code = state or st, code or zp
        i, n = 0, len(rest)
        if rest and rest[0] in ("BOX", "FM", "CR") or len(rest) > 1 and rest[0].isdigit() and rest[1] in ("BOX", "FM", "CR"):
            if rest[0].isdigit():
                number, i = rest[0], 1
            word, i = rest[i], i + 1
            value = rest[i] if i < n else ""
            i += 1
            if word == "BOX":
                number, street = value, "BOX"
            else:
                street = f"{word} {value}"
                if not number and i < n and rest[i].isdigit():
                    number, i = rest[i], i + 1
        else:
            name: list[str] = []
            if i < n and rest[i] in _UNITS and not unit and (i + 1 < n):
                unit, i = rest[i + 1], i + 2
            elif not street and (rest and rest[0][0].isdigit() or n > 1 and rest[-1].isdigit() or any(x in STREET_FORM for x in rest[1:]) or (any(x in _UNITS for x in rest[1:]))):
                if rest[i][0].isdigit():
                    number, i = rest[i], i + 1
                if i < n and rest[i] in DIRECTION_FORM and i + 1 < n:
                    direction, i = DIRECTION_FORM[rest[i]], i + 1
                # All words up to the street type, of two types side by side the last.
                end = next((k for k in range(i + 1, n) if rest[k] in STREET_FORM or rest[k] in _UNITS or rest[k].isdigit()), n)
                if end < n and rest[end] in STREET_FORM and not rest[i].isdigit():
                    while end + 1 < n and rest[end + 1] in STREET_FORM:
                        end += 1
                    name, kind, i = rest[i:end], STREET_FORM[rest[end]], end + 1
                else:  # without one a word belongs to the street, or two that end in a word for a place in the land
                    while i < n:
                        x = rest[i]
                        if name and (x in _UNITS or x.isdigit()):
                            break
                        if len(name) == 2 or len(name) == 1 and x not in _FEATURES and (n - i > 1 or st or zp):
                            break
                        name.append(x)
                        i += 1
                street = " ".join(name)
                if not number and i < n and rest[i].isdigit():
                    number, i = rest[i], i + 1
        if i < n and rest[i] in _UNITS and i + 1 < n and not unit:
            if rest[i] != "NO" or len(rest[i + 1]) < 5:
                unit, i = rest[i + 1], i + 2
        left = rest[i:]
        if left and left[0] == "#":
            left = left[1:]
        if left and not city and not left[0][0].isdigit():
            city = " ".join(x for x in left if not x.isdigit())
    return Address(number.lstrip("0") or number, direction, street, kind, unit.lstrip("0") or unit, city, state, code)
