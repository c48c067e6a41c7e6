"""Names of people and organisations as typed by people, taken apart."""

from __future__ import annotations

import re
from typing import NamedTuple

from landloom.llm.words import BUSINESS_FORM, COMPOUND_FORMS, GENERATION_FORM, GIVEN_FORMS, LEGAL_FORM, PARTICLES, ROMAN, Snap, plain

_SPACED = [(re.compile(p), r) for p, r in ((r"\bL\s*L\s*C\b", "LLC"), (r"\bL\s*P\b", "LP"))]
_DOTTED = re.compile(r"\b([A-Z])\.\s?(?=[A-Z]\b)")
_LEAD = re.compile(r"^\s*(?:%|C/O|ATTN)?\s*(?:THE\s+)?")
_WORD = re.compile(r"[A-Z0-9]+|&")
_AND = re.compile(r"&|\bAND(?: WIFE| HUSBAND| SPOUSE)?\b|\bET UX\b")
_JOINS = frozenset(("&", "AND", "WIFE", "HUSBAND", "SPOUSE", "ET", "UX"))
_SERIES = frozenset(("II", "III", "IV"))
GIVEN_SNAP, COMPOUND_SNAP, BUSINESS_SNAP = Snap(GIVEN_FORMS), Snap(COMPOUND_FORMS), Snap(BUSINESS_FORM)


class Name(NamedTuple):
    """kind: person, couple, organisation or unknown; core: surname or own name.

    A given name that may stand for several has them all, with slashes between;
    a kind of business comes as its full form. `other` is the second reading of
    a person whose surname may be either end: surname, bar, given names.
    """

    kind: str
    core: str
    given: tuple[str, ...]
    suffix: str
    series: str
    legal: str
    other: str = ""

    def readings(self) -> list[Name]:
        if not self.other:
            return [self]
        core, _, given = self.other.partition("|")
        return [self._replace(other=""), self._replace(core=core, given=tuple(given.split()), other="")]


NOBODY = Name("unknown", "", (), "", "", "")


def _organisation(words: list[str], legal: str) -> Name:
    rest = [w for w in words if w not in LEGAL_FORM and w != "&"]
    series = next((ROMAN.get(w, w) for w in reversed(rest[1:]) if w in ROMAN or w.isdigit()), "")
    core, kinds = [], []
    for i, w in enumerate(rest):
        kind = BUSINESS_SNAP.near(w) if i else None
        if kind:
            kinds.append(kind)
        elif not (i and (w in ROMAN or w.isdigit() or w in ("AND", "OF"))):
            core.append(w)
    return Name("organisation", " ".join(core), tuple(kinds), "", series, legal)


def _joined(words: list[str]) -> list[tuple[str, str | None, bool]]:
    """Words with what given names they may be, and whether as written: given names of two words and surnames after particles are one."""
    out: list[tuple[str, str | None, bool]] = []
    i = 0
    while i < len(words):
        w = words[i]
        two = words[i + 1] if i + 1 < len(words) else ""
        if w in PARTICLES and two and two not in _JOINS:
            k = i + 1
            while k + 1 < len(words) and words[k] in PARTICLES and words[k + 1] not in _JOINS:
                k += 1
            out.append((" ".join(words[i:k + 1]), None, False))
            i = k + 1
            continue
        compound = COMPOUND_SNAP.near(w + two) if len(w) > 2 and len(two) > 2 and two not in _JOINS else None
        if compound:
            out.append((w, compound, w + two in COMPOUND_FORMS))
            i += 2
            continue
        out.append((w, GIVEN_SNAP.near(w), w in GIVEN_FORMS))
        i += 1
    return out


def parse(text: str) -> Name:
    """Parse one name; no input raises.

    The surname is what stands before a comma, or the end that is no given name;
    if both ends or none may be one, a person has two readings.
    """
    t = plain(text)
    t = _DOTTED.sub(r"\1", t).replace(".", " ").replace("'", "")
    for pattern, to in _SPACED:
        t = pattern.sub(to, t)
    t = _LEAD.sub("", t)
    words = _WORD.findall(t)
    if not words:
        return NOBODY
    legal = next((LEGAL_FORM[w] for w in reversed(words[1:]) if w in LEGAL_FORM), "")
    # A word as it stands in a table counts before one that is only like it.
    if legal or any(w in BUSINESS_FORM for w in words[1:]) and not any(w in GIVEN_FORMS for w in words) or any(map(BUSINESS_SNAP.near, words[1:])) and not any(map(GIVEN_SNAP.near, words)):
        return _organisation(words, legal)
    couple = bool(_AND.search(t))
    suffix = next((GENERATION_FORM.get(w, w) for w in words[1:] if w in GENERATION_FORM or w in _SERIES), "")
    own = [w for i, w in enumerate(words) if not (w in GENERATION_FORM or w in _SERIES) or not i]
    head = len(_WORD.findall(t.partition(",")[0])) if "," in t else 0
    tokens = [x for x in _joined(own) if x[0] not in _JOINS]
    if not tokens:
        return NOBODY
    last = len(tokens) - 1
    spots = [i for i, x in enumerate(tokens) if x[1] is None and len(x[0]) > 1]
    ends = [i for i in {0: 0, last: last} if i in spots]
    if head and not couple and head < len(words) and 0 < len(_joined(words[:head])) < len(tokens) and words[head] not in GENERATION_FORM and words[head] not in _SERIES:
        size = len(_joined(words[:head]))
        tokens = [(" ".join(x[0] for x in tokens[:size]), None, False), *tokens[size:]]
        at = [0]
    elif len(ends) == 1 or couple and ends:
        at = ends[:1] if "," not in t or ends[0] == 0 else ends
    elif spots and not ends:
        at = spots[-1:]
    elif couple or not last:
        at = [0]
    elif ends:
        at = [0, last]
    else:  # all may be given names: the end that is only like one is the surname
        like = [i for i in (0, last) if not tokens[i][2]]
        at = like if len(like) == 1 else [0, last]
    suffix = suffix or ""

    def reading(k: int) -> tuple[str, tuple[str, ...]]:
        given = tuple(p or w.replace(" ", "") for i, (w, p, _) in enumerate(tokens) if i != k)
        return tokens[k][0], tuple(sorted(given)) if couple else given

    read = sorted({reading(k) for k in at})
    other = f"{read[1][0]}|{' '.join(read[1][1])}" if len(read) > 1 else ""
    return Name("couple" if couple else "person", *read[0], suffix, "", "", other)
