"""Evaluation passages inside training text, by greedy string tiling."""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Consecutive item words that make a leak; scattered changed words at the ends may hide EDGE of them.
LEAST_WORDS, EDGE = 25, 2
#: Shortest tile, and the item and document words that may lie between two tiles of one passage.
TILE, ITEM_GAP, DOC_GAP = 2, 6, 12
#: Share of the words, and of the own names, dates and figures, that must be matched.
COVERED, OWN = 0.6, 0.7
#: Share of the whole item that must be matched when its passages stand in another order.
REORDERED = 0.8
#: A word in more than this share of the different item texts (and in more than so many) is stock wording.
STOCK_SHARE, STOCK_ITEMS = 0.01, 3
#: The same for two neighbouring words.
PAIR_SHARE, STOCK_PAIRS = 0.03, 10
#: Items that go to the executors together, about; more are taken in blocks.
BLOCK_ITEMS = 20_000
#: Seeds of an item within this many document words are looked at together.
NEAR = 80
#: Items of more words than this are tiled without a look at the words they share.
LONG_ITEM = 500

_MARKUP = re.compile(r"<[^<>\n]{1,200}>|\[(?:sic|\.\.\.|…)\]|&[a-z]+;|[*_~`#|]+")
_TOKEN = re.compile(r"\d[\d.,/]*\d(?![^\W\d_])|[^\W_]+")
_OCR = str.maketrans("015", "ols")


def _figure(token: str) -> str:
    """A number without its notation: no thousands marks, no closing zeros."""
    if "/" in token:
        return "/".join(p.lstrip("0") for p in token.split("/"))
    if "," in token:
        head, _, tail = token.rpartition(",")
        token = token.replace(",", "") if "." in tail or len(tail) == 3 else head.replace(".", "").replace(",", "") + "." + tail
    if "." in token:
        token = token.rstrip("0").rstrip(".") if token.count(".") == 1 else token.replace(".", "")
    return token


def tokens(text: str) -> list[str]:
    """Words and figures in one writing: no case, markup, punctuation, notation or misread letters."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    if "<" in text or "[" in text or "*" in text or "_" in text or "&" in text or "#" in text or "|" in text or "~" in text or "`" in text:
        text = _MARKUP.sub("", text)
    found = _TOKEN.findall(text.lower())
    for i, t in enumerate(found):
        if not t.isalpha():
            if t[0].isdigit() and not any(c.isalpha() for c in t):
                if len(t) > 1:
                    found[i] = _figure(t)
            elif len(t) > 1:
                found[i] = t.translate(_OCR)
    return found


def _proper(text: str) -> set[str]:
    """Words written as names: with a capital inside a sentence, or at its start before another one."""
    out: set[str] = set()
    for sentence in re.split(r"(?<=[.!?;:])\s+|\n+", text):
        found = re.findall(r"[^\W_]+", sentence)
        for i, w in enumerate(found):
            if w[0].isupper() and (i or len(found) > 1 and found[1][0].isupper()):
                out.update(tokens(w))
    return out


class Items:
    """Tokens, own words (names, dates, figures) and seeds of all items.

    Seeds are rare own words, neighbours of which one is an own word, and as many of the
    other own words, the rarest first, as it takes that no passage is matched without a seed.
    """

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        self.ids, self.tokens, proper = [], [], []
        for item, text in rows:
            got = tokens(text or "")
            if got:
                self.ids.append(item)
                self.tokens.append(got)
                proper.append(_proper(text))
        count: dict[str | tuple[str, str], int] = {}
        different = set(map(tuple, self.tokens))
        stock, stock_pairs = max(STOCK_ITEMS, STOCK_SHARE * len(different)), max(STOCK_PAIRS, PAIR_SHARE * len(different))
        for got in different:
            for t in {*got, *zip(got, got[1:])}:
                count[t] = count.get(t, 0) + 1
        self.own = [np.array([t[0].isdigit() or t in names and count[t] <= stock for t in got]) for got, names in zip(self.tokens, proper)]
        self.seeds: dict[str | tuple[str, str], list[int]] = {}
        for k, (got, own) in enumerate(zip(self.tokens, self.own)):
            for t in {t for t, o in zip(got, own) if o}:
                if count[t] <= stock and (len(t) > 4 if t[0].isdigit() else len(t) > 3):
                    self.seeds.setdefault(t, []).append(k)
            for t in {t for t, o, o2 in zip(zip(got, got[1:]), own, own[1:]) if o or o2}:
                if count[t] <= stock_pairs:
                    self.seeds.setdefault(t, []).append(k)
        self.own_words = [[t for t, o in zip(got, own) if o] for got, own in zip(self.tokens, self.own)]
        # Short or common own words are seeds too where a passage could else be matched without any seed.
        for k, words in enumerate(self.own_words):
            need = self.need(k)
            bare = [k not in self.seeds.get(t, ()) for t in words]
            for t in sorted({t for t, b in zip(words, bare) if b}, key=lambda t: (count[t], t)):
                if not _enough(bare, need):
                    break
                self.seeds.setdefault(t, []).append(k)
                bare = [b and w != t for w, b in zip(words, bare)]
        self.seed_set = frozenset(self.seeds)

    def need(self, k: int) -> np.ndarray:
        """How many of the own words i to j - 1 of an item must be matched if a passage holds these only; infinite where none can."""
        n, at = len(self.tokens[k]), np.flatnonzero(self.own[k])
        ends = np.concatenate([[-1], at, [n]])
        i, j = np.meshgrid(np.arange(len(at) + 1), np.arange(len(at) + 1), indexing="ij")
        # The longest passage with these own words lies between the own words beside them.
        room = ends[np.minimum(j + 1, len(at) + 1)] - ends[i] - 1
        out = np.where((j - i >= 2) & (room >= LEAST_WORDS - EDGE), OWN * (j - i) - 1e-9, np.inf)
        if len(at) and n >= LEAST_WORDS - EDGE:  # passages in another order
            out[0, -1] = OWN * len(at) - 1e-9
        return out


def _enough(met: list[bool], need: np.ndarray) -> bool:
    """Whether own words of an item, those that are met marked, are enough for any passage."""
    good = np.array([0, *accumulate(met)])
    return bool((good - good[:, None] >= need).any())


def _own_met(own_words: list[str], need: np.ndarray, doc: set[str]) -> bool:
    """Whether enough own words of an item stand in the document for any passage; never False where `leaked` finds one."""
    return _enough([t in doc for t in own_words], need)


def tiles(item: list[str], doc: list[str], least: int = TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item position, document position, length), none overlapping.

    Again and again the longest matches of unmarked words are marked. Matches of
    a search length are found by a running hash over the words.
    """
    n, m = len(item), len(doc)
    code: dict[str, int] = {}
    a = [code.setdefault(t, len(code) + 1) for t in item]
    b = [code.get(t, 0) for t in doc]
    used_a, used_b = [False] * n, [False] * m
    out = []
    size = min(n, m, 24)
    base, mod = 1_000_003, (1 << 61) - 1
    while size >= least:
        power = pow(base, size - 1, mod)
        table: dict[int, list[int]] = {}
        h, run = 0, 0
        for i in range(n):
            if used_a[i]:
                h, run = 0, 0
                continue
            if run >= size:
                h = (h - a[i - size] * power) % mod
            h = (h * base + a[i]) % mod
            run += 1
            if run >= size:
                table.setdefault(h, []).append(i - size + 1)
        found = []
        h, run = 0, 0
        for j in range(m):
            if used_b[j] or not b[j]:
                h, run = 0, 0
                continue
            if run >= size:
                h = (h - b[j - size] * power) % mod
            h = (h * base + b[j]) % mod
            run += 1
            if run >= size and h in table:
                at = j - size + 1
                for i in table[h]:
                    k = 0
                    while i + k < n and at + k < m and a[i + k] == b[at + k] and not used_a[i + k] and not used_b[at + k]:
                        k += 1
                    if k >= size:
                        found.append((k, i, at))
        found.sort(key=lambda x: (-x[0], x[1], x[2]))
        for k, i, at in found:
            if not any(used_a[i:i + k]) and not any(used_b[at:at + k]):
                used_a[i:i + k] = [True] * k
                used_b[at:at + k] = [True] * k
                out.append((i, at, k))
        size = size // 2 if size > 8 else size - 1
    return out


def leaked(item: list[str], own: np.ndarray, doc: list[str]) -> tuple[int, float]:
    """Most consecutive item words found in the document text, and the share of the item matched; (0, 0) for none."""
    found = sorted(tiles(item, doc), key=lambda t: t[1])
    # Tiles of stock wording that other text lies between belong to no passage.
    chains: list[list[tuple[int, int, int]]] = []
    near: list[list[tuple[int, int, int]]] = []
    for tile in found:
        near = [c for c in near if tile[1] - (c[-1][1] + c[-1][2]) <= DOC_GAP]
        for chain in reversed(near):
            i, _, k = chain[-1]
            if 0 <= tile[0] - (i + k) <= ITEM_GAP:
                chain.append(tile)
                break
        else:
            chains.append([tile])
            near.append(chains[-1])
    best, covered = 0, np.zeros(len(item), bool)
    for chain in chains:
        a, z = chain[0][0], chain[-1][0] + chain[-1][2]
        hit = np.zeros(z - a, bool)
        for i, _, k in chain:
            hit[i - a:i - a + k] = True
        # A single own word between two tiles, in its place in the document, is matched too.
        for (i, j, k), (i2, j2, _) in zip(chain, chain[1:]):
            between = doc[j + k:j2]
            for p in range(i + k, i2):
                if item[p] in between:
                    hit[p - a] = True
        mine = own[a:z]
        good_own = hit[mine].mean() if mine.any() else 0.0
        if mine.sum() >= 1 and good_own >= OWN and hit.mean() >= COVERED:
            covered[a:z] |= hit
            if mine.sum() >= 2:
                best = max(best, z - a)
    share = float(covered.mean()) if len(item) else 0.0
    if own.any() and share >= REORDERED and covered[own].mean() >= OWN:
        best = max(best, int(covered.sum()))
    return best, share


def _may_leak(item: list[str], own: np.ndarray, words: set[str]) -> bool:
    """Whether the shares that `leaked` asks for could be met if every shared word were matched; never False where it finds a leak."""
    if len(item) > LONG_ITEM:
        return True
    there = np.array([t in words for t in item])
    if own.any() and there.mean() >= REORDERED and there[own].mean() >= OWN:
        return True
    hits, mine, good = (np.concatenate([[0], np.cumsum(x)]) for x in (there, own, there & own))
    at = np.arange(len(hits))
    span, n_own = at - at[:, None], mine - mine[:, None]
    return bool(((span >= LEAST_WORDS - EDGE) & (n_own >= 2) & (good - good[:, None] >= OWN * n_own) & (hits - hits[:, None] >= COVERED * span)).any())


def _regions(at: list[int], length: int, reach: int) -> list[tuple[int, int]]:
    """Document ranges around groups of seeds that stand near each other; one seed is enough."""
    out, group = [], [at[0]]
    for p in [*at[1:], 1 << 60]:
        if p - group[-1] <= NEAR:
            group.append(p)
            continue
        out.append((max(0, group[0] - reach), min(length, group[-1] + reach)))
        group = [p]
    return out


def find_leaks(documents: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str) -> DataFrame:
    """Each document with each item of which it holds LEAST_WORDS consecutive words: `doc`, `item`, `words`, `share`.

    The items are held-out tests: up to about BLOCK_ITEMS of them go to every
    executor, more are dealt to blocks by a hash, and the documents are read
    once for each block, whole, without a shuffle. Stock wording is counted in
    each block by shares of its different texts. Null or empty texts leak
    nothing. Items of equal text are all reported.
    """
    blocks = max(1, math.ceil(items.count() / BLOCK_ITEMS))
    block = F.pmod(F.xxhash64(F.col(item).cast("string")), F.lit(blocks))
    found = [_leaks_of(documents, doc, text, items.filter(block == k), item, item_text) for k in range(blocks)]
    return functools.reduce(DataFrame.unionByName, found)


def _leaks_of(documents: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str) -> DataFrame:
    """`find_leaks` for one block of items."""
    rows = items.select(item, item_text).collect()
    known = Items(sorted((r[0], r[1]) for r in rows if r[1] is not None))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        need = lru_cache(4_000)(known.need)
        for batch in batches:
            out = []
            for doc_id, body in zip(batch["doc"], batch["text"]):
                own_tokens = tokens(body)
                neighbours = list(zip(own_tokens, own_tokens[1:]))
                shared = known.seed_set.intersection(own_tokens) | known.seed_set.intersection(neighbours)
                if not shared:
                    continue
                places: dict[int, list[int]] = {}
                for seeds in (own_tokens, neighbours):
                    for p, seed in enumerate(seeds):
                        if seed in shared:
                            for k in known.seeds[seed]:
                                places.setdefault(k, []).append(p)
                words = set(own_tokens)
                for k, at in places.items():
                    if not _own_met(known.own_words[k], need(k), words):
                        continue
                    best = (0, 0.0)
                    for lo, hi in _regions(sorted(at), len(own_tokens), len(known.tokens[k]) + DOC_GAP):
                        part = own_tokens[lo:hi]
                        near = set(part)
                        if _own_met(known.own_words[k], need(k), near) and _may_leak(known.tokens[k], known.own[k], near):
                            best = max(best, leaked(known.tokens[k], known.own[k], part))
                    if best[0] >= LEAST_WORDS - EDGE:
                        out.append((doc_id, known.ids[k], best[0], best[1]))
            yield pd.DataFrame(out, columns=["doc", "item", "words", "share"])

    kinds = documents.schema[doc].dataType.simpleString(), items.schema[item].dataType.simpleString()
    texts = documents.filter(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    return texts.mapInPandas(run, f"doc {kinds[0]}, item {kinds[1]}, words int, share double")
