"""Which rows of a county name the same owner."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations, product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landloom.functions.text import key_text
from landloom.llm.classes import components
from landloom.llm.names import Name, parse
from landloom.llm.words import distance
from landloom.missing import TABLE_TOKENS, is_missing
from landloom.session import cut

_PARTS = ["kind", "core", "given", "suffix", "series", "legal", "other"]
_NEVER = 99.0
#: A spelling of a surname may be a slip of another one that this many times as many names
#: share, or of any other if no more than RARE names share it.
SLIP_RATIO, RARE = 5, 2
#: Least score of a link in bits: the rarity of the rarest rewriting that two names share, less BITS for each slip or part left out.
LEAST_SCORE, BITS = 2.0, 2.0
#: Names that a table counts as holding at least: few names do not make a form common.
LEAST_NAMES = 1 << 16


def _slips(core: str) -> list[str]:
    """Rewritings of a surname or own name that survive slips: its letters in order of the
    alphabet, whole and with any one left out."""
    c = core.replace(" ", "")
    if len(c) < 5:
        return [c]
    letters = sorted(c)
    return ["".join(letters), *sorted({"".join(letters[:i] + letters[i + 1:]) for i in range(len(letters))})]


def _halves(core: str) -> list[str]:
    """The first and the last four letters, which survive several slips in the other half."""
    c = core.replace(" ", "")
    return ["<" + c[:4], ">" + c[-4:]] if len(c) > 4 else []


def _meanings(given: str) -> list[str]:
    return given.split("/")


def _initials(given: str) -> set[str]:
    return {m[0] for m in _meanings(given)}


def rewritings(name: Name) -> list[str]:
    """Every canonical form under which a writing of the same owner may be met.

    Token order: both readings of a person whose surname may be either end.
    Nicknames: every given name that a short form may stand for. Legal forms may
    be left out, so no form has them. Initials: the first given name as an
    initial, and further ones as initials or left out. Slips: the letters of the
    surname but one, and its halves, under the full first given name.
    """
    out: dict[str, None] = {}
    for r in name.readings():
        whole = f"|{r.core.replace(' ', '')}"
        tail = f"|{r.suffix}|{r.series}"
        first, more = (r.given[:1], r.given[1:]) if r.kind == "person" else (r.given, ())
        for given in product(*map(_meanings, first)):
            head = f"{r.kind}|{' '.join(sorted(given))}{tail}|"
            for c in (*_slips(r.core), *_halves(r.core)):
                out[head + c] = None
            if more:
                out.update(dict.fromkeys(f"{head}{' '.join(m)}{whole}" for m in product(*map(_initials, more))))
        if r.kind == "person" and first:
            out.update(dict.fromkeys(f"{i}.{tail}{whole}" for i in sorted(_initials(first[0]))))
    return list(out)


def _given_cost(p: str, q: str) -> float:
    """How far two given names, each perhaps of several meanings, are from being one."""
    if p == q or not set(_meanings(p)).isdisjoint(_meanings(q)):
        return 0.0
    if len(p) == 1 or len(q) == 1:
        return 0.3 if not _initials(p).isdisjoint(_initials(q)) else _NEVER
    near = (distance(m, n, 1) <= 1 for m in _meanings(p) for n in _meanings(q) if min(len(m), len(n)) > 4)
    return 1.0 if any(near) else _NEVER


def cost(a: Name, b: Name) -> float:
    """How far two parsed names are from naming one owner, by their nearest readings; 99 when they cannot."""
    return _nearest(a, b)[0]


def _nearest(a: Name, b: Name) -> tuple[float, bool]:
    """The cost of two names, and whether it is for one surname letter by letter."""
    if not a.other and not b.other:
        return _cost(a, b), a.core == b.core
    return min(((_cost(x, y), x.core != y.core) for x in a.readings() for y in b.readings()))[0], any(x.core == y.core for x in a.readings() for y in b.readings())


def _cost(a: Name, b: Name) -> float:
    if a.kind != b.kind or a.suffix != b.suffix or a.series != b.series or (a.legal and b.legal and a.legal != b.legal):
        return _NEVER
    x, y = a.core.replace(" ", ""), b.core.replace(" ", "")
    size = max(len(x), len(y))
    most = 0 if size < 4 else 1 if size < 6 else 2 if size < 9 else 3
    d = distance(x, y, most)
    if d > most:
        return _NEVER
    total = float(d) + 0.1 * (a.legal != b.legal)
    g, h = a.given, b.given
    if g == h:
        return total
    if a.kind == "organisation" or not g or not h or a.kind == "couple" and len(g) != len(h):
        return _NEVER
    if a.kind == "couple":
        # In order of their letters two couples may stand the other way about.
        total += min(sum(_given_cost(p, q) for p, q in zip(g, turn)) for turn in permutations(h)) if len(h) < 4 else sum(_given_cost(p, q) for p, q in zip(g, h))
    else:
        total += sum(_given_cost(p, q) for p, q in zip(g, h)) + 0.5 * abs(len(g) - len(h))
    return total if total < _NEVER else _NEVER


def _fits(a: Name, b: Name, na: int, nb: int) -> float:
    """The cost of two names, whose surnames `na` and `nb` names share; 99 too where one may not be a slip of the other."""
    total, same = _nearest(a, b)
    return total if same or min(na, nb) <= RARE or SLIP_RATIO * min(na, nb) <= max(na, nb) else _NEVER


def _may_link(a: str, b: str) -> Column:
    """Conditions of `_fits` on surnames and spreads; keeps every pair that it keeps."""
    x, y = (F.replace(F.col(f"{s}.core"), F.lit(" "), F.lit("")) for s in (a, b))
    size = F.greatest(F.length(x), F.length(y))
    most = F.when(size < 4, 0).when(size < 6, 1).when(size < 9, 2).otherwise(3)
    # A swap of neighbours is one slip but two edits here.
    far = F.levenshtein(x, y, 6)
    low, high = (f(F.col(f"{a}.spread"), F.col(f"{b}.spread")) for f in (F.least, F.greatest))
    return F.col(f"{a}.two") | F.col(f"{b}.two") | (F.col(f"{a}.core") == F.col(f"{b}.core")) | (((low <= RARE) | (SLIP_RATIO * low <= high)) & (far >= 0) & (far <= 2 * most))


def _name(kind: str, core: str, given: str, suffix: str, series: str, legal: str, other: str) -> Name:
    return Name(kind, core, tuple(given.split()) if given else (), suffix, series, legal, other)


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parsed = [parse(t) for t in batch["name_key"]]
        yield pd.DataFrame({
            "area": batch["area"].to_numpy(), "name_key": batch["name_key"].to_numpy(), "n": batch["n"].to_numpy(),
            "kind": [p.kind for p in parsed], "core": [p.core for p in parsed], "given": [" ".join(p.given) for p in parsed],
            "suffix": [p.suffix for p in parsed], "series": [p.series for p in parsed], "legal": [p.legal for p in parsed], "other": [p.other for p in parsed],
        })


def _form_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        nodes, forms = [], []
        for area, node, *parts in batch[["area", "node", *_PARTS]].itertuples(index=False):
            found = rewritings(_name(*parts))
            nodes += [node] * len(found)
            forms += [f"{area}|{f}" for f in found]
        yield pd.DataFrame({"node": pd.Series(nodes, dtype="int64"), "form": pd.Series(forms, dtype=object)})


def _verify_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    a, b = [f"{p}_a" for p in _PARTS], [f"{p}_b" for p in _PARTS]
    for batch in batches:
        far = np.array([
            _fits(_name(*p), _name(*q), m, n)
            for p, q, m, n in zip(batch[a].itertuples(index=False), batch[b].itertuples(index=False), batch["spread_a"], batch["spread_b"])
        ], float)
        yield batch.loc[(far < _NEVER) & (batch["rarity"].to_numpy(float) - BITS * far >= LEAST_SCORE), ["a", "b"]]


def settle(items: list[tuple[int, Name, int, int]]) -> list[tuple[int, int]]:
    """Split a component into owners (node, Name, rows, spread): common and full names first.

    A name joins the nearest owner it fits, if it is nearer than all others;
    one that fits several equally well is not rare enough to tell and stands alone.
    """
    top = max(x[3] for x in items)
    order = sorted(items, key=lambda x: (SLIP_RATIO * x[3] <= top or x[3] <= RARE, -len(x[1].given), any(len(g) == 1 for g in x[1].given), -x[2], not x[1].legal, x[0]))
    owners: list[list[tuple[int, Name, int]]] = []
    out = []
    for node, name, _, spread in order:
        fits = []
        for i, owner in enumerate(owners):
            head = owner[0]
            c = _fits(name, head[1], spread, head[2])
            if c < _NEVER:
                fits.append((c, i))
        fits.sort()
        if fits and (len(fits) == 1 or fits[0][0] < fits[1][0]):
            owners[fits[0][1]].append((node, name, spread))
            out.append((node, owners[fits[0][1]][0][0]))
        elif fits:
            out.append((node, node))
        else:
            owners.append([(node, name, spread)])
            out.append((node, node))
    return out


def _settle_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by label; a component may run over several batches."""
    now, items = None, []
    for batch in batches:
        out: list[tuple[int, int]] = []
        for label, node, n, spread, *parts in batch[["label", "node", "n", "spread", *_PARTS]].itertuples(index=False):
            if label != now:
                out += settle(items) if items else []
                now, items = label, []
            items.append((node, _name(*parts), n, spread))
        yield pd.DataFrame(out, columns=["node", "owner"], dtype="int64")
    if items:
        yield pd.DataFrame(settle(items), columns=["node", "owner"])


def name_records(rows: DataFrame, area: str, row: str, field: str) -> DataFrame:
    """`area`, `row`, `name_key` of the rows whose name is not missing."""
    flat = rows.select(F.col(f"`{area}`").alias("area"), F.col(f"`{row}`").alias("row"), F.col(f"`{field}`").alias("name"))
    return flat.filter(~is_missing(F.col("name"), TABLE_TOKENS)).select("area", "row", key_text(F.col("name")).alias("name_key"))


def owners(records: DataFrame) -> DataFrame:
    """The owner of each distinct name text of an area: `area`, `name_key`, `owner`.

    All rewritings of each parsed name are exploded and equi-joined; a pair is
    scored by the rarity of the rarest form that it shares (bits: all names over
    those that have the form) less what the two differ by, and the components of
    the links are split into owners. Names that cannot be read link to equal
    texts only. An empty table gives an empty result.
    """
    return _owners(records).select("area", "name_key", "owner")


def _text() -> Column:
    return F.xxhash64("area", "name_key")


def _owners(records: DataFrame) -> DataFrame:
    """`owners`, with a number `text` of each distinct text."""
    area_type = records.schema["area"].dataType.simpleString()
    texts = records.groupBy("area", "name_key").agg(F.count(F.lit(1)).alias("n"))
    parsed = texts.mapInPandas(_parse_batches, f"area {area_type}, name_key string, n long, " + ", ".join(f"{p} string" for p in _PARTS))
    read = F.col("kind") != "unknown"
    parsed = cut(parsed.withColumn("node", F.when(read, F.xxhash64("area", *_PARTS)).otherwise(F.xxhash64("area", "name_key"))), "names")
    spread = parsed.filter(read).select("core", "node").groupBy("core").agg(F.count_distinct("node").alias("spread"))
    nodes = parsed.filter(read).groupBy("node", "area", *_PARTS).agg(F.sum("n").alias("n")).join(spread, "core")
    nodes = cut(nodes.select("node", "area", *_PARTS, "n", "spread"), "nodes")
    forms = nodes.select("area", "node", *_PARTS).mapInPandas(_form_batches, "node long, form string").select("node", F.xxhash64("form").alias("form"))
    # Forms of a single name leave before the join; forms are dealt once for that.
    each = Window.partitionBy("form")
    counted = forms.withColumns({"first": F.min("node").over(each), "last": F.max("node").over(each), "shared": F.count(F.lit(1)).over(each)})
    shared = counted.filter("first <> last").select("node", "form", "shared")
    met = cut(shared.join(nodes.select("node", "core", "spread", (F.col("other") != "").alias("two")), "node"), "forms")
    p, q = met.alias("p"), met.alias("q")
    on = (F.col("p.form") == F.col("q.form")) & (F.col("p.node") < F.col("q.node")) & _may_link("p", "q")
    pairs = p.join(q, on).groupBy(F.col("p.node").alias("a"), F.col("q.node").alias("b")).agg(F.min("p.shared").alias("shared"))
    pairs = pairs.select("a", "b", F.log2(F.lit(float(max(nodes.count(), LEAST_NAMES))) / F.col("shared")).alias("rarity"))
    one = nodes.select(F.col("node").alias("a"), F.col("spread").alias("spread_a"), *[F.col(x).alias(f"{x}_a") for x in _PARTS])
    two = nodes.select(F.col("node").alias("b"), F.col("spread").alias("spread_b"), *[F.col(x).alias(f"{x}_b") for x in _PARTS])
    links = cut(pairs.join(one, "a").join(two, "b").mapInPandas(_verify_batches, "a long, b long"), "links")
    members = components(links).join(nodes, "node").repartition("label").sortWithinPartitions("label", "node")
    found = members.select("label", "node", "n", "spread", *_PARTS).mapInPandas(_settle_batches, "node long, owner long")
    return parsed.join(found, "node", "left").select("area", "name_key", _text().alias("text"), F.coalesce("owner", "node").alias("owner"))


def same_owner_pairs(records: DataFrame) -> DataFrame:
    """Pairs of rows of one area that name one owner in different texts: `row_a` < `row_b`.

    Owners written one way only, however many rows they hold, leave first. The
    different texts of an owner are paired, and the rows put to each pair, so
    rows of one text never meet.
    """
    known = cut(_owners(records).select("area", "owner", "text"), "owners")
    several = known.groupBy("area", "owner").agg(F.count(F.lit(1)).alias("ways")).filter("ways > 1").select("area", "owner")
    texts = cut(known.join(several, ["area", "owner"], "left_semi"), "texts")
    rows = cut(records.select("row", _text().alias("text")).join(texts.select("text"), "text", "left_semi"), "found")
    a, b = texts.withColumnRenamed("text", "text_a"), texts.withColumnRenamed("text", "text_b")
    pairs = a.join(b, ["area", "owner"]).filter("text_a < text_b").select("text_a", "text_b")
    one, two = (rows.select(F.col("text").alias(f"text_{s}"), F.col("row").alias(f"row_{s}")) for s in "ab")
    both = pairs.join(one, "text_a").join(two, "text_b")
    return both.select(F.least("row_a", "row_b").alias("row_a"), F.greatest("row_a", "row_b").alias("row_b"))
