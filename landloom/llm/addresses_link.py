"""Which address records of a county denote one location."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landloom.functions.text import key_text
from landloom.llm.addresses import Address, parse
from landloom.llm.classes import components
from landloom.llm.words import PLACE_FORM, distance
from landloom.missing import TABLE_TOKENS, is_missing
from landloom.session import cut

#: Bands and hashes per band of the MinHash signature.
BANDS, ROWS = 12, 2
#: Affine gap costs of a part left out, and the greatest cost of one location.
GAP_OPEN, GAP_MORE, MOST_COST = 1.0, 0.25, 5.0
#: Costs of an edit within a word, and of a word for its abbreviation.
EDIT, ABBREVIATED = 0.6, 0.2
_NEVER = 99.0
_PARTS = Address._fields
_rng = np.random.default_rng(20240501)
_MUL = (_rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_ADD = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64)


def _fnv(text: str) -> int:
    h = 0xCBF29CE484222325
    for c in text.encode():
        h = ((h ^ c) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
    return h


_GRAMS: dict[str, int] = {}


def _gram(text: str) -> int:
    h = _GRAMS.get(text)
    if h is None:
        if len(_GRAMS) > 200_000:
            _GRAMS.clear()
        h = _GRAMS[text] = _fnv(text)
    return h


def block(a: Address) -> str:
    """What the alignment demands to be equal: house or box number and unit; of a numbered road also its number."""
    words = a.street.split()
    return f"{a.number}/{a.unit}/{a.street if words and words[0] in ('BOX', 'FM', 'CR') else ''}"


def shingles(a: Address) -> list[int]:
    """Hashes of the words of the street and of the q-grams of each; of the whole street where it is a number or a box."""
    return [*_street_shingles(a.street)]


@lru_cache(100_000)
def _street_shingles(street: str) -> tuple[int, ...]:
    words = street.split()
    if not words:
        return ()
    if words[0] in ("BOX", "FM", "CR"):
        return (_gram("=" + street),)
    out = set()
    for w in words:
        w = PLACE_FORM.get(w, w)
        padded = f"^{w}$"
        # A street's only word is no more than its q-grams.
        out.update((*(["=" + w] if len(words) > 1 else []), *(padded[i:i + 2] for i in range(len(padded) - 1))))
    return tuple(_gram(g) for g in sorted(out))


def bands(blocks: list[str], grams: list[list[int]]) -> list[list[int]]:
    """Band keys of each record: MinHash of its shingles, mixed with its block."""
    return _bands(blocks, grams).tolist()


def _bands(blocks: list[str], grams: Sequence[Sequence[int]]) -> np.ndarray:
    """`bands` as an array; a set of shingles that several records have is hashed once."""
    if not blocks:
        return np.empty((0, BANDS), np.int64)
    known: dict[tuple[int, ...], int] = {}
    which = np.array([known.setdefault(tuple(g), len(known)) for g in grams])
    sizes = np.array([len(g) for g in known])
    flat = np.fromiter((x for g in known for x in g), np.uint64, int(sizes.sum()))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    own = np.array([_fnv(b) for b in blocks], np.uint64)
    out = np.empty((len(blocks), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            key = own * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band)
            for r in range(ROWS):
                k = band * ROWS + r
                least = np.minimum.reduceat((flat * _MUL[k] + _ADD[k]) >> np.uint64(16), starts)
                key = (key ^ least[which]) * np.uint64(0xBF58476D1CE4E5B9)
                key ^= key >> np.uint64(29)
            out[:, band] = key
    return out.view(np.int64)


def _word_cost(x: str, y: str) -> float:
    if x == y:
        return 0.0
    if PLACE_FORM.get(x, x) == PLACE_FORM.get(y, y):
        return ABBREVIATED
    if any(c.isdigit() for c in x + y):
        return _NEVER
    most = 1 if max(len(x), len(y)) < 6 else 2 if max(len(x), len(y)) < 9 else 3
    d = distance(x, y, most)
    return EDIT * d if d <= most else _NEVER


def _tokens(a: Address) -> list[tuple[str, str]]:
    words = a.street.split()
    parts = [("N", a.number), ("D", a.direction), *(("S", w) for w in words), ("K", a.kind), ("U", a.unit), ("C", "".join(PLACE_FORM.get(w, w) for w in a.city.split())), ("T", a.state), ("Z", a.zip)]
    return [(k, v) for k, v in parts if v]


def align(a: Address, b: Address) -> float:
    """Cost of the best affine-gap alignment of the parts of two addresses.

    The parser has put directions, street types and states into one writing;
    other words cost by the dictionary of abbreviations, else by edit distance;
    different numbers, units,
    directions, street types, states and codes never align. A part may be left
    out at the price of a gap, but not the number, the street, or the unit.
    """
    for x, y in ((a.number, b.number), (a.unit, b.unit)):
        if x != y:
            return _NEVER
    for x, y in ((a.direction, b.direction), (a.kind, b.kind), (a.state, b.state), (a.zip, b.zip)):
        if x and y and x != y:
            return _NEVER
    s, t = _tokens(a), _tokens(b)
    inf = 1e9
    n, m = len(s), len(t)

    def gap(token: tuple[str, str], first: bool) -> float:
        return inf if token[0] in "NSU" else GAP_OPEN if first else GAP_MORE

    match = [[inf] * (m + 1) for _ in range(n + 1)]
    up = [[inf] * (m + 1) for _ in range(n + 1)]
    left = [[inf] * (m + 1) for _ in range(n + 1)]
    match[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            if i and j and s[i - 1][0] == t[j - 1][0]:
                before = min(match[i - 1][j - 1], up[i - 1][j - 1], left[i - 1][j - 1])
                if before < inf:
                    match[i][j] = before + _word_cost(s[i - 1][1], t[j - 1][1])
            if i:
                up[i][j] = min(min(match[i - 1][j], left[i - 1][j]) + gap(s[i - 1], True), up[i - 1][j] + gap(s[i - 1], False))
            if j:
                left[i][j] = min(min(match[i][j - 1], up[i][j - 1]) + gap(t[j - 1], True), left[i][j - 1] + gap(t[j - 1], False))
    return min(match[n][m], up[n][m], left[n][m])


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parsed = [parse(t) for t in batch["address"]]
        out = pd.DataFrame(parsed, columns=list(_PARTS))
        out.insert(0, "area", batch["area"].to_numpy())
        out.insert(1, "address_key", batch["address_key"].to_numpy())
        yield out


def _band_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        items = [Address(*r) for r in batch[list(_PARTS)].itertuples(index=False)]
        grams = [_street_shingles(a.street) if a.number else () for a in items]
        at = [i for i, g in enumerate(grams) if g]
        areas = batch["area"].astype(str).tolist()
        keys = _bands([f"{areas[i]}|{block(items[i])}" for i in at], [grams[i] for i in at])
        nodes = batch["node"].to_numpy()[at]
        # Of equal band keys within a record one is enough.
        yield pd.DataFrame({"node": np.repeat(nodes, BANDS), "band": keys.reshape(-1)})


def _verify_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        left = [Address(*r) for r in batch[[f"{p}_a" for p in _PARTS]].itertuples(index=False)]
        right = [Address(*r) for r in batch[[f"{p}_b" for p in _PARTS]].itertuples(index=False)]
        keep = np.array([align(x, y) <= MOST_COST for x, y in zip(left, right)], bool)
        yield batch.loc[keep, ["a", "b"]]


def _settle(items: list[tuple[int, Address, int]]) -> list[tuple[int, int]]:
    """Split a component into locations: full addresses first; one that leaves parts out joins
    the only location it fits, or stands alone where it fits several that differ."""
    order = sorted(items, key=lambda x: (-sum(bool(p) for p in x[1]), -x[2], x[0]))
    found: list[list[tuple[int, Address]]] = []
    out = []
    for node, a, _ in order:
        fits = [g for g in found if align(a, g[0][1]) <= MOST_COST and all(_agree(a, other) for _, other in g)]
        if len(fits) > 1:  # the nearest, if it is nearer than all others
            costs = sorted((align(a, g[0][1]), i) for i, g in enumerate(fits))
            fits = [fits[costs[0][1]]] if costs[0][0] < costs[1][0] else []
            if not fits:
                out.append((node, node))
                continue
        if fits:
            fits[0].append((node, a))
            out.append((node, fits[0][0][0]))
        else:
            found.append([(node, a)])
            out.append((node, node))
    return out


def _agree(a: Address, b: Address) -> bool:
    return all(not x or not y or x == y for x, y in ((a.direction, b.direction), (a.kind, b.kind), (a.state, b.state), (a.zip, b.zip)))


def _settle_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by label; a component may run over several batches."""
    now, items = None, []
    for batch in batches:
        out: list[tuple[int, int]] = []
        rows = zip(batch["label"], batch["node"], batch["n"], batch[list(_PARTS)].itertuples(index=False))
        for label, node, n, parts in rows:
            if label != now:
                out += _settle(items) if items else []
                now, items = label, []
            items.append((node, Address(*parts), n))
        yield pd.DataFrame(out, columns=["node", "place"])
    if items:
        yield pd.DataFrame(_settle(items), columns=["node", "place"])


def address_records(rows: DataFrame, area: str, row: str, fields: list[str]) -> DataFrame:
    """The address records: `area`, `row`, `field`, `address_key`; missing ones are left out."""
    cell = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("address")) for f in fields])).alias("c")
    flat = rows.select(F.col(f"`{area}`").alias("area"), F.col(f"`{row}`").alias("row"), cell).select("area", "row", "c.field", "c.address")
    return flat.filter(~is_missing(F.col("address"), TABLE_TOKENS)).select("area", "row", "field", key_text(F.col("address")).alias("address_key"))


def _node() -> Column:
    return F.xxhash64("area", *_PARTS)


def locations(records: DataFrame) -> DataFrame:
    """The location of each distinct address text of an area: `area`, `address_key`, `place`.

    Equal components are one node. Nodes are banded by MinHash over the words
    and q-grams of the street, within what the alignment demands to be equal
    (house or box number, unit; a unit left out is another location); candidates are verified by the alignment; components of the links are split
    into locations. A text that cannot be read as an address is a location of
    its own. An empty table gives an empty result.
    """
    texts = records.groupBy("area", "address_key").agg(F.count(F.lit(1)).alias("n"))
    area_type = records.schema["area"].dataType.simpleString()
    schema = f"area {area_type}, address_key string, " + ", ".join(f"`{p}` string" for p in _PARTS)
    parsed = texts.select("area", "address_key", F.col("address_key").alias("address")).mapInPandas(_parse_batches, schema)
    read = (F.col("number") != "") & (F.col("street") != "")
    parsed = parsed.withColumn("node", F.when(read, _node()).otherwise(F.xxhash64("area", "address_key")))
    parsed = cut(parsed, "parsed")
    nodes = cut(parsed.filter(read).groupBy("node", "area", *_PARTS).agg(F.count(F.lit(1)).alias("n")), "nodes")
    banded = nodes.select("node", "area", *_PARTS).mapInPandas(_band_batches, "node long, band long")
    # Bands of a single node leave before the join; bands are dealt once for that.
    each = Window.partitionBy("band")
    shared = banded.withColumns({"first": F.min("node").over(each), "last": F.max("node").over(each)}).filter("first <> last").select("node", "band")
    shared = cut(shared, "bands")
    pairs = shared.alias("p").join(shared.alias("q"), (F.col("p.band") == F.col("q.band")) & (F.col("p.node") < F.col("q.node"))).select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct()
    one = nodes.select(F.col("node").alias("a"), *[F.col(p).alias(f"{p}_a") for p in _PARTS])
    two = nodes.select(F.col("node").alias("b"), *[F.col(p).alias(f"{p}_b") for p in _PARTS])
    links = cut(pairs.join(one, "a").join(two, "b").mapInPandas(_verify_batches, "a long, b long"), "links")
    labels = components(links)
    members = labels.join(nodes, "node").repartition("label").sortWithinPartitions("label", "node")
    places = members.select("label", "node", "n", *_PARTS).mapInPandas(_settle_batches, "node long, place long")
    return parsed.join(places, "node", "left").select("area", "address_key", F.coalesce("place", "node").alias("place"))


def same_place_pairs(records: DataFrame) -> DataFrame:
    """Pairs of records of one area at one location whose texts differ: `row_a`, `field_a`, `row_b`, `field_b`.

    Locations written one way only, however many records they hold, leave
    first. The different texts of a location are paired, and the records put to
    each pair, so records of one text never meet.
    """
    places = cut(locations(records).select("area", "place", F.xxhash64("area", "address_key").alias("text")), "places")
    several = places.groupBy("area", "place").agg(F.count(F.lit(1)).alias("ways")).filter("ways > 1").select("area", "place")
    texts = cut(places.join(several, ["area", "place"], "left_semi"), "texts")
    found = cut(records.select("row", "field", F.xxhash64("area", "address_key").alias("text")).join(texts.select("text"), "text", "left_semi"), "found")
    a, b = texts.withColumnRenamed("text", "text_a"), texts.withColumnRenamed("text", "text_b")
    pairs = a.join(b, ["area", "place"]).filter("text_a < text_b").select("text_a", "text_b")
    one, two = (found.select(F.col("text").alias(f"text_{s}"), F.struct("row", "field").alias(s)) for s in "ab")
    both = pairs.join(one, "text_a").join(two, "text_b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return both.select(F.col("a.row").alias("row_a"), F.col("a.field").alias("field_a"), F.col("b.row").alias("row_b"), F.col("b.field").alias("field_b"))
