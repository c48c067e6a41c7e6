"""Duplicates of new batches against all accepted history, by stored small-world graph shards.

History is cut into segments: what was accepted before the first batch, and
each batch. A `History` is a folder: per segment its rows, which are read only
to name what was found, and shards of graphs over runs of one, two, four, ...
segments. A new batch adds one shard; two shards of
equal length are compacted into one of twice the length, so a batch is searched
in about log2 of the number of segments shards, and no batch reads the rows of
history again. Shards are bucketed tables: a search moves its queries only.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.functions.text import parcel_key
from landloom.llm.addresses import parse as parse_address
from landloom.llm.addresses_link import MOST_COST, align
from landloom.llm.classes import components
from landloom.llm.names import parse as parse_name
from landloom.llm.names_link import cost
from landloom.llm.smallworld import Graph, build_links
from landloom.missing import TABLE_TOKENS, is_missing
from landloom.session import cut, discard, shared_dir

#: Nodes of one graph, about; the number of graphs follows from it, larger ones are dealt.
GRAPH_NODES = 100_000
#: Acres are whole numbers of this part of an acre within a graph, in so many low bits of a point.
ACRE_STEP, ACRE_BITS = 10_000, 36
#: Kinds of graphs: parcels by id; records of ids of up to 12 letters and digits; records of longer numbers.
PARCELS, RECORDS, LONG_RECORDS = 0, 1, 2
ID_TEXT = r"[A-Za-z]*[0-9]+(?:\.0+)?"
#: What a graph keeps of each node beside its point, and what parts and ends the texts of nodes.
_FIELDS = (("item", np.int64), ("id", np.int64), ("acres", np.float64), ("decimals", np.int8))
_PART, _END = "\x1f", "\x1e"
_GRAPH = "graph int, sub int, kind int, points binary, links binary, " + ", ".join(f"{f} binary" for f, _ in _FIELDS) + ", texts binary"
_FOUND = "kind int, q long, n long"


class Shard(NamedTuple):
    """A stored run of segments: the first one, how many, graphs of each kind, whether large ones are dealt."""

    first: int
    length: int
    graphs: int
    nodes: int
    dealt: bool


def _graphs(nodes: int) -> int:
    """Graphs of each kind of a shard: a power of two, so a graph of a small shard is cut up when the shard grows."""
    return 1 << max(0, round(np.log2(max(nodes, 1) / GRAPH_NODES)))


def covering(upto: int) -> list[tuple[int, int]]:
    """Shards (first segment, length) that cover segments 0 to upto - 1: the binary digits of `upto`."""
    out, at = [], 0
    for k in reversed(range(upto.bit_length())):
        if upto >> k & 1:
            out.append((at, 1 << k))
            at += 1 << k
    return out


def one_slip(a: np.ndarray, b: np.ndarray, base: int = 10) -> np.ndarray:
    """Whether two whole numbers differ by one digit put in, left out, changed, or two neighbours swapped."""
    out = np.zeros(len(a), bool)
    swap = a > b
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    la, lb = _digits(a, base), _digits(b, base)
    for i in range(int(lb.max()) if len(lb) else 0):
        unit = base**i
        # One changed digit or a swap of neighbours: equal above and below.
        same = (la == lb) & (a % unit == b % unit)
        x, y = a // unit, b // unit
        out |= same & (x // base == y // base) & (a != b)
        out |= same & (x // base // base == y // base // base) & (x // base % base == y % base) & (x % base == y // base % base) & (a != b)
        # One digit more in b at this place.
        out |= (lb == la + 1) & (y // base * unit + b % unit == a)
    return out


def _digits(x: np.ndarray, base: int) -> np.ndarray:
    out = np.ones(len(x), np.int64)
    unit = base
    while len(x) and unit <= int(x.max()):
        out += x >= unit
        unit *= base
    return out


def house_number(address: Column) -> Column:
    """The house or box number of an address, found without its codes, units and road numbers; null if there is none."""
    t = F.upper(address)
    t = F.regexp_replace(t, r"(?:[A-Z.]{2,}\s*,?\s+)\d{5}(?:-\d{4})?(?=\s*(?:$|[,;\n-]|\d))", " ")
    t = F.regexp_replace(t, r"(?:#|\b(?:APT|UNIT|STE|SUITE|NO)\b)\.?\s*#?\w+", " ")
    t = F.regexp_replace(t, r"\b(?:F\.?\s?M\.?|C\.?\s?R\.?|FARM TO MARKET|COUNTY|CO)(?:\s+(?:ROAD|RD))?\.?\s*\d+", " ")
    number = F.regexp_extract(t, r"(?<![\w-])0*(\d{1,7})(?![\w-])", 1)
    return F.when(number != "", number)


def parcel_items(rows: DataFrame, area: str, land: str, ids: str) -> DataFrame:
    """The rows with `parcels`: the distinct parcel keys in the land id and the id list, formatting aside."""
    kind = dict(rows.dtypes)[ids]
    listed = F.transform(F.col(ids), lambda x: x.cast("string")) if kind.startswith("array") else F.regexp_extract_all(F.col(ids), F.lit(ID_TEXT), 0)
    every = F.array_distinct(F.concat(F.array(F.col(land).cast("string")), F.coalesce(listed, F.array().cast("array<string>"))))
    # Plain numbers without a leading zero, which most are, are their own key.
    key = lambda x: F.when(x.rlike("^[1-9][0-9]*$"), x).when(~is_missing(x, TABLE_TOKENS), parcel_key(x))
    return rows.withColumn("parcels", F.array_distinct(F.array_compact(F.transform(every, key))))


def history_rows(rows: DataFrame, *, area: str, segment: Column, source: str, key: str, land: str, ids: str, name: str, address: str, acres: str) -> DataFrame:
    """Rows of either table in the common form that a `History` takes."""
    miss = lambda c: is_missing(F.col(c), TABLE_TOKENS)
    plain = F.regexp_replace(F.col(acres).cast("string"), "[,$ ]", "")
    return parcel_items(rows, area, land, ids).select(
        F.col(area).alias("area"), segment.cast("int").alias("segment"), F.lit(source).alias("source"), F.col(key).cast("string").alias("key"), "parcels",
        F.when(~miss(name), F.col(name)).alias("name"), F.when(~miss(address), F.col(address)).alias("address"),
        plain.try_cast("double").alias("acres"), F.length(F.regexp_extract(plain, r"\.(\d+)", 1)).alias("decimals"))


def _nodes(rows: DataFrame) -> DataFrame:
    """The nodes of rows: `kind`, `point`, the fields, and `text`.

    The point of a parcel is a hash of its area and id. The point of a record
    has a hash of its area and house number above, then how far its acres are
    rounded, then the acres. Its text is what is compared exactly: area, name,
    address, and the parcels that its row holds.
    """
    each = rows.select("area", "name", "address", "acres", F.least("decimals", F.lit(9)).alias("decimals"), "house", "parcels", F.explode("parcels").alias("id"))
    item = F.xxhash64("area", "id")
    parcels = each.select(F.lit(PARCELS).alias("kind"), item.alias("point")).select("kind", "point", F.col("point").alias("item"), F.lit(0).cast("long").alias("id"), F.lit(0.0).alias("acres"), F.lit(0).alias("decimals"), F.lit("").alias("text"))
    code = F.when(F.length("id") <= 12, F.conv("id", 36, 10).try_cast("long")).when(F.col("id").rlike("^[0-9]{13,17}$"), F.col("id").try_cast("long"))
    low = F.least(F.round(F.col("acres") * ACRE_STEP), F.lit(float(2**ACRE_BITS - 1))).cast("long")
    place = F.xxhash64("area", F.coalesce("house", F.lit("")))
    point = F.shiftleft(place, ACRE_BITS + 2).bitwiseOR(F.shiftleft(F.least("decimals", F.lit(2)).cast("long"), ACRE_BITS)).bitwiseOR(low)
    clean = lambda c: F.translate(c, _PART + _END, "  ")
    text = F.concat_ws(_PART, F.col("area").cast("string"), clean(F.col("name")), clean(F.col("address")), F.array_join("parcels", ","))
    usable = each.filter("name is not null and address is not null and acres > 0").withColumn("code", code).filter("code is not null")
    records = usable.select(F.when(F.length("id") <= 12, RECORDS).otherwise(LONG_RECORDS).alias("kind"), point.alias("point"), item.alias("item"), F.col("code").alias("id"), "acres", "decimals", text.alias("text"))
    return parcels.unionByName(records)


def _graph_row(graph: int, sub: int, kind: int, points: np.ndarray, field: dict[str, np.ndarray], texts: np.ndarray) -> dict:
    """One graph as a row of arrays: distinct nodes in order. The point of a parcel says all, so nothing else is kept of it."""
    if kind == PARCELS:
        points = np.unique(points)
        field, texts = {f: np.empty(0, t) for f, t in _FIELDS}, ()
    else:
        order = np.argsort(points, kind="stable")
        once = order[~pd.DataFrame({"p": points[order], "i": field["item"][order], "t": texts[order]}).duplicated().to_numpy()]
        points, field, texts = points[once], {f: v[once] for f, v in field.items()}, texts[once]
    return {"graph": graph, "sub": sub, "kind": kind, "points": points.tobytes(), "links": build_links(len(points)).tobytes(), **{f: v.tobytes() for f, v in field.items()}, "texts": _END.join(texts).encode()}


def _build(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    """The graph of the nodes of one group."""
    points = nodes["point"].to_numpy(np.int64).view(np.uint64)
    return pd.DataFrame([_graph_row(key[0], key[1], int(nodes["kind"].iloc[0]), points, {f: nodes[f].to_numpy(t) for f, t in _FIELDS}, nodes["text"].to_numpy())])


def _opened(row: pd.Series) -> tuple[int, Graph, dict[str, np.ndarray]]:
    return int(row["kind"]), Graph.stored(row["points"], row["links"]), {f: np.frombuffer(row[f], t) for f, t in _FIELDS}


def _texts(row: pd.Series) -> np.ndarray:
    return np.array(row["texts"].decode().split(_END), object)


def _place(kind: int, points: np.ndarray) -> np.ndarray:
    """The part of a point by whose low bits a graph is chosen."""
    return points if kind == PARCELS else points >> np.uint64(ACRE_BITS + 2)


def _split(graphs: int):
    """Stored graphs cut up into those of a shard of more graphs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                kind, graph, field = _opened(row)
                number = (_place(kind, graph.points) & np.uint64(graphs - 1)).astype(np.int64)
                texts = _texts(row) if kind != PARCELS else None
                for g in np.unique(number):
                    mine = number == g
                    yield pd.DataFrame([_graph_row(kind * graphs + int(g), 0, kind, graph.points[mine], {f: v[mine] for f, v in field.items()} if kind != PARCELS else {}, texts[mine] if kind != PARCELS else ())])

    return run


def _merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
    """One graph of the nodes of several."""
    opened = [_opened(row) for _, row in parts.iterrows()]
    kind = opened[0][0]
    texts = np.concatenate([_texts(row) for _, row in parts.iterrows()]) if kind != PARCELS else ()
    field = {f: np.concatenate([o[2][f] for o in opened]) for f, _ in _FIELDS}
    return pd.DataFrame([_graph_row(key[0], key[1], kind, np.concatenate([o[1].points for o in opened]), field, texts)])


def _unfolded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The nodes of stored graphs, one row each."""
    for batch in batches:
        for _, row in batch.iterrows():
            kind, graph, field = _opened(row)
            points = graph.points.view(np.int64)
            if kind == PARCELS:
                field = {f: points if f == "item" else np.zeros(len(points), t) for f, t in _FIELDS}
            yield pd.DataFrame({"kind": np.int32(kind), "point": points, **field, "text": _texts(row) if kind != PARCELS else ""})


def _same_record(a: str, b: str, x: str, y: str) -> bool:
    """Whether two records of the ids x and y agree; ids that one row holds side by side are two parcels, however alike."""
    area1, name1, address1, held1 = a.split(_PART)
    area2, name2, address2, held2 = b.split(_PART)
    if area1 != area2 or y in held1.split(",") or x in held2.split(","):
        return False
    return cost(parse_name(name1), parse_name(name2)) < 99 and align(parse_address(address1), parse_address(address2)) <= MOST_COST


def _spelled(number: int, base: int) -> str:
    return np.base_repr(number, base)


def _find(graphs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """Pairs of asked and stored parcels: equal ones, and those of agreeing records whose ids are one slip apart."""
    nothing = np.empty(0, np.int64)
    if not len(graphs) or not len(queries):
        return pd.DataFrame({"kind": nothing.astype(np.int32), "q": nothing, "n": nothing})
    row = graphs.iloc[0]
    kind, graph, field = _opened(row)
    points = queries["point"].to_numpy(np.int64).view(np.uint64)
    if kind == PARCELS:
        q, n = graph.within(points, np.zeros(len(points), np.uint64))
        return pd.DataFrame({"kind": np.int32(kind), "q": points[q].view(np.int64), "n": graph.points[n].view(np.int64)})
    item, number, acres, decimals = (queries[f].to_numpy(t) for f, t in _FIELDS)
    texts, stored, base = queries["text"].to_numpy(), None, 36 if kind == RECORDS else 10
    low, shift = np.uint64(2**ACRE_BITS - 1), np.uint64(ACRE_BITS + 2)
    out: set[tuple[int, int]] = set()
    for rounding in range(3):  # stored acres of no, one, more decimals: the coarser rounding of the two tells the radius
        aim = (points >> shift << shift) | np.uint64(rounding << ACRE_BITS) | (points & low)
        reach = np.ceil(0.56 * ACRE_STEP * 10.0 ** -np.minimum(decimals, rounding).astype(float)).astype(np.uint64)
        for at in range(0, len(aim), 50_000):
            q, n = graph.within(aim[at:at + 50_000], reach[at:at + 50_000])
            q = q + at
            tolerance = 0.55 * 10.0 ** -np.minimum(decimals[q], field["decimals"][n]).astype(float)
            near = (points[q] >> shift == graph.points[n] >> shift) & (np.abs(acres[q] - field["acres"][n]) <= tolerance)
            q, n = q[near], n[near]
            slip = one_slip(number[q], field["id"][n], base)
            for i, j in zip(q[slip], n[slip]):
                stored = _texts(row) if stored is None else stored
                if (item[i], field["item"][j]) not in out and _same_record(texts[i], stored[j], _spelled(number[i], base), _spelled(field["id"][j], base)):
                    out.add((item[i], field["item"][j]))
    return pd.DataFrame({"kind": np.int32(kind), "q": np.array([a for a, _ in out], np.int64), "n": np.array([b for _, b in out], np.int64)})


class History:
    """An index of accepted rows in a folder of the shared file system.

    `add` takes the rows of one batch, in the form of `history_rows`: it writes
    the batch's postings, records and shard, searches the shards for its parcels
    and, for mistyped ids, its records, and compacts. `repeats` gives the rows
    found. Opening a folder that holds an index goes on with it.

    An id is a mistyped one of a stored parcel if it is one slip away and name,
    address and acres agree up to spelling and rounding, so a row without one
    of these three is compared by id only, as are ids of more than 12 letters
    and digits that are no numbers of up to 17 digits. Ids that one row holds
    side by side are never one parcel. Rows without parcels repeat nothing; a
    repeated row repeats each copy. Beams are widened to the full radius, so
    the recall is that of the exhaustive search.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark, self.folder = spark, folder or os.path.join(shared_dir(spark), f"history-{uuid.uuid4().hex}")
        self.shards: list[Shard] = []
        self.segments = 0
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._names: dict[Shard, str] = {}
        if folder is None:
            discard(spark, self.folder)
        elif self._there("state"):
            state = spark.read.parquet(self._at("state")).orderBy(F.desc("segments")).first()
            self.segments, self.parts = state["segments"], state["parts"]
            self.shards = [Shard(*s) for s in state["shards"]]

    def _at(self, *names: str) -> str:
        return os.path.join(self.folder, *names)

    def _there(self, name: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._at(name))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def _table(self, shard: Shard) -> DataFrame:
        """The bucketed table of a shard."""
        if shard not in self._names:
            name = f"shard_{uuid.uuid4().hex}"
            self.spark.sql(f"create table {name} ({_GRAPH}) using parquet clustered by (graph, sub) into {self.parts} buckets location '{self._at('shards', f'{shard.first}-{shard.length}')}'")
            self._names[shard] = name
        return self.spark.table(self._names[shard])

    def _graph(self, nodes: DataFrame, shard: Shard) -> DataFrame:
        place = F.when(F.col("kind") == PARCELS, F.col("point")).otherwise(F.shiftrightunsigned("point", ACRE_BITS + 2))
        return nodes.withColumn("graph", F.col("kind") * shard.graphs + F.pmod(place, F.lit(shard.graphs)).cast("int"))

    def _write(self, nodes: DataFrame, first: int, length: int, size: int) -> None:
        """Write a shard; of a graph of too many nodes the distinct ones are dealt to several by their parcels."""
        shard = Shard(first, length, _graphs(size), size, False)
        known = self._graph(nodes, shard)
        large = known.groupBy("graph").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 3 * GRAPH_NODES).select("graph", F.ceil(F.col("n") / GRAPH_NODES).cast("int").alias("subs"))
        if not large.isEmpty():
            shard, known = shard._replace(dealt=True), known.distinct()
            large.coalesce(1).write.parquet(self._at("shards", f"{first}-{length}-dealt"))
        known = self._dealt(known, shard).withColumn("sub", F.pmod("item", F.col("subs")).cast("int"))
        self._save(known.repartition(self.parts, "graph", "sub").groupBy("graph", "sub").applyInPandas(_build, _GRAPH), shard)

    def _save(self, built: DataFrame, shard: Shard) -> None:
        name = f"shard_{uuid.uuid4().hex}"
        built.write.format("parquet").bucketBy(self.parts, "graph", "sub").option("path", self._at("shards", f"{shard.first}-{shard.length}")).saveAsTable(name)
        self._names[shard] = name
        self.shards.append(shard)

    def _dealt(self, nodes: DataFrame, shard: Shard) -> DataFrame:
        if not shard.dealt:
            return nodes.withColumn("subs", F.lit(1))
        large = self.spark.read.parquet(self._at("shards", f"{shard.first}-{shard.length}-dealt"))
        return nodes.join(large, "graph", "left").withColumn("subs", F.coalesce("subs", F.lit(1)))

    def _compact(self) -> None:
        """Merge the last two shards as long as they are of equal length; graphs move whole, without unfolding their nodes."""
        while len(self.shards) > 1 and self.shards[-1].length == self.shards[-2].length:
            b, a = self.shards.pop(), self.shards.pop()
            both, size = self._table(a).unionAll(self._table(b)), a.nodes + b.nodes
            if a.dealt or b.dealt:
                nodes = both.mapInPandas(_unfolded, "kind int, point long, item long, id long, acres double, decimals int, text string")
                self._write(cut(nodes, "merged"), a.first, a.length + b.length, size)
            else:
                parts = both.mapInPandas(_split(_graphs(size)), _GRAPH).repartition(self.parts, "graph", "sub")
                self._save(parts.groupBy("graph", "sub").applyInPandas(_merge, _GRAPH), Shard(a.first, a.length + b.length, _graphs(size), size, False))
            for old in (a, b):
                self.spark.sql(f"drop table {self._names.pop(old)}")
                discard(self.spark, self._at("shards", f"{old.first}-{old.length}"), now=True)

    def add(self, rows: DataFrame) -> None:
        """Accept the rows of the next segment; their own `segment` is not read."""
        segment, self.segments = self.segments, self.segments + 1
        rows = rows.filter(F.size("parcels") > 0)
        # What was found is named from here; nothing else of a row is kept but the nodes of its graphs.
        rows.select("source", "key", F.transform("parcels", lambda x: F.xxhash64("area", x)).alias("items")).write.parquet(self._at("rows", f"segment={segment}"))
        house = F.when(F.col("name").isNotNull() & (F.col("acres") > 0), house_number(F.col("address")))
        nodes = cut(_nodes(rows.withColumn("house", house)), "nodes")
        self._write(nodes, segment, 1, nodes.count())
        if segment:
            self._search(nodes, segment)
        self._compact()
        shards = F.array(*[F.struct(*[F.lit(v).alias(f) for f, v in shard._asdict().items()]) for shard in self.shards])
        state = self.spark.range(1, numPartitions=1).select(F.lit(self.segments).alias("segments"), F.lit(self.parts).alias("parts"), shards.alias("shards"))
        state.write.mode("append").parquet(self._at("state"))

    def _search(self, nodes: DataFrame, segment: int) -> None:
        """Write what the shards hold of a batch's parcels, and of its records under ids one slip away."""
        found = None
        for shard in self.shards:
            # Within the batch itself only mistyped ids are looked for.
            asked = nodes.filter(F.col("kind") != PARCELS) if shard.first == segment else nodes
            asked = self._dealt(self._graph(asked, shard), shard).withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))).select("graph", "sub", "point", *[f for f, _ in _FIELDS], "text")
            one = self._table(shard).groupBy("graph", "sub").cogroup(asked.groupBy("graph", "sub")).applyInPandas(_find, _FOUND)
            found = one if found is None else found.unionAll(one)
        found.write.parquet(self._at("found", f"segment={segment}"))

    def repeats(self, segment: int | None = None) -> DataFrame:
        """Each row of the segment (of all of them) with each row of an earlier one that holds one of its parcels.

        Columns `key` of the later row, `hist_source`, `hist_key`.
        """
        empty = "source string, key string, hist_source string, hist_key string"
        if self.segments < 2:
            return self.spark.createDataFrame([], empty).select("key", "hist_source", "hist_key")
        held = self.spark.read.parquet(self._at("rows")).select("segment", "source", "key", F.explode("items").alias("item"))
        late = held.filter(F.col("segment") > 0 if segment is None else F.col("segment") == segment).select(F.col("segment").alias("late"), F.col("key").alias("row_key"), "item")
        found = self.spark.read.parquet(self._at("found"))
        hits = found.filter(F.col("kind") == PARCELS).select(F.col("segment").alias("late"), F.col("q").alias("item"), F.col("n").alias("node")).distinct()
        labels = cut(components(found.filter(F.col("kind") != PARCELS), "n", "q"), "labels")
        same = labels.select(F.col("node").alias("item"), "label").join(labels, "label").filter("item <> node").select("item", "node")
        met = late.join(hits, ["late", "item"]).select("late", "row_key", "node").unionByName(late.join(same, "item").select("late", "row_key", "node"))
        early = held.select(F.col("segment").alias("early"), F.col("source").alias("hist_source"), F.col("key").alias("hist_key"), F.col("item").alias("node"))
        return met.join(early, "node").filter("early < late").select(F.col("row_key").alias("key"), "hist_source", "hist_key").distinct()


def duplicates(rows: DataFrame, batches: int) -> DataFrame:
    """Each row of a batch with each earlier row of its area that holds one of its parcels: `key`, `hist_source`, `hist_key`.

    `rows` come from `history_rows`; segment 0 was accepted before the first
    batch, `batches` is the number of the last one. Each segment is added to a
    new `History` in turn.
    """
    history = History(rows.sparkSession)
    known = cut(rows, "rows")
    for segment in range(batches + 1):
        history.add(known.filter(F.col("segment") == segment).drop("segment"))
    return history.repeats()
