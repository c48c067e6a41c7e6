"""Several values packed in one cell: segmentation learned from the whole column.

A cell is cut at every place that may separate two values (comma, semicolon,
bar, slash, ampersand, tab, newline, the word "and"); quoted spans are one
atom. A lattice joins neighbouring atoms again into candidate values. How
often each shape of value occurs is learned by expectation-maximisation over
all cells of the column, and the Viterbi path through the lattice is the split.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landloom.missing import TABLE_TOKENS
from landloom.session import cut

#: Neighbouring atoms that one value may span.
MAX_ATOMS = 4
#: Expectation-maximisation rounds after the start from undoubted values.
ROUNDS = 2
#: Shapes that the model holds; rarer ones get the floor probability.
MODEL_SHAPES = 20_000
FLOOR = 1e-7
HARD = "|;\t\n"

_SEP = re.compile(r"[ \u00a0]*(?:[,;|&\t]|\r?\n|(?<!\b[nN])/|/(?![aA]\b))[ \u00a0]*|[ \u00a0]+and[ \u00a0]+", re.IGNORECASE)
_QUOTED = re.compile(r"[ \u00a0]*(\"[^\"]*\"|'[^']*')(?=[ \u00a0]*(?:[,;|&\t/]|\r?\n|[ \u00a0]and[ \u00a0]|$))", re.IGNORECASE)
_DIGITS = str.maketrans("0123456789", "9" * 10)
_RUN = re.compile(r"9+|[^\W\d_]+")
_AROUND = " \u00a0"
#: A cell without any of these holds one value.
MAYBE = r"[,;|/&\t\n]|(?i)\sand\s"


def _run(m: re.Match) -> str:
    text = m[0]
    if text[0] != "9":
        return "w"
    return "a" if len(text) < 3 else "t" if len(text) == 3 else "L"


def shape(atom: str) -> str:
    """The class of an atom: runs of 1-2, 3 and more digits, words, other characters."""
    text = _SEP.sub(lambda m: _sep_class(m[0]), atom.translate(_DIGITS))
    return re.sub(r"\.[atL]", ".f", _RUN.sub(_run, text))[:40]


def atoms(cell: str) -> tuple[list[tuple[int, int, bool]], list[str]]:
    """Spans of the atoms (start, end, quoted) and the separators between them."""
    lo, hi = 0, len(cell)
    body = cell.strip(_AROUND)
    if len(body) > 1 and (body[0] + body[-1]) in ("[]", "{}", "()"):
        lo = cell.index(body[0]) + 1
        hi = cell.rindex(body[-1])
    spans, seps, at = [], [], lo
    while True:
        quoted = _QUOTED.match(cell, at, hi)
        if quoted:
            spans.append((quoted.start(1) + 1, quoted.end(1) - 1, True))
            sep = _SEP.match(cell, quoted.end(), hi)
            if not sep:  # only spaces are left
                return spans, seps
        else:
            sep = _SEP.search(cell, at, hi)
            spans.append((at, sep.start() if sep else hi, False))
            if not sep:
                return spans, seps
        seps.append(sep[0])
        at = sep.end()


def _sep_class(sep: str) -> str:
    return ("_" if sep[0] in _AROUND else "") + sep.strip(_AROUND).lower() + ("_" if len(sep) > 1 and sep[-1] in _AROUND else "")


def chunks(masked: str) -> list[tuple[list[tuple[int, int, bool]], list[str], list[str]]]:
    """The parts of a cell between undoubted separators: spans, shapes, separator classes.

    A separator is undoubted if it is hard (never inside a value) or touches a quoted span.
    """
    spans, seps = atoms(masked)
    out = [([spans[0]], [shape(masked[spans[0][0]:spans[0][1]].strip())], [])]
    for sep, before, span in zip(seps, spans, spans[1:]):
        kind = _sep_class(sep)
        text = shape(masked[span[0]:span[1]].strip())
        if kind.strip("_") in HARD or kind.strip("_") in ("\r\n", "") or before[2] or span[2] or before[0] >= before[1] or span[0] >= span[1]:
            out.append(([span], [text], []))
        else:
            out[-1][0].append(span)
            out[-1][1].append(text)
            out[-1][2].append(kind)
    return out


def _edges(shapes: list[str], seps: list[str]) -> list[list[tuple[int, str]]]:
    """For each end position the candidate values (start, shape) that end there."""
    out = []
    for j in range(1, len(shapes) + 1):
        row, text = [], ""
        for i in range(j - 1, max(-1, j - 1 - MAX_ATOMS), -1):
            text = shapes[i] + (seps[i] + text if text or i < j - 1 else text)
            row.append((i, text))
        out.append(row)
    return out


def viterbi(shapes: list[str], seps: list[str], cost: dict[str, float], floor: float) -> list[tuple[int, int]]:
    """Atom ranges of the cheapest path; among equal ones that with the shorter last value."""
    best, back = [0.0], [0]
    for row in _edges(shapes, seps):
        options = [(best[i] + cost.get(text, floor * (len(best) - i)), -i, i) for i, text in row]
        total, _, i = min(options)
        best.append(total)
        back.append(i)
    path, j = [], len(shapes)
    while j:
        path.append((back[j], j))
        j = back[j]
    return path[::-1]


def expected(shapes: list[str], seps: list[str], prob: dict[str, float], floor: float) -> Counter:
    """Expected number of each value shape by forward and backward sums, scaled at each step."""
    edges, n = _edges(shapes, seps), len(shapes)
    weight = [[(i, text, prob.get(text, floor ** (j - i))) for i, text in row] for j, row in enumerate(edges, 1)]
    fore, scale = [1.0], [1.0]
    for j, row in enumerate(weight, 1):
        total = 0.0
        for i, _, p in row:
            s = p * fore[i]
            for k in range(i + 1, j):
                s /= scale[k]
            total += s
        scale.append(total or 1e-300)
        fore.append(1.0)
    back = [0.0] * n + [1.0]
    for j in range(n, 0, -1):
        for i, _, p in weight[j - 1]:
            s = p * back[j]
            for k in range(i + 1, j + 1):
                s /= scale[k]
            back[i] += s
    out: Counter = Counter()
    for j, row in enumerate(weight, 1):
        for i, text, p in row:
            s = p * back[j]
            for k in range(i + 1, j + 1):
                s /= scale[k]
            out[text] += s
    return out


def _key(shapes: list[str], seps: list[str]) -> str:
    return "\x01".join(shapes) + "\x02" + "\x01".join(seps)


def _count_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()
    for batch in batches:
        seen: Counter = Counter(zip(batch["field_name"], (x.translate(_DIGITS) for x in batch["cell"])))
        for (field, masked), n in seen.items():
            for _, shapes, seps in chunks(masked):
                counts[field, _key(shapes, seps)] += n
        if len(counts) > 200_000:
            yield pd.DataFrame([(f, k, n) for (f, k), n in counts.items()], columns=["field_name", "chunk", "n"])
            counts.clear()
    yield pd.DataFrame([(f, k, n) for (f, k), n in counts.items()], columns=["field_name", "chunk", "n"])


def _unkey(key: str) -> tuple[list[str], list[str]]:
    shapes, seps = key.split("\x02")
    return shapes.split("\x01"), seps.split("\x01") if seps else []


def _model(df: DataFrame) -> dict[str, dict[str, float]]:
    """Relative frequencies of the shapes per field; the number of shapes is bounded."""
    sums = df.groupBy("field_name", "shape").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "field_name", "shape").limit(MODEL_SHAPES)
    out: dict[str, dict[str, float]] = {}
    for field, text, n in sums.collect():
        if n > 1e-6:
            out.setdefault(field, {})[text] = n
    return {f: {s: n / sum(m.values()) for s, n in m.items()} for f, m in out.items()}


def learn(cells: DataFrame, rounds: int = ROUNDS) -> dict[str, dict[str, float]]:
    """Value shape frequencies per field from all cells (`field_name`, `cell`)."""
    maybe = F.col("cell").rlike(MAYBE)
    # A cell that holds no separator is one undoubted value; its shape is taken on the JVM.
    plain = cells.filter(~maybe).select("field_name", F.regexp_replace(F.regexp_replace("cell", r"[0-9]", "9"), r"[\p{L}]+", "w").alias("cell")).groupBy("field_name", "cell").agg(F.count(F.lit(1)).alias("times"))
    packed = cells.filter(maybe).select("field_name", "cell").mapInPandas(_count_chunks, "field_name string, chunk string, n long")

    def plain_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(f, _key(s, p), n) for f, c, n in zip(batch["field_name"], batch["cell"], batch["times"]) for _, s, p in chunks(c)]
            yield pd.DataFrame(rows, columns=["field_name", "chunk", "n"])

    both = packed.unionByName(plain.mapInPandas(plain_chunks, "field_name string, chunk string, n long"))
    table = cut(both.groupBy("field_name", "chunk").agg(F.sum("n").alias("n")), "chunks")

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(f, s[0], float(n)) for f, k, n in zip(batch["field_name"], batch["chunk"], batch["n"]) for s, p in [_unkey(k)] if not p]
            yield pd.DataFrame(rows, columns=["field_name", "shape", "n"])

    model = _model(table.mapInPandas(start, "field_name string, shape string, n double"))
    for _ in range(rounds):
        now = model

        def step(batches: Iterator[pd.DataFrame], now: dict = now) -> Iterator[pd.DataFrame]:
            for batch in batches:
                sums: Counter = Counter()
                for f, k, n in zip(batch["field_name"], batch["chunk"], batch["n"]):
                    for text, x in expected(*_unkey(k), now.get(f, {}), FLOOR).items():
                        sums[f, text] += x * n
                yield pd.DataFrame([(f, s, x) for (f, s), x in sums.items()], columns=["field_name", "shape", "n"])

        model = _model(table.mapInPandas(step, "field_name string, shape string, n double"))
    return model


class Splitter:
    """Splits cells by a learned model; paths are kept per digit-masked cell."""

    def __init__(self, model: dict[str, dict[str, float]]) -> None:
        self.cost = {f: {s: -math.log(p) for s, p in m.items()} for f, m in model.items()}
        self.floor = -math.log(FLOOR)
        self.paths: dict[tuple[str, str], list[tuple[int, int]]] = {}

    def spans(self, field: str, masked: str) -> list[tuple[int, int]]:
        got = self.paths.get((field, masked))
        if got is None:
            got, cost = [], self.cost.get(field, {})
            for spans, shapes, seps in chunks(masked):
                got += [(spans[i][0], spans[j - 1][1]) for i, j in viterbi(shapes, seps, cost, self.floor)] if seps else [spans[0][:2]]
            if len(self.paths) > 100_000:
                self.paths.clear()
            self.paths[field, masked] = got
        return got

    def split(self, field: str, cell: str) -> list[str]:
        values = [cell[a:b].strip() for a, b in self.spans(field, cell.translate(_DIGITS))]
        return ["" if v.lower() in TABLE_TOKENS else v for v in values]


def unpack(df: DataFrame, keys: list[str], fields: list[str], *, rounds: int = ROUNDS) -> DataFrame:
    """One row per value of each packed cell: the keys, `field_name`, `item_pos`, `item_text`, `n_items`.

    `item_text` is the value as written, without enclosing quotes and outer
    white space; an absent value or missing token keeps its position as an
    empty string. A missing cell gives no row; a cell with one value gives one
    row. Equal cells give equal rows, once per input row. An empty table gives
    an empty result.
    """
    cell = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"`{f}`").cast("string").alias("cell")) for f in fields])).alias("c")
    cells = df.select(*[F.col(f"`{k}`").alias(f"key{i}__") for i, k in enumerate(keys)], cell)
    cells = cells.select(*[f"key{i}__" for i in range(len(keys))], "c.field_name", "c.cell").filter(F.col("cell").isNotNull() & ~F.lower(F.trim("cell")).isin(*TABLE_TOKENS))
    model = learn(cells, rounds)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(fields: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        splitter = Splitter(model)
        for field, cell in fields:
            yield pd.Series([splitter.split(f, c) for f, c in zip(field, cell)], index=cell.index, dtype=object)

    maybe = F.col("cell").rlike(MAYBE)
    many = cells.filter(maybe).withColumn("values__", split("field_name", "cell"))
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace("cell", r"(?U)^\s+|\s+$", ""), r"^[\[{(]\s*(.*?)\s*[\]})]$", "$1"), r"^([\"'])(.*)\1$", "$2")
    one = cells.filter(~maybe).withColumn("values__", F.array(F.when(F.lower(F.trim(bare)).isin(*TABLE_TOKENS), "").otherwise(bare)))
    out = many.unionByName(one).withColumn("n_items", F.size("values__"))
    named = [F.col(f"key{i}__").alias(k) for i, k in enumerate(keys)]
    return out.select(*named, "field_name", "n_items", F.posexplode("values__").alias("item_pos", "item_text"))
