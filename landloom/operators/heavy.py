"""Per-key results when a handful of keys hold most rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys with at least this share of the sketched rows are heavy.
HEAVY_SHARE = 0.01
#: Share of rows that the sketch looks at; which rows is decided by their content.
SKETCH_SHARE = 0.05
#: Parts into which the rows of one heavy key are dealt.
SALTS = 64


@dataclass(frozen=True)
class Split:
    """Rows of heavy keys, all other rows, and the heavy keys."""

    heavy: DataFrame
    light: DataFrame
    keys: DataFrame


def _name(df: DataFrame, base: str) -> str:
    """A column name that no column of `df` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def heavy_keys(df: DataFrame, keys: list[str], share: float = HEAVY_SHARE, sketch: float = SKETCH_SHARE) -> DataFrame:
    """The keys with the most rows in a sampled sketch, at most 1/share of them.

    No more than 1/share keys can hold that share of all rows, so every such key
    that the sketch saw is among them and the result, bounded by that number,
    may be broadcast. The sketch decides only which way the rows of a key take;
    the results below are the same whatever it finds. A null key is a key like
    any other. An empty table has no heavy key.
    """
    n = _name(df, "n__")
    counts = df.sample(False, sketch, seed=17).groupBy(*keys).agg(F.count(F.lit(1)).alias(n)).filter(F.col(n) > 1)
    return counts.orderBy(F.desc(n), *keys).limit(int(1 / share)).select(*keys)


def split_heavy(df: DataFrame, keys: list[str], share: float = HEAVY_SHARE, sketch: float = SKETCH_SHARE) -> Split:
    """Split `df` by whether its key is heavy; the heavy keys, at most 1/share, are broadcast."""
    hot = heavy_keys(df, keys, share, sketch)
    mark = hot.select(*[F.col(k).alias(f"hot__{i}") for i, k in enumerate(keys)])
    on = None
    for i, k in enumerate(keys):
        one = _same(df[k], mark[f"hot__{i}"])
        on = one if on is None else on & one
    return Split(df.join(F.broadcast(mark), on, "left_semi"), df.join(F.broadcast(mark), on, "left_anti"), hot)


def best_row_per_key(df: DataFrame, keys: list[str], order: Column, pick: Column, *, share: float = HEAVY_SHARE, salts: int = SALTS) -> DataFrame:
    """Per key the `pick` of the row with the greatest `order`, and the number of rows.

    Rows whose `order` is null count but are never picked; a key without any
    other row has a null `best`. Equal `order` values must not occur between
    different `pick` values (put a tie-breaker into `order`; a number rather than
    a struct keeps the aggregation in hash tables). Heavy keys are
    found with a sketch, their rows marked by a broadcast join and reduced in
    `salts` parts; all other keys take one ordinary shuffle; then union.
    Columns: the keys, `best`, `n_rows`.
    """
    rows = df.select(*keys, order.alias("ord__"), pick.alias("pick__"))
    parts = split_heavy(rows, keys, share)
    partial = parts.heavy.withColumn("salt__", F.pmod(F.xxhash64("pick__"), F.lit(salts))).groupBy(*keys, "salt__").agg(
        F.max_by("pick__", "ord__").alias("pick__"), F.max("ord__").alias("ord__"), F.count(F.lit(1)).alias("n__"))
    heavy = partial.groupBy(*keys).agg(F.max_by("pick__", "ord__").alias("best"), F.sum("n__").alias("n_rows"))
    light = parts.light.groupBy(*keys).agg(F.max_by("pick__", "ord__").alias("best"), F.count(F.lit(1)).alias("n_rows"))
    return heavy.unionByName(light)


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], *, how: str = "inner", share: float = HEAVY_SHARE, salts: int = SALTS) -> DataFrame:
    """Equi-join whose left side may have heavy keys.

    Rows of heavy keys are dealt over `salts` parts and meet the right rows of
    those keys, repeated once per part; all others take an ordinary join.
    `how` is inner, left, left_semi or left_anti. Null keys match nothing, as in SQL.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    salt = _name(left, "salt__")
    while salt.lower() in {c.lower() for c in right.columns}:
        salt = "_" + salt
    parts = split_heavy(left, keys, share)
    mark = parts.keys.select(*[F.col(k).alias(f"hot__{i}") for i, k in enumerate(keys)])
    on = None
    for i, k in enumerate(keys):
        one = right[k] == mark[f"hot__{i}"]
        on = one if on is None else on & one
    many = right.join(F.broadcast(mark), on, "left_semi").withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    few = parts.heavy.withColumn(salt, F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    return few.join(many, [*keys, salt], how).drop(salt).unionByName(parts.light.join(right, keys, how))
