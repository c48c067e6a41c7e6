"""Duplicate parcel ids: the first row stays, values that differ are merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landloom.functions.arrays import distinct_values, pipe_text
from landloom.functions.numbers import is_true
from landloom.functions.text import clean_cell


def dedupe_by_id(df: DataFrame, key: Sequence[str], order: Sequence[str], *, lists: Sequence[str] = (), flags: Sequence[str] = ()) -> DataFrame:
    """One row per key, the first in `order`; rows with a blank or null key part all stay.

    Of keys with several rows, `lists` columns hold all their distinct values in
    order, joined by bars, and `flags` columns `True` if any row says so;
    other keys keep their cells as they are. Keys are taken cleaned.
    """
    names = [f"key{i}__" for i in range(len(key))]
    keyed = df.withColumns({n: clean_cell(F.col(f"`{k}`")) for n, k in zip(names, key)})
    blank = F.lit(False)
    for n in names:
        blank = blank | (F.col(n) == "")
    # A blank key is its own group: the row's order makes it one.
    place = F.struct(*[F.col(f"`{o}`") for o in order])
    keyed = keyed.withColumn("alone__", F.when(blank, F.to_json(place)))
    merged = [*lists, *flags]
    rest = [c for c in df.columns if c not in merged]
    groups = keyed.groupBy(*names, "alone__").agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), place).alias("first__"), F.count(F.lit(1)).alias("n__"),
        *[F.transform(F.array_sort(F.collect_list(F.struct(place.alias("o"), F.col(f"`{c}`").cast("string").alias("v")))), lambda s: s["v"]).alias(f"all__{i}") for i, c in enumerate(lists)],
        *[F.bool_or(is_true(F.col(f"`{c}`"))).alias(f"any__{i}") for i, c in enumerate(flags)])
    out = {c: F.col("first__")[c] for c in rest}
    several = F.col("n__") > 1
    for i, c in enumerate(lists):
        out[c] = F.when(several, pipe_text(distinct_values(F.col(f"all__{i}")))).otherwise(F.col("first__")[c].cast("string"))
    for i, c in enumerate(flags):
        out[c] = F.when(several, F.when(F.col(f"any__{i}"), "True").otherwise("False")).otherwise(F.col("first__")[c].cast("string"))
    return groups.select(*[out[c].alias(c) for c in df.columns])


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str], *, last: bool = False) -> DataFrame:
    """The first (or last) row of each key; nothing is merged."""
    places = [F.col(f"`{o}`").desc() if last else F.col(f"`{o}`") for o in order]
    window = Window.partitionBy(*key).orderBy(*places)
    return df.withColumn("rn__", F.row_number().over(window)).filter("rn__ = 1").drop("rn__")


def duplicate_statistics(df: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Keys that several rows share, the rows of those, and the most rows of one key."""
    counts = df.groupBy(*by, *[k for k in key if k not in by]).agg(F.count(F.lit(1)).alias("n__"))
    return counts.groupBy(*by).agg(
        F.count_if(F.col("n__") > 1).alias("duplicate_keys"), F.coalesce(F.sum(F.when(F.col("n__") > 1, F.col("n__"))), F.lit(0)).alias("duplicate_rows"),
        F.max("n__").alias("most_rows"))
