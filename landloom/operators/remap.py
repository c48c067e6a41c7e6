"""Raw exports to the fixed essential columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landloom.functions.schema import ESSENTIAL, built, mapping
from landloom.functions.text import value_text
from landloom.missing import M8, is_missing


def drop_blank_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows in which some cell, apart from the ignored columns, is not blank. No columns, no rows."""
    cells = [value_text(F.col(f"`{c}`")) != "" for c in df.columns if c not in ignore]
    return df.filter(reduce(lambda a, b: a | b, cells)) if cells else df.filter("false")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows; columns by name in the order they are first seen, nulls where a frame lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def remap(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The essential columns as text, built from whatever columns `df` has; `keep` passes columns through."""
    sources = mapping([c for c in df.columns if c not in keep])
    return df.select(*keep, *[built(sources[name]).alias(name) for name in ESSENTIAL])


def blank_counts(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and blank cells per column."""
    names = [c for c in (columns or df.columns) if c not in by]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(is_missing(F.col(f"`{c}`"), M8)).alias(f"blank_{c}") for c in names])
