"""Rows left out by key phrases in the owner's name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landloom.functions.text import clean_cell, phrase_pattern

# The phrases that leave an owner out.
OWNER_PHRASES = ("university", "church", "ministries", "hospital", "medical", "school", "community development", "county of", "county")


def matched_phrases(name: Column, phrases: Sequence[str] = OWNER_PHRASES, *, inside: bool = False) -> Column:
    """The phrases within a name, in the order given; repeated phrases count once."""
    unique = list({p.strip().lower(): p.strip() for p in phrases if p.strip()}.values())
    if not unique:
        raise ValueError("no phrases given")
    text = clean_cell(name)
    return F.array_compact(F.array(*[F.when(text.rlike(phrase_pattern(p, inside=inside)), F.lit(p)) for p in unique]))


def split_excluded(df: DataFrame, name: str, phrases: Sequence[str] = OWNER_PHRASES, *, inside: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows to keep, and removed rows with the phrases found in `removed_by`; together they are all rows."""
    found = df.withColumn("found__", matched_phrases(F.col(f"`{name}`"), phrases, inside=inside))
    removed = found.filter(F.size("found__") > 0).withColumn("removed_by", F.array_join("found__", " | "))
    return found.filter(F.size("found__") == 0).drop("found__"), removed.drop("found__")


def phrase_counts(df: DataFrame, name: str, phrases: Sequence[str] = OWNER_PHRASES, by: Sequence[str] = ()) -> DataFrame:
    """Rows per phrase, most first, then by phrase."""
    hits = df.select(*by, F.explode(matched_phrases(F.col(f"`{name}`"), phrases)).alias("phrase"))
    return hits.groupBy(*by, "phrase").agg(F.count(F.lit(1)).alias("n_rows")).orderBy(*by, F.desc("n_rows"), F.lower("phrase"))


def phrase_summary(df: DataFrame, name: str, phrases: Sequence[str] = OWNER_PHRASES, by: Sequence[str] = ()) -> DataFrame:
    """The counts as one text, `phrase=count` joined by bars."""
    counts = phrase_counts(df, name, phrases, by)
    parts = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n_rows")).alias("a"), F.lower("phrase").alias("b"), F.concat_ws("=", "phrase", F.col("n_rows").cast("string")).alias("t")))), lambda s: s["t"])
    return counts.groupBy(*by).agg(F.array_join(parts, " | ").alias("summary"))


def first_names(df: DataFrame, name: str, order: Sequence[str], most: int = 10) -> DataFrame:
    """The first distinct names in order, whatever their case, `most` of them."""
    rows = df.select(clean_cell(F.col(f"`{name}`")).alias("name"), F.struct(*order).alias("o")).filter("name <> ''")
    return rows.groupBy(F.lower("name").alias("k")).agg(F.min_by("name", "o").alias("name"), F.min("o").alias("o")).orderBy("o").limit(most).select("name")
