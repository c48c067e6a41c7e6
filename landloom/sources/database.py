"""Stored tables: over JDBC or as Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.functions.text import county_key


def read_stored(spark: SparkSession, place: str, table: str, *, columns: Sequence[str] | None = None, partition: str = "county_id", parts: int = 64, bounds: tuple[int, int] | None = None, page: int = 10_000, **options: str) -> DataFrame:
    """A stored table: `jdbc:` places are read in ranges of `partition`, others are folders of Parquet tables."""
    if place.startswith("jdbc:"):
        reader = spark.read.format("jdbc").option("url", place).option("dbtable", table).option("fetchsize", page).options(**options)
        if bounds:
            reader = reader.option("partitionColumn", partition).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
        df = reader.load()
    else:
        df = spark.read.parquet(f"{place.rstrip('/')}/{table}.parquet")
    return df.select(*columns) if columns else df


def county_dimension(df: DataFrame, ident: str = "county_id", name: str = "county_name") -> DataFrame:
    """Counties with the key by which other sources name them; of names that fall together the smallest id stays."""
    return df.withColumn("county_key", county_key(F.col(name))).groupBy("county_key").agg(F.min_by(F.struct(*df.columns), ident).alias("c")).select("county_key", "c.*")


def with_county(df: DataFrame, counties: DataFrame, name: str) -> DataFrame:
    """Rows with the county that `name` names; `county_known` is false where there is none."""
    keyed = df.withColumn("county_key", county_key(F.col(name)))
    add = county_dimension(counties).select("county_key", *[c for c in counties.columns if c not in df.columns], F.lit(True).alias("county_known"))
    return keyed.join(add, "county_key", "left").withColumn("county_known", F.coalesce("county_known", F.lit(False)))


def row_counts(df: DataFrame, by: str | None = None) -> DataFrame:
    """Rows in all, or per value of `by`."""
    return (df.groupBy(by) if by else df.groupBy()).agg(F.count(F.lit(1)).alias("n_rows"))
