"""Queries of the general training-data operators over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.functions.text import key_text
from landloom.missing import TABLE_TOKENS, is_missing
from landloom.operators import drift
from landloom.operators.heavy import best_row_per_key, skew_join, split_heavy
from landloom.operators.unpack import unpack
from landloom.plans.tables import table
from landloom.session import cut

Query = Callable[[SparkSession, str], DataFrame]


def _mailing(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "load_rows").select("county_id", "mailing_address", "owned_lands", "row_no")
    key = F.when(~is_missing(F.col("mailing_address"), TABLE_TOKENS), key_text(F.col("mailing_address")))
    return rows.select("county_id", key.alias("mailing_key"), "owned_lands", "row_no").filter("mailing_key is not null")


def _most_lands() -> Column:
    """Most owned lands, the smallest row_no among equals, as one number."""
    wide = "decimal(38,0)"
    return F.col("owned_lands").cast(wide) * F.lit("10000000000000000000").cast("decimal(20,0)") - F.col("row_no").cast("decimal(19,0)")


def best_owner_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Per county and mailing key the row with the most owned lands, and the rows of the key."""
    return best_row_per_key(_mailing(spark, folder), ["county_id", "mailing_key"], _most_lands(), F.col("row_no"))


def p4_best_row(spark: SparkSession, folder: str) -> DataFrame:
    return best_owner_rows(spark, folder).select("county_id", "mailing_key", F.col("best").alias("row_no"), "n_rows")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    counties = table(spark, folder, "load_rows").groupBy("county_id").agg(F.count(F.lit(1)).alias("county_rows"))
    best = best_owner_rows(spark, folder).filter("best is not null")
    return best.join(counties, "county_id").filter("n_rows * 20 >= county_rows").select("county_id", "mailing_key", F.col("best").alias("row_no"))


def p4_mail_history(spark: SparkSession, folder: str) -> DataFrame:
    """Per county and mailing key of the load rows: the accepted rows with that key, by a skew-safe join."""
    owners = table(spark, folder, "db_owner")
    key = F.when(~is_missing(F.col("mailing_address"), TABLE_TOKENS), key_text(F.col("mailing_address")))
    owners = owners.select("county_id", key.alias("mailing_key"), "acres").filter("mailing_key is not null")
    owners = owners.groupBy("county_id", "mailing_key").agg(F.count(F.lit(1)).alias("accepted"), F.max("acres").alias("max_acres"))
    joined = skew_join(_mailing(spark, folder), owners, ["county_id", "mailing_key"])
    return joined.groupBy("county_id").agg(F.count(F.lit(1)).alias("matched_rows"), F.sum("accepted").alias("row_pairs"), F.max("max_acres").alias("max_acres"))


def p4_heavy_share(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with a mailing address per county, counted on both ways."""
    parts = split_heavy(_mailing(spark, folder), ["county_id", "mailing_key"])
    both = parts.heavy.unionByName(parts.light)
    return both.groupBy("county_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("owned_lands").alias("lands"))


def _paths(spark: SparkSession, folder: str) -> DataFrame:
    return drift.path_values(table(spark, folder, "raw_cad"), "input_file", "record_no", "payload")


def _drift(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    paths = cut(_paths(spark, folder), "paths")
    order = drift.file_order(table(spark, folder, "file_summary"), "feed_no", "input_file", "exported_at")
    return paths, drift.changes(paths, order)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return _drift(spark, folder)[1].select("input_file", "change_kind", "old_name", "new_name")


def p1_table(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all files as one table with consistent, typed columns."""
    return drift.consistent_table(*_drift(spark, folder))[0]


def p1_failed_casts(spark: SparkSession, folder: str) -> DataFrame:
    """Per file and attribute the values that cannot be read as the attribute's type."""
    return drift.consistent_table(*_drift(spark, folder))[1]


def p1_field_values(spark: SparkSession, folder: str) -> DataFrame:
    """Non-null values per file and field."""
    return _paths(spark, folder).groupBy(F.col("file").alias("input_file"), "name").agg(F.count(F.lit(1)).alias("n_values"))


PACKED = ["id_list", "acres_list", "deed_date_list", "market_value_list"]


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = unpack(table(spark, folder, "load_rows"), ["row_no"], PACKED)
    return rows.filter("n_items > 1").select("row_no", "field_name", "item_pos", "item_text")


def p3_value_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Values, absent values and the longest list per field, over all cells."""
    rows = unpack(table(spark, folder, "load_rows"), ["row_no"], PACKED)
    return rows.groupBy("field_name").agg(F.count(F.lit(1)).alias("n_values"), F.count_if(F.col("item_text") == "").alias("n_absent"), F.max("n_items").alias("longest"))


# The white space that `(?U)\s` and DuckDB's `\s` take differs only for rare characters.
_KEY = "upper(trim(regexp_replace({0}, '[\\s\\x{{00A0}}]+', ' ', 'g')))"
_MISS = "({0} is null or lower(trim(regexp_replace({0}, '[\\s\\x{{00A0}}]+', ' ', 'g'))) in ('empty','','nan','none','null','n/a','na','--','unknown','not available'))"
_MAILING = f"""mailing as (select county_id, {_KEY.format('mailing_address')} mailing_key, owned_lands, row_no
    from load_rows where not {_MISS.format('mailing_address')})"""
_BEST = """best as (select county_id, mailing_key, count(*) n_rows,
    arg_max(row_no, (owned_lands, -row_no)) filter (owned_lands is not null) row_no from mailing group by all)"""

QUERIES: dict[str, Query] = {
    "p1_found": p1_found,
    "p1_table": p1_table,
    "p1_failed_casts": p1_failed_casts,
    "p1_field_values": p1_field_values,
    "p3_found": p3_found,
    "p3_value_counts": p3_value_counts,
    "p4_found": p4_found,
    "p4_best_row": p4_best_row,
    "p4_mail_history": p4_mail_history,
    "p4_heavy_share": p4_heavy_share,
}

ORACLES: dict[str, str] = {
    "p1_field_values": """with k as (select input_file, payload::json j, unnest(json_keys(payload::json)) as name from raw_cad)
    select input_file, name, count(*) n_values from k where json_type(j, '$."' || name || '"') <> 'NULL' group by all""",
    "p4_found": f"""with {_MAILING}, {_BEST}, c as (select county_id, count(*) n from load_rows group by all)
    select county_id, mailing_key, row_no from best join c using (county_id) where n_rows * 20 >= n and row_no is not null""",
    "p4_best_row": f"with {_MAILING}, {_BEST} select county_id, mailing_key, row_no, n_rows from best",
    "p4_mail_history": f"""with {_MAILING}, o as (select county_id, {_KEY.format('mailing_address')} mailing_key, acres from db_owner where not {_MISS.format('mailing_address')}),
    g as (select county_id, mailing_key, count(*) accepted, max(acres) max_acres from o group by all)
    select county_id, count(*) matched_rows, cast(sum(accepted) as bigint) row_pairs, max(max_acres) max_acres from mailing join g using (county_id, mailing_key) group by county_id""",
    "p4_heavy_share": f"with {_MAILING} select county_id, count(*) n_rows, cast(sum(owned_lands) as bigint) lands from mailing group by county_id",
}
