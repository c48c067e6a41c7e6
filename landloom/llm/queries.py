"""Queries of the llm operators over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.llm.addresses_link import address_records, locations, same_place_pairs
from landloom.llm.history import duplicates, history_rows, parcel_items
from landloom.llm.language import tag_documents
from landloom.llm.leaks import find_leaks
from landloom.llm.names_link import name_records, owners, same_owner_pairs
from landloom.llm.packing import LOSS, SEGMENTS, TOKENS, fill_containers, measure
from landloom.llm.survivor import address_parts, best_values, fuse, grouped, name_words, rule_survivors
from landloom.missing import TABLE_TOKENS, is_missing
from landloom.functions.text import key_text
from landloom.plans.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def _addresses(spark: SparkSession, folder: str) -> DataFrame:
    return address_records(table(spark, folder, "load_rows"), "county_id", "row_no", ["legal_address", "mailing_address"])


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return same_place_pairs(_addresses(spark, folder))


def p2_places(spark: SparkSession, folder: str) -> DataFrame:
    """Each distinct address text of a county with the location it denotes."""
    return locations(_addresses(spark, folder)).select(F.col("area").alias("county_id"), "address_key", "place")


def _names(spark: SparkSession, folder: str) -> DataFrame:
    return name_records(table(spark, folder, "load_rows"), "county_id", "row_no", "full_name")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return same_owner_pairs(_names(spark, folder))


def p7_owners(spark: SparkSession, folder: str) -> DataFrame:
    """Each distinct name text of a county with the owner it names."""
    return owners(_names(spark, folder)).select(F.col("area").alias("county_id"), "name_key", "owner")


def _history(spark: SparkSession, folder: str) -> DataFrame:
    names = {"area": "county_id", "land": "land_id", "ids": "id_list", "name": "full_name", "address": "legal_address", "acres": "acres"}
    load = history_rows(table(spark, folder, "load_rows"), segment=F.col("batch_no"), source="load_rows", key="row_no", **names)
    owner = history_rows(table(spark, folder, "db_owner"), segment=F.lit(0), source="db_owner", key="unique_id", **names)
    return load.unionByName(owner)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    last = table(spark, folder, "load_rows").agg(F.max("batch_no")).first()[0] or 0
    found = duplicates(_history(spark, folder), last)
    return found.select(F.col("key").cast("long").alias("row_no"), F.col("hist_source").alias("hist_table"), "hist_key")


def p5_existing_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Per county the distinct parcel keys that the accepted rows hold."""
    rows = parcel_items(table(spark, folder, "db_owner"), "county_id", "land_id", "id_list")
    keys = rows.select("county_id", F.explode("parcels").alias("parcel")).distinct()
    return keys.groupBy("county_id").agg(F.count(F.lit(1)).alias("existing_parcel_id_keys"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = grouped(table(spark, folder, "load_rows"), "county_id", "land_id")
    acres = F.col("acres").try_cast("double")
    flag = F.lower(F.trim(F.coalesce(F.col("legal_acreage_filled_by_script"), F.lit(""))))
    filled = F.regexp_replace(flag, r"[\[\]\"' ]", "").rlike("^true(,true)*$")
    scores = {
        "legal_address": F.when(~is_missing(F.col("legal_address"), TABLE_TOKENS), address_parts(F.col("legal_address"))),
        "acres": F.when(acres > 0, F.when(filled, 0).otherwise(1)),
        "full_name": F.when(~is_missing(F.col("full_name"), TABLE_TOKENS), name_words(F.col("full_name"))),
    }
    found = rule_survivors(rows, "row_no", "exported_at", scores)
    return found.select(F.col("group_row").alias("group_row_no"), "field_name", F.col("best_row").alias("best_row_no"))


def p6_fused(spark: SparkSession, folder: str) -> DataFrame:
    """Per parcel and field the value of greatest posterior; the sources are the files."""
    rows = grouped(table(spark, folder, "load_rows"), "county_id", "land_id")
    acres = F.round(F.col("acres").try_cast("double"), 2)
    values = {
        "legal_address": F.when(~is_missing(F.col("legal_address"), TABLE_TOKENS), key_text(F.col("legal_address"))),
        "acres": F.when(acres > 0, acres.cast("string")),
        "full_name": F.when(~is_missing(F.col("full_name"), TABLE_TOKENS), key_text(F.col("full_name"))),
    }
    cell = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), v.alias("v")) for f, v in values.items()])).alias("c")
    flat = rows.select("area__", "key__", F.col("source_file").alias("source"), cell)
    claims = flat.select(F.concat_ws("|", "area__", "key__", "c.f").alias("item"), "source", F.col("c.v").alias("value"))
    best = best_values(fuse(claims))
    part = F.split("item", r"\|")
    return best.select(part[0].cast("int").alias("county_id"), part[1].alias("parcel"), part[2].alias("field_name"), "value", "n_sources", F.round("posterior", 6).alias("posterior"))


def p10_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Every language segment of every document, with a confidence."""
    tagged = tag_documents(table(spark, folder, "documents"), "doc_id", "text", "lang")
    return tagged.withColumnRenamed("doc", "doc_id")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    case = F.col("label_lang").isNull() | (F.col("n_segments") > 1) | (F.col("label_lang") != F.col("lang"))
    return p10_segments(spark, folder).filter(case).select("doc_id", "seg_no", "lang")


def p8_packed(spark: SparkSession, folder: str) -> DataFrame:
    """Container and position of every text, or piece of a text longer than a container."""
    packed = fill_containers(measure(table(spark, folder, "documents"), "doc_id", "text"))
    return packed.withColumnRenamed("doc", "doc_id")


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Per container what it holds, and whether every limit is kept."""
    sums = p8_packed(spark, folder).groupBy("container_id").agg(F.count(F.lit(1)).alias("n_segments"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_loss").alias("n_loss"))
    return sums.withColumn("kept", (F.col("n_tokens") <= TOKENS) & (F.col("n_segments") <= SEGMENTS) & (F.col("n_loss") <= LOSS))


def p9_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with each item it leaks: consecutive item words found, share of the item matched."""
    found = find_leaks(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "item_text")
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "words", "share")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_leaks(spark, folder).select("doc_id", "item_id").distinct()


def p9_leaked_items(spark: SparkSession, folder: str) -> DataFrame:
    """Per item the documents that leak it and the most consecutive words of it in one of them."""
    leaks = p9_leaks(spark, folder).groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("words").alias("most_words"))
    items = table(spark, folder, "eval_items").select("item_id", "item_kind")
    return items.join(leaks, "item_id", "left").select("item_id", "item_kind", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("most_words", F.lit(0)).alias("most_words"))


QUERIES: dict[str, Query] = {"p2_found": p2_found, "p2_places": p2_places, "p5_found": p5_found, "p5_existing_keys": p5_existing_keys,
    "p6_found": p6_found, "p6_fused": p6_fused, "p7_found": p7_found, "p7_owners": p7_owners,
    "p8_packed": p8_packed, "p8_fill": p8_fill,
    "p9_found": p9_found, "p9_leaks": p9_leaks, "p9_leaked_items": p9_leaked_items,
    "p10_found": p10_found, "p10_segments": p10_segments,
}

_PARCEL = """regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(regexp_replace({0}, '[\\s"''\\[\\]{{}}]', '', 'g')), '\\.0+$', ''), '[^0-9A-Z]', '', 'g'), '^R([0-9])', '\\1'), '^0+(.)', '\\1')"""
_MISSING = "('empty','','nan','none','null','n/a','na','--','unknown','not available')"

ORACLES: dict[str, str] = {
    "p5_existing_keys": f"""with x as (select county_id, land_id t from db_owner union all select county_id, cast(unnest(id_list) as varchar) t from db_owner),
    k as (select distinct county_id, {_PARCEL.format('t')} p from x where t is not null and lower(trim(t)) not in {_MISSING})
    select county_id, count(*) existing_parcel_id_keys from k where p <> '' group by county_id""",
}
