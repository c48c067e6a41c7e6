"""Parcels grouped by owner, their values kept in aligned lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landloom.functions.arrays import acres_texts, json_text
from landloom.functions.numbers import parse_number
from landloom.functions.text import clean_cell
from landloom.missing import is_missing

ALIGNED = ("market_value_list", "owner_tax_year_list", "deed_date_list", "legal_acreage_filled_by_script", "Empty_Legal_Acreage")


def ordered(column: str, order: Sequence[str]) -> Column:
    """The cleaned values of a group in the order of its rows."""
    place = F.struct(*[F.col(f"`{o}`") for o in order])
    return F.transform(F.array_sort(F.collect_list(F.struct(place.alias("o"), clean_cell(F.col(f"`{column}`")).alias("v")))), lambda s: s["v"])


def group_owners(df: DataFrame, area: Sequence[str], order: Sequence[str], *, name: str = "full_name", address: str = "mailing_address", legal: str = "legal_address", acres: str = "acres", ident: str = "id", aligned: Sequence[str] = ALIGNED) -> DataFrame:
    """One row per area, owner name and mailing address, with a list per aligned column.

    Names and addresses are compared as cleaned text, case and all; a row whose
    address is missing is a group of its own. The representative row is that
    with the most acres among those with a legal address, else with the most
    acres, the first among equals; acres that are no number count as none.
    Lists are JSON text in the order of the rows; `lands_count` counts them.
    Rows are reduced by one shuffle on the group key.
    """
    present = [c for c in aligned if c in df.columns]
    place = F.struct(*[F.col(f"`{o}`") for o in order])
    number = F.coalesce(parse_number(F.col(f"`{acres}`")), F.lit(0.0))
    usable = ~is_missing(F.col(f"`{legal}`"))
    rows = df.withColumns({
        "name__": clean_cell(F.col(f"`{name}`")), "address__": F.when(is_missing(F.col(f"`{address}`")), F.concat(F.lit("__row_"), F.to_json(place))).otherwise(clean_cell(F.col(f"`{address}`"))),
    })
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    # The greatest acres first; among equals the smallest place, so places are compared by their negation.
    best = F.min_by(whole, F.struct(F.when(usable, 0).otherwise(1), -number, place))
    groups = rows.groupBy(*area, "name__", "address__").agg(
        best.alias("r"), F.count(F.lit(1)).alias("lands_count"), ordered(ident, order).alias("ids__"), ordered(acres, order).alias("acres__"), F.min(place).alias("place__"),
        *[ordered(c, order).alias(f"list__{c}") for c in present])
    lists = {"id_list": json_text(F.col("ids__")), "acres_list": json_text(acres_texts(F.col("acres__"))), **{c: json_text(F.col(f"list__{c}")) for c in present}}
    rest = [c for c in df.columns if c not in lists and c not in ("lands_count",)]
    return groups.select(*[F.col("r")[c].alias(c) for c in rest], F.col("lands_count").cast("int").alias("lands_count"), *[v.alias(k) for k, v in lists.items()])


def selection_counts(df: DataFrame, area: Sequence[str], order: Sequence[str], **names: str) -> DataFrame:
    """Per area: rows, groups, groups of several rows, and groups without any legal address."""
    legal = names.get("legal", "legal_address")
    flagged = df.withColumn("has_legal__", ~is_missing(F.col(f"`{legal}`")))
    place = F.struct(*[F.col(f"`{o}`") for o in order])
    address = names.get("address", "mailing_address")
    key = F.when(is_missing(F.col(f"`{address}`")), F.to_json(place)).otherwise(clean_cell(F.col(f"`{address}`")))
    groups = flagged.groupBy(*area, clean_cell(F.col(names.get("name", "full_name"))).alias("n__"), key.alias("k__")).agg(F.count(F.lit(1)).alias("n_rows"), F.bool_or("has_legal__").alias("legal"))
    return groups.groupBy(*area).agg(
        F.sum("n_rows").alias("rows_before"), F.count(F.lit(1)).alias("groups"), F.count_if(F.col("n_rows") > 1).alias("groups_of_several"),
        F.count_if(~F.col("legal")).alias("groups_without_legal"), F.max("n_rows").alias("most_parcels"))
