"""Parcels that the database already holds, taken out of new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landloom.functions.arrays import json_text, list_cell_loose, recomputed_acres
from landloom.functions.numbers import number_text, whole_exact
from landloom.functions.text import clean_scalar, once
from landloom.missing import M5, is_missing
from landloom.operators.owners import ALIGNED


def land_text(col: Column) -> Column:
    """An id as text, quotes and `.0` dropped; leading zeros stay unless `.0` shows a number."""
    text = F.regexp_replace(clean_scalar(col), "^['\"]+|['\"]+$", "")
    number = text.rlike(r"^-?\d+\.0+$")
    return F.when(number, F.regexp_replace(F.regexp_replace(text, r"\.0+$", ""), r"^(-?)0+(?=\d)", "$1")).otherwise(text)


def id_keys(col: Column) -> Column:
    """The forms under which an id is compared: its text and, of a number, the plain number. A missing id has none."""
    plain = whole_exact(col).cast("string")
    return F.when(is_missing(col, M5), F.array().cast("array<string>")).otherwise(F.array_distinct(F.array_compact(F.array(F.nullif(land_text(col), F.lit("")), plain))))


def existing_keys(df: DataFrame, area: Sequence[str], land: str = "land_id", ids: str = "id_list") -> DataFrame:
    """The distinct keys of an area that rows hold as land id or in their id list, with where they come from."""
    listed = F.col(f"`{ids}`") if dict(df.dtypes)[ids].startswith("array") else list_cell_loose(F.col(f"`{ids}`"))
    of_land = df.select(*area, F.explode(id_keys(F.col(f"`{land}`"))).alias("parcel"), F.lit(0).alias("rank"))
    of_list = df.select(*area, F.explode(listed).alias("x")).select(*area, F.explode(id_keys(F.col("x").cast("string"))).alias("parcel"), F.lit(1).alias("rank"))
    return of_land.unionByName(of_list).groupBy(*area, "parcel").agg(F.min("rank").alias("rank"))


def key_statistics(keys: DataFrame, area: Sequence[str]) -> DataFrame:
    """Distinct keys per area, those of land ids and those that only lists add."""
    return keys.groupBy(*area).agg(F.count_if(F.col("rank") == 0).alias("land_keys"), F.count_if(F.col("rank") == 1).alias("list_keys_added"), F.count(F.lit(1)).alias("all_keys"))


def subtract_parcels(df: DataFrame, keys: DataFrame, area: Sequence[str], row: str, *, ident: str = "id", ids: str = "id_list", aligned: Sequence[str] = ("acres_list", *ALIGNED), counts: Sequence[str] = ("lands_count", "owned_lands"), acres: str = "acres") -> DataFrame:
    """Rows with the parcels that are not in `keys`, and what became of each row.

    `outcome`: `kept` whole, `partial` (lists cut to the parcels that remain,
    id, counts and acres made new), `dropped` (all parcels there already; its
    cells as before), `skipped_kept` (no id to compare). `seen`, `removed`,
    `remaining` count parcels; `removed_ids` lists them. `row` must be unique.
    Ids are exploded once, joined once and put together again by row.
    """
    present = [c for c in aligned if c in df.columns]
    has_list = ids in df.columns
    listed = list_cell_loose(F.col(f"`{ids}`")) if has_list else F.array().cast("array<string>")
    from_list = F.size(listed) > 0
    every = F.when(from_list, listed).otherwise(F.array(F.col(f"`{ident}`").cast("string")))
    rows = df.withColumn("ids__", F.when(is_missing(F.col(f"`{ident}`"), M5), F.array().cast("array<string>")).otherwise(every)).withColumn("list__", from_list)
    items = rows.select(*area, F.col(f"`{row}`").alias("row__"), F.posexplode("ids__").alias("pos", "item")).withColumn("forms", id_keys(F.col("item"))).filter(F.size("forms") > 0)
    probe = items.select(*area, "row__", "pos", F.explode("forms").alias("parcel"))
    there = keys.select(*area, "parcel").distinct().withColumn("there__", F.lit(True))
    compared = probe.join(there, [*area, "parcel"], "left").groupBy("row__").agg(F.collect_set("pos").alias("valid__"), F.collect_set(F.when(F.col("there__"), F.col("pos"))).alias("hit__"))
    marked = rows.join(compared, rows[row] == compared["row__"], "left").drop("row__")
    none = F.array().cast("array<int>")
    marked = marked.withColumns({"valid__": F.array_sort(F.coalesce("valid__", none)), "hit__": F.array_sort(F.coalesce("hit__", none))})
    marked = marked.withColumn("left__", F.array_except("valid__", "hit__"))
    n_valid, n_hit, n_left = F.size("valid__"), F.size("hit__"), F.size("left__")
    outcome = F.when(n_valid == 0, "skipped_kept").when(n_hit == 0, "kept").when(n_left == 0, "dropped").otherwise("partial")
    marked = marked.withColumn("outcome", outcome)
    # Each cell is parsed once, never once per item, and only where its list is cut.
    partial = F.col("outcome") == "partial"
    at = lambda values, places, read: once(values, lambda v: F.transform(places, lambda i: once(F.coalesce(F.get(v, i), F.lit("")), read)))
    picked = {c: at(list_cell_loose(F.col(f"`{c}`")), "left__", lambda x: F.when(is_missing(x, M5), "").otherwise(x)) for c in present}
    out = {}
    for c, values in picked.items():
        out[c] = F.when(partial & F.col("list__"), json_text(values, spaced=False)).otherwise(F.col(f"`{c}`"))
    if has_list:
        out[ids] = F.when(partial, json_text(at(F.col("ids__"), "left__", land_text), spaced=False)).otherwise(F.col(f"`{ids}`"))
    out[ident] = F.when(partial, land_text(F.coalesce(F.get("ids__", F.get("left__", F.lit(0))), F.lit("")))).otherwise(F.col(f"`{ident}`"))
    for c in counts:
        if c in df.columns:
            out[c] = F.when(partial, n_left.cast(df.schema[c].dataType)).otherwise(F.col(f"`{c}`"))
    if "acres_list" in present and acres in df.columns:
        marked = marked.withColumn("fresh__", F.when(partial, recomputed_acres(picked["acres_list"])))
        made = number_text(F.col("fresh__"), 6) if dict(df.dtypes)[acres] == "string" else F.col("fresh__")
        out[acres] = F.when(F.col("fresh__").isNotNull(), made).otherwise(F.col(f"`{acres}`"))
    removed = json_text(at(F.col("ids__"), "hit__", land_text), spaced=False)
    return marked.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns], "outcome", n_valid.alias("seen"), n_hit.alias("removed"), n_left.alias("remaining"), removed.alias("removed_ids"))


def outcome_counts(subtracted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return subtracted.groupBy(*by).agg(
        *[F.count_if(F.col("outcome") == o).alias(f"rows_{o}") for o in ("kept", "partial", "dropped", "skipped_kept")],
        F.sum("seen").alias("parcels_seen"), F.sum("removed").alias("parcels_removed"), F.sum("remaining").alias("parcels_kept"))
