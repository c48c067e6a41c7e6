"""One more row for each mailing address that several owner rows share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landloom.functions.arrays import acres_texts, aligned_cell, field, json_text, list_cell, number_sum
from landloom.functions.numbers import id_text, number_text, parse_number
from landloom.functions.text import clean_cell, group_label, group_label_plain, mailing_code, once
from landloom.missing import is_missing
from landloom.operators.owners import ALIGNED
from landloom.session import cut

CORE = ("id", "full_name", "legal_address", "mailing_address", "acres", "city", "zip", "state")
PREFERRED = (*CORE, "lands_count", "id_list", "acres_list", *ALIGNED)


def with_parcels(df: DataFrame, aligned: Sequence[str]) -> DataFrame:
    """Owner rows with `parcels__`: their lists side by side, the row's own id and acres where a list is empty.

    One expression in which every list is made once.
    """
    own_id = F.filter(F.array(id_text(F.col("id"))), lambda x: x != "")
    own_acres = F.filter(F.array(number_text(parse_number(F.col("acres")))), lambda x: x != "")
    ids = once(list_cell(F.col("id_list"), pipes=True), lambda v: F.when(F.size(v) > 0, F.transform(v, lambda x: id_text(x))).otherwise(own_id))
    acres = once(list_cell(F.col("acres_list"), pipes=True), lambda v: F.when(F.size(v) > 0, acres_texts(v)).otherwise(own_acres))

    def beside(s: Column) -> Column:
        size = F.greatest(F.size(s["id"]), F.size(s["acres"]), F.lit(1))
        return F.struct(s["id"].alias("id"), s["acres"].alias("acres"), *[aligned_cell(F.col(f"`{c}`"), size).alias(c) for c in aligned])

    def entries(s: Column) -> Column:
        size = F.greatest(F.lit(1), *[F.size(s[n]) for n in names])
        return F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(*[F.coalesce(F.get(s[n], i), F.lit("")).alias(n) for n in names]))

    names = ["id", "acres", *aligned]
    return df.withColumn("parcels__", once(once(F.struct(ids.alias("id"), acres.alias("acres")), beside), entries))


def measures(df: DataFrame, aligned: Sequence[str]) -> DataFrame:
    """Owner rows with their parcels, count, largest parcel and its id, total acres, first id."""
    rows = with_parcels(df, aligned)
    rows = rows.withColumns({"own_acres__": F.coalesce(parse_number(F.col("acres")), F.lit(0.0)), "own_id__": id_text(F.col("id")), "given__": parse_number(F.col("lands_count"))})
    sizes = F.transform("parcels__", lambda p: F.struct(F.coalesce(parse_number(p["acres"]), F.lit(0.0)).alias("acres"), id_text(p["id"]).alias("id")))
    start = F.struct(F.col("own_id__").alias("id"), F.col("own_acres__").alias("acres"))

    def summed(s: Column) -> Column:
        best = F.aggregate(
            s, start,
            lambda b, p: F.when((p["acres"] > b["acres"]) | ((p["acres"] == b["acres"]) & (b["id"] == "") & (p["id"] != "")), F.struct(p["id"].alias("id"), p["acres"].alias("acres"))).otherwise(b))
        first = F.coalesce(F.nullif(F.col("own_id__"), F.lit("")), F.get(F.filter(F.transform(s, lambda p: p["id"]), lambda x: x != ""), F.lit(0)), F.lit(""))
        return F.struct(best.alias("best"), first.alias("first"), F.aggregate(s, F.lit(0.0), lambda a, p: a + p["acres"]).alias("total"))

    rows = rows.withColumn("sums__", once(sizes, summed))
    return rows.withColumns({
        "best__": F.col("sums__")["best"], "first__": F.col("sums__")["first"],
        "count__": F.when(F.col("given__") > 0, F.bround("given__")).otherwise(F.size("parcels__")).cast("long"),
        "total__": F.when(F.col("sums__")["total"] > 0, F.col("sums__")["total"]).otherwise(F.col("own_acres__")),
    }).drop("own_acres__", "own_id__", "given__", "sums__")


def rollup_mailing(df: DataFrame, area: Sequence[str], order: Sequence[str], *, aligned: Sequence[str] = ALIGNED, id_mode: str = "best", name_mode: str = "primary", clear_source: bool = True) -> DataFrame:
    """All rows and, for each mailing address that several rows share, one group row.

    Addresses are compared as cleaned text within an area; missing ones never
    group. The source rows of a group lose their mailing address. The group row
    takes after its primary owner: the row with the most parcels, then the
    largest parcel, then the most acres, then the first. Its id is that owner's,
    or on a tie of counts that of the largest parcel, or a code of the address;
    its parcels are those of all rows, each id once, the first.
    """
    if id_mode not in ("best", "code", "own") or name_mode not in ("primary", "owner", "group"):
        raise ValueError("unknown mode")
    present = [c for c in aligned if c in df.columns]
    place = F.struct(*[F.col(f"`{o}`") for o in order])
    key = F.when(~is_missing(F.col("mailing_address")), clean_cell(F.col("mailing_address")))
    keyed = df.withColumn("key__", key)
    shared = keyed.filter("key__ is not null").groupBy(*area, "key__").agg(F.count(F.lit(1)).alias("rows__")).filter("rows__ > 1")
    # Null keys meet nothing, so one left join marks the members; a hot address is on one small row of `shared`.
    marked = keyed.join(shared, [*area, "key__"], "left")
    # Read twice, so its lists are taken apart once.
    members = cut(measures(marked.filter("rows__ is not null"), present), "members")
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns], "best__", "first__")
    rank = F.struct((-F.col("count__")).alias("a"), (-F.col("best__")["acres"]).alias("b"), (-F.col("total__")).alias("c"), place.alias("o"))
    groups = members.groupBy(*area, "key__").agg(
        F.min_by(whole, rank).alias("r"), F.max("count__").alias("most__"), F.min(place).alias("place__"),
        F.collect_list("count__").alias("counts__"), F.sum(F.coalesce(parse_number(F.col("acres")), F.lit(0.0))).alias("rows_acres__"),
        F.array_sort(F.collect_list(F.struct(place.alias("o"), clean_cell(F.col("full_name")).alias("n")))).alias("members__"))
    # Each id once, the first: reduced by id, so a hot address is dealt over many tasks until its lists are made.
    items = members.select(*area, "key__", place.alias("o"), F.posexplode("parcels__").alias("pos", "p")).withColumn("k__", F.lower(id_text(F.col("p")["id"])))
    items = items.withColumn("k__", F.when(F.col("k__") == "", F.to_json(F.struct("o", "pos"))).otherwise(F.col("k__")))
    firsts = items.groupBy(*area, "key__", "k__").agg(F.min_by(F.struct("o", "pos", "p"), F.struct("o", "pos")).alias("f"))
    lists = firsts.groupBy(*area, "key__").agg(F.transform(F.array_sort(F.collect_list("f")), lambda f: f["p"]).alias("parcels__"))
    groups = groups.join(lists, [*area, "key__"])
    groups = groups.withColumn("total__", number_sum(field(F.col("parcels__"), "acres"))).withColumn("code__", mailing_code(F.col("r")["mailing_address"]))
    r = F.col("r")
    tied = F.size(F.filter("counts__", lambda c: c == F.col("most__"))) > 1
    largest, own = r["best__"]["id"], r["first__"]
    code = F.col("code__")
    best_id = F.when(tied, F.coalesce(F.nullif(largest, F.lit("")), own)).otherwise(F.coalesce(F.nullif(own, F.lit("")), largest))
    made = F.concat(F.lit("MA#"), code)
    chosen = {"best": F.coalesce(F.nullif(best_id, F.lit("")), made), "code": made, "own": F.coalesce(F.nullif(clean_cell(r["id"]), F.lit("")), made)}[id_mode]
    names = F.array_distinct(F.filter(F.concat(F.array(clean_cell(r["full_name"])), F.transform("members__", lambda m: m["n"])), lambda x: x != ""))
    others = F.greatest(F.size(names) - 1, F.lit(0))
    if name_mode == "primary":
        label = group_label(code, r["full_name"], others)
    elif name_mode == "owner":
        label = F.concat(F.lit("MA#"), code, F.lit(" | "), clean_cell(r["full_name"]), F.when(others > 0, F.concat(F.lit(" (+"), others.cast("string"), F.lit(")"))).otherwise(""))
    else:
        label = group_label_plain(code, F.size(names))
    total = F.col("total__")
    values = {
        "id": chosen, "full_name": label, "legal_address": F.lit(""), "mailing_address": clean_cell(r["mailing_address"]),
        "acres": number_text(F.when(total > 0, total).otherwise(F.col("rows_acres__"))), "lands_count": F.size("parcels__").cast("int"),
        "id_list": json_text(F.transform(field(F.col("parcels__"), "id"), lambda x: id_text(x))), "acres_list": json_text(acres_texts(field(F.col("parcels__"), "acres"))),
        **{c: json_text(field(F.col("parcels__"), c)) for c in present},
    }
    group_rows = groups.select(*[values.get(c, clean_cell(r[c]) if c in CORE else r[c]).cast(df.schema[c].dataType).alias(c) for c in df.columns], F.lit(True).alias("is_group"))
    sources = marked
    if clear_source:
        sources = sources.withColumn("mailing_address", F.when(F.col("rows__").isNotNull(), "").otherwise(F.col("mailing_address")))
    source_rows = sources.select(*df.columns, F.lit(False).alias("is_group"))
    return source_rows.unionByName(group_rows)
