"""New rows linked to stored rows, and the values that the stored rows gain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landloom.functions.arrays import list_cell_loose, looked_up, pad_trim, typed
from landloom.functions.numbers import whole_half_even
from landloom.functions.text import clean_scalar, group_token, lower_name
from landloom.missing import M5, is_missing

SQL_TYPES = {"number": "double", "whole": "bigint", "date": "date"}
VALUE_LISTS = {"acres_list": "number", "market_value_list": "number", "owner_tax_year_list": "whole", "deed_date_list": "date"}
# Points of a link.
POINTS = {"land": 10_000, "shared": 100, "own_in_theirs": 250, "theirs_in_own": 150, "name": 30, "group": 25, "part": 10, "length": 25, "lands": 10}


def land_id(col: Column) -> Column:
    """An id as text; `10522.0` as 10522."""
    text = clean_scalar(col)
    return F.when(text.rlike(r"^\d+\.0+$"), F.regexp_replace(F.regexp_replace(text, r"\.0+$", ""), r"^0+(?=\d)", "")).otherwise(text)


def source_records(df: DataFrame, area: Sequence[str], row: str, *, ident: str = "id", ids: str = "id_list", name: str = "full_name", lands: str = "lands_count", acres: str = "acres") -> tuple[DataFrame, DataFrame]:
    """Typed records (`area`, `row`, `land_id`, `name`, `lands`, `ids`, value lists by id), and skipped rows with a reason.

    Value lists are cut or filled to the raw id list, positions without a whole
    number as id leave, and of repeated ids the first value stays.
    """
    land = land_id(F.col(f"`{ident}`"))
    raw = list_cell_loose(F.col(f"`{ids}`")) if ids in df.columns else F.array().cast("array<string>")
    raw = F.when(F.size(raw) > 0, raw).otherwise(F.array(land))
    rows = df.withColumns({"land__": land, "raw__": raw})
    rows = rows.withColumn("num__", F.transform("raw__", lambda x: whole_half_even(x)))
    fallback = F.array_compact(F.array(whole_half_even(F.col("land__"))))
    good = F.filter("num__", lambda x: x.isNotNull())
    reason = F.when(F.col("land__") == "", "missing_land_id").when((F.size(good) == 0) & (F.size(fallback) == 0), "no_valid_parcel_ids")
    rows = rows.withColumn("reason", reason)
    skipped = rows.filter("reason is not null").select(*area, F.col(f"`{row}`").alias("row"), F.col("land__").alias("land_id"), "reason")
    lists = {}
    for c, kind in VALUE_LISTS.items():
        values = list_cell_loose(F.col(f"`{c}`")) if c in df.columns else F.array().cast("array<string>")
        if c == "acres_list" and acres in df.columns:
            one = F.filter(F.array(F.col(f"`{acres}`").cast("string")), lambda x: ~is_missing(x, M5))
            values = F.when(F.size(values) > 0, values).otherwise(one)
        lists[c] = values
    kept = rows.filter("reason is null").withColumns({f"v_{c}": v for c, v in lists.items()})
    kept = kept.withColumns({f"v_{c}": pad_trim(typed(F.col(f"v_{c}"), kind), F.size("raw__")) for c, kind in VALUE_LISTS.items()})
    kept = kept.withColumn("found__", F.array_distinct(F.when(F.size(good) > 0, good).otherwise(fallback)))
    kept = kept.select(
        *area, F.col(f"`{row}`").alias("row"), F.col("land__").alias("land_id"), (clean_scalar(F.col(f"`{name}`")) if name in df.columns else F.lit("")).alias("name"),
        (whole_half_even(F.col(f"`{lands}`")) if lands in df.columns else F.lit(None).cast("bigint")).alias("lands"), F.col("found__").alias("ids"),
        *[looked_up(F.col("found__"), F.col("num__"), F.col(f"v_{c}"), SQL_TYPES[kind]).alias(c) for c, kind in VALUE_LISTS.items()])
    return kept, skipped


def name_points(a: Column, b: Column) -> Column:
    """Points for names: equal, the same group code, or one within the other."""
    x, y = lower_name(a), lower_name(b)
    own = F.trim(F.regexp_replace(F.element_at(F.split(x, r"\|"), -1), r"\(\+\d+\s+others?\)", ""))
    code_x, code_y = group_token(a), group_token(b)
    return (
        F.when((x == "") | (y == ""), 0).when(x == y, POINTS["name"]).when((code_x != "") & (code_x == code_y), POINTS["group"])
        .when((own != "") & (y.contains(own) | own.contains(y)), POINTS["part"]).otherwise(0)
    )


def candidates(records: DataFrame, stored: DataFrame, area: Sequence[str], *, unique: str = "unique_id", land: str = "land_id", ids: str = "id_list", name: str = "full_name", lands: str = "owned_lands") -> DataFrame:
    """Scored pairs of records and stored rows of one area that share a land id or a parcel.

    A stored row without an id list stands for its land id. Columns: the area,
    `row`, `unique`, `score`, `overlap`. Two equi-joins on exploded keys; each
    pair is scored once.
    """
    old = stored.select(*area, F.col(unique).alias("unique"), land_id(F.col(land)).alias("their_land"), F.col(name).alias("their_name"), F.col(lands).cast("bigint").alias("their_lands"), F.coalesce(F.transform(ids, lambda x: x.cast("bigint")), F.array().cast("array<bigint>")).alias("their_ids"))
    old = old.withColumn("their_number", whole_half_even(F.col("their_land")))
    standing = F.when(F.size("their_ids") > 0, F.col("their_ids")).otherwise(F.array_compact(F.array(F.col("their_number"))))
    by_land = records.select(*area, "row", F.col("land_id").alias("k")).join(old.filter("their_land <> ''").select(*area, F.col("their_land").alias("k"), "unique"), [*area, "k"]).select(*area, "row", "unique")
    by_parcel = records.select(*area, "row", F.explode("ids").alias("k")).join(old.select(*area, "unique", F.explode(F.array_distinct(standing)).alias("k")), [*area, "k"]).select(*area, "row", "unique")
    pairs = by_land.unionByName(by_parcel).distinct()
    both = pairs.join(records.select(*area, "row", "land_id", "name", "lands", "ids"), [*area, "row"]).join(old, [*area, "unique"])
    number = whole_half_even(F.col("land_id"))
    overlap = F.size(F.array_intersect("ids", "their_ids"))
    mine = F.size("ids")
    theirs = F.when(F.size("their_ids") > 0, F.size("their_ids")).otherwise(F.coalesce(F.col("their_lands"), F.lit(0)))
    yes = lambda cond, points: F.when(F.coalesce(cond, F.lit(False)), points).otherwise(0)
    score = (
        yes(F.col("land_id") == F.col("their_land"), POINTS["land"]) + POINTS["shared"] * overlap
        + yes(F.array_contains("their_ids", number), POINTS["own_in_theirs"]) + yes(F.array_contains("ids", F.col("their_number")), POINTS["theirs_in_own"])
        + name_points(F.col("name"), F.col("their_name"))
        + F.when((mine > 0) & (theirs > 0), F.when(mine == theirs, POINTS["length"]).otherwise(-F.least(F.abs(mine - theirs), F.lit(POINTS["length"])))).otherwise(0)
        + yes(F.col("lands") == F.col("their_lands"), POINTS["lands"])
    )
    return both.select(*area, "row", "unique", score.cast("bigint").alias("score"), overlap.alias("overlap"))


def best_matches(scored: DataFrame, area: Sequence[str], least: int = 1) -> DataFrame:
    """The best stored row of each record, by score, overlap, then the greatest id; `ambiguous` where others tie."""
    usable = scored.filter(F.col("score") >= least)
    window = Window.partitionBy(*area, "row").orderBy(F.desc("score"), F.desc("overlap"), F.desc("unique"))
    ties = Window.partitionBy(*area, "row", "score", "overlap")
    ranked = usable.withColumn("ties", F.count(F.lit(1)).over(ties)).withColumn("rank", F.row_number().over(window))
    return ranked.filter("rank = 1").withColumn("ambiguous", F.col("ties") > 1).drop("rank")


def merged_lists(records: DataFrame, stored: DataFrame, matches: DataFrame, area: Sequence[str], *, unique: str = "unique_id", ids: str = "id_list", land: str = "land_id", acres: str = "acres", overwrite: bool = False) -> DataFrame:
    """The lists each matched stored row would hold, and which of them change.

    Stored ids first, then new ones; a stored value stays unless it is null (or
    `overwrite`). A list is changed if it has a value and differs from the
    stored one, numbers to 1e-9. `changed` names them; rows without a change leave.
    """
    sure = matches.filter(~F.col("ambiguous")).select(*area, "row", "unique", "score", "overlap")
    old = stored.select(*area, F.col(unique).alias("unique"), F.coalesce(F.transform(ids, lambda x: x.cast("bigint")), F.array().cast("array<bigint>")).alias("old_ids"), whole_half_even(F.col(land)).alias("their_number"), F.col(acres).cast("double").alias("their_acres"), *[F.col(c).alias(f"old_{c}") for c in VALUE_LISTS])
    both = sure.join(records, [*area, "row"]).join(old, [*area, "unique"])
    final = F.array_union("old_ids", "ids")
    both = both.withColumn("final_ids", F.when(F.size(final) > 0, final).otherwise(F.col("ids")))
    out, changed = {}, [F.when(F.col("old_ids") != F.col("final_ids"), F.lit("id_list"))]
    for c, kind in VALUE_LISTS.items():
        sql_type = SQL_TYPES[kind]
        stored_list = F.coalesce(F.col(f"old_{c}").cast(f"array<{sql_type}>"), F.array().cast(f"array<{sql_type}>"))
        both = both.withColumn(f"o_{c}", pad_trim(stored_list, F.size("old_ids"), F.lit(None).cast(sql_type)))
        was = looked_up(F.col("final_ids"), F.col("old_ids"), F.col(f"o_{c}"), sql_type)
        if c == "acres_list":
            was = F.when((F.size("old_ids") == 0) & F.col("their_number").isNotNull(), F.transform("final_ids", lambda i: F.when(i == F.col("their_number"), F.col("their_acres")))).otherwise(was)
        now = looked_up(F.col("final_ids"), F.col("ids"), F.col(c), sql_type)
        both = both.withColumns({f"was_{c}": was, f"now_{c}": now})
        was, now = F.col(f"was_{c}"), F.col(f"now_{c}")
        value = F.zip_with(was, now, lambda a, b: F.coalesce(b, a) if overwrite else F.coalesce(a, b))
        near = (lambda a, b: a.eqNullSafe(b) | (F.abs(a - b) < 1e-9)) if kind == "number" else (lambda a, b: a.eqNullSafe(b))
        same = F.forall(F.zip_with(was, value, near), lambda x: F.coalesce(x, F.lit(False)))
        some = F.exists(value, lambda x: x.isNotNull())
        out[f"final_{c}"] = value
        changed.append(F.when(some & ~same, F.lit(c)))
    made = both.withColumns(out).withColumn("changed", F.array_compact(F.array(*changed)))
    return made.filter(F.size("changed") > 0).select(*area, "row", "unique", "score", "overlap", "final_ids", *out, "changed", F.size(F.array_except("ids", "old_ids")).alias("ids_added"))


def resolve_conflicts(updates: DataFrame, area: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """One update per stored row: the highest score, overlap, number of changes, row; the others apart."""
    window = Window.partitionBy(*area, "unique").orderBy(F.desc("score"), F.desc("overlap"), F.desc(F.size("changed")), F.desc("row"))
    ranked = updates.withColumn("rank", F.row_number().over(window))
    return ranked.filter("rank = 1").drop("rank"), ranked.filter("rank > 1").drop("rank")


def apply_updates(stored: DataFrame, updates: DataFrame, area: Sequence[str], *, unique: str = "unique_id") -> DataFrame:
    """The stored rows with the changed lists of their update; rows are never added."""
    new = updates.select(*area, F.col("unique").alias(unique), "changed", F.col("final_ids").alias("final_id_list"), *[f"final_{c}" for c in VALUE_LISTS])
    both = stored.join(new, [*area, unique], "left")
    types = dict(stored.dtypes)
    out = {c: F.when(F.array_contains("changed", c), F.col(f"final_{c}").cast(types[c])).otherwise(F.col(c)) for c in ("id_list", *VALUE_LISTS)}
    return both.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in stored.columns])

