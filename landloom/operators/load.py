"""Typed owner rows with sequence ids, and keyed writes into a stored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landloom.functions.arrays import list_cell_commas, null_if_empty, pad_trim
from landloom.functions.numbers import lands_count, parse_bool, parse_date, whole_truncated
from landloom.functions.text import split_name
from landloom.missing import M4, is_missing
from landloom.session import cut


def text_or_null(col: Column, longest: int | None = None) -> Column:
    """Cleaned text, cut to the given length; missing is null."""
    text = F.trim(F.regexp_replace(col.cast("string"), r"\s+", " "))
    return F.when(~is_missing(col, M4), text if longest is None else F.substring(text, 1, longest))


def money(col: Column) -> Column:
    """A number without commas and a dollar sign in front."""
    text = F.regexp_replace(F.regexp_replace(F.trim(col.cast("string")), ",", ""), r"^\$", "")
    return F.when(~is_missing(col, M4) & text.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), text.try_cast("double"))


def sequence_index(unique: Column) -> Column:
    """The running number in an id of four parts; else null."""
    parts = F.split(unique, "-")
    return F.when(F.size(parts) == 4, F.get(parts, F.lit(2)).try_cast("bigint"))


def largest_index(stored: DataFrame, area: str = "county_id", unique: str = "unique_id") -> DataFrame:
    """The greatest running number per area; areas without any have none."""
    return stored.groupBy(area).agg(F.max(sequence_index(F.col(unique))).alias("largest_index")).filter("largest_index is not null")


def number_rows(df: DataFrame, start: DataFrame, area: str, order: Sequence[str], *, unique: str = "unique_id", prefix: str = "TX", version: int = 1) -> DataFrame:
    """Rows with ids that go on after the greatest number of their area, in order.

    The rows are laid out in ranges of area and order, each range numbers its
    own rows per area, and begins where the ranges before it end; so a large
    area is dealt over many tasks. `order` must be total within an area.
    """
    laid = cut(df.repartitionByRange(area, *order).withColumn("part__", F.spark_partition_id()), "ranges")
    sizes = laid.groupBy(area, "part__").agg(F.count(F.lit(1)).alias("n__"))
    before = F.coalesce(F.sum("n__").over(Window.partitionBy(area).orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(area, "part__", before.alias("before__")).join(start.select(area, "largest_index"), area, "left")
    rows = laid.join(starts, [area, "part__"])
    own = F.row_number().over(Window.partitionBy(area, "part__").orderBy(*order))
    index = F.coalesce("largest_index", F.lit(0)) + F.col("before__") + own
    return rows.withColumn(unique, F.concat_ws("-", F.lit(prefix), F.col(area).cast("string"), index.cast("string"), F.lit(str(version)))).drop("largest_index", "part__", "before__")


def typed_rows(df: DataFrame, *, ident: str = "id") -> tuple[DataFrame, DataFrame]:
    """Rows with typed payload columns beside what they had, and skipped rows with a reason.

    `p` holds the payload: land id, name and its parts, addresses, numbers, and
    lists cut or filled to the id list. A row without id and id list is skipped.
    """
    has = set(df.columns)
    cell = lambda c: F.col(f"`{c}`").cast("string") if c in has else F.lit(None).cast("string")
    numbers = F.filter(F.transform(list_cell_commas(cell("id_list")), lambda x: whole_truncated(x)), lambda x: x.isNotNull())
    own = whole_truncated(cell(ident))
    rows = df.withColumn("ids__", F.when(F.size(numbers) > 0, numbers).otherwise(F.array_compact(F.array(own))))
    land = F.coalesce(text_or_null(cell(ident), 64), F.get(F.col("ids__"), F.lit(0)).cast("string"))
    rows = rows.withColumn("land__", land)
    bad = F.col("land__").isNull() & (F.size("ids__") == 0)
    skipped = rows.filter(bad).select(*df.columns, F.lit("missing_id_and_id_list").alias("reason"))
    size = F.greatest(F.size("ids__"), F.lit(1))
    # Cells become arrays in a step of their own, so that none is parsed twice.
    cells = [c for c in ("acres_list", "market_value_list", "owner_tax_year_list", "deed_date_list") if c in has]
    good = rows.filter(~bad).withColumns({f"cells_{c}__": list_cell_commas(cell(c)) for c in cells}).withColumn("name__", text_or_null(cell("full_name"), 150))

    def values(column: str, read, kind: str) -> Column:
        if column not in has:
            return F.lit(None).cast(f"array<{kind}>")
        return null_if_empty(pad_trim(F.transform(F.col(f"cells_{column}__"), lambda x: read(x).cast(kind)), size, F.lit(None).cast(kind)))

    acres = money(cell("acres"))
    good = good.withColumn("acres__", values("acres_list", money, "double"))
    acres_list = F.col("acres__")
    one = pad_trim(F.array(acres), size, F.lit(None).cast("double"))
    acres_list = F.when(F.exists(F.coalesce(acres_list, F.array().cast("array<double>")), lambda x: x.isNotNull()), acres_list).otherwise(one)
    first, last = split_name(F.col("name__"))
    flags = F.transform(list_cell_commas(cell("legal_acreage_filled_by_script")), lambda x: parse_bool(x))
    payload = F.struct(
        F.col("land__").alias("land_id"), F.col("name__").alias("full_name"), text_or_null(cell("legal_address")).alias("legal_address"),
        text_or_null(cell("mailing_address")).alias("mailing_address"), acres.alias("acres"), text_or_null(cell("city"), 100).alias("city"), text_or_null(cell("zip"), 10).alias("zip"),
        first.alias("first_name_1"), last.alias("last_name_1"), lands_count(cell("lands_count"), cell("owned_lands"), ids=F.col("ids__")).cast("int").alias("owned_lands"),
        null_if_empty(F.col("ids__")).alias("id_list"), acres_list.alias("acres_list"), values("market_value_list", money, "double").alias("market_value_list"),
        values("owner_tax_year_list", whole_truncated, "int").alias("owner_tax_year_list"), values("deed_date_list", parse_date, "date").alias("deed_date_list"),
        F.size(F.filter(flags, lambda x: x)).alias("true_flags"))
    return good.withColumn("p", payload).drop("ids__", "land__", "name__", "acres__", *[f"cells_{c}__" for c in cells]), skipped


PAYLOAD = (
    "unique_id", "county_id", "county_name", "land_id", "full_name", "legal_address", "mailing_address", "acres", "city", "zip", "first_name_1", "last_name_1",
    "owned_lands", "cad_category", "acres_list", "id_list", "market_value_list", "owner_tax_year_list", "deed_date_list",
)


def owner_payload(df: DataFrame, counties: DataFrame, stored: DataFrame, order: Sequence[str], *, area: str = "county_id", ident: str = "id") -> tuple[DataFrame, DataFrame]:
    """New rows as payload of the stored table, numbered after its greatest ids, and skipped rows.

    The payload has `true_flags` besides. Numbers count the accepted rows only.
    `counties` names the areas; its size is that of the dimension.
    """
    typed, skipped = typed_rows(df, ident=ident)
    named = typed.drop("county_name", "cad_category").join(counties.select(area, "county_name", "cad_category"), area, "left")
    # Written before they are dealt to ranges, since taking the ranges' bounds reads every row once more.
    named = cut(named.select(*dict.fromkeys([area, "county_id", "county_name", "cad_category", *order, "p"])), "typed")
    numbered = number_rows(named, largest_index(stored, area), area, order)
    return numbered.select(*[(F.col("p")[c] if c in _IN_P else F.col(c)).alias(c) for c in PAYLOAD], F.col("p")["true_flags"].alias("true_flags")), skipped


_IN_P = set(PAYLOAD) - {"unique_id", "county_id", "county_name", "cad_category"}


def upsert(stored: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows without those that are new, and the new rows; columns by name, nulls where one side lacks them.

    Of new rows that repeat a key any one stays, so keys stay unique.
    """
    new = new.dropDuplicates(list(keys))
    return stored.join(new.select(*keys), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def keyed_update(stored: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str], *, stamp: str | None = None) -> DataFrame:
    """Stored rows with the columns of their change where that is not null; no row is added.

    `stamp` names a column that then holds the time of the update.
    """
    new = changes.select(*keys, *[F.col(c).alias(f"new__{c}") for c in columns], F.lit(True).alias("hit__"))
    both = stored.join(new, list(keys), "left")
    out = {c: F.coalesce(F.col(f"new__{c}"), F.col(c)) for c in columns}
    if stamp:
        out[stamp] = F.when(F.col("hit__"), F.current_timestamp()).otherwise(F.col(stamp) if stamp in stored.columns else F.lit(None).cast("timestamp"))
    return both.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in stored.columns], *([out[stamp].alias(stamp)] if stamp and stamp not in stored.columns else []))
