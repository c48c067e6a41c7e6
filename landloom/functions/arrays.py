"""List cells and aligned lists as arrays, without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landloom.functions.numbers import id_text, number_text, parse_bool, parse_date, parse_number, strict_number, whole_half_even
from landloom.functions.text import clean_cell, clean_scalar, once
from landloom.missing import M4, M5, M9, is_missing

PIPE = " | "


def _bracketed(text: Column) -> Column:
    """The items of `[...]` in JSON or with single quotes; null for other text."""
    inside = F.regexp_extract(text, r"^\[\s*(.*?)\s*\]$", 1)
    bare = F.transform(F.split(inside, r"\s*,\s*"), lambda x: F.regexp_replace(x, "^['\"]+|['\"]+$", ""))
    read = F.coalesce(F.from_json(F.regexp_replace(text, r"\bNone\b", "null"), "array<string>"), bare)
    return F.when(text.rlike(r"^\[\s*\]$"), F.array().cast("array<string>")).when(text.rlike(r"^\[.*\]$"), read)


def list_cell(col: Column, *, pipes: bool = False) -> Column:
    """A list cell of the grouping stages: a bracketed list, else with `pipes` the parts, else one item; missing is empty."""

    def read(text: Column) -> Column:
        items = F.coalesce(_bracketed(text), F.split(text, r" \| ") if pipes else F.array(text), F.array(text))
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.transform(items, lambda x: clean_cell(x)))

    return once(clean_cell(col), read)


def list_cell_loose(col: Column) -> Column:
    """A list cell of the database stages: also ` | ` and commas, but no commas where the cell holds dates."""

    def read(text: Column) -> Column:
        dates = text.rlike(r"\d{1,2}/\d{1,2}/\d{2,4}")
        plain = F.when(text.contains(PIPE), F.split(text, r" \| ")).when(text.contains(",") & ~dates, F.split(text, ",")).otherwise(F.array(text))
        return F.transform(F.coalesce(_bracketed(text), plain), lambda x: F.trim(x))

    return F.when(is_missing(col, ("", "[]")), F.array().cast("array<string>")).otherwise(once(clean_scalar(col), read))


def list_cell_commas(col: Column) -> Column:
    """A list cell of the load stage: bars first, else every comma splits."""

    def read(text: Column) -> Column:
        plain = F.when(text.contains("|"), F.split(text, r"\|")).otherwise(F.split(text, ","))
        return F.transform(F.coalesce(_bracketed(text), plain), lambda x: F.trim(x))

    return F.when(is_missing(col, M4), F.array().cast("array<string>")).otherwise(once(F.trim(col.cast("string")), read))


def aligned_cell(col: Column, size: Column) -> Column:
    """A list cell beside an id list: bars split it only if that gives the id list's length."""

    def read(text: Column) -> Column:
        parts = F.transform(F.split(text, r" \| "), lambda x: F.trim(x))
        plain = F.when((size > 1) & (F.size(parts) == size), parts).otherwise(F.array(text))
        items = F.transform(F.coalesce(_bracketed(text), plain), lambda x: clean_cell(x))
        return F.when(text == "", F.array().cast("array<string>")).otherwise(items)

    return once(clean_cell(col), read)


def pad_trim(array: Column, size: Column, fill: Column | None = None) -> Column:
    """Exactly `size` items: cut, or filled up with `fill` (null); no size, no items."""
    wanted = F.greatest(size, F.lit(0))
    more = lambda a: F.array_repeat(F.lit(None) if fill is None else fill, F.greatest(wanted - F.size(a), F.lit(0)).cast("int"))
    return once(array, lambda a: F.concat(F.slice(a, F.lit(1), wanted.cast("int")), more(a)))


def typed(array: Column, kind: str) -> Column:
    """Items as numbers, whole numbers, dates or flags; what cannot be read is null."""
    read = {"number": strict_number, "whole": whole_half_even, "date": parse_date, "flag": parse_bool}[kind]
    return F.transform(array, lambda x: read(x))


def null_if_empty(array: Column) -> Column:
    return once(array, lambda a: F.when(F.size(a) > 0, a))


def json_text(array: Column, *, spaced: bool = True) -> Column:
    """A list as JSON text; `spaced` puts a space after each comma."""
    if not spaced:
        return F.to_json(array)

    def written(a: Column) -> Column:
        quoted = F.transform(a, lambda x: F.substring(F.to_json(F.array(x)), 2, 1 << 30))
        items = F.array_join(F.transform(quoted, lambda x: x.substr(F.lit(1), F.length(x) - 1)), ", ")
        # Where nothing needs escaping, quotes are put around the items as they are.
        plain = (F.size(a) > 0) & ~F.exists(a, lambda x: x.isNull()) & ~F.array_join(a, "").rlike(r'["\\\x00-\x1f]')
        return F.concat(F.lit("["), F.when(plain, F.concat(F.lit('"'), F.array_join(a, '", "'), F.lit('"'))).otherwise(items), F.lit("]"))

    return once(array.cast("array<string>"), written)


def pipe_text(array: Column) -> Column:
    return F.array_join(array, PIPE, "")


def acres_texts(array: Column) -> Column:
    return F.transform(array, lambda x: number_text(parse_number(x)))


def distinct_any_case(array: Column) -> Column:
    """Distinct items whatever their case; the first spelling and its place are kept."""
    lower = F.transform(array, lambda x: F.lower(x))
    return F.filter(array, lambda x, i: F.array_position(lower, F.lower(x)) == i + 1)


def distinct_values(texts: Column) -> Column:
    """All values of cells that may hold several, distinct whatever their case, in order."""
    parts = F.flatten(F.transform(texts, lambda t: F.split(clean_cell(t), r" \| ")))
    return distinct_any_case(F.filter(F.transform(parts, lambda x: clean_cell(x)), lambda x: x != ""))


def ordered_union(first: Column, second: Column) -> Column:
    return F.array_union(first, second)


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def non_null_count(array: Column) -> Column:
    return F.size(F.filter(array, lambda x: x.isNotNull()))


def number_sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + F.coalesce(parse_number(x), F.lit(0.0)))


def recomputed_acres(array: Column) -> Column:
    """The sum of the numbers, to six digits; null if there is none."""
    total = lambda n: F.when(F.size(n) > 0, F.bround(F.aggregate(n, F.lit(0.0), lambda a, x: a + x), 6))
    return once(F.filter(typed(array, "number"), lambda x: x.isNotNull()), total)


VALUE_FIELDS = ("acres", "market", "tax_year", "deed_date", "filled", "empty")


def parcels(ids: Column, **lists: Column) -> Column:
    """Aligned lists as one array of structs (`id` and the given fields), as long as the longest list."""
    size = F.greatest(F.size(ids), *[F.size(x) for x in lists.values()], F.lit(1)) if lists else F.greatest(F.size(ids), F.lit(1))
    blank = F.lit("")
    return F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(F.coalesce(F.get(ids, i), blank).alias("id"), *[F.coalesce(F.get(x, i), blank).alias(n) for n, x in lists.items()]))


def first_per_id(array: Column) -> Column:
    """Parcels with each id once, the first; blank ids all stay."""
    keyed = F.transform(array, lambda p, i: F.struct(F.lower(id_text(p["id"])).alias("k"), i.alias("i"), p.alias("p")))
    # One pass: the ids seen so far are kept beside the parcels taken.
    seen = F.aggregate(
        keyed, F.struct(F.array().cast("array<string>").alias("ids"), F.filter(keyed, lambda x: F.lit(False)).alias("taken")),
        lambda a, x: F.when((x["k"] != "") & F.array_contains(a["ids"], x["k"]), a).otherwise(F.struct(F.array_append(a["ids"], x["k"]).alias("ids"), F.array_append(a["taken"], x).alias("taken"))))
    return F.transform(seen["taken"], lambda x: x["p"])


def field(array: Column, name: str) -> Column:
    return F.transform(array, lambda p: p[name])


def looked_up(keys: Column, ids: Column, values: Column, sql_type: str) -> Column:
    """For each of the distinct keys the first value that is not null among those whose id is the key; null if there is none.

    Keys and ids are sorted together, so the work is n log n, not one search per key.
    """
    key = F.transform(keys, lambda k, i: F.struct(k.alias("id"), F.lit(0).alias("side"), F.lit(False).alias("blank"), i.alias("pos"), F.lit(None).cast(sql_type).alias("v")))
    held = F.zip_with(ids, values.cast(f"array<{sql_type}>"), lambda i, v: F.struct(i.alias("id"), v.alias("v")))
    given = F.transform(held, lambda x, i: F.struct(x["id"].alias("id"), F.lit(1).alias("side"), x["v"].isNull().alias("blank"), i.alias("pos"), x["v"].alias("v")))

    def joined(s: Column) -> Column:
        """Each key with what follows it in order, if that is of the same id."""
        following = lambda i: F.get(s, i + 1)
        pairs = F.transform(s, lambda x, i: F.struct(x["side"].alias("side"), x["pos"].alias("pos"), F.when(following(i)["id"] == x["id"], following(i)["v"]).alias("v")))
        return F.transform(F.array_sort(F.filter(pairs, lambda p: p["side"] == 0)), lambda p: p["v"])

    # Within an array of one item the sorted list is a variable, evaluated once.
    return F.get(F.transform(F.array(F.array_sort(F.concat(key, given))), joined), F.lit(0))


def is_blank_item(x: Column) -> Column:
    return is_missing(x, M5) | is_missing(x, M9)
