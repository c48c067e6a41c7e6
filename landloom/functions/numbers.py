"""Number, date, and flag expressions on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landloom.functions.text import clean_cell, clean_scalar
from landloom.missing import M4, M5, M9, is_missing

SQUARE_FEET = 43_560.0
# Acres in one unit of area.
ACRES_PER = {
    "square_feet": 1 / 43560.0, "sqft": 1 / 43560.0, "sq_ft": 1 / 43560.0, "ft2": 1 / 43560.0,
    "square_meters": 1 / 4046.8564224, "sqm": 1 / 4046.8564224, "m2": 1 / 4046.8564224,
    "acres": 1.0, "acre": 1.0, "hectares": 2.4710538147, "hectare": 2.4710538147,
    "square_yards": 1 / 4840.0, "sq_yards": 1 / 4840.0, "yd2": 1 / 4840.0,
    "square_miles": 640.0, "sq_miles": 640.0, "mi2": 640.0,
}


def parse_number(col: Column, *, merge_points: bool = False) -> Column:
    """A number out of text: every character but digits, point and minus dropped; null if none is left.

    With `merge_points` further points are dropped instead of making it null.
    """
    text = F.regexp_replace(col.cast("string"), r"[^0-9.\-]", "")
    if merge_points:
        text = F.when(F.regexp_count(text, F.lit(r"\.")) > 1, F.concat(F.regexp_extract(text, r"^([^.]*\.)", 1), F.regexp_replace(F.regexp_extract(text, r"^[^.]*\.(.*)$", 1), r"\.", ""))).otherwise(text)
    usable = ~is_missing(col, M9) & text.rlike("[0-9]")
    return F.when(usable, text.try_cast("double"))


def strict_number(col: Column) -> Column:
    """A number with only a dollar sign, thousands commas and quotes removed; else null."""
    text = F.regexp_replace(F.trim(F.regexp_replace(clean_scalar(col), "^['\"]+|['\"]+$", "")), "[$,]", "")
    return F.when(~is_missing(col, M5) & text.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), text.try_cast("double"))


def whole_half_even(col: Column) -> Column:
    """Whole number of any number text, halves to even."""
    text = F.regexp_replace(clean_scalar(col), "[,'\"]", "")
    exact = F.when(text.rlike(r"^-?\d+(\.0+)?$"), F.regexp_replace(text, r"\.0+$", "").try_cast("bigint"))
    return F.when(~is_missing(col, M5), F.coalesce(exact, F.bround(strict_number(col)).cast("bigint")))


def whole_exact(col: Column) -> Column:
    """Whole number of text that is one, `.0` allowed; else null."""
    text = F.regexp_replace(F.trim(F.regexp_replace(clean_scalar(col), "^['\"]+|['\"]+$", "")), ",", "")
    return F.when(~is_missing(col, M5) & text.rlike(r"^-?\d+(\.0+)?$"), F.regexp_replace(text, r"\.0+$", "").try_cast("bigint"))


def whole_truncated(col: Column) -> Column:
    """Whole number of any number text, decimals cut off."""
    text = F.regexp_replace(F.trim(col.cast("string")), ",", "")
    number = F.when(text.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), text.try_cast("double"))
    exact = F.when(text.rlike(r"^-?\d+$"), text.try_cast("bigint"))
    return F.when(~is_missing(col, M4), F.coalesce(exact, F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))))


def legal_number(text: Column) -> Column:
    """A number of a legal description: `44 60` 44.60, `093` 0.93, `296.` 296, `61,63950` 61.6395, `.5` 0.5."""
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    t = F.regexp_replace(t, r"^(\d+) (\d{1,4})$", "$1.$2")
    t = F.regexp_replace(t, r"^0(\d+)$", "0.$1")
    decimal_comma = t.rlike(r"^[^.,]*,[^.,]*$") & ~t.rlike(r",\d{3}$")
    t = F.when(decimal_comma, F.regexp_replace(t, ",", ".")).otherwise(F.regexp_replace(t, ",", ""))
    return F.regexp_replace(t, r"\.$", "").try_cast("double")


def rounded(col: Column, digits: int = 6) -> Column:
    return F.bround(col, digits)


def number_text(col: Column, digits: int = 12) -> Column:
    """A number without closing zeros, whole numbers without a point; null as an empty string."""
    text = F.format_string(f"%.{digits}f", col)
    short = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(col.isNull(), "").otherwise(short)


def percent(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.when(whole > 0, F.round(100.0 * part / whole, digits)).otherwise(0.0)


def to_acres(col: Column, unit: str = "square_feet") -> Column:
    """Acres of an area in `unit`; zero and less stay as they are, no number gives null."""
    factor = ACRES_PER.get(unit.strip().lower())
    if factor is None:
        raise ValueError(f"unknown unit of area {unit!r}; known: {', '.join(sorted(ACRES_PER))}")
    return rounded(parse_number(col) * F.lit(factor))


def id_text(col: Column) -> Column:
    """An id as text: numbers without commas, `.0` and leading zeros; other text cleaned."""
    text = clean_cell(col)
    number = F.regexp_replace(text, ",", "")
    whole = F.regexp_replace(F.regexp_extract(number, r"^([-+]?\d+)(\.0*)?$", 1), r"^\+?(-?)0+(?=\d)", "$1")
    return F.when(whole != "", F.regexp_replace(whole, r"^\+", "")).when(number.rlike(r"^[-+]?\d*\.\d+$"), number_text(number.try_cast("double"))).otherwise(text)


def parse_bool(col: Column) -> Column:
    text = F.lower(F.trim(col.cast("string")))
    return F.when(text.isin("true", "t", "1", "yes", "y"), True).when(text.isin("false", "f", "0", "no", "n"), False)


def is_true(col: Column) -> Column:
    """Whether a flag cell says yes: a word for it, or a number that is not zero."""
    text = F.lower(F.trim(col.cast("string")))
    return F.coalesce(text.isin("true", "t", "yes", "y", "1") | (F.coalesce(text.try_cast("double"), F.lit(0.0)) != 0), F.lit(False))


def parse_date(col: Column) -> Column:
    """A date in one of the usual notations; month before day, day before month only where that is impossible."""
    text = F.regexp_replace(F.trim(F.regexp_replace(clean_scalar(col), "^['\"]+|['\"]+$", "")), r"T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z?$", "")
    text = F.regexp_replace(text, r" 00:00:00$", "")
    short = text.rlike(r"^\d{1,2}[/-]\d{1,2}[/-]\d{2}$")
    slash = F.regexp_replace(text, "-", "/")
    tries = [
        F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_timestamp(text, F.lit("yyyy-M-d"))),
        F.when(text.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"), F.try_to_timestamp(text, F.lit("yyyy/M/d"))),
        F.when(short, F.try_to_timestamp(slash, F.lit("M/d/yy"))),
        F.when(text.rlike(r"^\d{1,2}[/-]\d{1,2}[/-]\d{4}$"), F.try_to_timestamp(slash, F.lit("M/d/yyyy"))),
        F.when(text.rlike(r"^\d{1,2}[/-]\d{1,2}[/-]\d{4}$"), F.try_to_timestamp(slash, F.lit("d/M/yyyy"))),
        F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd"))),
        F.when(text.rlike(r"(?i)^\d{1,2}-[a-z]{3}-\d{4}$"), F.try_to_timestamp(F.initcap(F.lower(F.regexp_replace(text, "-", " "))), F.lit("d MMM yyyy"))),
        F.when(text.rlike(r"(?i)^[a-z]{3} \d{1,2}, \d{4}$"), F.try_to_timestamp(F.initcap(F.lower(text)), F.lit("MMM d, yyyy"))),
    ]
    # Two-digit years: 69 to 99 are of the last century.
    date = F.coalesce(*tries).cast("date")
    date = F.when(short & (F.year(date) >= 2069), F.add_months(date, -1200)).otherwise(date)
    return F.when(~is_missing(col, M5), date)


def excel_date(col: Column) -> Column:
    """The date of a spreadsheet day number between 20000 and 80000; else null."""
    number = col.cast("double")
    return F.when(number.between(20_000, 80_000), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(number).cast("int")))


def lands_count(*counts: Column, ids: Column) -> Column:
    """The first count that is a number, not below zero; else the number of ids; else one."""
    given = F.coalesce(*[whole_truncated(c) for c in counts])
    return F.when(given.isNotNull(), F.greatest(given, F.lit(0))).when(F.size(ids) > 0, F.size(ids)).otherwise(1)


def duration_text(seconds: Column) -> Column:
    """Hours, minutes and seconds of a duration, leading zero parts left out."""
    s = F.greatest(F.floor(F.coalesce(seconds, F.lit(0.0))), F.lit(0)).cast("bigint")
    h, m, r = F.floor(s / 3600).cast("bigint"), F.floor(s % 3600 / 60).cast("bigint"), s % 60
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, r)).when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))
