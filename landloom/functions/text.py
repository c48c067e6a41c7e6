"""Text expressions on the JVM side."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from landloom.missing import M4, M8, M9, is_missing


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once, however often and in whatever lambda it is used.

    A column of an earlier step is no such promise: steps are merged where the
    column is used once, even if that is within a lambda that runs per item.
    """
    return F.get(F.transform(F.array(value), then), F.lit(0))


def key_text(col: Column) -> Column:
    """Trimmed, runs of white space as one space, upper-cased. Null stays null."""
    return F.upper(F.trim(F.regexp_replace(col, r"(?U)\s+", " ")))


def parcel_key(col: Column) -> Column:
    """A parcel id without its formatting: white space, a leading R, `.0`, leading zeros.

    Ids with other letters keep their letters and digits. Missing gives null.
    """
    text = F.upper(F.regexp_replace(col.cast("string"), r"(?U)[\s\"'\[\]{}]", ""))
    text = F.regexp_replace(text, r"\.0+$", "")
    text = F.regexp_replace(text, r"[^0-9A-Z]", "")
    text = F.regexp_replace(text, r"^R(?=[0-9])", "")
    text = F.regexp_replace(text, r"^0+(?=.)", "")
    return F.when(~text.isin("", "NAN", "NONE", "NULL", "NA", "UNKNOWN", "NOTAVAILABLE", "EMPTY"), text)


def clean_cell(col: Column, tokens: tuple[str, ...] = M9) -> Column:
    """Missing as an empty string; else white space collapsed and the `.0` of a whole number dropped."""
    text = F.trim(F.regexp_replace(col.cast("string"), r"\s+", " "))
    return F.when(is_missing(col, tokens), "").otherwise(F.regexp_replace(text, r"^(-?\d+)\.0$", "$1"))


def clean_scalar(col: Column) -> Column:
    """Trimmed text without a byte-order mark; null as an empty string."""
    return F.coalesce(F.trim(F.regexp_replace(col.cast("string"), "﻿", "")), F.lit(""))


def value_text(col: Column) -> Column:
    """A cell as text: a midnight time dropped, then as `clean_cell` with the shorter token set."""
    text = F.trim(F.regexp_replace(col.cast("string"), r"\s+", " "))
    text = F.regexp_replace(text, r"^(.+?) 00:00:00$", "$1")
    return F.when(is_missing(col, M8), "").otherwise(F.regexp_replace(text, r"^(-?\d+)\.0$", "$1"))


def join_text(*cols: Column, sep: str = " ") -> Column:
    """The cleaned values that are not empty, joined."""
    return F.concat_ws(sep, *[F.nullif(value_text(c), F.lit("")) for c in cols])


def legal_text(col: Column) -> Column:
    """A legal description with a letter O before a decimal point read as zero, white space collapsed."""
    text = F.regexp_replace(col, r"(?i)(?<![A-Z0-9])O\.(\d+)", "0.$1")
    return F.when(is_missing(col), "").otherwise(F.trim(F.regexp_replace(text, r"\s+", " ")))


def county_title(col: Column) -> Column:
    """A county's name without the word county and the state."""
    text = F.regexp_replace(F.trim(F.regexp_replace(col, r"\s+", " ")), r"(?i)\s+county(?:\s*,?\s*(?:texas|tx))?\s*$", "")
    return F.trim(text)


def county_key(col: Column) -> Column:
    """Letters and digits of a county's name in lower case, the word county left out."""
    return F.regexp_replace(F.lower(county_title(col)), "[^a-z0-9]+", "")


def lower_name(col: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(clean_scalar(col), r"\s+", " ")))


def group_token(col: Column) -> Column:
    """The `MA#...` code within a name; empty if there is none."""
    return F.regexp_extract(F.upper(clean_scalar(col)), r"\bMA#[A-Z0-9]+\b", 0)


def split_name(col: Column, longest: int = 100) -> tuple[Column, Column]:
    """First and last name: the first word is the last name, of the first person, without a group code.

    A single word is a first name; missing gives nulls.
    """
    text = F.trim(F.regexp_replace(col, r"\s+", " "))
    text = F.when(F.upper(text).rlike(r"^MA#.*\|"), F.trim(F.regexp_replace(text, r"^[^|]*\|", ""))).otherwise(text)
    text = F.trim(F.split(text, "&")[0])
    words = F.split(text, " ")
    usable = ~is_missing(col, M4) & (text != "")
    several = usable & (F.size(words) > 1)
    rest = F.array_join(F.slice(words, 2, 1_000), " ")
    first = F.when(several, F.substring(rest, 1, longest)).when(usable, F.substring(words[0], 1, longest))
    return first, F.when(several, F.substring(words[0], 1, longest))


def tidy_address(col: Column) -> Column:
    """An address with care-of marks and white space tidied and one space after commas."""
    text = F.regexp_replace(col, r"[\n\t%]", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"\s*,\s*", ", "), r"\s{2,}", " ")
    return F.when(is_missing(col), "").otherwise(F.regexp_replace(F.trim(text), "^,+|,+$", ""))


# Words of an address that stay in capitals.
UPPER_WORDS = ("PO", "BOX", "FM", "HWY", "US", "CR", "RTE", "N", "S", "E", "W", "NW", "NE", "SW", "SE", "C/O", "ATTN:", "DC")


def smart_title(col: Column) -> Column:
    """Words capitalised, but for those that stay in capitals; commas at words' ends dropped."""
    words = F.filter(F.split(col, r"\s+"), lambda w: w != "")
    bare = F.transform(words, lambda w: F.regexp_replace(w, "^,+|,+$", ""))
    titled = F.transform(bare, lambda w: F.when(F.upper(w).isin(*UPPER_WORDS), F.upper(w)).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 10_000)))))
    return F.array_join(titled, " ")


def hash_text(col: Column) -> Column:
    """The form of an address that its code is made from: capitals, digits, single spaces."""
    text = F.regexp_replace(F.upper(clean_cell(col)), "[^A-Z0-9 ]+", "")
    return F.trim(F.regexp_replace(text, " +", " "))


def mailing_code(col: Column, size: int = 6) -> Column:
    """The first characters of the SHA-1 of an address in capitals; zeros for an empty one."""
    text = hash_text(col)
    return F.when(text == "", "0" * size).otherwise(F.upper(F.substring(F.sha1(text), 1, size)))


def shorten(col: Column, longest: Column | int) -> Column:
    """Cut to the given length, the last three characters then being dots."""
    limit = F.lit(longest) if isinstance(longest, int) else longest
    cut = F.when(limit <= 3, col.substr(F.lit(1), limit)).otherwise(F.concat(F.rtrim(col.substr(F.lit(1), limit - 3)), F.lit("...")))
    return F.when((limit <= 0) | (F.length(col) <= limit), col).otherwise(cut)


def group_label(code: Column, primary: Column, others: Column, longest: int = 150) -> Column:
    """`MA#code | PRIMARY (+N others)`, the primary name shortened so that the whole fits."""
    name = F.when(clean_cell(primary) == "", "UNKNOWN OWNER").otherwise(clean_cell(primary))
    head = F.concat(F.lit("MA#"), code, F.lit(" | "))
    tail = F.when(others > 0, F.concat(F.lit(" (+"), others.cast("string"), F.when(others == 1, F.lit(" other)")).otherwise(F.lit(" others)")))).otherwise("")
    room = F.lit(longest) - F.length(head) - F.length(tail)
    return shorten(F.concat(head, shorten(name, room), tail), longest)


def group_label_plain(code: Column, names: Column, label: str = "MAILING ADDRESS GROUP", longest: int = 150) -> Column:
    """The label without a primary owner: how many owners share the address."""
    tail = F.when(names > 1, F.concat(F.lit(" (+"), names.cast("string"), F.lit(" owners)"))).otherwise("")
    return shorten(F.concat(F.lit("MA#"), code, F.lit(f" | {label}"), tail), longest)


def html_escape(col: Column) -> Column:
    out = F.replace(F.coalesce(col.cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;"))
    for a, b in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def phrase_pattern(phrase: str, *, inside: bool = False) -> str:
    """A pattern for a whole phrase in any case; with `inside` also within longer words."""
    words = r"\s+".join(re.escape(w) for w in phrase.split())
    return f"(?i){words}" if inside else f"(?i)(?<![A-Za-z0-9]){words}(?![A-Za-z0-9])"
