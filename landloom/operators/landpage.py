"""Acres out of property pages: HTML tables, page states, search addresses."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landloom.functions.numbers import SQUARE_FEET
from landloom.functions.schema import plain_name
from landloom.missing import M9

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: A start tag of these closes an open one of the same kind.
_SIBLING = {"tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "li": ("li",), "option": ("option",), "p": ("p",)}
# Texts that tell the state of a page.
ERROR_TEXTS = ("an error occurred", "oops! something went wrong", "oops something went wrong", "please try again later", "something went wrong", "internal server error", "runtime error")
BLOCK_TEXTS = ("access denied", "too many requests", "rate limit", "unusual traffic", "temporarily blocked", "verify you are human", "checking your browser", "captcha", "forbidden", "service unavailable")
ABSENT_TEXTS = ("Property Not Found", "No data found")
ACRE_HEADS, FEET_HEADS = ("acreage", "acres", "acre", "legal_acreage"), ("sqft", "square_feet", "sq_ft")
TEXT_HEADS, TYPE_HEADS = ("description", "land_description"), ("type", "land_type")


class Node:
    """An element with its attributes, children (elements and texts), and parent."""

    __slots__ = ("tag", "attributes", "children", "parent")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attributes, self.parent, self.children = tag, attributes, parent, []

    def walk(self) -> Iterator[Node]:
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def own(self, *tags: str) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node) and c.tag in tags]

    def has_class(self, name: str) -> bool:
        return name in (self.attributes.get("class") or "").split()

    @property
    def text(self) -> str:
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                out.append(item)
            elif item.tag not in ("script", "style"):
                stack += reversed(item.children)
        return " ".join(" ".join(out).replace(" ", " ").split())


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        closes, node = _SIBLING.get(tag, ()), self.at
        while node.parent is not None and closes and node.tag not in ("table", "ul", "ol", "div"):
            if node.tag in closes:
                self.at = node.parent
            node = node.parent
        child = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(child)
        if tag not in _VOID:
            self.at = child

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def tree(html: str | None) -> Node:
    """The element tree of a page; whatever the input, it does not raise."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def title(root: Node) -> str:
    found = root.all("title")
    return found[0].text if found else ""


def panel(root: Node, heading: str) -> Node | None:
    """The first panel whose heading holds the text, whatever its case."""
    for node in root.all("div"):
        if node.has_class("panel"):
            head = next((n for n in node.walk() if n.has_class("panel-heading")), None)
            if head is not None and heading.lower() in head.text.lower():
                return node
    return None


def heads(table: Node) -> list[str]:
    """The texts of the first row that has head cells."""
    row = next((r for r in table.all("tr") if r.own("th")), None)
    return [h.text for h in row.own("th")] if row else []


def _number(text: str) -> float | None:
    kept = re.sub(r"[^0-9.\-]", "", text)
    whole, point, rest = kept.partition(".")
    if text.strip().lower() in M9:
        return None
    try:
        return float(whole + point + rest.replace(".", ""))
    except ValueError:
        return None


def land_rows(table: Node) -> list[dict]:
    """The data rows of a land table; acres from the acre column, else from square feet."""
    names = [plain_name(h) for h in heads(table)]
    at = lambda wanted: next((i for i, n in enumerate(names) if n in wanted), None)
    acre, feet, text, kind = at(ACRE_HEADS), at(FEET_HEADS), at(TEXT_HEADS), at(TYPE_HEADS)
    if acre is None and feet is None:
        return []
    out = []
    for row in table.all("tr"):
        cells = row.own("td")
        if row.own("th") or not cells:
            continue
        cell = lambda i: cells[i].text if i is not None and i < len(cells) else ""  # noqa: B023, E731
        raw = cell(acre)
        if acre is not None and acre < len(cells):
            marked = [n.attributes["data-acres"].strip() for n in (cells[acre], *cells[acre].walk()) if n.attributes.get("data-acres", "").strip()]
            raw = marked[0] if marked else raw
        acres, raw_feet, source = _number(raw), cell(feet), "acreage_column"
        size = _number(raw_feet)
        if acres is None and size is not None and size > 0:
            acres, raw, source = size / SQUARE_FEET, raw_feet, "sqft_fallback"
        out.append({
            "row_number": len(out) + 1, "raw_acreage": raw, "acreage": None if acres is None else round(acres, 6), "raw_sqft": raw_feet, "sqft": size,
            "description": cell(text), "land_type": cell(kind), "source": source,
        })
    return out


def find_land_rows(root: Node) -> tuple[list[dict], str]:
    """The land rows of a page and where they stand: the land panel, else any table with acres."""
    found = panel(root, "Property Land")
    if found is not None:
        tables = found.all("table")
        rows = land_rows(tables[0]) if tables else []
        return rows, "property_land_panel" if rows else "property_land_table_no_acreage_columns" if tables else "property_land_panel_no_table"
    for table in root.all("table"):
        names = {plain_name(h) for h in heads(table)}
        if "acreage" in names and names & {"sqft", "description"} and (rows := land_rows(table)):
            return rows, "fallback_table_with_acreage_header"
    return [], "property_land_table_not_found"


def page_ids(root: Node) -> dict[str, str]:
    """Labels and values of the table in the details panel."""
    found = panel(root, "Property Details")
    tables = found.all("table") if found is not None else []
    out: dict[str, str] = {}
    for row in tables[0].all("tr") if tables else []:
        cells = row.own("th", "td")
        for i, cell in enumerate(cells):
            if cell.tag == "th":
                value = cells[i + 1].text if i + 1 < len(cells) and cells[i + 1].tag == "td" else ""
                out[cell.text.rstrip(":")] = value
            elif i == 0 or cells[i - 1].tag != "th":
                strong = next(iter(cell.all("strong")), None)
                if strong is not None and strong.text:
                    out[strong.text.rstrip(":")] = cell.text.removeprefix(strong.text).strip()
    return out


def combine(rows: Sequence[dict], how: str = "sum") -> tuple[float | None, str, str]:
    """Acres of all rows with some (`sum`, `first` or `max`), the raw values joined by ` + `, the method."""
    some = [r for r in rows if r["acreage"] is not None]
    real = [r for r in some if abs(r["acreage"]) > 1e-12]
    if not real:
        return None, "", "zero_acreage_not_accepted" if some else "no_numeric_acreage_values"
    values = [r["acreage"] for r in real]
    value = {"first": values[0], "max": max(values)}.get(how, sum(values))
    return round(value, 6), " + ".join(r["raw_acreage"] for r in real), f"property_land_{how}"


def classify(html: str | None, how: str = "sum") -> dict:
    """Status and acres of a page. The order of the tests matters: error, absent, blocked, then content."""
    root = tree(html)
    text, name = root.text, title(root)
    lower = text.lower()
    out = {"title": name, "status": "", "acreage": None, "raw_acreage": "", "method": "", "property_id": "", "quick_ref_id": "", "detail": "", "rows": []}
    if name.lower() == "error" or any(t in lower for t in ERROR_TEXTS):
        return out | {"status": "site_error", "detail": "generic_error_page"}
    if any(t in text for t in ABSENT_TEXTS):
        return out | {"status": "property_not_found", "detail": "property_not_found"}
    if any(t in lower for t in BLOCK_TEXTS):
        return out | {"status": "blocked", "detail": "blocked_or_rate_limited"}
    ids = page_ids(root)
    out |= {"property_id": ids.get("Property ID", ""), "quick_ref_id": ids.get("Quick Ref ID", "")}
    rows, place = find_land_rows(root)
    if not rows:
        known = panel(root, "Property Details") is not None or "Property ID:" in text and ("Legal Description:" in text or "Property Values" in text)
        return out | ({"status": "no_land_table", "detail": place} if known else {"status": "failed", "detail": f"{place} | title={name} | body={text[:240]}"})
    acres, raw, method = combine(rows, how)
    return out | {"rows": rows, "acreage": acres, "raw_acreage": raw, "method": method, "status": "success" if acres is not None else "no_acreage_value", "detail": place}


_ROW = "struct<row_number int, raw_acreage string, acreage double, raw_sqft string, sqft double, description string, land_type string, source string>"
PAGE = f"status string, acreage double, raw_acreage string, method string, property_id string, quick_ref_id string, detail string, rows array<{_ROW}>"


def parse_page(html: Column, how: str = "sum") -> Column:
    """`classify` as a column of structs."""

    @F.pandas_udf("status string, acreage double, raw_acreage string, method string, property_id string, quick_ref_id string, detail string, title string, rows string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import json

        for batch in batches:
            parsed = [classify(h, how) for h in batch.where(batch.notna(), None)]
            yield pd.DataFrame([{**p, "rows": json.dumps(p["rows"], ensure_ascii=False)} for p in parsed], columns=["status", "acreage", "raw_acreage", "method", "property_id", "quick_ref_id", "detail", "title", "rows"])

    # Else a filter on the result would have every page parsed once more.
    return run.asNondeterministic()(html)


def land_row_array(rows: Column) -> Column:
    """The land rows of a parsed page as structs."""
    return F.from_json(rows, f"array<{_ROW}>")


def search_base(site: Column) -> Column:
    """The address of a site's property search: a scheme, no `www.`, `esearch.` in front."""
    text = F.trim(site)
    host = F.regexp_extract(text, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?([^/?#]*)", 1)
    scheme = F.coalesce(F.nullif(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1), F.lit("")), F.lit("https"))
    bare = F.regexp_replace(F.lower(host), r"^www\.", "")
    bare = F.when(bare.startswith("esearch."), bare).otherwise(F.concat(F.lit("esearch."), bare))
    return F.when(host != "", F.concat(scheme, F.lit("://"), bare)).otherwise("")


def id_candidates(ident: Column) -> Column:
    """The forms under which a page may know an id: as it is, and of digits with R in front."""
    text = F.regexp_replace(F.trim(ident), r"\.0$", "")
    return F.array_distinct(F.array_compact(F.array(F.nullif(text, F.lit("")), F.when(text.rlike(r"^\d+$"), F.concat(F.lit("R"), text)))))


def page_address(base: Column, ident: Column, year: Column | None = None) -> Column:
    tail = F.when(year.isNotNull(), F.concat(F.lit("?year="), year.cast("string"))).otherwise("") if year is not None else F.lit("")
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/Property/View/"), ident, tail)


def fill_from_pages(missing: DataFrame, pages: DataFrame, key: Sequence[str], urls: str = "urls", *, accepted: Sequence[str] = ("success", "no_land_table", "no_acreage_value", "property_not_found", "blocked")) -> DataFrame:
    """For each row the result of its first page, in the order of its addresses, with an accepted status.

    `urls` is an array of addresses; `pages` hold `url`, `html`. Rows without
    any page have a null result. Pages are parsed once, whoever asks for them.
    """
    asked = missing.select(*key, F.posexplode(urls).alias("attempt", "url"))
    wanted = pages.join(asked.select("url").distinct(), "url", "left_semi").withColumn("page", parse_page(F.col("html"))).drop("html")
    tried = asked.join(wanted, "url").filter(F.col("page")["status"].isin(*accepted))
    first = tried.groupBy(*key).agg(F.min_by(F.struct("url", "attempt", "page"), "attempt").alias("result"))
    return missing.join(first, list(key), "left")


def not_done(rows: DataFrame, done: DataFrame, key: Sequence[str], *, status: str = "status", version: str = "parser_version", current: int = 1, terminal: Sequence[str] = ("success", "property_not_found", "no_land_table")) -> DataFrame:
    """Rows still to do: those without a terminal result of the current parser."""
    return rows.join(done.filter(F.col(status).isin(*terminal) & (F.col(version) >= current)).select(*key), list(key), "left_anti")
