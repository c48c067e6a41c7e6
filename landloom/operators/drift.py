"""Schemas that drift between files: path-value rows, change report, one typed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landloom.session import cut

#: Share of aligned records that must carry the same value under both names.
RENAME_SHARE = 0.5
#: Aligned records needed before values decide; below it a rename is not claimed.
RENAME_LEAST = 3
#: Fields with the most distinct values by which records of two files are aligned.
ALIGN_FIELDS = 3
#: Columns of the consistent table; more names than this are an error, not a loss.
MOST_NAMES = 5_000


def field_type(kind: Column) -> Column:
    """text, integer (no decimal point), decimal, boolean, array or object, from a variant's schema; null for null."""
    size = F.regexp_extract(kind, r"^DECIMAL\((\d+),0\)$", 1)
    return (
        F.when(kind == "STRING", "text")
        .when((kind == "BIGINT") | ((size != "") & (F.try_to_number(size, F.lit("99")) > 18)), "integer")
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "decimal")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
    )


def plain_value(text: Column) -> Column:
    """A value without its notation: case, white space, date order, thousands marks, units."""
    t = F.upper(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))
    t = F.regexp_replace(t, r"^\[\"?(.*?)\"?(,.*)?\]$", "$1")
    t = F.regexp_replace(t, r"^(\d{4})[-/](\d\d)[-/](\d\d)$", "$1$2$3")
    t = F.regexp_replace(t, r"^(\d\d)/(\d\d)/(\d{4})$", "$3$1$2")
    number = F.regexp_extract(t, r"^\$?\s*(-?\d[\d,]*(?:\.\d+)?)\s*(?:AC|ACRES|SQFT|SQ FT|USD)?\.?$", 1)
    number = F.regexp_replace(F.regexp_replace(number, ",", ""), r"(\.\d*?)0+$", "$1")
    number = F.regexp_replace(F.regexp_replace(number, r"\.$", ""), r"^0+(?=\d)", "")
    t = F.when(number != "", number).otherwise(t)
    return F.when(t.isin("Y", "YES", "T"), "TRUE").when(t.isin("N", "NO", "F"), "FALSE").otherwise(t)


def path_values(records: DataFrame, file: str, number: str, payload: str) -> DataFrame:
    """One row per field of a record: `file`, `rec`, `name`, `kind`, `raw`.

    Names keep case and spaces. A payload that is null, no JSON or no object,
    or that names a key twice, gives no row. Null values are left out.
    """
    spark = records.sparkSession
    rows = records.select(F.col(file).alias("file"), F.col(number).alias("rec"), F.try_parse_json(payload).alias("v"))
    rows = rows.filter(F.schema_of_variant("v").startswith("OBJECT"))
    flat = rows.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    flat = flat.select("file", "rec", F.col("key").alias("name"), field_type(F.schema_of_variant("value")).alias("kind"), F.col("value").cast("string").alias("raw"))
    return flat.filter("kind is not null")


def field_statistics(paths: DataFrame) -> DataFrame:
    """Per file and name: the type of most values, how many values, how many distinct ones."""
    kinds = paths.groupBy("file", "name", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.xxhash64("raw")).alias("d"))
    return kinds.groupBy("file", "name").agg(
        F.max(F.struct("n", "kind")).getField("kind").alias("type"),
        F.sum("n").alias("n_values"), F.max(F.struct("n", "kind")).getField("n").alias("n_main"), F.max("d").alias("n_distinct"))


def file_order(files: DataFrame, feed: str, file: str, at: str) -> DataFrame:
    """The files of a feed in order of `at`, each with the one before: `feed`, `seq`, `file`, `before`."""
    rows = files.select(F.col(feed).alias("feed"), F.col(file).alias("file"), F.col(at).alias("at")).groupBy("feed", "file").agg(F.min("at").alias("at"))
    window = Window.partitionBy("feed").orderBy("at", "file")
    return rows.select("feed", F.row_number().over(window).alias("seq"), "file", F.lag("file").over(window).alias("before"))


def changes(paths: DataFrame, order: DataFrame) -> DataFrame:
    """Each column added, removed, renamed or changed in type between a file and the one before.

    Columns `input_file`, `change_kind`, `old_name`, `new_name`, `old_type`,
    `new_type`, `share` (of aligned records that carry the same value under
    both names, for renames). A file without records has no fields: all fields
    of the file before are removed there. Ties between types go to the name
    that is last in order; ties between renames to the names first in order.
    """
    stats = cut(field_statistics(paths), "fields")
    steps = cut(order.filter("before is not null"), "steps")
    now = steps.join(stats, "file").select("feed", "seq", "file", "before", "name", F.col("type").alias("new_type"), F.col("n_values").alias("n_new"), F.col("n_distinct").alias("d_new"))
    was = steps.join(stats.withColumnRenamed("file", "before"), "before").select("feed", "seq", "file", "before", "name", F.col("type").alias("old_type"), F.col("n_values").alias("n_old"), F.col("n_distinct").alias("d_old"))
    both = cut(was.join(now, ["feed", "seq", "file", "before", "name"], "full"), "both")
    ended = both.filter("new_type is null").select("file", "before", F.col("name").alias("old_name"), "old_type")
    begun = both.filter("old_type is null").select("file", "before", F.col("name").alias("new_name"), "new_type")
    kept = both.filter("old_type is not null and new_type is not null")
    pairs = ended.join(begun, ["file", "before"])

    # Records of the two files are aligned by the kept fields that come nearest to a key.
    rank = Window.partitionBy("file").orderBy(F.desc(F.least(F.col("d_old") / F.col("n_old"), F.lit(1.0)) * F.least(F.col("d_new") / F.col("n_new"), F.lit(1.0)) * F.least("n_old", "n_new")), "name")
    align = kept.join(pairs.select("file").distinct(), "file", "left_semi").withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= ALIGN_FIELDS).select("file", "before", "name", "r")
    align = cut(align, "align")
    # Values are freed from their notation once, and only those of fields that are compared.
    compared = [align.select("file", "name"), align.select("before", "name"), begun.select("file", "new_name"), ended.select("before", "old_name")]
    wanted = compared[0].union(compared[1]).union(compared[2]).union(compared[3]).distinct()
    values = cut(paths.join(wanted, ["file", "name"], "left_semi").select("file", "rec", "name", plain_value(F.col("raw")).alias("v")), "values")
    earlier = values.withColumnRenamed("file", "before")
    # One record per value on either side, so no value can multiply rows.
    cur = align.join(values, ["file", "name"]).groupBy("file", "before", "r", "v").agg(F.min("rec").alias("rec"))
    old = align.join(earlier, ["before", "name"]).groupBy("file", "before", "r", "v").agg(F.min("rec").alias("rec_before"))
    matched = cur.join(old, ["file", "before", "r", "v"]).groupBy("file", "before", "rec", "rec_before").agg(F.lit(1).alias("one"))

    new_values = values.join(begun.select("file", F.col("new_name").alias("name"), "before"), ["file", "name"]).join(ended.select("file").distinct(), "file", "left_semi").select("file", "rec", F.col("name").alias("new_name"), F.col("v").alias("new_v"))
    old_values = earlier.join(ended.select("before", F.col("old_name").alias("name"), "file"), ["before", "name"]).join(begun.select("file").distinct(), "file", "left_semi").select("file", F.col("rec").alias("rec_before"), F.col("name").alias("old_name"), F.col("v").alias("old_v"))
    aligned = matched.join(new_values, ["file", "rec"]).join(old_values, ["file", "rec_before"])
    a, b = F.col("old_v").try_cast("double"), F.col("new_v").try_cast("double")
    years = a.between(1900, 2100) & b.between(1900, 2100) & (a == F.floor(a)) & (b == F.floor(b)) & (F.abs(a - b) <= 3)
    # The same up to rounding; a later year, or a revised amount, speaks for the same attribute less strongly.
    same = F.when(F.col("old_v") == F.col("new_v"), 1.0).when(F.abs(a - b) <= 0.051 + 0.001 * F.abs(a), 1.0).when(years, 0.9).when((a > 0) & (b > 0) & F.try_divide(b, a).between(0.7, 1.5), 0.6).otherwise(0.0)
    score = aligned.groupBy("file", "old_name", "new_name").agg(F.count(F.lit(1)).alias("n"), F.avg(same).alias("share")).filter((F.col("n") >= RENAME_LEAST) & (F.col("share") >= RENAME_SHARE))
    by_old = Window.partitionBy("file", "old_name").orderBy(F.desc("share"), F.desc("n"), "new_name")
    by_new = Window.partitionBy("file", "new_name").orderBy(F.desc("share"), F.desc("n"), "old_name")
    renamed = score.withColumn("ro", F.row_number().over(by_old)).withColumn("rn", F.row_number().over(by_new)).filter("ro = 1 and rn = 1").select("file", "old_name", "new_name", "share")
    renamed = cut(renamed.join(pairs.select("file", "old_name", "new_name", "old_type", "new_type"), ["file", "old_name", "new_name"]), "renamed")

    none = F.lit(None)
    head = ["file", "change_kind", "old_name", "new_name", "old_type", "new_type", "share"]
    parts = [
        renamed.withColumn("change_kind", F.lit("renamed")),
        renamed.filter("old_type <> new_type").withColumn("old_name", F.col("new_name")).withColumn("change_kind", F.lit("retyped")),
        kept.filter("old_type <> new_type").select("file", F.lit("retyped").alias("change_kind"), F.col("name").alias("old_name"), F.col("name").alias("new_name"), "old_type", "new_type", none.cast("double").alias("share")),
        ended.join(renamed.select("file", "old_name"), ["file", "old_name"], "left_anti").select("file", F.lit("removed").alias("change_kind"), "old_name", F.lit("").alias("new_name"), "old_type", none.cast("string").alias("new_type"), none.cast("double").alias("share")),
        begun.join(renamed.select("file", "new_name"), ["file", "new_name"], "left_anti").select("file", F.lit("added").alias("change_kind"), F.lit("").alias("old_name"), "new_name", none.cast("string").alias("old_type"), "new_type", none.cast("double").alias("share")),
    ]
    out = parts[0].select(*head)
    for part in parts[1:]:
        out = out.unionByName(part.select(*head))
    return out.withColumnRenamed("file", "input_file").distinct()


def attributes(paths: DataFrame, report: DataFrame) -> dict[str, tuple[str, str]]:
    """For each name its attribute (the most common of the names linked by renames) and the attribute's type.

    Works on column names only; their number is checked against MOST_NAMES.
    """
    rows = paths.groupBy("name", "kind").agg(F.count(F.lit(1)).alias("n")).limit(MOST_NAMES * 6 + 1).collect()
    links = report.filter("change_kind = 'renamed'").select("old_name", "new_name").distinct().limit(MOST_NAMES**2).collect()
    names = {r["name"] for r in rows}
    if len(names) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} column names")
    root = {n: n for n in names}

    def find(n: str) -> str:
        while root.setdefault(n, n) != n:
            n = root[n]
        return n

    for r in sorted(links):
        root[find(r["old_name"])] = find(r["new_name"])
    count: dict[str, dict[str, int]] = {}
    size: dict[str, int] = {}
    for r in rows:
        size[r["name"]] = size.get(r["name"], 0) + r["n"]
        kinds = count.setdefault(find(r["name"]), {})
        kinds[r["kind"]] = kinds.get(r["kind"], 0) + r["n"]
    title: dict[str, str] = {}
    for n in sorted(names, key=lambda n: (-size[n], n)):
        title.setdefault(find(n), n)
    return {n: (title[find(n)], max(sorted(count[find(n)]), key=lambda k: count[find(n)][k])) for n in names}


_SQL_TYPE = {"text": "string", "integer": "bigint", "decimal": "double", "boolean": "boolean", "array": "array<string>", "object": "string"}


def typed(raw: Column, kind: Column, to: str) -> Column:
    """A raw value as the attribute's type; null where it cannot be read as that."""
    plain = plain_value(raw)
    whole = F.regexp_replace(plain, r"\.0+$", "")
    if to == "integer":
        return whole.try_cast("bigint")
    if to == "decimal":
        return plain.try_cast("double")
    if to == "boolean":
        return plain.try_cast("boolean")
    if to == "array":
        return F.when(kind == "array", F.from_json(raw, "array<string>")).otherwise(F.array(raw))
    return raw


def consistent_table(paths: DataFrame, report: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One typed row per record, and the failed casts per file and attribute.

    The table has `input_file`, `record_no`, `n_failed_casts` and a column per
    attribute, whose name has other characters than letters, digits and `_`
    replaced and a number added where two names then clash. Where a record
    carries an attribute under two names, the name first in order gives it.
    """
    known = attributes(paths, report)
    spark = paths.sparkSession
    mapping = F.create_map(*[F.lit(x) for n in sorted(known) for x in (n, known[n][0])]) if known else F.create_map()
    rows = paths.withColumn("attribute", mapping[F.col("name")]) if known else paths.withColumn("attribute", F.lit(""))
    wanted = {a: t for a, t in known.values()}
    cells = rows.groupBy("file", "rec", "attribute").agg(F.min_by(F.struct("raw", "kind"), "name").alias("c"))
    packed = cells.groupBy("file", "rec").agg(F.map_from_entries(F.collect_list(F.struct("attribute", "c"))).alias("m"))
    out, failed, taken = [], [], {"input_file", "record_no", "n_failed_casts"}
    for a in sorted(wanted):
        cell = F.col("m")[F.lit(a)]
        value = typed(cell["raw"], cell["kind"], wanted[a]).cast(_SQL_TYPE[wanted[a]])
        base = name = "".join(c if c.isalnum() or c == "_" else "_" for c in a).lower() or "_"
        k = 1
        while name in taken:
            k += 1
            name = f"{base}_{k}"
        taken.add(name)
        out.append(value.alias(name))
        failed.append(F.when(cell["raw"].isNotNull() & value.isNull(), F.lit(a)))
    bad = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    wide = packed.select(F.col("file").alias("input_file"), F.col("rec").alias("record_no"), bad.alias("bad__"), *out)
    casts = wide.select("input_file", F.explode("bad__").alias("attribute")).groupBy("input_file", "attribute").agg(F.count(F.lit(1)).alias("n_failed"))
    types = spark.createDataFrame(sorted((a, t) for a, t in wanted.items()) or [("", "")], "attribute string, attribute_type string")
    return wide.withColumn("n_failed_casts", F.size("bad__")).drop("bad__"), casts.join(types, "attribute", "left").select("input_file", "attribute", "attribute_type", "n_failed")
