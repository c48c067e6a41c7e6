"""Listings and tables of county files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landloom.functions.schema import strip_names
from landloom.missing import M9

SUFFIXES = (".csv", ".xlsx", ".xlsm", ".xls")
#: Encodings in the order in which they are tried.
ENCODINGS = ("utf-8-sig", "utf-8", "cp1252", "latin-1")


def list_files(spark: SparkSession, root: str, suffixes: Sequence[str] = SUFFIXES, *, skip_summaries: bool = True, counties: Sequence[str] | None = None) -> DataFrame:
    """Data files below `root`: `county`, `name`, `stem`, `suffix`, `path`, `size`, in order of county and name.

    The county is the folder of a file; files in the root itself have the
    root's name. Lock files, summaries, audits and folders that begin with `_` are left out.
    """
    top = root.rstrip("/").rsplit("/", 1)[-1]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size"))
    files = files.withColumns({"name": F.regexp_extract("path", r"([^/]+)$", 1), "county": F.url_decode(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))})
    files = files.withColumns({"name": F.url_decode(F.regexp_replace("name", r"\+", "%2B")), "suffix": F.lower(F.regexp_extract("name", r"(\.[^.]+)$", 1))})
    files = files.withColumn("stem", F.expr("substring(name, 1, length(name) - length(suffix))"))
    keep = F.col("suffix").isin(*suffixes) & ~F.col("name").startswith("~$") & ~F.col("county").startswith("_")
    if skip_summaries:
        keep = keep & ~F.lower("stem").rlike(r"(_summary|_audit)$|audit|_removed_")
    if counties is not None:
        keep = keep & F.col("county").isin(*counties, top)
    return files.filter(keep).select("county", "name", "stem", "suffix", "path", "size").orderBy(F.lower("county"), F.lower("name"))


def preferred_file(files: DataFrame, stems: Sequence[str], words: Sequence[str] = ()) -> DataFrame:
    """One file per county: with a preferred stem (`{county}` stands for the county), else a word in its name, else the first."""
    stem = F.lower("stem")
    rank = F.lit(len(stems) + len(words))
    for i, w in reversed(list(enumerate(words))):
        rank = F.when(stem.contains(w.lower()), len(stems) + i).otherwise(rank)
    for i, s in reversed(list(enumerate(stems))):
        rank = F.when(stem == F.replace(F.lit(s.lower()), F.lit("{county}"), F.lower("county")), i).otherwise(rank)
    window = Window.partitionBy("county").orderBy("r__", F.lower("name"))
    return files.withColumn("r__", rank).withColumn("n__", F.row_number().over(window)).filter("n__ = 1").drop("r__", "n__")


def output_format(files: DataFrame) -> DataFrame:
    """Per county `csv` if all its files are, else `xlsx`."""
    return files.groupBy("county").agg(F.when(F.bool_and(F.col("suffix") == ".csv"), "csv").otherwise("xlsx").alias("file_type"))


def read_csv(spark: SparkSession, paths: str | Sequence[str], *, missing_to_null: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """CSV files with one header as text, with `_src_file` and `county`. Nothing is inferred, so ids keep leading zeros.

    With `missing_to_null` missing tokens become null; else cells are as written and absent ones empty strings.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", encoding).option("mode", "PERMISSIVE").option("nullValue", "\u0000").option("emptyValue", "")
    df = strip_names(reader.csv(list(paths) if not isinstance(paths, str) else paths))
    cells = {c: F.when(~F.lower(F.trim(F.col(f"`{c}`"))).isin(*M9), F.col(f"`{c}`")) if missing_to_null else F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in df.columns}
    place = F.col("_metadata.file_path")
    return df.withColumns({**cells, "_src_file": place, "county": F.url_decode(F.regexp_extract(place, r"([^/]+)/[^/]+$", 1))})


def read_tables(spark: SparkSession, files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of CSV and spreadsheet files whatever their encoding: `county`, `_src_file`, `_src_row`, then `columns` as text.

    Each file is one task's work, read by its bytes, so rows keep their numbers
    (the header is row 1) and a file's encoding is found by trying. A column
    that a file lacks is null; a file that cannot be read gives one row with
    its reason in `_error`.
    """
    wanted = list(columns)
    paths = [r["path"] for r in files.select("path").collect()]
    schema = "county string, _src_file string, _src_row bigint, _error string, " + ", ".join(f"`{c}` string" for c in wanted)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv
        import io
        from urllib.parse import unquote

        from landloom.sources.xlsx import read_rows

        for batch in batches:
            for path, data in zip(batch["path"], batch["content"]):
                county, error, rows = unquote(path.split("/")[-2]), None, []
                try:
                    if path.lower().endswith(".csv"):
                        for name in ENCODINGS:
                            try:
                                rows = list(csv.reader(io.StringIO(bytes(data).decode(name))))
                                break
                            except UnicodeDecodeError:
                                continue
                    else:
                        rows = read_rows(bytes(data))
                except Exception as e:  # the file's fault, told in its row
                    error = f"{type(e).__name__}: {e}"[:300]
                at = {(h or "").strip(): i for i, h in enumerate(rows[0])} if rows else {}
                out = [[county, path, n, None, *[row[at[c]] if c in at and at[c] < len(row) else None for c in wanted]] for n, row in enumerate(rows[1:], 2)]
                if error:
                    out = [[county, path, 0, error, *[None] * len(wanted)]]
                yield pd.DataFrame(out, columns=["county", "_src_file", "_src_row", "_error", *wanted])

    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.format("binaryFile").load(paths).select("path", "content").repartition(len(paths), "path").mapInPandas(run, schema)
