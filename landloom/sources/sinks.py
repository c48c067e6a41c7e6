"""Files and tables written."""

from __future__ import annotations

import html
import os
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOM = "﻿"


def write_csv(df: DataFrame, path: str, *, by: Sequence[str] = (), dry_run: bool = False) -> int | None:
    """CSV with a header, partitioned by `by`; a dry run only counts."""
    if dry_run:
        return df.count()
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "")
    (writer.partitionBy(*by) if by else writer).csv(path)
    return None


def export_files(df: DataFrame, folder: str, by: str, order: Sequence[str], *, suffix: str = "", kind: str = "csv", bom: bool = True) -> DataFrame:
    """One CSV or spreadsheet file per value of `by`, `<value><suffix>.<kind>`, put in place when complete.

    For hand-over to people: each value is one task's work and must fit it. The
    native sink is Parquet. Returns `name`, `path`, `n_rows` of what was written.
    """
    columns = [c for c in df.columns if c != by]

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        from landloom.sources.xlsx import write_rows

        name = str(rows[by].iloc[0])
        rows = rows.sort_values(list(order), kind="stable")[columns]
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, f"{name.replace('/', '_')}{suffix}.{kind}")
        made = f"{path}.{os.getpid()}.tmp"
        if kind == "csv":
            with open(made, "w", encoding="utf-8", newline="") as f:
                f.write(BOM if bom else "")
                rows.to_csv(f, index=False)
        else:
            with open(made, "wb") as f:
                f.write(write_rows([columns, *rows.where(rows.notna(), None).itertuples(index=False)]))
        os.replace(made, path)
        return pd.DataFrame({"name": [name], "path": [path], "n_rows": [len(rows)]})

    return df.groupBy(by).applyInPandas(write, "name string, path string, n_rows bigint")


def upsert_jdbc(df: DataFrame, url: str, table: str, keys: Sequence[str], *, batch: int = 500, driver: str = "psycopg2") -> None:
    """Insert rows, or update those whose keys are there, in batches; a repeated task changes nothing more."""
    columns = df.columns
    update = ", ".join(f"{c} = excluded.{c}" for c in columns if c not in keys)
    sql = f"insert into {table} ({', '.join(columns)}) values ({', '.join(['%s'] * len(columns))}) on conflict ({', '.join(keys)}) do update set {update}"

    def send(rows: Iterator) -> None:
        import importlib

        with importlib.import_module(driver).connect(url) as link, link.cursor() as cursor:
            chunk = []
            for row in rows:
                chunk.append(tuple(row))
                if len(chunk) == batch:
                    cursor.executemany(sql, chunk)
                    chunk = []
            if chunk:
                cursor.executemany(sql, chunk)

    df.foreachPartition(send)


def tracker_update(tracker: DataFrame, metrics: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Tracker rows with the metrics of their county; rows without metrics stay as they are, none is added."""
    new = metrics.select(key, *[F.col(c).alias(f"new__{c}") for c in columns])
    both = tracker.join(new, key, "left")
    old = set(tracker.columns)
    return both.select(*[F.coalesce(F.col(f"new__{c}").cast(tracker.schema[c].dataType), F.col(c)).alias(c) if c in columns else F.col(c) for c in tracker.columns], *[F.col(f"new__{c}").alias(c) for c in columns if c not in old])


def html_report(title: str, tables: dict[str, DataFrame], most: int = 5_000) -> str:
    """A page with one table per metrics frame, `most` rows each; the frames are summaries, small by nature."""
    out = [f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><style>table{{border-collapse:collapse}}td,th{{border:1px solid #ccc;padding:2px 6px}}</style><h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        rows = df.limit(most + 1).collect()
        head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
        body = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in rows[:most])
        more = f"<p>More than {most} rows; the table holds the first.</p>" if len(rows) > most else ""
        out.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{body}</table>{more}")
    return "".join(out)
