"""Counts, rates and running measures for reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reason_counts(df: DataFrame, reason: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per reason, most first, then by reason."""
    return df.groupBy(*by, reason).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(*by, F.desc("n_rows"), reason)


def totals(df: DataFrame, by: Sequence[str], sums: Sequence[str], *, overall: bool = False) -> DataFrame:
    """Rows and sums per group; with `overall` also one row of all, its group columns null."""
    grouped = df.rollup(*by) if overall else df.groupBy(*by)
    out = grouped.agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(f"sum_{c}") for c in sums], F.grouping_id().alias("level__") if overall else F.lit(0).alias("level__"))
    return (out.filter(F.col("level__").isin(0, 2 ** len(by) - 1)) if overall else out).drop("level__")


def status_rates(df: DataFrame, by: Sequence[str], status: str, bad: Sequence[str], seconds: str | None = None) -> DataFrame:
    """Rows, share of bad statuses, and the mean of the durations that are not zero."""
    flags = F.col(status).isin(*bad).cast("double")
    more = [F.avg(F.nullif(F.col(seconds), F.lit(0))).alias("mean_seconds")] if seconds else []
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(F.coalesce(flags, F.lit(0.0))).alias("bad_share"), *more)


def recent_bad_share(df: DataFrame, by: Sequence[str], order: Sequence[str], bad: Column, *, last: int = 20, least: int = 8) -> DataFrame:
    """Each row with the share of bad ones among the last rows of its group; null before `least` rows.

    `order` must be total within a group.
    """
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(last - 1), 0)
    n = F.count(F.lit(1)).over(window)
    return df.withColumn("recent_bad_share", F.when(n >= least, F.avg(F.coalesce(bad, F.lit(False)).cast("double")).over(window)))


def deal(df: DataFrame, order: Sequence[str], parts: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows dealt in turn to `parts` numbered from 0, in order, within groups."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("part", F.pmod(F.row_number().over(window) - 1, F.lit(parts)).cast("int"))


def delay_factor(df: DataFrame, by: Sequence[str], order: Sequence[str], outcome: str, *, ok: float = 0.94, bad: float = 1.18, blocked: float = 1.6, most: float = 3.0) -> DataFrame:
    """Per group the factor after all outcomes in order: down on `ok`, not below 1; up on `bad`, more on `blocked`, not above `most`.

    A replay of a log; a group's outcomes are folded in one row as short codes.
    """
    code = F.when(F.col(outcome) == "ok", ok).when(F.col(outcome) == "blocked", blocked).otherwise(bad)
    steps = F.transform(F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), code.alias("f")))), lambda s: s["f"])
    return df.groupBy(*by).agg(F.aggregate(steps, F.lit(1.0), lambda a, f: F.greatest(F.lit(1.0), F.least(F.lit(most), a * f))).alias("factor"))


def workers(levels: DataFrame, by: Sequence[str], level: str, *, most_bad: float = 0.35, most_seconds: float = 35.0) -> DataFrame:
    """Per group the greatest level below the first that fails: blocked, too many bad, or too slow; one at least."""
    fails = (F.col("blocked") > 0) | (F.col("bad_share") > most_bad) | (F.col("mean_seconds") > most_seconds)
    flagged = levels.withColumn("fails__", F.coalesce(fails, F.lit(False)))
    first = flagged.groupBy(*by).agg(F.min(F.when(F.col("fails__"), F.col(level))).alias("first__"))
    return flagged.join(first, list(by)).groupBy(*by).agg(F.coalesce(F.max(F.when(F.col("first__").isNull() | (F.col(level) < F.col("first__")), F.col(level))), F.lit(1)).alias("workers"))
