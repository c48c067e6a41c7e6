"""The best representative of each duplicate group, field by field.

Two ways. `rule_survivors` follows a fixed order of preference and is exact;
`fuse` estimates how far each source can be trusted, which sources copy from
each other, and takes the value with the greatest posterior probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landloom.functions.text import parcel_key
from landloom.llm.addresses import parse as parse_address
from landloom.missing import TABLE_TOKENS, is_missing
from landloom.session import cut

#: Rounds of the truth and accuracy estimates, false values per field assumed, and the accuracy of a source at first.
ROUNDS, FALSE_VALUES, FIRST_ACCURACY = 3, 50, 0.8
#: Prior probability that of two sources one copies from the other, and the share of values a copier copies.
DEPEND, COPIED = 0.2, 0.8


def address_parts(text: Column) -> Column:
    """How many of number with street or box, unit, city, state, zip an address has."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if t is None else parse_address(t).parts for t in batch], dtype="Int32")

    return count(text)


def name_words(text: Column) -> Column:
    """Words of two or more letters after full stops and commas are deleted."""
    return F.regexp_count(F.regexp_replace(text, "[.,]", ""), F.lit(r"(?<![^\s])\p{L}{2,}(?![^\s])"))


def grouped(rows: DataFrame, area: str, key: str) -> DataFrame:
    """The rows whose key is not missing, with `area__` and `key__` (formatting aside)."""
    miss = is_missing(F.col(f"`{key}`"), TABLE_TOKENS)
    return rows.filter(~miss).withColumn("area__", F.col(f"`{area}`")).withColumn("key__", parcel_key(F.col(f"`{key}`"))).filter("key__ is not null")


def rule_survivors(rows: DataFrame, row: str, at: str, scores: dict[str, Column]) -> DataFrame:
    """Per group of two or more rows and field the row whose value survives.

    `rows` come from `grouped`; `scores` gives per field a whole number, null
    where the value is missing and so never survives. The greatest score wins,
    then the latest `at` (null counts as earliest), then the smallest `row`.
    Columns `group_row`, `field_name`, `best_row`; no row where none is left.
    One hash aggregation on numbers, so a group of any size is reduced where
    its rows lie.
    """
    wide = "decimal(38,0)"
    when = F.coalesce(F.unix_micros(F.col(f"`{at}`").cast("timestamp")) + F.lit(10**17), F.lit(0))
    # score, time and row as one number: each of the lower parts has room for 18 digits.
    rank = {f: (s.cast(wide) * F.lit(10**18).cast(wide) + when.cast(wide)) for f, s in scores.items()}
    base = rows.select("area__", "key__", F.col(f"`{row}`").alias("row"), *[r.cast(wide).alias(f"r{i}") for i, r in enumerate(rank.values())])
    sums = [F.count(F.lit(1)).alias("n"), F.min("row").alias("group_row")]
    sums += [F.max(f"r{i}").alias(f"r{i}") for i in range(len(rank))]
    best = base.groupBy("area__", "key__").agg(*sums).filter("n > 1")
    tops = F.array(*[F.struct(F.lit(f).alias("field_name"), F.lit(i).alias("i"), F.col(f"r{i}").alias("top")) for i, f in enumerate(rank)])
    wanted = best.select("area__", "key__", "group_row", F.explode(tops).alias("t")).select("area__", "key__", "group_row", "t.*").filter("top is not null")
    own = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"r{i}").alias("top")) for i in range(len(rank))])
    flat = base.select("area__", "key__", "row", F.explode(own).alias("t")).select("area__", "key__", "row", "t.*").filter("top is not null")
    # Smallest row of each distinct rank, reduced before it meets the tops.
    firsts = flat.groupBy("area__", "key__", "i", "top").agg(F.min("row").alias("best_row"))
    return firsts.join(wanted, ["area__", "key__", "i", "top"]).select("group_row", "field_name", "best_row")


def _cases(claims: DataFrame) -> DataFrame:
    """One row per item: `case`, a number of which sources told the same value, and `told`, its values by their sources."""
    values = claims.groupBy("item", "value").agg(F.array_sort(F.collect_set(F.xxhash64("source"))).alias("sources"))
    items = values.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("sources", "value"))).alias("told"))
    return items.withColumn("case", F.xxhash64(F.transform("told", lambda t: t["sources"])))


def _copies(pairs: DataFrame, belief: DataFrame, accuracy: DataFrame) -> DataFrame:
    """For each two sources that share items the probability that the first copies from the second: `s`, `t`, `copies`.

    Evidence are the items on which they tell the same true value, the same
    false one (which chance seldom gives), and different values.
    """
    p = F.coalesce("p", F.lit(0.0))
    weighed = pairs.join(belief.select("case", "g", "p"), ["case", "g"], "left")
    sums = weighed.groupBy("s", "t").agg(F.sum(F.when(F.col("same"), F.col("n") * p).otherwise(0.0)).alias("kt"), F.sum(F.when(F.col("same"), F.col("n") * (1 - p)).otherwise(0.0)).alias("kf"), F.sum(F.when(F.col("same"), 0).otherwise(F.col("n"))).alias("kd"))
    both = sums.join(accuracy.select(F.col("s"), F.col("a").alias("a")), "s").join(accuracy.select(F.col("s").alias("t"), F.col("a").alias("b")), "t")
    a, b, c = F.col("a"), F.col("b"), COPIED
    true, false = a * b, (1 - a) * (1 - b) / FALSE_VALUES

    def gain(origin: Column) -> Column:
        """Log likelihood of copying from a source of this accuracy, over that of independence."""
        return F.col("kt") * F.log((c * origin + (1 - c) * true) / true) + F.col("kf") * F.log((c * (1 - origin) + (1 - c) * false) / false) + F.col("kd") * float(np.log(1 - c))

    both = both.withColumns({"one": gain(b), "two": gain(a)}).withColumn("top", F.greatest("one", "two", F.lit(0.0)))
    weight = {x: DEPEND / 2 * F.exp(F.col(x) - F.col("top")) for x in ("one", "two")}
    whole = weight["one"] + weight["two"] + (1 - DEPEND) * F.exp(-F.col("top"))
    known = both.withColumns({"first": weight["one"] / whole, "second": weight["two"] / whole})
    return known.select("s", "t", F.col("first").alias("copies")).union(known.select("t", "s", "second")).filter("copies > 0.01")


def fuse(claims: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Bayesian fusion with copy detection over claims (`item`, `source`, `value`).

    Alternates: the posterior of each value of an item from the accuracies of
    its sources, the accuracy of each source from the posteriors of its values,
    and for each two sources that share an item the probability that one copies
    from the other (all that share one are compared). Of sources that tell one
    value the more accurate votes first; each later one votes by the share that
    it copied from none of those before. Claims with a null in any column are
    left out; repeated claims count once. Columns `item`, `value`, `posterior`,
    `n_sources`.

    What is estimated depends on an item only by which sources told the same
    value, so all rounds go over these cases with the number of their items.
    The values of one item, and its sources, are held in one row.
    """
    items = cut(_cases(claims.select("item", "source", "value").dropna()), "items")
    cases = items.groupBy("case").agg(F.count(F.lit(1)).cast("double").alias("n"), F.first(F.transform("told", lambda t: t["sources"])).alias("groups"))
    flat = F.flatten(F.transform("groups", lambda sources, g: F.transform(sources, lambda s: F.struct(s.alias("s"), g.alias("g")))))
    cases = cut(cases.withColumn("flat", flat), "cases")
    votes = cut(cases.select("case", "n", F.explode("flat").alias("v")).select("case", "n", "v.s", "v.g"), "votes")
    # Both sources of a pair in order; `g` is the value of the first.
    two = F.flatten(F.transform("flat", lambda x, i: F.transform(F.filter("flat", lambda y: x["s"] < y["s"]), lambda y: F.struct(x["s"].alias("s"), y["s"].alias("t"), x["g"].alias("g"), (x["g"] == y["g"]).alias("same")))))
    pairs = cut(cases.filter(F.size("flat") > 1).select("case", "n", F.explode(two).alias("p")).select("case", "n", "p.*"), "pairs")
    accuracy = votes.select("s").distinct().withColumn("a", F.lit(FIRST_ACCURACY))
    copies = None
    for turn in range(rounds + 1):
        voiced = votes.join(accuracy, "s")
        share = F.lit(1.0)
        if copies is not None:
            # Of two sources of one value the more accurate (then the smaller number) comes first.
            known = voiced.select("case", "g", "s", "a")
            other = known.select("case", "g", F.col("s").alias("t"), F.col("a").alias("b"))
            before = (F.col("b") > F.col("a")) | ((F.col("b") == F.col("a")) & (F.col("t") < F.col("s")))
            own = known.join(other, ["case", "g"]).filter((F.col("s") != F.col("t")) & before).join(copies, ["s", "t"])
            own = own.groupBy("case", "g", "s").agg(F.exp(F.sum(F.log(1 - COPIED * F.col("copies")))).alias("share"))
            voiced = voiced.join(own, ["case", "g", "s"], "left")
            share = F.coalesce("share", F.lit(1.0))
        voice = share * F.log(FALSE_VALUES * F.col("a") / (1 - F.col("a")))
        score = voiced.groupBy("case", "g").agg(F.sum(voice).alias("score"))
        each = Window.partitionBy("case")
        belief = score.withColumn("e", F.exp(F.col("score") - F.max("score").over(each)))
        belief = cut(belief.select("case", "g", (F.col("e") / F.sum("e").over(each)).alias("p")), "belief")
        if turn < rounds:
            # Two claims more, one and a half of them right: no source is ever taken for sure.
            told = votes.join(belief, ["case", "g"]).groupBy("s").agg(F.sum(F.col("n") * F.col("p")).alias("right"), F.sum("n").alias("all"))
            accuracy = cut(told.select("s", ((F.col("right") + 1.5) / (F.col("all") + 2)).alias("a")), "accuracy")
            copies = cut(_copies(pairs, belief, accuracy), "copies")
    flat = items.select("item", "case", F.posexplode("told").alias("g", "t")).select("item", "case", "g", "t.value", F.size("t.sources").cast("long").alias("n_sources"))
    return flat.join(belief, ["case", "g"]).select("item", "value", "n_sources", F.col("p").alias("posterior"))


def best_values(post: DataFrame) -> DataFrame:
    """Per item the value with the greatest posterior, the first in order among equals."""
    top = post.groupBy("item").agg(F.max("posterior").alias("posterior"))
    return post.join(top, ["item", "posterior"]).groupBy("item", "posterior").agg(F.min("value").alias("value"), F.max("n_sources").alias("n_sources"))
