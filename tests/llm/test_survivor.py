from pyspark.sql import functions as F

from landloom.llm.survivor import address_parts, best_values, fuse, grouped, name_words, rule_survivors


def test_rules(spark):
    rows = [(1, 1, "R0077", "5 ELM ST, X TX 78666", "A. B. SMITH", "2020-01-01"), (1, 2, "77.0", "5 ELM ST APT 2, X TX 78666", "SMITH JOHN", "2019-01-01"), (1, 3, " 77", "N/A", "SMITH JOHN", "2021-01-01"), (1, 4, "77", None, "smith john", "2021-01-01"), (2, 5, "77", "x", "y", None), (1, 6, "NA", "x", "y", None)]
    df = spark.createDataFrame(rows, "county_id int, row_no long, land_id string, legal_address string, full_name string, at string").withColumn("at", F.col("at").cast("timestamp"))
    scores = {"legal_address": F.when(F.col("legal_address") != "N/A", address_parts(F.col("legal_address"))), "full_name": name_words(F.col("full_name")), "none": F.lit(None).cast("int")}
    got = {tuple(r) for r in rule_survivors(grouped(df, "county_id", "land_id"), "row_no", "at", scores).collect()}
    assert got == {(1, "legal_address", 2), (1, "full_name", 3)}
    assert rule_survivors(grouped(df.limit(0), "county_id", "land_id"), "row_no", "at", scores).count() == 0


def test_fusion_discounts_copies(spark):
    # Four honest sources outvote a liar and its two copiers on most items, but are only two on the last ten.
    claims = []
    for i in range(40):
        claims += [(f"i{i}", s, "true") for s in ("a", "b", "c", "d")[: 4 if i < 30 else 2]]
        claims += [(f"i{i}", s, f"false{i}") for s in ("liar", "copy1", "copy2")]
    claims += [("only", "a", "v"), (None, "a", "v"), ("x", None, "v"), ("x", "a", None), ("only", "a", "v")]
    best = {r["item"]: r["value"] for r in best_values(fuse(spark.createDataFrame(claims, "item string, source string, value string"))).collect()}
    assert best["only"] == "v" and set(best) == {f"i{i}" for i in range(40)} | {"only"}
    assert all(best[f"i{i}"] == "true" for i in range(40))
    assert fuse(spark.createDataFrame([], "item string, source string, value string")).count() == 0
