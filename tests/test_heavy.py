from pyspark.sql import functions as F

from landloom.operators.heavy import best_row_per_key, heavy_keys, skew_join, split_heavy


def rows(spark):
    data = [("hot", i, i % 7) for i in range(3000)] + [(f"k{i % 400}", 3000 + i, i % 5) for i in range(1000)] + [(None, 5000, 1), ("nul", 5001, None), ("tie", 5002, 3), ("tie", 5003, 3), ("tie", 5003, 3)]
    return spark.createDataFrame(data, "k string, id long, v int")


def order():
    return F.when(F.col("v").isNotNull(), F.col("v").cast("decimal(38,0)") * 1000000 - F.col("id"))


def test_best_row_matches_brute_force(spark):
    df = rows(spark)
    got = {r["k"]: (r["best"], r["n_rows"]) for r in best_row_per_key(df, ["k"], order(), F.col("id"), share=0.05).collect()}
    want = {}
    for r in df.collect():
        want.setdefault(r["k"], []).append(r)
    want = {k: (max(((r["v"], -r["id"]) for r in g if r["v"] is not None), default=(None, None)), len(g)) for k, g in want.items()}
    assert got == {k: (None if b[1] is None else -b[1], n) for k, (b, n) in want.items()}
    assert got["nul"] == (None, 1) and got["tie"] == (5002, 3) and got[None] == (5000, 1)


def test_split_keeps_every_row_and_finds_the_hot_key(spark):
    df = rows(spark)
    parts = split_heavy(df, ["k"], share=0.05, sketch=0.5)
    assert parts.heavy.count() + parts.light.count() == df.count()
    assert "hot" in {r["k"] for r in parts.keys.collect()}
    assert heavy_keys(df, ["k"], share=0.05).count() <= 20


def test_skew_join_is_the_plain_join(spark):
    left, right = rows(spark), spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4)], "k string, w int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = sorted(map(str, skew_join(left, right, ["k"], how=how, share=0.05).collect()))
        b = sorted(map(str, left.join(right, ["k"], how).collect()))
        assert a == b


def test_empty_and_clashing_names(spark):
    empty = rows(spark).limit(0)
    assert best_row_per_key(empty, ["k"], order(), F.col("id")).count() == 0
    clash = rows(spark).withColumn("n__", F.lit(1)).withColumn("salt__", F.lit(2)).withColumn("Best", F.lit(3))
    assert best_row_per_key(clash, ["k"], order(), F.col("id")).count() == rows(spark).select("k").distinct().count()
    assert skew_join(clash, spark.createDataFrame([("hot", 1)], "k string, w int"), ["k"]).count() == 3000
