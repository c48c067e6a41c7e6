"""Links by every listed parcel against brute force over all pairs."""

from pyspark.sql import functions as F

from landloom.functions.arrays import looked_up
from landloom.plans.reference_queries import QUERIES

#: row_no, county_id, land_id, its parcels, id_list as delivered, full_name, owned_lands.
LOAD = [
    (1, 1, "10", [10, 11, 12], "[10, 11, 12]", "ANN ROE", 3), (2, 1, "20", [20, 31], '["20", "31"]', "BO DUS", 2), (3, 1, "40", [40], None, "CY LEE", 1),
    (4, 1, "50", [50, 61, 62], "50, 61, 62", "DI MAR", 3), (5, 2, "10", [10, 11], "10|11", "ANN ROE", 2), (6, 1, "70", [70], "[70]", "", None),
    (7, 1, "80", [80, 31], "80;31", "", None), (8, 1, "80", [80, 31], "80.0\n31.0", "", None), (9, 1, "80", [80, 31], "{80,31}", "", None), (10, 1, "80", [80, 31], "80 and 31", "", None),
]
#: unique_id, county_id, land_id, id_list, full_name, owned_lands.
STORED = [
    ("a", 1, "11", [11, 12], "Ann Roe", 2), ("b", 1, "10", None, "ANN", 1), ("c", 1, "99", [31], "Bo Dus", 1), ("d", 1, "98", [31], "Bo Dus", 1),
    ("e", 1, "40", [40], "CY LEE", 1), ("f", 1, "61", None, "EL NIX", 3), ("g", 2, "11", [11], "ANN ROE", 1), ("h", 2, "70", [70], "X", 1),
]


def brute_force():
    out = {}
    for row, county, land, ids, _, name, lands in LOAD:
        for unique, their_county, their_land, theirs, their_name, their_lands in STORED:
            held = theirs or [int(their_land)]
            if county != their_county or not (land == their_land or set(ids) & set(held)):
                continue
            overlap = len(set(ids) & set(theirs or []))
            size = len(theirs) if theirs else their_lands
            x, y = name.lower(), their_name.lower()
            score = 10_000 * (land == their_land) + 100 * overlap + 250 * (int(land) in (theirs or [])) + 150 * (int(their_land) in ids)
            score += 0 if not x or not y else 30 if x == y else 10 if x in y or y in x else 0
            score += 25 if len(ids) == size else -min(abs(len(ids) - size), 25)
            out[row, unique] = (county, score + 10 * (lands == their_lands), overlap)
    return out


def test_links_by_all_parcels(spark, tmp_path):
    spark.createDataFrame([(r, c, k, cell, n, m) for r, c, k, _, cell, n, m in LOAD], "row_no long, county_id int, land_id string, id_list string, full_name string, owned_lands int").write.parquet(f"{tmp_path}/load_rows.parquet")
    spark.createDataFrame(STORED, "unique_id string, county_id int, land_id string, id_list array<long>, full_name string, owned_lands int").write.parquet(f"{tmp_path}/db_owner.parquet")
    want = brute_force()
    assert {(1, "a"), (2, "c"), (2, "d"), (4, "f"), (5, "g")} <= set(want)  # through listed parcels only
    got = QUERIES["match_list_candidates"](spark, str(tmp_path)).collect()
    assert sorted((r["county_id"], r["row_no"], r["unique_id"], r["score"], r["overlap"]) for r in got) == sorted((c, r, u, s, o) for (r, u), (c, s, o) in want.items())
    rank = {}
    for (r, u), (c, s, o) in want.items():
        rank.setdefault((c, r), []).append((s, o, u))
    rank = {k: [x for x in sorted(v, reverse=True) if x[0] >= 1] for k, v in rank.items()}
    best = QUERIES["match_list_best"](spark, str(tmp_path)).collect()
    assert {(r["county_id"], r["row_no"]): (r["unique_id"], r["score"]) for r in best} == {k: (v[0][2], v[0][0]) for k, v in rank.items() if v}
    ties = {r["county_id"]: (r["n_rows"], r["n_ambiguous"]) for r in QUERIES["match_list_ambiguous"](spark, str(tmp_path)).collect()}
    assert ties == {c: (sum(k[0] == c for k in rank), sum(k[0] == c and len(v) > 1 and v[0][:2] == v[1][:2] for k, v in rank.items())) for c in (1, 2)}


def test_looked_up_takes_the_first_value_that_is_there(spark):
    rows = [([3, 1, 9], [1, 3, 1, None, 3], [None, 5.0, 2.0, 7.0, 6.0]), ([], [1], [2.0]), ([4], [], []), ([None, 2], [None, 2], [1.0, 8.0]), (None, [1], [1.0])]
    df = spark.createDataFrame(rows, "k array<bigint>, i array<bigint>, v array<double>")
    got = [r[0] for r in df.select(looked_up(F.col("k"), F.col("i"), F.col("v"), "double")).collect()]
    assert got == [[5.0, 2.0, None], [], [None], [None, 8.0], None]
