"""Golden vectors and properties of the stages."""

import pytest
from pyspark.sql import functions as F

from landloom.functions import numbers as N
from landloom.functions import text as X
from landloom.functions.schema import mapping, resolve
from landloom.operators import acreage, dedupe, enrich, exclude, landpage, load, match, owners, rollup, subtract

ESSENTIAL = "county string, n int, id string, full_name string, legal_address string, mailing_address string, acres string, city string, zip string, state string"


@pytest.mark.parametrize(("text", "acres", "method", "confidence"), [
    ("LOT 37 AC 15.6440", 15.644, "ac_unit_before_number", "high"), ("ACRES 44 60", 44.6, "acres_keyword_before_number", "high"),
    ("296. ACRES", 296.0, "number_before_acres_unit", "high"), ("61,63950 AC", 61.6395, "number_before_acres_unit", "high"),
    ("093 AC", 0.93, "number_before_acres_unit", "high"), ("O.16 AC", 0.16, "number_before_acres_unit", "high"),
    ("20.829AC", 20.829, "decimal_tight_before_ac_unit", "high"), ("565AC", 565.0, "decimal_tight_before_ac_unit", "low"),
    ("AB 224 R HAILEY 13.82 (3.82 AC HS)", 13.82, "unlabeled_decimal_fallback", "medium"), ("ACRES 0.113 & NE 1/2 ALLEY 0.06 AC", 0.173, "additive_acres_sum", "medium"),
    ("43,560 SQ FT", 1.0, "square_feet_fallback", "low"), ("", None, "missing_legal_desc", "none"), ("NOTHING HERE", None, "not_found", "none"),
])
def test_acreage_vectors(text, acres, method, confidence):
    got = acreage.parse(text)
    assert (got["acres"], got["method"], got["confidence"]) == (acres, method, confidence)


def test_fill_acreage(spark):
    df = spark.createDataFrame([("1.5", "ACRES 9", None), ("", "ACRES 9", "43560"), ("n/a", "LOT 4", "43,560"), ("0", "ACRES 9", "1"), (None, None, None)], "acres string, t string, area string")
    got = [(r["acres"], r["legal_acreage_source"], r["Empty_Legal_Acreage"]) for r in acreage.fill_acreage(df, acres="acres", description=F.col("t"), surface="area").collect()]
    assert got == [(1.5, "existing", False), (9.0, "legal_description", True), (1.0, "surface_area", True), (0.0, "existing", False), (None, "unfilled", True)]


@pytest.mark.parametrize(("address", "want"), [
    ("123 MAIN ST, SAN MARCOS, TX 78666-1234", ("San Marcos", "TX", "78666")), ("456 FM 150 KYLE TX 78640", ("Kyle", "TX", "78640")),
    ("% JOHN DOE, 1 ELM ST AUSTIN TX 78701", ("Austin", "TX", "78701")), ("5 OAK GROVE PARK CITY TX 75001", ("Grove Park City", "TX", "75001")),
    ("PO BOX 10000 AUSTIN TX", ("", "TX", "10000")), ("100 CONGRESS AVE", ("", "", "")),
])
def test_address_vectors(spark, address, want):
    r = enrich.enrich_addresses(spark.createDataFrame([(address, "", "", "")], "mailing_address string, city string, state string, zip string")).first()
    assert (r["city"], r["state"], r["zip"]) == want


def test_enrichment_never_changes_filled_cells(spark):
    r = enrich.enrich_addresses(spark.createDataFrame([("1 ELM ST, KYLE, TX 78640", "Here", "OK", "1")], "mailing_address string, city string, state string, zip string")).first()
    assert (r["city"], r["state"], r["zip"]) == ("Here", "OK", "1")


def test_dedupe_merges(spark):
    df = spark.createDataFrame([("7", 1, "100", "False"), ("7", 2, "100 | 200", "True"), ("", 3, "a", "x"), (None, 4, "b", "y"), ("8", 5, "c | C", "maybe")], "id string, n int, m string, f string")
    got = {(r["id"], r["n"]): (r["m"], r["f"]) for r in dedupe.dedupe_by_id(df, ["id"], ["n"], lists=["m"], flags=["f"]).collect()}
    assert got == {("7", 1): ("100 | 200", "True"), ("", 3): ("a", "x"), (None, 4): ("b", "y"), ("8", 5): ("c | C", "maybe")}


def owner_frame(spark):
    rows = [("c", 1, "1", "A", "", "M", "5", "", "", ""), ("c", 2, "2", "A", "1 ELM", "M", "3", "", "", ""), ("c", 3, "3", "A", "x", "N/A", "1", "", "", ""), ("c", 4, "4", "A", "x", "n/a", "1", "", "", "")]
    return spark.createDataFrame(rows, ESSENTIAL)


def test_group_owners(spark):
    got = {r["id"]: r for r in owners.group_owners(owner_frame(spark), ["county"], ["n"]).collect()}
    assert set(got) == {"2", "3", "4"} and got["2"]["lands_count"] == 2
    assert got["2"]["id_list"] == '["1", "2"]' and got["2"]["acres_list"] == '["5", "3"]'
    assert sum(r["lands_count"] for r in got.values()) == 4


def test_rollup(spark):
    rows = [("c", 1, "10", "O1", "L", "123 Main St.", "5", "", "", "", 1, '["10"]', '["5"]'), ("c", 2, "20", "O2", "L", "123 Main St.", "3", "", "", "", 2, '["20", "21"]', '["1", "2"]'), ("c", 3, "30", "O3", "L", "", "9", "", "", "", 1, "30", "9")]
    df = spark.createDataFrame(rows, ESSENTIAL + ", lands_count int, id_list string, acres_list string")
    out = rollup.rollup_mailing(df, ["county"], ["n"]).collect()
    group = next(r for r in out if r["is_group"])
    assert len(out) == 4 and (group["id"], group["acres"], group["lands_count"], group["id_list"]) == ("20", "8", 3, '["10", "20", "21"]')
    assert group["full_name"] == "MA#840FCD | O2 (+1 other)" and group["legal_address"] == ""
    assert [r["mailing_address"] for r in out if not r["is_group"]].count("") == 3


def test_exclusion(spark):
    names = ["HAYS COUNTY", "FIRST BAPTIST CHURCH", "COUNTY'S BEST", "COUNTYLINE LLC", "CHURCHILL JOHN", "SCHOOLS INC", None, ""]
    kept, removed = exclude.split_excluded(spark.createDataFrame([(n,) for n in names], "full_name string"), "full_name")
    assert {r[0] for r in removed.collect()} == set(names[:3]) and kept.count() == 5


def test_subtract(spark):
    rows = [(1, 10, "1", "[1,2,3]", "[1,2,4]", "7", "3"), (1, 11, "2", "2", "5", "5", "1"), (1, 12, "5", "5", "5", "5", "1"), (1, 13, None, "2", "5", "5", "1"), (2, 14, "2", "2", "5", "5", "1")]
    df = spark.createDataFrame(rows, "area int, row int, id string, id_list string, acres_list string, acres string, lands_count string")
    stored = spark.createDataFrame([(1, "2.0", [77])], "area int, land_id string, id_list array<bigint>")
    got = {r["row"]: r for r in subtract.subtract_parcels(df, subtract.existing_keys(stored, ["area"]), ["area"], "row").collect()}
    assert [got[i]["outcome"] for i in range(10, 15)] == ["partial", "dropped", "kept", "skipped_kept", "kept"]
    assert (got[10]["id"], got[10]["id_list"], got[10]["acres"], got[10]["lands_count"], got[10]["removed_ids"]) == ("1", '["1","3"]', "5", "2", '["2"]')
    assert all(r["seen"] == r["removed"] + r["remaining"] for r in got.values())


def test_match_score_ambiguity_and_merge(spark):
    src = spark.createDataFrame([(1, 1, "10", "[10, 11]", "A", 2, None, None), (1, 2, "2", "[2, 3]", "Z", 2, "[7, 8]", None)], "county_id int, row int, id string, id_list string, full_name string, lands_count int, acres_list string, market_value_list string")
    records, skipped = match.source_records(src, ["county_id"], "row")
    stored = spark.createDataFrame(
        [("u1", 1, "10", "A", 1, 5.0, [10], [5.0], None, None, None), ("u2", 1, "1", "B", 2, None, [1, 2], [5.0, None], None, None, None)],
        "unique_id string, county_id int, land_id string, full_name string, owned_lands int, acres double, id_list array<bigint>, acres_list array<double>, market_value_list array<double>, owner_tax_year_list array<int>, deed_date_list array<date>")
    scored = match.candidates(records, stored, ["county_id"])
    scores = {(r["row"], r["unique"]): r["score"] for r in scored.collect()}
    assert scores[1, "u1"] == 10529 and skipped.count() == 0
    updates = match.merged_lists(records, stored, match.best_matches(scored, ["county_id"]), ["county_id"])
    u = {r["unique"]: r for r in updates.collect()}["u2"]
    assert list(u["final_ids"]) == [1, 2, 3] and list(u["final_acres_list"]) == [5.0, 7.0, 8.0] and u["changed"] == ["id_list", "acres_list"]
    done = {r["unique_id"]: r for r in match.apply_updates(stored, updates, ["county_id"]).collect()}
    assert len(done) == 2 and list(done["u2"]["id_list"]) == [1, 2, 3]
    twins = stored.unionByName(stored.filter("unique_id = 'u1'").withColumn("unique_id", F.lit("u9")))
    best = {r["row"]: r["ambiguous"] for r in match.best_matches(match.candidates(records, twins, ["county_id"]), ["county_id"]).collect()}
    assert best[1] is True


def test_load_numbers_and_names(spark):
    df = spark.createDataFrame([(61, 1, "SMITH JOHN & MARY", "5"), (61, 2, "MA#840FCD | DOE JANE (+2 others)", "6"), (62, 3, "SOLO", ""), (61, 4, "X", None)], "county_id int, n int, full_name string, id string")
    stored = spark.createDataFrame([("TX-61-3000-1", 61), ("TX-61-9", 61), ("bad", 61)], "unique_id string, county_id int")
    counties = spark.createDataFrame([(61, "Hays", 1), (62, "Kyle", 2)], "county_id int, county_name string, cad_category int")
    payload, skipped = load.owner_payload(df, counties, stored, ["n"])
    got = {r["unique_id"]: (r["first_name_1"], r["last_name_1"]) for r in payload.collect()}
    assert got == {"TX-61-3001-1": ("JOHN", "SMITH"), "TX-61-3002-1": ("JANE (+2 others)", "DOE")}
    assert {r["n"] for r in skipped.collect()} == {3, 4}


def test_land_page():
    head = "<div class='panel'><div class='panel-heading'>Property Land</div><table><tr><th>Acreage<th>Sqft</tr>"
    got = landpage.classify(head + "<tr><td>1.5<td></tr><tr><td>0<td></tr><tr><td><td>21780</tr></table></div>")
    assert (got["status"], got["acreage"], got["raw_acreage"], got["method"]) == ("success", 2.0, "1.5 + 21780", "property_land_sum")
    assert landpage.classify("Property Not Found captcha")["status"] == "property_not_found"
    assert landpage.classify("<title>Error</title>captcha")["status"] == "site_error"
    assert landpage.classify("please solve the CAPTCHA")["status"] == "blocked"
    assert landpage.classify(None)["status"] == "failed"


def test_numbers(spark):
    v = ["10522.0", "10.7", "10.5", "1e3", "R123", None, "n/a"]
    df = spark.createDataFrame([(x,) for x in v], "x string").select(N.whole_half_even(F.col("x")), N.whole_exact(F.col("x")), N.whole_truncated(F.col("x")))
    assert [tuple(r) for r in df.collect()] == [(10522, 10522, 10522), (11, None, 10), (10, None, 10), (1000, None, 1000), (None, None, None), (None, None, None), (None, None, None)]
    one = spark.range(1).select(N.parse_date(F.lit("13/02/2020")).alias("a"), N.parse_date(F.lit("1/2/99")).alias("b"), N.excel_date(F.lit(43831)).alias("c"), X.mailing_code(F.lit("123 Main St.")).alias("d")).first()
    assert (str(one["a"]), str(one["b"]), str(one["c"]), one["d"]) == ("2020-02-13", "1999-01-02", "2020-01-01", "840FCD")


def test_resolution():
    assert resolve(["Prop ID", "OWNER"], ["prop_id", "owner"]) == "OWNER" and resolve(["Prop ID"], ["prop_id"]) == "Prop ID"
    assert mapping(["situs_num", "situs_street", "mail_addr"])["legal_address"] == ["situs_num", "situs_street"]
