import pytest

from landloom.llm.addresses import parse
from landloom.llm.addresses_link import MOST_COST, address_records, align, bands, block, locations, same_place_pairs, shingles

SAME = [
    ("1467 LERNUXDAD CREEK CT, GUDLOTKITVILLE AR 81482", "1467 LERNUXDAD CREEK CT\nGUDLOTKITVILLE AR 81482"), ("PO BOX 115, NOVDINMATBURG CA 31501", "pob 115, novdinmatburg,ca 31501-7311"),
    ("1236 FM 145 APT 87, KESMOSGANBURG TX 77852", "1236 F.M. 145 NO 87, KESMOSGANBURG TEXAS 77852"), ("1212 BALFAMKES POINT LOOP APT 17, FOLNISGEMBURG TX 79109", "BALLFAMKES POINT LP. 1212  # 17;  FOLNISGEMBURG TX 79109"),
    ("1658 CR 136, FOLGORKIT GROVE TX 79477", "1658 c.r. 136"), ("2758 W DELMEBGUD MILL RD, KARFAMNUXBURG TX 78504", "% TAX DEPT, KARFAMNUXBURG TX 78504, 2758 DELMEBGUD MILL RD"),
    ("12 Martin Luther King Jr Blvd, Kyle TX", "12 MARTIN LUTHER KING JR BOULEVARD, KYLE, TEXAS"), ("10 OLD MILL CREEK RANCH RD, KYLE", "10 Old Mill Crk Ranch Road"), ("7 PARK PLACE DR, KYLE TX", "7 Park Place Drive, Kyle TX"), ("5 ELM CREEK ST, MARBLE FALLS TX", "5 ELM CRK ST, MARBLE FLS TX"),
    ("20 FAMFOLFOL POINT DR, DINGANDUS SPRINGS TX", "DINGANDUS SPRINGS TX 20 FAMFOLFOL POINT DR"),
]
OTHER = [
    ("1080 E BURNUXKES BLUFF LN, F TX 79109", "1080 E BURNUXKES BLUFF PL, F TX 79109"), ("1 N KARMOSKIT PASTURE TRL, M TX", "1 S KARMOSKIT PASTURE TRL, M TX"), ("101 CR 130 APT 112, F TX", "101 CR 130 APT 73, F TX"),
    ("101 CR 130, F TX", "101 CR 131, F TX"), ("5 ELM ST APT 2, X TX", "5 ELM ST, X TX"), ("12 OAKDEL MEADOW DR, X TX", "13 OAKDEL MEADOW DR, X TX"),
]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_one_location(a, b):
    assert align(parse(a), parse(b)) <= MOST_COST


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_other_location(a, b):
    assert align(parse(a), parse(b)) > MOST_COST


@pytest.mark.parametrize(("text", "street", "kind", "city"), [("12 Martin Luther King Jr Blvd", "MARTIN LUTHER KING JR", "BLVD", ""), ("10 OLD MILL CREEK RANCH RD, KYLE", "OLD MILL CREEK RANCH", "RD", "KYLE"), ("3 PARK PLACE DR APT 4, KYLE TX 78640", "PARK PLACE", "DR", "KYLE")])
def test_streets_of_any_number_of_words(text, street, kind, city):
    a = parse(text)
    assert (a.street, a.kind, a.city) == (street, kind, city)


@pytest.mark.parametrize("text", ["", " ", ",;,", "#", "% ", "APT", "N N N", "é" * 50_000, "1" * 300, "PO BOX", "FM", "TX 78666"])
def test_nothing_raises(text):
    a = parse(text)
    assert a.parts >= 0 and isinstance(shingles(a), list) and isinstance(block(a), str)


def test_bands_agree_for_equal_and_differ_for_other_records():
    a, b = parse("12 OAKDEL MEADOW DR, X TX"), parse("13 OAKDEL MEADOW DR, X TX")
    x, y, z = bands([block(a), block(a), block(b)], [shingles(a), shingles(a), shingles(b)])
    assert x == y and not set(x) & set(z)
    assert bands([], []) == []


def test_pairs_against_brute_force(spark):
    texts = [t for pair in SAME + OTHER for t in pair] + ["N/A", None, "", "12 OAKDEL MEADOW DR, X TX"]
    df = spark.createDataFrame([(i % 2, 100 + i, t, texts[-1 - i]) for i, t in enumerate(texts)] + [(1 - i % 2, 900 + i, t, None) for i, t in enumerate(texts)], "county_id int, row_no long, legal_address string, mailing_address string")
    records = address_records(df, "county_id", "row_no", ["legal_address", "mailing_address"])
    got = {tuple(r) for r in same_place_pairs(records).collect()}
    all_rows = [tuple(r) for r in records.collect()]
    want = set()
    for area, row, field, key in all_rows:
        for area2, row2, field2, key2 in all_rows:
            if area == area2 and key != key2 and (row, field) < (row2, field2) and parse(key).number and align(parse(key), parse(key2)) <= MOST_COST:
                want.add((row, field, row2, field2))
    assert got == want and got


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([], "county_id int, row_no long, legal_address string, mailing_address string, node int, area string")
    records = address_records(df, "county_id", "row_no", ["legal_address", "mailing_address"])
    assert locations(records).count() == 0 and same_place_pairs(records).count() == 0


def test_street_shingles_are_made_once_and_phrases_looked_for_by_their_signs():
    from landloom.llm import addresses_link as link

    link._street_shingles.cache_clear()
    for number in range(50):
        shingles(parse(f"{number + 1} OAK MILL RD, BALKOD TX 78001"))
    assert link._street_shingles.cache_info().misses == 1
    for text, street in (("P. O. B 12, BALKOD TX 78001", "BOX"), ("p\to\nbox 12", "BOX"), ("12 F M 33, BALKOD TX", "FM 33"), ("12 CNTY ROAD 5", "CR 5"), ("12 C R 44", "CR 44")):
        assert parse(text).street == street, text
