import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landloom.llm import history
from landloom.llm.history import History, covering, duplicates, history_rows, one_slip
from landloom.llm.smallworld import Graph
from landloom.llm.words import distance


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 50), max_size=60), st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 50), max_size=30), st.integers(0, 2**63) | st.integers(0, 9))
def test_search_is_exhaustive(points, queries, radius):
    q, n = Graph(np.array(points, np.uint64)).within(np.array(queries, np.uint64), np.full(len(queries), radius, np.uint64))
    want = {(i, j) for i, a in enumerate(queries) for j, b in enumerate(points) if abs(a - b) <= radius}
    assert set(zip(q.tolist(), n.tolist())) == want and len(q) == len(want)


def test_a_fixed_beam_misses_what_a_widened_one_finds():
    rng = np.random.default_rng(5)
    points, queries = rng.integers(0, 100_000, 5_000).astype(np.uint64), rng.integers(0, 100_000, 300).astype(np.uint64)
    graph, radius = Graph(points), np.full(300, 200, np.uint64)
    want = {(i, j) for i, a in enumerate(queries.tolist()) for j in np.flatnonzero(np.abs(points.astype(np.int64) - a) <= 200)}
    found = [set(zip(*[x.tolist() for x in graph.within(queries, radius, beam, rounds)])) for beam, rounds in ((2, 1), (8, 1), (4, None))]
    assert found[0] < found[1] < found[2] == want


def test_routing_passes_equal_points():
    points = np.array([5] * 50_000 + [9], np.uint64)
    q, n = Graph(points).within(np.array([9, 10], np.uint64), np.array([0, 1], np.uint64))
    assert sorted(zip(q.tolist(), n.tolist())) == [(0, 50_000), (1, 50_000)]


@settings(max_examples=200, deadline=None)
@given(st.integers(100, 999_999), st.integers(100, 9_999_999))
def test_one_slip_is_edit_distance_one(a, b):
    assert bool(one_slip(np.array([a]), np.array([b]))[0]) == (a != b and distance(str(a), str(b), 1) == 1)


@settings(max_examples=200, deadline=None)
@given(st.from_regex(r"\A[1-9A-Z][0-9A-Z]{0,11}\Z"), st.integers(0, 11), st.sampled_from("09AZ"))
def test_slips_of_letters(text, at, letter):
    at = min(at, len(text) - 1)
    for other in (text[:at] + letter + text[at + 1:], text[:at] + text[at + 1:], text[:at] + text[at:at + 2][::-1] + text[at + 2:]):
        if other and other[0] != "0":
            assert bool(one_slip(np.array([int(text, 36)]), np.array([int(other, 36)]), 36)[0]) == (text != other)


def test_slips_near_a_number():
    pairs = [(12345, 12354), (12345, 1245), (12345, 123345), (12345, 12346), (10000, 1000), (100, 999), (12345, 54321)]
    got = one_slip(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])).tolist()
    assert got == [distance(str(a), str(b), 1) == 1 for a, b in pairs]


def test_shards_cover_each_segment_once():
    for upto in range(1, 40):
        assert [s for a, n in covering(upto) for s in range(a, a + n)] == list(range(upto)) and len(covering(upto)) <= 6


def test_duplicates(spark):
    load = [
        (1, 1, 7, "R00100", '["100.0", "200"]', "OAKBAL TIMBER LLC", "12 ELMDEL ST, X TX", "5.50"), (2, 2, 7, "100", "", None, None, None),
        (3, 2, 7, "99999", "99999", "N", "1 A ST, X TX", "1"), (4, 2, 7, "4242", "", "Oakbal Timber", "12 Elmdel Str, X Tx", "9.1234"), (5, 3, 8, "100", "", None, None, None),
        (6, 3, 7, "N/A", None, None, None, None), (6, 3, 7, "N/A", None, None, None, None), (7, 3, 7, "42", "42", "OAKBAL TIMBER LLC", "12 ELMDEL ST, X TX", "9.12"),
    ]
    owner = [("u1", 7, "200", [200], "Z", "Q", 1.0), ("u2", 7, "42422", [42422], "OAKBAL TIMBER LLC", "12 ELMDEL ST, X TX", 9.12), ("u3", 7, None, None, None, None, None), ("u4", 7, "42422", None, None, None, None)]
    names = {"area": "county_id", "land": "land_id", "ids": "id_list", "name": "full_name", "address": "legal_address", "acres": "acres"}
    a = spark.createDataFrame(load, "row_no long, batch_no int, county_id int, land_id string, id_list string, full_name string, legal_address string, acres string")
    b = spark.createDataFrame(owner, "unique_id string, county_id int, land_id string, id_list array<bigint>, full_name string, legal_address string, acres double")
    rows = history_rows(a, segment=F.col("batch_no"), source="load_rows", key="row_no", **names).unionByName(history_rows(b, segment=F.lit(0), source="db_owner", key="unique_id", **names))
    got = {tuple(r) for r in duplicates(rows, 3).collect()}
    assert got == {("1", "db_owner", "u1"), ("2", "load_rows", "1"), ("4", "db_owner", "u2"), ("4", "db_owner", "u4")}
    assert duplicates(rows.limit(0), 1).count() == 0


def _rows(spark, values, segment):
    df = spark.createDataFrame(values, "key string, area int, land string, ids string, name string, address string, acres string")
    return history_rows(df, area="area", segment=F.lit(segment), source="s", key="key", land="land", ids="ids", name="name", address="address", acres="acres")


def test_batches_are_added_to_a_stored_index(spark, tmp_path):
    record = ("OAKBAL TIMBER LLC", "12 ELMDEL ST, X TX")
    folder = f"file://{tmp_path}/index"
    first = History(spark, folder)
    first.add(_rows(spark, [("a", 1, "4242", "", *record, "9.12"), ("b", 1, "77", "", None, None, None)], 0))
    first.add(_rows(spark, [("c", 1, "77", "", None, None, None)], 1))
    first.add(_rows(spark, [("d", 2, "77", "", None, None, None)], 2))
    assert [(s.first, s.length) for s in first.shards] == [(0, 2), (2, 1)]
    # Opened again, with the rows of history gone: a batch is searched in the shards only.
    again = History(spark, folder)
    assert again.segments == 3 and [(s.first, s.length) for s in again.shards] == [(0, 2), (2, 1)]
    (tmp_path / "index/rows").rename(tmp_path / "index/away")
    again.add(_rows(spark, [("e", 1, "4224", "77.0", "Oakbal Timber", "12 Elmdel Str, X Tx", "9.1234")], 3))
    assert [(s.first, s.length) for s in again.shards] == [(0, 4)]
    for segment in range(3):
        (tmp_path / f"index/away/segment={segment}").rename(tmp_path / f"index/rows/segment={segment}")
    assert {tuple(r) for r in again.repeats(3).collect()} == {("e", "s", k) for k in "abc"}
    assert {tuple(r) for r in again.repeats().collect()} == {("e", "s", k) for k in "abc"} | {("c", "s", "b")}


def test_slips_of_coarser_roundings_letters_and_no_house(spark):
    name = "OAKBAL TIMBER LLC"
    old = [("a", 1, "4242", "", name, "12 ELMDEL ST, X TX", "160.5"), ("b", 1, "A77", "", name, "ELMDEL ST, X TX", "12"), ("c", 1, "1234567890123456", "", name, "12 ELMDEL ST, X TX", "3.25"), ("z", 2, "4242", "", name, "12 ELMDEL ST, X TX", "160.5")]
    new = [("d", 1, "4224", "", name, "12 ELMDEL ST, X TX", "160.4862"), ("e", 1, "A7", "", name, "ELMDEL ST, X TX", "12.34"), ("f", 1, "1234567890123465", "", name, "12 ELMDEL ST, X TX", "3.2512"), ("g", 1, "4243", "", name, "12 ELMDEL ST, X TX", "161.5")]
    index = History(spark)
    index.add(_rows(spark, old, 0))
    index.add(_rows(spark, new, 1))
    assert {tuple(r) for r in index.repeats().collect()} == {("d", "s", "a"), ("e", "s", "b"), ("f", "s", "c")}


def test_a_large_graph_is_dealt(spark, monkeypatch):
    monkeypatch.setattr(history, "GRAPH_NODES", 20)
    record = ("OAKBAL TIMBER LLC", "12 ELMDEL ST, X TX", "9.12")
    index = History(spark)
    index.add(_rows(spark, [(f"o{i}", 1, str(1000 + 20 * i), "", *record) for i in range(200)], 0))
    index.add(_rows(spark, [(f"n{i}", 1, f"{1000 + 20 * i}7", "", *record) for i in range(0, 200, 10)], 1))
    assert any(s.dealt for s in index.shards)
    got = {tuple(r) for r in index.repeats().collect()}
    assert {(f"n{i}", "s", f"o{i}") for i in range(0, 200, 10)} <= got
