import json

from landloom.operators import drift


def frames(spark):
    ids = list(range(100, 112))
    first = [{"id": i, "Owner": f"NAME {i}", "acres": i + 0.5, "yr": 2019, "old_only": "x"} for i in ids]
    second = [{"id": float(i), "owner_name": f"name {i}", "acres": [i + 0.5], "tax_year": 2020, "new_one": f"Z{i}"} for i in ids]
    third = [*second[:-1], {"id": None}, {"id": 1.5, "acres": "12 AC"}]
    rows = [(f, n, json.dumps(r)) for f, rs in (("a", first), ("b", second), ("c", third)) for n, r in enumerate(rs)]
    rows += [("a", 98, "not json"), ("a", 99, None), ("b", 99, "[1]")]
    records = spark.createDataFrame(rows, "input_file string, record_no long, payload string")
    files = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "b", 2), (1, "c", 3), (2, "z", 1)], "feed long, input_file string, at long")
    return records, files


def test_changes(spark):
    records, files = frames(spark)
    paths = drift.path_values(records, "input_file", "record_no", "payload")
    got = {tuple(r) for r in drift.changes(paths, drift.file_order(files, "feed", "input_file", "at")).select("input_file", "change_kind", "old_name", "new_name").collect()}
    assert got == {
        ("b", "renamed", "Owner", "owner_name"), ("b", "renamed", "yr", "tax_year"), ("b", "removed", "old_only", ""), ("b", "added", "", "new_one"),
        ("b", "retyped", "id", "id"), ("b", "retyped", "acres", "acres"),
    }


def test_consistent_table_and_failed_casts(spark):
    records, files = frames(spark)
    paths = drift.path_values(records, "input_file", "record_no", "payload")
    report = drift.changes(paths, drift.file_order(files, "feed", "input_file", "at"))
    table, failed = drift.consistent_table(paths, report)
    rows = table.collect()
    assert len(rows) == 12 + 12 + 12
    assert {"input_file", "record_no", "id", "owner_name", "acres"} <= set(table.columns)
    assert all(r["owner_name"] is None or r["owner_name"].lower().startswith("name") for r in rows)
    assert failed.columns == ["input_file", "attribute", "attribute_type", "n_failed"]


def test_empty(spark):
    records, files = frames(spark)
    paths = drift.path_values(records.limit(0), "input_file", "record_no", "payload")
    assert drift.changes(paths, drift.file_order(files.limit(0), "feed", "input_file", "at")).count() == 0
