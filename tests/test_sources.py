from landloom.sources import files, sinks
from landloom.sources.xlsx import XlsxSource, read_rows, write_rows
from landloom.streaming.progress import run_available


def test_xlsx_round_trip(tmp_path, spark):
    rows = [["id", "name"], ["007", "Ana & <b>"], [None, "x"]]
    assert read_rows(write_rows(rows)) == [["id", "name"], ["007", "Ana & <b>"], [None, "x"]]
    (tmp_path / "a.xlsx").write_bytes(write_rows(rows))
    spark.dataSource.register(XlsxSource)
    got = spark.read.format("xlsx_sheet").load(str(tmp_path / "*.xlsx")).collect()
    assert [(r["id"], r["_src_row"]) for r in got] == [("007", 2), (None, 3)]


def test_listing_encodings_and_rows(tmp_path, spark):
    for county, name, data in (("Hays", "b.csv", "﻿id,n\n1,é\n".encode()), ("Hays", "a.csv", "id,n\n2,é\n".encode("cp1252")), ("Hays", "x_summary.csv", b"q\n"), ("_audit", "z.csv", b"id\n9\n"), ("Kyle", "c.xlsx", write_rows([["id"], ["3"]])), ("Kyle", "bad.xlsx", b"no")):
        (tmp_path / county).mkdir(exist_ok=True)
        (tmp_path / county / name).write_bytes(data)
    found = files.list_files(spark, str(tmp_path))
    assert [(r["county"], r["name"]) for r in found.collect()] == [("Hays", "a.csv"), ("Hays", "b.csv"), ("Kyle", "bad.xlsx"), ("Kyle", "c.xlsx")]
    got = {(r["county"], r["id"], r["n"], r["_src_row"]) for r in files.read_tables(spark, found, ["id", "n"]).collect() if r["_error"] is None}
    assert got == {("Hays", "1", "é", 2), ("Hays", "2", "é", 2), ("Kyle", "3", None, 2)}
    assert {r["county"]: r["file_type"] for r in files.output_format(found).collect()} == {"Hays": "csv", "Kyle": "xlsx"}
    assert {r["county"]: r["name"] for r in files.preferred_file(found, ["b"]).collect()} == {"Hays": "b.csv", "Kyle": "bad.xlsx"}


def test_exports_and_report(tmp_path, spark):
    df = spark.createDataFrame([("Hays", 2, "b"), ("Hays", 1, None), ("Kyle", 1, "k")], "county string, n int, v string")
    done = {r["name"]: r["n_rows"] for r in sinks.export_files(df, str(tmp_path), "county", ["n"], suffix="_x").collect()}
    assert done == {"Hays": 2, "Kyle": 1} and (tmp_path / "Hays_x.csv").read_text(encoding="utf-8-sig").startswith("n,v\n1,")
    assert "&lt;" in sinks.html_report("a<b", {"t": df})


def test_available_now_runs_append_only_new_files(tmp_path, spark):
    src, out, point = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    for k in (1, 2):
        spark.range(k * 10).write.mode("append").parquet(src)
        run_available(spark, src, "id long", out, point, lambda s: s.filter("id % 2 = 0"))
        assert spark.read.parquet(out).count() == {1: 5, 2: 15}[k]
