import pytest

from landloom.operators.unpack import FLOOR, Splitter, atoms, chunks, expected, unpack, viterbi


def cells(spark, values, field="v"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"row long, {field} string")


def split(spark, values):
    out = {}
    for r in unpack(cells(spark, values), ["row"], ["v"]).collect():
        out.setdefault(r["row"], {})[r["item_pos"]] = r["item_text"]
    return {values[k]: [v[i] for i in range(len(v))] for k, v in out.items()}


def test_dates_money_and_mixed_separators(spark):
    train = ['["Aug 8, 1983", "Mar 1, 2001"]', '["01/02/2003","4/5/06"]', '["$1,234.50", "$12,000"]', "$9,999 | $1,000", "12345", "R0016"] * 20
    got = split(spark, train + ["Aug 8, 1983", "Mar 24, 1974, May 23, 2004", "3/4/05, 01/02/2003", "$1,234.50,$12,000", "12345;23456|34567", "12345 and 23456", "12345\t\t34567", "; 3/4/05", "N/A | 4/5/06", "null"])
    assert got["Aug 8, 1983"] == ["Aug 8, 1983"]
    assert got["Mar 24, 1974, May 23, 2004"] == ["Mar 24, 1974", "May 23, 2004"]
    assert got["3/4/05, 01/02/2003"] == ["3/4/05", "01/02/2003"]
    assert got["$1,234.50,$12,000"] == ["$1,234.50", "$12,000"]
    assert got["12345;23456|34567"] == ["12345", "23456", "34567"]
    assert got["12345 and 23456"] == ["12345", "23456"]
    assert got["12345\t\t34567"] == ["12345", "", "34567"]
    assert got["; 3/4/05"] == ["", "3/4/05"]
    assert got["N/A | 4/5/06"] == ["", "4/5/06"]
    assert "null" not in got


def test_quotes_are_atoms():
    spans, seps = atoms("['a, b', 'c; d']")
    assert len(spans) == 2 and len(seps) == 1


def test_expected_counts_sum_to_paths():
    # Two atoms: apart or together; brute force over both paths.
    prob = {"L": 0.6, "L,L": 0.1}
    got = expected(["L", "L"], [","], prob, FLOOR)
    both, one = 0.6 * 0.6, 0.1
    assert got["L"] == pytest.approx(2 * both / (both + one)) and got["L,L"] == pytest.approx(one / (both + one))


def test_viterbi_takes_the_cheapest_path():
    assert viterbi(["a", "a", "a"], ["/", "/"], {"a/a/a": 1.0, "a": 5.0}, 16.0) == [(0, 3)]
    assert viterbi(["L", "L"], [",_"], {"L": 0.1}, 16.0) == [(0, 1), (1, 2)]


def test_empty_table_long_cells_and_clashing_names(spark):
    assert unpack(cells(spark, []), ["row"], ["v"]).count() == 0
    long = " | ".join(str(10000 + i) for i in range(20_000))
    df = cells(spark, [long, None, "", "   "]).selectExpr("row", "row item_pos", "v field_name")
    out = unpack(df, ["row", "item_pos"], ["field_name"])
    assert out.count() == 20_000


def test_unlearned_cells_split_by_default():
    spans = Splitter({}).split("f", "12, 34")
    assert spans in (["12", "34"], ["12, 34"])
    assert len(chunks("a|b")) == 2
