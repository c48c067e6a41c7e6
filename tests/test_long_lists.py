"""Rows with lists of thousands of parcels."""

from __future__ import annotations

import json
import time

from landloom.operators.owners import ALIGNED
from landloom.operators.subtract import subtract_parcels


def test_long_lists_are_parsed_once(spark):
    """One row of 6,000 parcels, every second of them there already; before, each list was parsed again for each item that stayed."""
    n = 6_000
    cells = {"id_list": json.dumps([str(i + 1) for i in range(n)]), "acres_list": json.dumps([f"{i + 1}.5" for i in range(n)]), **{c: json.dumps([f"v{i}" for i in range(n)]) for c in ALIGNED}}
    rows = spark.createDataFrame([{"county": 1, "key": "r", "id": "1", "acres": "1.5", "lands_count": n, **cells}])
    keys = spark.createDataFrame([(1, str(i), 1) for i in range(1, n + 1, 2)], "county int, parcel string, rank int")
    began = time.monotonic()
    (out,) = subtract_parcels(rows, keys, ["county"], "key").collect()
    assert time.monotonic() - began < 60
    left = range(1, n, 2)
    assert (out.outcome, out.seen, out.removed, out.remaining, out.id, out.lands_count) == ("partial", n, n // 2, n // 2, "2", n // 2)
    assert json.loads(out.id_list) == [str(i + 1) for i in left]
    assert json.loads(out.acres_list) == [f"{i + 1}.5" for i in left]
    assert all(json.loads(out[c]) == [f"v{i}" for i in left] for c in ALIGNED)
    assert float(out.acres) == sum(i + 1.5 for i in left)
