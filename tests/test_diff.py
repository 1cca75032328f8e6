"""Row digests ahead of the cell join."""

import math

import pytest

from cadence.operators import diff
from cadence.operators.diff import compared, diff_sections, keyed

SCHEMA = "section string, row_label string, col_label string, value double, text string"
CELLS = [("A", f"r{i}", f"c{j}", float(i * 10 + j), None) for i in range(5) for j in range(3)]
CELLS += [("B", "t", None, None, "title"), ("B", "r", "c0", math.nan, None), ("B", "r", "c1", None, "x")]


def side(spark, cells):
    return keyed(spark.createDataFrame(cells, SCHEMA).repartition(3), [])


def found(spark, gold, gen):
    return {r["section"]: r.asDict() for r in diff_sections(side(spark, gold), side(spark, gen)).collect()}


def test_equal_sides_need_no_cell_join(spark, monkeypatch):
    monkeypatch.setattr(diff, "diff_cells", lambda *a: pytest.fail("joined"))
    f = found(spark, CELLS, list(reversed(CELLS)))
    assert f["A"]["passed"] and (f["A"]["rows_gold"], f["A"]["cols_gen"], f["A"]["n_cells"]) == (5, 3, 15)
    assert f["B"]["passed"] and (f["B"]["rows_gold"], f["B"]["cols_gold"], f["B"]["n_cells"]) == (2, 2, 3)


def test_only_unlike_rows_reach_the_cell_join(spark, monkeypatch):
    seen = []
    real = diff.diff_cells
    monkeypatch.setattr(diff, "diff_cells", lambda g, n, *a: seen.append((g.count(), n.count())) or real(g, n, *a))
    gen = [(s, r, c, v + 1e-9 if (r, c) == ("r1", "c1") else v + 1 if (r, c) == ("r3", "c0") else v, t) for s, r, c, v, t in CELLS]
    f = found(spark, CELLS, gen)
    assert seen == [(6, 6)]
    assert (f["A"]["n_cells"], f["A"]["n_mismatch"], f["A"]["status"]) == (15, 1, "data mismatch") and f["B"]["passed"]


def test_null_nan_text_and_titles(spark):
    def changed(at, value, text):
        return found(spark, CELLS, [(s, r, c, value, text) if (s, r, c) == at else (s, r, c, v, t) for s, r, c, v, t in CELLS])["B"]

    assert changed(("B", "r", "c0"), None, None)["n_mismatch"] == 1  # NaN against null
    assert changed(("B", "r", "c1"), None, "y")["n_mismatch"] == 1
    assert changed(("B", "r", "c1"), 0.0, "x")["n_mismatch"] == 1
    title = changed(("B", "t", None), None, "other")
    assert (title["n_cells"], title["n_mismatch"]) == (3, 1)
    assert changed(("B", "t", None), None, "title")["passed"]


def test_rows_and_sections_on_one_side(spark):
    f = found(spark, CELLS, [c for c in CELLS if c[0] == "A" and c[1] != "r0"])
    assert f["A"]["status"] == "shape mismatch" and (f["A"]["rows_gold"], f["A"]["rows_gen"], f["A"]["n_mismatch"]) == (5, 4, 3)
    b = f["B"]
    assert b["status"] == "missing in generated" and b["rows_gen"] is None and b["cols_gen"] is None and b["rows_gold"] == 2
    assert found(spark, [], []) == {}
    assert found(spark, [], CELLS)["A"]["status"] == "missing in golden"


def test_cells_that_swap_columns_are_unlike(spark):
    """A digest that only summed values would not see it."""
    gen = [(s, r, {"c0": "c1", "c1": "c0"}.get(c, c) if (s, r) == ("A", "r2") else c, v, t) for s, r, c, v, t in CELLS]
    assert found(spark, CELLS, gen)["A"]["n_mismatch"] == 2


def test_each_side_is_read_once_for_rows_and_shapes(spark, tmp_path):
    for name in ("gold", "gen"):
        spark.createDataFrame(CELLS, SCHEMA).write.parquet(f"{tmp_path}/{name}")
    sides = [keyed(spark.read.schema(SCHEMA).parquet(f"{tmp_path}/{n}"), []) for n in ("gold", "gen")]
    plan = compared(*sides)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange") == 1 and "Join" not in plan
