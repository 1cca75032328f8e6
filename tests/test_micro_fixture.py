"""Flat, rate, category and daily blocks on the FIXTURES §4 micro-solution,
read through the solution-layout source."""

import pytest

from pyspark.sql import functions as F

from cadence import schemas
from cadence.api import daily_block, metric_cells, monthly_block, no_data_rules, report_findings
from cadence.sources.rules import rows_frame
from cadence.sources.solution import SolutionSource
from tests import fixture as fx


def grid_table(df, rule_ord=1):
    rows = df.where(f"rule_ord = {rule_ord}").collect()
    out = {}
    for r in rows:
        label = "Total" if r["row_kind"] == "total" else r["object"]
        out.setdefault(label, {})[r["col_label"]] = r["value"]
    return {k: [round(v[c], 4) for c in fx.COLS] for k, v in out.items()}


def rule(ro=1, group="All", rate=False, pattern="monthly", unit=None, cls="Generator"):
    return (ro, "( 1 ) Summary", cls, group, "Generation", pattern, rate, unit)


def test_flat_sum(spark):
    src = fx.solution(spark)
    g = monthly_block(src, fx.ruleset(spark, [rule()]))
    assert grid_table(g) == fx.EXPECTED_SUM


def test_flat_rate(spark):
    src = fx.solution(spark)
    g = monthly_block(src, fx.ruleset(spark, [rule(rate=True)]))
    assert grid_table(g) == fx.EXPECTED_RATE


def test_category_filter_is_case_and_space_insensitive(spark):
    src = fx.solution(spark)
    g = monthly_block(src, fx.ruleset(spark, [rule(group="Thermal")]))
    assert grid_table(g) == fx.EXPECTED_THERMAL


def test_all_rules_in_one_plan_equal_rule_at_a_time(spark):
    src = fx.solution(spark)
    rs = fx.ruleset(spark, [rule(1), rule(2, rate=True), rule(3, group="Thermal")])
    together = monthly_block(src, rs)
    assert grid_table(together, 1) == fx.EXPECTED_SUM
    assert grid_table(together, 2) == fx.EXPECTED_RATE
    assert grid_table(together, 3) == fx.EXPECTED_THERMAL


def test_name_fallback_and_nan_cell(spark):
    src = fx.solution(spark)
    cells = metric_cells(src, fx.ruleset(spark, [rule()])).collect()
    r1 = {(r["object"], str(r["month_start"])): r["value"] for r in cells if r["object"] == "R1"}
    assert r1 == {("R1", "2026-01-01"): 0.0, ("R1", "2026-02-01"): 7.0}


def test_timeslice_filter(spark):
    src = fx.solution(spark)
    g = monthly_block(src, fx.ruleset(spark, [rule()]))
    # series 5 (Peak, value 100) never reaches an 'All Periods' rule
    assert g.where("value >= 100").count() == 0


def test_daily_crosses_bands_over_objects(spark):
    src = fx.solution(spark)
    g = daily_block(src, fx.ruleset(spark, [rule(pattern="daily")]))
    rows = g.select("object", "band", "day").distinct().count()
    assert rows == 3 * 2 * 31
    jan5 = {r["object"]: r["value"] for r in
            g.where("col_label = 'Jan-2026' AND day = 5 AND band = 1").collect()}
    assert jan5 == {"G1": 1.0, "G2": 0.0, "R1": 0.0}


def test_units_and_names(spark):
    src = fx.solution(spark)
    rs = fx.ruleset(spark, [rule(unit="MWh")], units=[("gwh", "mwh", 1000.0)],
                    names=[(1, "G1", "Gen"), (2, "G2", "Gen")])
    t = grid_table(monthly_block(src, rs))
    assert t["Gen"] == [6000.0, 14000.0, 20000.0, 5000.0, 5000.0, 25000.0]
    assert t["Total"] == [6000.0, 21000.0, 27000.0, 5000.0, 5000.0, 32000.0]


@pytest.mark.parametrize("rate", [False, True])
def test_total_column_consistency(spark, rate):
    src = fx.solution(spark)
    t = grid_table(monthly_block(src, fx.ruleset(spark, [rule(rate=rate)])))
    for label, (jan26, feb26, tot26, jan27, tot27, total) in t.items():
        if not rate:
            assert tot26 == pytest.approx(jan26 + feb26)
            assert total == pytest.approx(tot26 + tot27)


def changed(spark, series=None, period=None):
    """The micro-solution with its series or period table changed."""
    src = fx.solution(spark)
    return SolutionSource(spark, src._fact, series(src._fki) if series else src._fki, period(src._period) if period else src._period)


@pytest.mark.parametrize("rate", [False, True])
def test_undated_rows_are_in_no_total(spark, rate):
    undated = changed(spark, period=lambda p: p.withColumn("StartDate", F.when(F.col("PeriodId") != 3, F.col("StartDate"))))
    t = grid_table_of(monthly_block(undated, fx.ruleset(spark, [rule(rate=rate)])))
    assert t["G1"]["Total"] == (4.5 if rate else 11) and t["R1"]["Total"] == 0


def grid_table_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["object"] or "Total", {})[r["col_label"]] = r["value"]
    return out


def test_a_timeslice_is_one_however_it_is_spelled(spark):
    spelled = changed(spark, series=lambda s: s.withColumn("TimesliceName", F.when(F.col("SeriesId") == 2, "all periods ").otherwise(F.col("TimesliceName")))
                      .withColumn("TimesliceId", F.when(F.col("SeriesId") == 4, 9).otherwise(F.col("TimesliceId"))))
    rs = fx.ruleset(spark, [rule()])
    g = monthly_block(spelled, rs)
    assert g.count() == 4 * len(fx.COLS) and grid_table(g) == fx.EXPECTED_SUM
    rs.ratings = rows_frame(spark, [(1, "Generator", "All", "Generation", None, None)], schemas.BLUEPRINT_RAT)
    r = monthly_block(spelled, rs, which="ratings", with_total_row=False).where("col_label = 'Total'")
    got = {(x["timeslice_id"], x["timeslice"], x["object"]): x["value"] for x in r.collect()}
    assert {k[:2] for k in got} == {(0, "All Periods"), (1, "Peak")} or {k[:2] for k in got} == {(0, "all periods"), (1, "Peak")}
    assert sorted(v for (i, _, _), v in got.items() if i == 0) == [4, 7, 21] and len(got) == 4


def test_findings_of_periods_units_and_rules(spark):
    odd = changed(spark, series=lambda s: s.withColumn("UnitValue", F.when(F.col("SeriesId") == 2, "TWh").otherwise(F.col("UnitValue"))),
                  period=lambda p: p.unionByName(p.where("PeriodId = 3")))
    rs = fx.ruleset(spark, [rule(1), rule(2, unit="crates"), rule(3, cls="Fuel")], units=[("gwh", "mwh", 1000.0)])
    got = [tuple(r) for r in report_findings(odd, rs).collect()]
    assert got == [("source", "period repeats", None, "3", 2), ("source", "several units", None, "generation", 2),
                   ("standard", "no data", 3, "Generation", None), ("standard", "no unit rule", 2, "GWh to crates", None)]
    assert [r["rule_ord"] for r in no_data_rules(fx.solution(spark), rs).collect()] == [3]


def test_band_merge_by_mean(spark):
    g = monthly_block(fx.solution(spark), fx.ruleset(spark, [rule(rate=True)]), band_merge="mean")
    assert grid_table(g)["G1"][0] == 2.0  # bands of 2 and 2 average to 2, and sum to 4
    with pytest.raises(ValueError):
        monthly_block(fx.solution(spark), fx.ruleset(spark, [rule()]), band_merge="median")


def test_emission_sub_header(spark):
    from cadence.functions.text import nested_subheader

    df = spark.createDataFrame([("Emission", "CO2"), ("Region", "R1")], "cls string, parent string")
    first, second = (r[0] for r in df.select(nested_subheader("parent", "cls")).collect())
    assert (first, second) == ("Total Effluents (lb) -- CO2", "R1")
