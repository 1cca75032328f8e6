"""Weighted cells and series kept by phase, sample, model and period type."""

import pytest
from pyspark.sql import functions as F

from cadence import analog
from cadence.api import metric_cells, weighted_cells
from cadence.sources.solution import SolutionSource
from tests.conftest import SF_SMALL

RULES = [(1, "( 1 ) A", "Unit", "All", "Load", "monthly", False, None), (2, "( 2 ) B", "Unit", "All", "Load", "daily", True, None),
         (3, "( 3 ) C", "Unit", "All", "Load", "monthly", True, None)]


@pytest.fixture
def source(spark):
    """One object, three samples; values 10, 20 and (null, 60) in January, and one day more of the first."""
    fact = [(1, 1, 10.0, 0), (2, 1, 20.0, 0), (3, 1, None, 0), (3, 2, 60.0, 0), (1, 2, 30.0, 0)]
    names = "SeriesId, DataFileId, KeyId, ChildObjectName, ParentObjectName, ChildClassName, ParentClassName, ChildObjectCategoryName, ParentObjectCategoryName, PropertyName, UnitValue, BandId, TimesliceId, TimesliceName, PhaseId, PhaseName, SampleId, SampleName, ModelName, PeriodTypeId, PeriodTypeName".split(", ")
    series = [(i, 0, i, "U", "P", "Unit", "Parent", "c", "c", "Load", "MW", 1, 0, "All Periods", 4, " ST schedule", i, f"Sample {i}", "Base" if i < 3 else "Other", 0, "Interval") for i in (1, 2, 3)]
    period = [(p, f"2026-01-0{p} 00:00:00", t) for p in (1, 2) for t in (0, 1)]
    return SolutionSource(
        spark, spark.createDataFrame(fact, "SeriesId long, PeriodId int, Value double, dataFileId long"), spark.createDataFrame(series, names),
        spark.createDataFrame(period, "PeriodId int, StartDate string, PeriodTypeId int"))


def values(cells):
    return {(r["rule_ord"], r["day"] if "day" in cells.columns else None): r["value"] for r in cells.collect()}


def test_period_type_joins_each_period_once(spark, source):
    rs = analog.ruleset(spark, standard=[RULES[0]], ratings=[])
    assert values(metric_cells(source, rs)) == {(1, None): 240.0}  # two types of each period: twice
    assert values(metric_cells(source.filtered(period_type="interval "), rs)) == {(1, None): 120.0}
    assert source.filtered(period_type="none such").series().count() == 0


def test_series_filters(spark, source):
    rs = analog.ruleset(spark, standard=[RULES[0]], ratings=[])
    kept = lambda **f: values(metric_cells(source.filtered(period_type="Interval", **f), rs))
    assert kept(phase="st Schedule") == {(1, None): 120.0} and kept(phase="MT") == {}
    assert kept(sample="sample 1") == {(1, None): 40.0} and kept(sample=["Sample 1", " SAMPLE 3"]) == {(1, None): 100.0}
    assert kept(model="base") == {(1, None): 60.0} and kept(model="base", sample="Sample 3") == {}


def test_weights_merge_with_partials(spark, source):
    src = source.filtered(period_type="Interval")
    table = spark.createDataFrame([(4, 1, 0.5), (4, 3, 2.0), (9, 2, 7.0)], "PhaseId int, SampleId int, Value double")
    weights = src.sample_weights(table)
    assert {(r["series_id"], r["weight"]) for r in weights.collect()} == {(1, 0.5), (3, 2.0)}
    rs = analog.ruleset(spark, standard=[RULES[0], RULES[2]], ratings=[])
    got = values(weighted_cells(src, rs, weights))
    total, weight = 0.5 * 40 + 20 + 2 * 60, 0.5 * 2 + 1 + 2  # the null has no weight
    assert got == {(1, None): total, (3, None): pytest.approx(total / weight)}
    day = values(weighted_cells(src, analog.ruleset(spark, standard=[RULES[2]], ratings=[]), weights, daily=True))
    assert day == {(3, 1): pytest.approx((0.5 * 10 + 20) / 1.5), (3, 2): pytest.approx((0.5 * 30 + 2 * 60) / 2.5)}
    one = src.series().select("series_id", "datafile_id", F.lit(1.0).alias("weight"))
    assert values(weighted_cells(src, rs, one)) == values(metric_cells(src, rs))


def test_weights_meet_partials_not_facts(spark):
    from cadence.operators.cells import rule_cells
    from cadence.sources.rules import prepare

    src = analog.sampled_solution(spark, SF_SMALL)
    p = prepare(analog.ruleset(spark, standard=[(1, "( 1 ) A", "Supplier", "All", "Quantity", "monthly", False, None)], ratings=[]))
    cells = rule_cells(src, p.sel, props=p.properties(), kinds=p.kinds(), weights=src.sample_weights(analog.sample_weights(spark)))
    plan = cells._jdf.queryExecution().optimizedPlan().toString().split("\n")
    weight = next(i for i, line in enumerate(plan) if "weight#" in line)
    assert any("Aggregate" in line and "sum(Value" in line or "sum(value" in line for line in plan[weight:])
