"""Report layout, text lines, golden-file parsing, report diff and plan shape,
on the test star at sf0.001."""

import uuid

import pytest
from pyspark.sql import functions as F

from cadence import analog
from cadence.operators.diff import diff_sections, keyed, verdict
from cadence.plans.layout import ordered_lines, report_lines
from cadence.plans.reports import standard_report, timeslice_report
from cadence.session import checkpoint_dir
from cadence.sources.report_text import read_report_cells
from cadence.sources.star import lineitem_source
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def src(spark):
    return lineitem_source(spark, SF_SMALL)


@pytest.fixture(scope="module")
def ratings(spark, src):
    return timeslice_report(src, analog.ruleset(spark, standard=[])).cache()


@pytest.fixture(scope="module")
def standard(spark, src):
    return standard_report(src, analog.ruleset(spark, ratings=[])).cache()


def test_sections_in_first_seen_order(standard):
    secs = [r[0] for r in standard.select("section", "section_ord").distinct().orderBy("section_ord").collect()]
    assert secs == ["( 1 ) Supply Summary", "( 2 ) Regional Totals", analog.FUEL, "( 4 ) Nation Detail",
                    "( 5 ) Daily Quantity"]


def test_total_row_is_sum_of_rows(standard):
    flat = standard.where("rule_ord = 1 AND col_label = 'Total'")
    rows = flat.where("row_kind = 'data'").agg(F.sum("value")).first()[0]
    tot = flat.where("row_kind = 'total'").first()["value"]
    assert tot == pytest.approx(rows)


def test_nested_titles_use_mapped_parent(standard):
    titles = {r[0] for r in standard.where("row_kind = 'title' AND rule_ord = 6").select("row_label").collect()}
    assert titles and "NATION_3" not in titles
    assert all(t == "Nation Three" or t.startswith("NATION_") for t in titles)


def test_stacked_rows_per_object(standard):
    st = standard.where(f"section = '{analog.FUEL}' AND row_kind = 'component'")
    labels = [r[0] for r in st.select("row_label").distinct().orderBy("row_label").collect()]
    assert sorted(labels) == sorted(c[0] for c in analog.COMPONENTS)
    zero = st.where("row_label LIKE '%Secondary%' AND value != 0").count()
    assert zero == 0


def test_report_lines_layout(ratings):
    lines = [r[0] for r in ordered_lines(report_lines(ratings)).select("line").collect()]
    assert lines[0] == "All Periods"
    assert lines[1].startswith(",Jan-1995,")
    assert lines[1].endswith(",Total")
    assert "" in lines
    body = lines[2]
    assert ":qty," in body


def test_text_roundtrip(spark, ratings):
    out = f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}"
    ordered_lines(report_lines(ratings)).select("line").coalesce(1).write.text(out)
    back = read_report_cells(spark, out).select("section", "row_label", "col_label", "value")
    mine = ratings.select("section", "row_label", "col_label", F.round("value", 4).alias("value"))
    assert back.count() == mine.count()
    assert back.exceptAll(mine).count() == 0


def _k(cells):
    return keyed(cells.withColumn("value", F.round("value", 4)), ["rule_ord", "s_obj"])


def test_diff_pass_on_copy(ratings):
    f = diff_sections(_k(ratings), _k(ratings))
    assert verdict(f).first()["passed"]


def test_diff_catches_changed_cell_missing_section_extra_row(spark, ratings):
    changed = ratings.withColumn("value", F.when(
        (F.col("section") == "A") & (F.col("col_label") == "Total") & (F.col("rule_ord") == 1),
        F.col("value") + 1).otherwise(F.col("value")))
    f = {r["section"]: r["status"] for r in diff_sections(_k(ratings), _k(changed)).collect()}
    assert f["A"] == "data mismatch" and f["N"] == "ok"

    missing = ratings.where("section != 'R'")
    f = {r["section"]: r["status"] for r in diff_sections(_k(ratings), _k(missing)).collect()}
    assert f["R"] == "missing in generated"

    extra_row = ratings.unionByName(ratings.where("section = 'N' AND rule_ord = 1").limit(3)
                                    .withColumn("row_label", F.lit("Extra")))
    f = {r["section"]: r["status"] for r in diff_sections(_k(ratings), _k(extra_row)).collect()}
    assert f["N"] == "shape mismatch"


def test_tolerance_is_relative_to_generated(spark):
    from cadence.operators.diff import close

    df = spark.createDataFrame([(1000000.0, 1000005.0), (0.0, 2e-5)], "a double, b double")
    res = [r[0] for r in df.select(close(F.col("a"), F.col("b"))).collect()]
    assert res == [True, False]


def test_fact_scanned_once_for_all_rules(spark, src):
    """All monthly rules in one plan: the fact table appears once."""
    from cadence.operators.blocks import monthly_values
    from cadence.sources.rules import prepare

    p = prepare(analog.ruleset(spark, ratings=[])).only({"flat", "nested", "stacked"})
    plan = monthly_values(src, p, p.names, p.units)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    assert "BroadcastHashJoin" in plan


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert set(df.columns) == {"rule_ord", "row_kind", "object", "col_label", "value"}
    assert df.count() > 0
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert set(E._registry()) <= set(sqls)


def test_standard_report_one_fact_scan_for_monthly_and_daily(spark, src):
    from cadence.operators.cells import rule_cells
    from cadence.sources.rules import prepare

    p = prepare(analog.ruleset(spark, ratings=[]))
    assert "daily" in p.kinds() and "flat" in p.kinds()
    cells = rule_cells(src, p.sel, daily=None, props=p.properties(), expand=p.needs_timeslices(), kinds=p.kinds())
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    days = {r[0] for r in cells.select((F.col("day").isNull()).alias("m")).distinct().collect()}
    assert days == {True, False}
