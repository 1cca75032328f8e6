"""A report with daily rules: the fact's partials are dealt by object once, its values are kept as lists
(never a shuffled row a rule and month), and shuffle files go when a cut is whole."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from cadence import analog
from cadence.api import calendar_of, daily_block, monthly_block
from cadence.operators.blocks import packed_values
from cadence.plans.reports import standard_report
from cadence.plans.sizing import ALL_KEYS, FREE_SHUFFLES, cut
from cadence.sources.rules import prepare
from cadence.sources.star import LINEITEM_MEASURES, StarSource, StarSpec, lineitem_source
from tests.conftest import SF_SMALL

NAN = float("nan")
#: supplier, band, date, quantity, discount, price, tax
ROWS = [(1, 1, dt.date(2026, 1, 5), 2.0, 0.1, 10.0, 0.5), (1, 1, dt.date(2026, 1, 5), 3.0, 0.3, 20.0, 0.25), (1, 2, dt.date(2026, 2, 7), 4.0, 0.0, 5.0, 0.0),
        (2, 1, dt.date(2026, 1, 5), 7.0, 0.5, 1.0, None), (2, 3, dt.date(2027, 1, 31), NAN, 0.2, 2.0, 1.0), (3, 1, dt.date(2027, 1, 31), 5.0, NAN, 3.0, 2.0),
        (4, 1, dt.date(2026, 1, 6), 11.0, 0.7, 4.0, 3.0), (5, 2, None, 13.0, 0.9, 6.0, 4.0), (6, 2, dt.date(2026, 1, 5), 17.0, 0.4, 7.0, 5.0), (None, 1, dt.date(2026, 1, 1), 1.0, 1.0, 1.0, 1.0)]
#: supplier, name, nation, region: 3 and 4 share a name, 1 and 2 are renamed to one, 6 has two names, 7 no rows
SUPPLIERS = [(1, "Supplier#000000001", "NATION_1", "EUROPE"), (2, "Supplier#000000002", "NATION_2", "ASIA"), (3, "Twin", "NATION_1", "EUROPE"), (4, "Twin", "NATION_2", "AMERICA"),
             (5, "Undated", "NATION_1", "ASIA"), (6, "First", "NATION_1", "ASIA"), (6, "Twin", "NATION_2", "EUROPE"), (7, "Idle", "NATION_1", "ASIA"), (8, None, "NATION_1", "ASIA")]


@pytest.fixture(scope="module")
def src(spark):
    fact = spark.createDataFrame(ROWS, "k long, band int, at date, l_quantity double, l_discount double, l_extendedprice double, l_tax double")
    dim = spark.createDataFrame(SUPPLIERS, "k long, name string, nation string, region string")
    attrs = {"child_name": F.col("name"), "parent_name": F.col("nation"), "child_class": F.lit("Supplier"), "parent_class": F.lit("Nation"),
             "child_category": F.col("region"), "parent_category": F.col("region")}
    return StarSource(spark, StarSpec(fact, "k", dim, "k", LINEITEM_MEASURES, "at", attrs, band=F.col("band")))


@pytest.fixture(params=["broadcast", "shuffled"])
def joins(spark, request):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    if request.param == "shuffled":
        for k in keys:
            spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def _cells(df, *names):
    return sorted(tuple("" if x is None else str(x) for x in r) for r in df.select(*names, F.round("value", 6).alias("value")).collect())


def test_monthly_rows_of_a_mixed_report_are_those_of_monthly_rules(spark, src, joins):
    """Same cells whether the rules share a scan with a daily rule (lists) or not (cells)."""
    report = standard_report(src, analog.ruleset(spark, ratings=[]))
    got = report.where("rule_ord IN (1, 2, 6) AND value IS NOT NULL")
    want = monthly_block(src, analog.ruleset(spark, standard=analog.rules_by_ord([1, 2, 6]))).withColumnsRenamed({"parent": "s_parent", "object": "s_obj"})
    names = ["rule_ord", "row_kind", "s_parent", "s_obj", "col_label"]
    assert _cells(got, *names) == _cells(want, *names) != []


def test_daily_rows_are_whole(spark, src, joins):
    """Values of one object are summed over its series and source names, NaN in a cell reads 0, and
    every object has every band of the rule for 31 days. Undated values only keep their object."""
    rs = analog.ruleset(spark, standard=analog.rules_by_ord([7]))
    want = {("S-ONE", 1, 5, "Jan-2026"): 12.0, ("S-ONE", 2, 7, "Feb-2026"): 4.0, ("Twin", 1, 31, "Jan-2027"): 5.0, ("Twin", 1, 6, "Jan-2026"): 11.0,
            ("Twin", 2, 5, "Jan-2026"): 17.0, ("First", 2, 5, "Jan-2026"): 17.0}
    block = daily_block(src, rs)
    got = {(r["object"], r["band"], r["day"], r["col_label"]): r["value"] for r in block.where("col_kind = 'month' AND value <> 0").collect()}
    assert got == want
    rows = block.where("col_label = 'Total'").select("object", "band", "day").collect()
    assert sorted(map(tuple, rows)) == sorted((o, b, d) for o in ("S-ONE", "Twin", "First", "Undated") for b in (1, 2, 3) for d in range(1, 32))
    ids = {(r["band"], r["day"], r["row_idx"]) for r in block.select("band", "day", "row_idx").distinct().collect()}
    assert ids == {(b, d, (b - 1) * 31 + d - 1) for b in (1, 2, 3) for d in range(1, 32)}
    report = standard_report(src, analog.ruleset(spark, ratings=[])).where("rule_ord = 7 AND row_kind = 'data'")
    assert {(r["s_group"], r["s_band"], r["s_day"], r["col_label"]): r["value"] for r in report.where("value <> 0 AND col_label LIKE '%-202%' AND col_label NOT LIKE 'Tot%'").collect()} == want


def test_stacked_rows_are_lookups(spark, src):
    """Components of an object are looked up in its maps: absent ones read 0, the row is their sum."""
    st = standard_report(src, analog.ruleset(spark, standard=analog.rules_by_ord([5]), ratings=[]))
    plan = st._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Join" in line and "col_ord" in line]
    n, objects = len(calendar_of(src).months), {"S-ONE", "Twin", "First", "Undated"}
    got = {(r["s_group"], r["row_kind"], r["s_comp"], r["col_label"]): r["value"] for r in st.where("value IS NOT NULL").collect()}
    assert len(got) == st.where("value IS NOT NULL").count() == len(objects) * n * 5
    assert {k: v for k, v in got.items() if v} == {
        ("S-ONE", "component", 0, "Jan-2026"): 12.0, ("S-ONE", "component", 0, "Feb-2026"): 4.0, ("S-ONE", "component", 2, "Jan-2026"): 0.75, ("S-ONE", "data", None, "Jan-2026"): 12.75,
        ("S-ONE", "data", None, "Feb-2026"): 4.0, ("Twin", "component", 0, "Jan-2027"): 5.0, ("Twin", "component", 0, "Jan-2026"): 28.0, ("Twin", "component", 2, "Jan-2027"): 2.0,
        ("Twin", "component", 2, "Jan-2026"): 5.0, ("Twin", "data", None, "Jan-2027"): 7.0, ("Twin", "data", None, "Jan-2026"): 33.0, ("First", "component", 0, "Jan-2026"): 17.0, ("First", "data", None, "Jan-2026"): 17.0}


def test_partials_are_shuffled_once_more_whatever_the_rules(spark):
    """Above the exchange that deals the partials by place nothing is shuffled, also where no side of a join is broadcast."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", ALL_KEYS: "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        p = prepare(analog.ruleset(spark, ratings=[]))
        plan = packed_values(lineitem_source(spark, SF_SMALL), p, None)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    exchanges = [line for line in plan.split("\n") if "Exchange " in line]
    assert plan.count("lineitem.parquet") == 1 and "REPARTITION_BY_COL" in exchanges[0]
    assert "ENSURE_REQUIREMENTS" not in plan[: plan.index("REPARTITION_BY_COL")]


def test_a_cut_leaves_no_shuffle_files(spark, src):
    def files():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {x.split("/")[-1] for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}

    before, setting = files(), spark.conf.get(FREE_SHUFFLES, None)
    kept = cut(src.observations().groupBy("series_id").count(), free=True)
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert files() - before == set() and kept.count() == 7 and spark.conf.get(FREE_SHUFFLES, None) == setting
