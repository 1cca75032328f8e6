"""Plans that must hold at scale give the same cells however they run, and the
solution layout is read from a hive-partitioned Parquet folder."""

import uuid

import pytest
from pyspark.sql import functions as F

from cadence import analog
from cadence.api import monthly_block
from cadence.operators.cells import rule_cells
from cadence.plans.reports import read_report, timeslice_report, write_report
from cadence.session import checkpoint_dir
from cadence.sources.rules import RULE_FILES, STD_COLUMNS, load_rules, prepare
from cadence.sources.solution import open_solution
from cadence.sources.star import lineitem_source
from tests import fixture as fx
from tests.conftest import SF_SMALL


THRESHOLDS = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]


def _rows(df):
    return sorted(tuple(r) for r in df.select("rule_ord", "row_kind", "object", "timeslice", "col_label",
                                               F.round("value", 6).alias("v")).collect())


@pytest.fixture
def no_broadcast(spark):
    """Joins by shuffle from here on, as for tables of any size."""
    def go():
        for k in THRESHOLDS:
            spark.conf.set(k, "-1")
    yield go
    for k in THRESHOLDS:
        spark.conf.unset(k)


def test_cells_do_not_depend_on_broadcasts(spark, no_broadcast):
    src = lineitem_source(spark, SF_SMALL)
    rs = analog.ruleset(spark, standard=analog.rules_by_ord([1, 2, 6]), ratings=[])
    broadcast = _rows(monthly_block(src, rs))
    no_broadcast()
    shuffled = monthly_block(src, rs)
    assert _rows(shuffled) == broadcast


def test_ratings_do_not_depend_on_broadcasts(spark, no_broadcast):
    src = lineitem_source(spark, SF_SMALL)
    rs = analog.ruleset(spark, standard=[])
    a = _rows(monthly_block(src, rs, which="ratings", with_total_row=False))
    no_broadcast()
    b = _rows(monthly_block(src, rs, which="ratings", with_total_row=False))
    assert a == b


def test_open_solution_from_parquet_layout(spark):
    base = f"{checkpoint_dir(spark)}/solution-{uuid.uuid4().hex}"
    mem = fx.solution(spark)
    mem._fact.write.partitionBy("dataFileId").parquet(f"{base}/data")
    mem._fki.write.parquet(f"{base}/fullkeyinfo")
    mem._period.write.parquet(f"{base}/period")
    src = open_solution(spark, base)
    assert dict(src._fact.dtypes)["dataFileId"] == "bigint"
    rule = (1, "( 1 ) Summary", "Generator", "All", "Generation", "monthly", False, None)
    rs = fx.ruleset(spark, [rule])
    p = prepare(rs)
    plan = rule_cells(src, p.sel, props=p.properties(), expand=False, kinds=p.kinds())._jdf.queryExecution()
    assert "dynamicpruning" in plan.optimizedPlan().toString()
    # the fact is aggregated below the join with the rules: two aggregates above its scan
    assert plan.optimizedPlan().toString().count("Aggregate [") >= 3
    g = monthly_block(src, rs)
    got = {}
    for r in g.collect():
        label = "Total" if r["row_kind"] == "total" else r["object"]
        got.setdefault(label, {})[r["col_label"]] = r["value"]
    assert {k: [round(v[c], 4) for c in fx.COLS] for k, v in got.items()} == fx.EXPECTED_SUM


def test_text_in_many_files_comes_back_whole(spark):
    cells = timeslice_report(lineitem_source(spark, SF_SMALL), analog.ruleset(spark, standard=[])).cache()
    out = f"{checkpoint_dir(spark)}/text-{uuid.uuid4().hex}"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_report(cells, out, "R")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    value = F.round("value", 4).alias("value")
    key = ["section", "row_label", "col_label"]
    back, mine = read_report(spark, f"{out}/R", text=True).select(*key, value), cells.select(*key, value)
    assert mine.exceptAll(back).isEmpty() and back.exceptAll(mine).isEmpty()
    assert spark.read.text(f"{out}/R_text").select("_metadata.file_path").distinct().count() > 1


def test_a_piece_of_a_report_is_an_error(spark):
    out = f"{checkpoint_dir(spark)}/piece-{uuid.uuid4().hex}"
    spark.createDataFrame([("Gen A,1,2",), ("Gen B,3,4",)], "line string").coalesce(1).write.text(f"{out}/R_text")
    with pytest.raises(Exception, match="before the first section title"):
        read_report(spark, f"{out}/R", text=True).collect()


def test_rule_tables_left_out_are_named(spark):
    out = f"{checkpoint_dir(spark)}/rules-{uuid.uuid4().hex}"
    with pytest.raises(FileNotFoundError, match="neither"):
        load_rules(spark, out)
    header = ",".join(STD_COLUMNS)
    spark.createDataFrame([(header,)], "line string").coalesce(1).write.text(f"{out}/{RULE_FILES['standard']}")
    with pytest.raises(FileNotFoundError, match=RULE_FILES["groups"]):
        load_rules(spark, out)


def test_measures_are_aggregated_side_by_side(spark):
    """A star's fact rows are not copied for each measure ahead of the aggregate."""
    from cadence.operators.cells import rule_cells
    from cadence.sources.rules import prepare
    from cadence.sources.star import lineitem_source

    p = prepare(analog.ruleset(spark, ratings=[]))
    cells = rule_cells(lineitem_source(spark, SF_SMALL), p.sel, daily=None, props=p.properties(), expand=p.needs_timeslices(), kinds=p.kinds())
    plan = cells._jdf.queryExecution().optimizedPlan().toString().split("\n")
    fact = next(i for i, line in enumerate(plan) if "l_suppkey" in line and "Relation" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above, at = [], depth(plan[fact])
    for line in reversed(plan[:fact]):  # the operators between the scan and the plan's top
        if depth(line) < at:
            above.append(line.lstrip(" :+-").split(" ")[0])
            at = depth(line)
    first = above.index("Aggregate")
    assert "Generate" in above[first:] and not {"Expand", "Generate"} & set(above[:first])
    assert plan[fact].count("l_quantity") == 1
