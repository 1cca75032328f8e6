"""What keeps the reports in proportion to their input: bounded tasks, narrow shuffles, plain loops."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cadence import analog, session
from cadence.api import cells_of, daily_block
from cadence.functions.calendar import Calendar
from cadence.functions.numeric import round4
from cadence.operators.totals import CELLS, column_list, dense_cells, row_cells, total_row
from cadence.plans.layout import number_text
from cadence.session import FIRST_PARTS, JOINED_UP, PARTITION_BYTES, PARTS, SHUFFLE_PARTS, SPLIT_BYTES, SPLITS, configure, in_bytes
from cadence.sources.report_text import parse_sections
from cadence.sources.rules import prepare
from cadence.sources.star import lineitem_source, read_fact
from tests.conftest import SF_SMALL

CAL = Calendar(tuple((dt.date(y, m, 1), y, f"{m}-{y}") for y, m in ((2026, 1), (2026, 2), (2027, 1))))


def test_tasks_are_bounded(spark):
    """A larger input means more tasks, not larger ones; smaller splits and more partitions are kept."""
    configure(spark)
    assert in_bytes(spark.conf.get(SPLITS)) <= SPLIT_BYTES and in_bytes(spark.conf.get(JOINED_UP)) <= PARTITION_BYTES
    assert int(spark.conf.get(FIRST_PARTS)) >= SHUFFLE_PARTS
    mine = {SPLITS: "1m", JOINED_UP: "16k", FIRST_PARTS: "900"}
    before = {k: spark.conf.get(k) for k in mine}
    try:
        for k, v in mine.items():
            spark.conf.set(k, v)
        configure(spark)
        assert {k: spark.conf.get(k) for k in mine} == mine
        spark.conf.unset(FIRST_PARTS)
        many, parts = "950", spark.conf.get(PARTS)
        spark.conf.set(PARTS, many)
        configure(spark)
        assert spark.conf.get(FIRST_PARTS, None) is None
        spark.conf.set(PARTS, parts)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_shuffles_grow_with_the_fact(spark, tmp_path, monkeypatch):
    """More splits of the fact mean more partitions in its shuffles, which hold 4 MB at most when joined up."""
    path = str(tmp_path / "lineitem.parquet")
    spark.range(0, 600, 1, 6).write.parquet(path)
    before = {k: spark.conf.get(k, None) for k in (SPLITS, JOINED_UP, FIRST_PARTS)}
    try:
        spark.conf.unset(FIRST_PARTS)
        configure(spark)
        assert in_bytes(spark.conf.get(JOINED_UP)) <= 4 << 20
        small = int(spark.conf.get(FIRST_PARTS))
        monkeypatch.setattr(session, "PARTS_A_SPLIT", 1000)
        fact = read_fact(spark, str(tmp_path), "lineitem")
        splits = fact.rdd.getNumPartitions()
        assert fact.count() == 600 and int(spark.conf.get(FIRST_PARTS)) == max(small, 1000 * splits) > small
        spark.conf.set(FIRST_PARTS, "900000")  # a session that asks for more keeps it
        read_fact(spark, str(tmp_path), "lineitem")
        assert spark.conf.get(FIRST_PARTS) == "900000"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize(("text", "n"), [("64MB", 64 << 20), ("8m", 8 << 20), ("16k", 16 << 10), ("5", 5), ("7b", 7), ("134217728b", 1 << 27)])
def test_sizes_are_read_as_spark_writes_them(text, n):
    assert in_bytes(text) == n


def test_grids_are_completed_without_a_pivot(spark):
    """No wide row and no dense cell is shuffled: the columns are exploded over the finished rows."""
    plan = daily_block(lineitem_source(spark, SF_SMALL), analog.ruleset(spark, standard=analog.rules_by_ord([7])))._jdf.queryExecution().optimizedPlan().toString()
    assert "pivotfirst" not in plan and "Expand" not in plan
    ops = [line.lstrip(" :+-").split(" ")[0] for line in plan.split("\n")]
    assert "Generate" in ops[: ops.index("Aggregate")]


def test_partials_are_rolled_up_by_one_aggregate(spark):
    """A rule's timeslices and 'All Periods' come from one aggregate over the partials."""
    p = prepare(analog.ruleset(spark, standard=[]), "ratings")
    plan = cells_of(lineitem_source(spark, SF_SMALL), p)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "spark_grouping_id" not in plan


def test_rows_carry_their_totals(spark):
    """Months, Tot-Y and Total of a row; a mean skips zeros; an undated value only keeps its row."""
    rows = [(1, False, "a", dt.date(2026, 1, 1), 2.0), (1, False, "a", dt.date(2026, 2, 1), 0.0), (1, False, "a", dt.date(2027, 1, 1), 5.0),
            (2, True, "a", dt.date(2026, 1, 1), 2.0), (2, True, "a", dt.date(2026, 2, 1), 0.0), (2, True, "a", dt.date(2027, 1, 1), 5.0),
            (1, False, None, None, 9.0)]
    values = spark.createDataFrame(rows, "rule_ord int, rate boolean, object string, month_start date, value double")
    made = row_cells(values, ["rule_ord", "rate", "object"], CAL)
    got = {(r["rule_ord"], r["object"]): r[CELLS] for r in made.collect()}
    assert got == {(1, "a"): {202601: 2.0, 202613: 2.0, 202701: 5.0, 202713: 5.0, 999999: 7.0}, (1, None): {},
                   (2, "a"): {202601: 2.0, 202613: 2.0, 202701: 5.0, 202713: 5.0, 999999: 3.5}}
    dense = dense_cells(made, column_list(CAL))
    assert dense.count() == 3 * 6 and dense.where("object IS NULL").agg(F.sum("value")).first()[0] == 0.0
    assert {r["rule_ord"]: r[CELLS][999999] for r in total_row(made, ["rule_ord"]).collect()} == {1: 7.0, 2: 3.5}


def test_whole_numbers_round_and_print_as_before(spark):
    values = [0.0, -0.0, 1.0, -3.0, 1e13, 2.0**53, 1e300, 0.00005, 1.23456, -0.00004, 12345678.125, float("inf"), float("nan"), None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", round4("v").alias("r"), number_text("v").alias("t"))
    got = {r["i"]: (str(r["r"]), r["t"]) for r in rows.collect()}
    assert [got[i] for i in range(6)] == [("0.0", "0.0"), ("0.0", "0.0"), ("1.0", "1.0"), ("-3.0", "-3.0"), ("10000000000000.0", "10000000000000.0"), (str(2.0**53), "9007199254740992.0")]
    assert [got[i][0] for i in range(6, 14)] == ["1e+300", "0.0001", "1.2346", "0.0", "12345678.125", "inf", "nan", "None"]


def test_quoted_and_plain_lines_parse_alike(spark):
    lines = ["( 1 ) A", ',Jan,"F,eb"', "x,1.5,", '"y,""z""",2.0,t', "p,,3.0"]
    frame = spark.createDataFrame([("f", i, v) for i, v in enumerate(lines)], "file string, pos long, line string")
    got = [tuple(r) for r in parse_sections(frame).select("row_label", "col_label", "value", "text").orderBy("row_no", "col_pos").collect()]
    assert got == [("x", "Jan", 1.5, None), ("x", "F,eb", None, None), ('y,"z"', "Jan", 2.0, None), ('y,"z"', "F,eb", None, "t"), ("p", "Jan", None, None), ("p", "F,eb", 3.0, None)]
