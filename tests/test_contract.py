"""Row-level contract of a solution's tables."""

import datetime
import uuid

from cadence import analog, schemas
from cadence.plans.contract import Contract, check_rows, check_solution, check_tables
from cadence.session import checkpoint_dir
from tests.conftest import SF_SMALL


def bad(findings) -> dict:
    return {(r["column"], r["rule"]): r["n_bad"] for r in findings.collect() if r["n_bad"]}


def test_every_violation_is_counted(spark):
    rows = [(1, "7", 1.0, "a"), (1, "x", 2.5, None), (2, "", None, "b"), (2, None, 4.0, "B"), (None, "9", 3e10, "a"), (None, "8", -1.0, "a")]
    df = spark.createDataFrame(rows, "k long, t string, d double, `a.b` string")
    c = Contract("k BIGINT, t INT, d INT, `a.b` STRING, gone DOUBLE", ("k",), ("k", "a.b"), {"a.b": "`a.b` = lower(`a.b`)", "d": "d > 0"})
    got = check_rows(df, "r", c)
    assert bad(got) == {("k", "null"): 2, ("t", "type"): 2, ("d", "type"): 2, ("d", "domain"): 1, ("a.b", "null"): 1, ("a.b", "domain"): 1, ("gone", "present"): 1, ("k", "key"): 3}
    assert {r["n_rows"] for r in got.collect()} == {6}
    assert bad(check_rows(df.limit(0), "r", c)) == {("gone", "present"): 1}


def test_other_types_are_misfits(spark):
    df = spark.createDataFrame([([1], "2024-01-01 00:00:00", datetime.date(2024, 1, 1)), (None, "no date", None)], "a array<int>, s string, d date")
    assert bad(check_rows(df, "r", Contract("a INT, s TIMESTAMP, d TIMESTAMP"))) == {("a", "type"): 1, ("s", "type"): 1}


def test_one_scan_and_no_join(spark):
    src = analog.solution(spark, SF_SMALL)
    df = src._fact
    plan = check_rows(df, "data", Contract(schemas.SOLUTION_TABLES["data"], ("SeriesId", "PeriodId")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_all_tables_of_a_solution(spark):
    assert len(schemas.SOLUTION_TABLES) == 20
    src = analog.solution(spark, SF_SMALL)
    base = f"{checkpoint_dir(spark)}/solution-{uuid.uuid4().hex}"
    src._fact.write.partitionBy("dataFileId").parquet(f"{base}/data")
    src._fki.write.parquet(f"{base}/fullkeyinfo")
    src._period.write.parquet(f"{base}/period")
    rows = check_solution(spark, base).collect()
    assert {r["relation"] for r in rows if r["column"] is None} == set(schemas.SOLUTION_TABLES) - {"data", "fullkeyinfo", "period"}
    found = {(r["relation"], r["column"], r["rule"]): r["n_bad"] for r in rows}
    n = src._fact.count()
    assert found["data", "dataFileId+SeriesId+PeriodId", "key"] == n - src._fact.select("dataFileId", "SeriesId", "PeriodId").distinct().count()
    assert found["data", "EpochId", "present"] == 1 and found["data", "Value", "type"] == 0
    assert found["fullkeyinfo", "KeyId", "key"] == 0 and found["fullkeyinfo", "ModelName", "present"] == 1
    assert check_tables({}, spark).count() == 20
