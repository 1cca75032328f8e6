"""Report rounding of ordinary, huge and non-finite numbers, in Spark and in the oracle's SQL."""

import math

import duckdb

from cadence.functions.numeric import round4, round4_sql


def test_round4(spark):
    want = {0.22725: 0.2273, 1.00005: 1.0001, -2.00015: -2.0002, 1e12 + 0.25: 1e12 + 0.25, 1e13: 1e13, 1e30: 1e30, -1e300: -1e300,
            float("inf"): float("inf"), float("-inf"): float("-inf"), 0.0: 0.0, 12345.67891: 12345.6789}
    df = spark.createDataFrame([(k,) for k in want] + [(None,), (float("nan"),)], "v double")
    rows = [(r["v"], r["r"]) for r in df.select("v", round4("v").alias("r")).collect()]
    values = ", ".join(f"('{k!r}'::DOUBLE)" for k in want)
    rows += duckdb.sql(f"SELECT v, {round4_sql('v')} FROM (VALUES {values}) t(v)").fetchall()
    for v, r in rows:
        if v is None or math.isnan(v):
            assert r is None or math.isnan(r)
        else:
            assert r == want[v], v
