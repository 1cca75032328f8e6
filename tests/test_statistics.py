"""Statistics of series against numpy."""

import numpy as np
from pyspark.sql import functions as F

from cadence.operators.ordering import cumulated
from cadence.operators.statistics import series_statistics


def test_statistics_against_numpy(spark):
    rng = np.random.default_rng(5)
    rows = []
    for s, n in ((1, 400), (2, 1), (3, 2), (4, 7), (None, 5)):
        rows += [(s, i, float(x)) for i, x in enumerate(rng.integers(-6, 7, n) / 4)]
    rows += [(9, i, 2.5) for i in range(3000)] + [(9, -1, 1.0), (9, 5, float("nan")), (5, 1, None), (5, 2, float("nan")), (6, 1, None), (6, 2, 1e6)]
    df = spark.createDataFrame(rows, "s long, p int, v double")
    out = series_statistics(df.repartition(5), ["s"], "v", "p")
    got = {r["s"]: r for r in out.collect()}
    assert set(got) == {r[0] for r in rows}
    for s, r in got.items():
        v = np.array([x for k, _, x in rows if k == s and x is not None and x == x])
        assert r["ValueCount"] == len(v)
        if not len(v):
            assert all(r[c] is None for c in ("Sum", "Min", "Max", "Median", "Mode", "StandardDeviation", "FirstQuartile"))
            continue
        values, n = np.unique(v, return_counts=True)
        want = [v.sum(), v.min(), v.max(), v.std(), values[n.argmax()], *np.quantile(v, [0.5, 0.25, 0.75])]
        have = [r[c] for c in ("Sum", "Min", "Max", "StandardDeviation", "Mode", "Median", "FirstQuartile", "ThirdQuartile")]
        assert np.allclose(have, want)
    assert series_statistics(df.limit(0), ["s"], "v", "p").count() == 0


def test_hash_depends_on_rows_not_on_their_order(spark):
    df = spark.createDataFrame([(1, p, float(p % 3)) for p in range(50)], "s long, p int, v double")
    code = lambda d: series_statistics(d, ["s"], "v", "p").first()["SeriesHash"]
    assert code(df) == code(df.orderBy(F.rand(3)).repartition(7))
    assert code(df) != code(df.withColumn("v", F.when(F.col("p") == 7, 9.0).otherwise(F.col("v"))))
    assert code(df) != code(df.union(df.limit(1)))


def test_running_sums_span_partitions(spark):
    df = spark.range(3000).select(F.col("id").alias("x"), (F.col("id") % 5).alias("w"))
    rows = cumulated(df.repartition(6), [F.col("x")], "w", "ahead", 4).orderBy("x").collect()
    assert [r["ahead"] for r in rows] == [sum(i % 5 for i in range(5)) * (x // 5) + sum(range(x % 5)) for x in range(3000)]
