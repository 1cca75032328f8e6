"""Row numbers over a whole table."""

from pyspark.sql import functions as F

from cadence.operators.ordering import numbered


def test_numbers_are_gapless_and_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("a")).alias("y.z"))
    rows = numbered(df, [F.col("`y.z`").asc_nulls_last(), F.col("x").desc()], "_at").collect()
    rows.sort(key=lambda r: r["_at"])
    assert [r["_at"] for r in rows] == list(range(1, 5001))
    assert [(r["y.z"], r["x"]) for r in rows] == sorted(((r["y.z"], r["x"]) for r in rows), key=lambda t: (t[0] is None, -t[1]))
    assert numbered(df.limit(0), [F.col("x")], "_at").count() == 0
