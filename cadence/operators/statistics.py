"""Statistics of series in the declared shape of ``aggregatedseries``.

Values are counted first: (series, value, n). Sum, extremes, count and deviation merge from
moments of the counted values. Quartiles and the median are exact: each distinct value knows how many
values of its series are not above it, from one running sum over the sorted counted values of all
series, and a quartile lies between the two values at its rank. No window or group holds a series,
so one that has a third of all values is dealt like the others.

Defined cases: NULL and NaN are no values. A series without values has ValueCount 0 and nulls. The
standard deviation is that of the values themselves (the divisor is their number). Quartiles lie at
(n - 1) * q, between two values in proportion. The mode is the most frequent value, the least of
equals. The hash is a sum over values, so the order of rows does not matter; equal rows count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.operators.ordering import cumulated

QUARTILES = {"FirstQuartile": 0.25, "Median": 0.5, "ThirdQuartile": 0.75}
#: Bits of a row's digest that the hash sums up, as hexadecimal digits, and its modulus.
_DIGITS, _MODULUS = 12, 16**12


def _digest(when: Column, value: Column) -> Column:
    text = F.concat_ws("|", F.coalesce(when.cast("string"), F.lit("")), F.coalesce(value.cast("decimal(38,10)").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("decimal(38,0)")


def series_statistics(facts: DataFrame, keys: list[str], value: str = "Value", period: str | None = None) -> DataFrame:
    """``keys``, Sum, Min, Max, ValueCount, StandardDeviation, Mode, Median, FirstQuartile, ThirdQuartile
    and SeriesHash of each series. ``period`` tells equal values apart in the hash."""
    x = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    rows = facts.select(*keys, x.alias("_v"), _digest(F.col(period) if period else F.lit(None), x).alias("_h"))
    counted = rows.groupBy(*keys, "_v").agg(F.count("*").alias("_n"), F.sum("_h").alias("_h"))
    n = F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0)
    ranked = cumulated(counted.withColumn("_c", n), [*(F.col(k).asc_nulls_first() for k in keys), F.col("_v").asc_nulls_first()], "_c", "_ahead")
    v, c = F.col("_v"), F.col("_c")
    most = F.max(F.when(v.isNotNull(), F.struct(c.alias("n"), (-v).alias("less"))))
    total = ranked.groupBy(*keys).agg(
        F.sum(v * c).alias("Sum"), F.min(v).alias("Min"), F.max(v).alias("Max"), F.sum(c).alias("_all"), most.alias("_most"),
        F.min("_ahead").alias("_first"), F.sum("_h").alias("_h"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    met = ranked.alias("r").join(total.alias("t"), same, "right").select(*(F.col(f"t.{k}") for k in keys), *(F.col(f"t.{c}") for c in total.columns if c not in keys), "_v", "_c", "_ahead")
    spread = F.col("_v") - F.col("Sum") / F.col("_all")
    low = F.col("_ahead") - F.col("_first")  # values of the series below this one

    def at(rank: Column) -> Column:
        return F.max(F.when((low <= rank) & (rank < low + F.col("_c")), F.col("_v")))

    aggs = [F.sum(spread * spread * F.col("_c")).alias("_spread")]
    for name, q in QUARTILES.items():
        place = (F.col("_all") - 1) * F.lit(q)
        aggs += [at(F.floor(place)).alias(f"_{name}_a"), at(F.ceil(place)).alias(f"_{name}_b")]
    fixed = [c for c in total.columns if c not in keys]
    # every fixed column is one value for each series
    out = met.groupBy(*keys).agg(*(F.first(c).alias(c) for c in fixed), *aggs)
    between = []
    for name, q in QUARTILES.items():
        place = (F.col("_all") - 1) * F.lit(q)
        a, b = F.col(f"_{name}_a"), F.col(f"_{name}_b")
        between.append((a + (b - a) * (place - F.floor(place))).alias(name))
    some = F.col("_all") > 0
    hashed = F.lower(F.lpad(F.hex((F.col("_h") % F.lit(_MODULUS)).cast("long")), _DIGITS, "0"))
    return out.select(
        *keys, F.when(some, F.col("Sum")).alias("Sum"), "Min", "Max", F.col("_all").cast("int").alias("ValueCount"),
        F.when(some, F.sqrt(F.col("_spread") / F.col("_all"))).alias("StandardDeviation"), (-F.col("_most.less")).alias("Mode"),
        *(c for c in between), hashed.alias("SeriesHash")).select(
        *keys, "Sum", "Min", "Max", "ValueCount", "StandardDeviation", "Mode", "Median", "FirstQuartile", "ThirdQuartile", "SeriesHash")
