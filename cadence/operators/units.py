"""Unit scaling: property -> stored unit -> (from, to) conversion rule.

The stored unit of a property is taken from its series with the lowest key id
(deterministic); matching is case-insensitive; the first conversion row wins;
no rule (or no stored unit) gives factor 1.0 and a flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.text import norm
from cadence.sources.base import Source


def property_units(source: Source) -> DataFrame:
    """(_u_prop, db_unit): one stored unit per normalised property."""
    declared = source.declared_units()
    if declared is not None:
        return declared.select(norm("property").alias("_u_prop"), F.trim("unit").alias("db_unit")).dropDuplicates(["_u_prop"])
    s = source.series()
    return s.groupBy(norm("property").alias("_u_prop")).agg(F.trim(F.min_by("unit", "key_id")).alias("db_unit"))


def ambiguous_units(source: Source) -> DataFrame:
    """(property, n_units): properties whose series carry more than one stored unit."""
    s = source.series().where(F.col("unit").isNotNull())
    return (s.groupBy(norm("property").alias("property")).agg(F.count_distinct(norm("unit")).alias("n_units"))
            .where("n_units > 1"))


def unit_factors(source: Source, sel_rules: DataFrame, units: DataFrame | None) -> DataFrame:
    """(rule_ord, component, factor, unit_missing, db_unit, unit_to) per selection rule."""
    r = sel_rules.select("rule_ord", "component", norm("property").alias("_u_prop"), "unit_to")
    pu = property_units(source)
    r = r.join(pu, "_u_prop", "left")
    if units is None:
        return r.select("rule_ord", "component", F.lit(1.0).alias("factor"), F.lit(True).alias("unit_missing"),
                        "db_unit", "unit_to")
    if "_u_ord" not in units.columns:
        units = units.withColumn("_u_ord", F.monotonically_increasing_id())
    j = r.join(
        units,
        (F.lower(F.col("db_unit")) == F.lower(F.col("UnitFrom"))) & (F.lower(F.trim("unit_to")) == F.lower(F.col("UnitTo"))),
        "left",
    )
    first = Window.partitionBy("rule_ord", "component").orderBy(F.col("_u_ord").asc_nulls_last())
    j = j.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") == 1)
    return j.select(
        "rule_ord", "component",
        F.coalesce(F.col("ConversionRate"), F.lit(1.0)).alias("factor"),
        F.col("ConversionRate").isNull().alias("unit_missing"),
        "db_unit", "unit_to",
    )


def apply_factors(df: DataFrame, factors: DataFrame, value: str = "value") -> DataFrame:
    """Multiply ``value`` by the factor of the cell's (rule, component)."""
    f = F.broadcast(factors.select(
        F.col("rule_ord").alias("_f_rule"), F.col("component").alias("_f_comp"), "factor"
    ))
    j = df.join(f, (df.rule_ord == f._f_rule) & df.component.eqNullSafe(f._f_comp), "left")
    return j.select(
        *[(F.col(value) * F.coalesce(F.col("factor"), F.lit(1.0))).alias(value) if c == value else df[c]
          for c in df.columns]
    )
