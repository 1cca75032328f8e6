"""Rule tables for the test star (lineitem as a solution analog).

These rows are configuration: the same rows feed the Spark rule DataFrames and
the SQL oracle's VALUES lists. Properties: Quantity (units), Discount
(fraction, a rate), Extended Price (USD), Tax (fraction). Class 'Supplier',
categories = region names, parents = nation names (class 'Nation'), bands =
line numbers, timeslices = return flags plus 'All Periods'.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cadence import schemas
from cadence.plans.sizing import local_frame
from cadence.sources.rules import EMISSIONS as EMISSIONS_SCHEMA
from cadence.sources.rules import RuleSet, rows_frame
from cadence.sources.solution import SolutionSource
from cadence.sources.star import read_fact, supplier_dimension

FUEL = "( 3 ) Thermal Unit Fuel Use (MBTU)"

# (rule_ord, Header, Class, Group, Property, Pattern, Rate, Unit)
STANDARD = [
    (1, "( 1 ) Supply Summary", "Supplier", "All", "Quantity", "monthly", False, "kunits"),
    (2, "( 1 ) Supply Summary", " supplier ", "AsiaEurope", "Discount", "monthly", True, "pct"),
    (3, "( 2 ) Regional Totals", "Supplier", "Americas", "Extended Price", "monthly-summary", False, "kUSD"),
    (4, "( 2 ) Regional Totals", "Supplier", "All", "Tax", "monthly-summary", True, None),
    (5, FUEL, "Supplier", "All", "Fuel", "monthly", False, None),
    (6, "( 4 ) Nation Detail", "Nation.Supplier", "AsiaEurope", "Quantity", "monthly", False, None),
    (7, "( 5 ) Daily Quantity", "Supplier", "All", "Quantity", "daily", False, None),
    (8, "( 6 ) Missing", "Supplier", "Antarctica", "Quantity", "monthly", False, None),
    (9, "( 6 ) Missing", "Supplier", "All", "Bogus Property", "monthly", False, None),
]

# (rule_ord, Class, Group, Property, Alias, Unit)
RATINGS = [
    (1, "Supplier", "All", "Quantity", "qty", None),
    (2, "Supplier", "AsiaEurope", "Discount", "disc", None),
    (3, "Supplier ", "Americas", "Tax", "nan", None),
]

# (Class, Group, Assets) — mixed case, spaces and an 'all' item on purpose.
GROUPS = [
    ("Supplier", "All", "all"),
    ("Supplier", "AsiaEurope", "Asia, europe ,ALL"),
    ("Supplier", "Americas", " america"),
    ("Supplier", "Antarctica", "ANTARCTICA"),
    ("Supplier", "Europe", "EUROPE"),
    ("Nation", "AsiaEurope", "ASIA, EUROPE"),
]

# (UnitFrom, UnitTo, ConversionRate); the second units->kunits row never wins.
UNITS = [
    ("units", "kunits", 0.001),
    ("fraction", "pct", 100.0),
    ("USD", "kUSD", 0.001),
    ("units", "kunits", 1000.0),
]

# (map_ord, source_name, report_name); the last row per source wins.
NAMES = [
    (1, "Supplier#000000001", "S-ONE"),
    (2, "Supplier#000000002", "S-ONE"),
    (3, "Supplier#000000003", "S-THREE"),
    (4, "Supplier#000000003", "S-THREE-LAST"),
    (5, "NATION_3", "Nation Three"),
]

# Stacked rows: (label, property[, group]). The startup component only covers
# Europe, so other suppliers show a zero startup row.
COMPONENTS = [
    ("        (Primary)", "Quantity"),
    ("        (Secondary)", None),
    ("        (Startup)", "Tax", "Europe"),
    ("        (Topping)", None),
]


# (rule_ord, Header, Class, Gas, Pattern, Unit, Property): series under a
# parent object; nations stand in for gases.
EMISSIONS = [
    (1, "( 8 ) Emissions", "Supplier", "NATION_3", "monthly", "kunits", "Quantity"),
    (2, "( 8 ) Emissions", "Supplier", " nation_7 ", "monthly-summary", None, "Tax"),
]


def ruleset(spark: SparkSession, standard=None, ratings=None, names=True, units=True, emissions=None) -> RuleSet:
    std = STANDARD if standard is None else standard
    rat = RATINGS if ratings is None else ratings
    return RuleSet(
        standard=rows_frame(spark, std, schemas.BLUEPRINT_STD) if std else None,
        ratings=rows_frame(spark, rat, schemas.BLUEPRINT_RAT) if rat else None,
        groups=rows_frame(spark, GROUPS, schemas.GROUPS),
        units=rows_frame(spark, UNITS, schemas.UNIT_CONVERSION) if units else None,
        names=rows_frame(spark, NAMES, schemas.NAME_MAP) if names else None,
        components=COMPONENTS,
        fuel_header=FUEL,
        emissions=rows_frame(spark, EMISSIONS if emissions is None else emissions, EMISSIONS_SCHEMA),
    )


def rules_by_ord(ords):
    return [r for r in STANDARD if r[0] in set(ords)]


# In solution(): every n-th supplier's child name is blanked, so that its parent's name stands in.
BLANK_EVERY = 7


def solution(spark: SparkSession, sf_dir: str, blank_names: bool = False) -> SolutionSource:
    """The test star's quantities in the solution layout. A series is (supplier, line number,
    timeslice); as in a solution, 'All Periods' is a series of its own beside each return
    flag's. Periods are the ship dates, data files the suppliers modulo 4. The series of line
    number 7 are stored in another unit."""
    li = read_fact(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_quantity")
    flags = F.array(F.struct(F.lit(0).alias("id"), F.lit("All Periods").alias("name")),
                    F.struct(F.ascii("l_returnflag").alias("id"), F.col("l_returnflag").alias("name")))
    rows = li.withColumn("ts", F.explode(flags)).select(
        F.col("l_suppkey").cast("long").alias("supplier"), F.col("l_linenumber").cast("int").alias("BandId"),
        F.col("ts.id").alias("TimesliceId"), F.col("ts.name").alias("TimesliceName"), "l_shipdate", "l_quantity",
        (F.col("l_suppkey") * 10000 + F.col("l_linenumber") * 1000 + F.col("ts.id")).cast("long").alias("SeriesId"),
        F.pmod("l_suppkey", F.lit(4)).cast("long").alias("dataFileId"))
    day = F.datediff("l_shipdate", F.lit("1990-01-01").cast("date"))
    fact = rows.select("SeriesId", day.alias("PeriodId"), F.col("l_quantity").cast("double").alias("Value"), "dataFileId")
    child = F.when(F.col("s_suppkey") % BLANK_EVERY == 0, F.lit(" ")).otherwise(F.col("s_name")) if blank_names else F.col("s_name")
    series = rows.select("SeriesId", "dataFileId", "supplier", "BandId", "TimesliceId", "TimesliceName").distinct()
    series = series.join(supplier_dimension(spark, sf_dir), F.col("supplier") == F.col("s_suppkey")).select(
        "SeriesId", F.col("dataFileId").alias("DataFileId"), F.col("SeriesId").alias("KeyId"),
        child.alias("ChildObjectName"), F.col("n_name").alias("ParentObjectName"), F.lit("Supplier").alias("ChildClassName"),
        F.lit("Nation").alias("ParentClassName"), F.col("r_name").alias("ChildObjectCategoryName"),
        F.col("r_name").alias("ParentObjectCategoryName"), F.lit("Quantity").alias("PropertyName"),
        F.when(F.col("BandId") == 7, "crates").otherwise("units").alias("UnitValue"), "BandId", "TimesliceId", "TimesliceName")
    period = li.where("l_shipdate IS NOT NULL").select(day.alias("PeriodId"), F.col("l_shipdate").alias("StartDate")).distinct()
    return SolutionSource(spark, fact, series, period)


# The sampled analog's names; weights by (PhaseId, SampleId, Value).
PHASES, MODELS, PERIOD_TYPES = {3: "MT Schedule", 4: "ST Schedule"}, {1: "Base", 2: "Stress"}, {0: "Interval", 1: "Day"}
SAMPLES = {0: "S0", 1: "S1", 2: "S2"}
SAMPLE_WEIGHTS = [(4, 0, 0.5), (4, 1, 0.2), (3, 0, 0.75), (3, 2, 0.25)]


def sampled_solution(spark: SparkSession, sf_dir: str) -> SolutionSource:
    """The test star's quantities as a solution of several samples, phases and models. A series
    is (supplier, sample, phase, model): the sample is the order key modulo 3, the phase tells
    returned rows, the model the first three lines from the others. Each ship date is a period
    id of both period types; the series are of type 0."""
    li = read_fact(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_quantity")
    rows = li.select(
        F.col("l_suppkey").cast("long").alias("supplier"), F.pmod("l_orderkey", F.lit(len(SAMPLES))).cast("int").alias("SampleId"),
        F.when(F.col("l_returnflag") == "R", 3).otherwise(4).alias("PhaseId"), F.when(F.col("l_linenumber") <= 3, 1).otherwise(2).alias("ModelId"),
        F.datediff("l_shipdate", F.lit("1990-01-01").cast("date")).alias("PeriodId"), "l_shipdate", F.col("l_quantity").cast("double").alias("Value"))
    rows = rows.withColumn("SeriesId", F.col("supplier") * 1000 + F.col("SampleId") * 100 + F.col("PhaseId") * 10 + F.col("ModelId"))
    rows = rows.withColumn("dataFileId", F.pmod("supplier", F.lit(4)).cast("long"))
    name = lambda c, names: F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col(c)]
    series = rows.select("SeriesId", "dataFileId", "supplier", "SampleId", "PhaseId", "ModelId").distinct()
    series = series.join(supplier_dimension(spark, sf_dir), F.col("supplier") == F.col("s_suppkey")).select(
        "SeriesId", F.col("dataFileId").alias("DataFileId"), F.col("SeriesId").alias("KeyId"), F.col("s_name").alias("ChildObjectName"),
        F.col("n_name").alias("ParentObjectName"), F.lit("Supplier").alias("ChildClassName"), F.lit("Nation").alias("ParentClassName"),
        F.col("r_name").alias("ChildObjectCategoryName"), F.col("r_name").alias("ParentObjectCategoryName"), F.lit("Quantity").alias("PropertyName"),
        F.lit("units").alias("UnitValue"), F.lit(1).alias("BandId"), F.lit(0).alias("TimesliceId"), F.lit("All Periods").alias("TimesliceName"),
        "PhaseId", name("PhaseId", PHASES).alias("PhaseName"), "SampleId", name("SampleId", SAMPLES).alias("SampleName"),
        "ModelId", name("ModelId", MODELS).alias("ModelName"), F.lit(0).alias("PeriodTypeId"), F.lit(PERIOD_TYPES[0]).alias("PeriodTypeName"))
    period = rows.where("PeriodId IS NOT NULL").select("PeriodId", F.col("l_shipdate").alias("StartDate")).distinct()
    period = period.withColumn("PeriodTypeId", F.explode(F.array(*[F.lit(k) for k in PERIOD_TYPES])))
    return SolutionSource(spark, rows.select("SeriesId", "PeriodId", "Value", "dataFileId"), series, period)


def sample_weights(spark: SparkSession):
    return local_frame(spark, SAMPLE_WEIGHTS, "PhaseId int, SampleId int, Value double")
