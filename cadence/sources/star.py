"""A plain star schema as a source.

The fact table holds one or more measure columns; each measure is a property.
A series is (dimension key, property). Band and timeslice, when the star has
them, are fact columns (``fact_attrs``). Every fact row also belongs to the
aggregate timeslice 'All Periods' (id 0), like the simulator's all-period
series; its cells are rolled up from the per-timeslice cells.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.calendar import month_start
from cadence.functions.text import DEFAULT_TIMESLICE, object_name
from cadence.plans.sizing import local_frame
from cadence.session import bound_tasks
from cadence.sources.base import Source, dealt, placed_by


@dataclass
class Measure:
    property: str
    column: str
    unit: str


@dataclass
class StarSpec:
    fact: DataFrame
    fact_key: str                      # fact column holding the series dimension key
    dimension: DataFrame               # one row per dimension key, joined attributes
    dim_key: str
    measures: list[Measure]
    start: str                         # fact timestamp column
    attrs: dict[str, Column] = field(default_factory=dict)  # canonical -> expr over dimension
    band: Column | None = None         # expr over fact; 1 when absent
    timeslice: Column | None = None    # expr over fact; only 'All Periods' when absent
    timeslice_id: Column | None = None


class StarSource(Source):
    key_cols = ["series_id", "property"]
    fact_attrs = ["band", "timeslice_id", "timeslice"]

    def __init__(self, spark: SparkSession, spec: StarSpec):
        self.spark = spark
        self.spec = spec

    # -- series ---------------------------------------------------------
    def series(self) -> DataFrame:
        s = self.spec
        a = s.attrs
        n = len(s.measures)
        props = F.array(*[
            F.struct(F.lit(m.property).alias("property"), F.lit(m.unit).alias("unit"), F.lit(i).alias("idx"))
            for i, m in enumerate(s.measures)
        ])
        child = a.get("child_name", F.lit(None).cast("string"))
        parent = a.get("parent_name", F.lit(None).cast("string"))
        base = s.dimension.select(
            F.col(s.dim_key).cast("long").alias("series_id"),
            object_name(child, parent).alias("object"),
            child.alias("child_name"),
            parent.alias("parent_name"),
            a.get("child_class", F.lit(None).cast("string")).alias("child_class"),
            a.get("parent_class", F.lit(None).cast("string")).alias("parent_class"),
            a.get("child_category", F.lit(None).cast("string")).alias("child_category"),
            a.get("parent_category", F.lit(None).cast("string")).alias("parent_category"),
            F.explode(props).alias("_p"),
        )
        return base.select(
            "*",
            F.col("_p.property").alias("property"),
            F.col("_p.unit").alias("unit"),
            (F.col("series_id") * F.lit(n) + F.col("_p.idx")).alias("key_id"),
        ).drop("_p")

    # -- facts ----------------------------------------------------------
    def _measures(self, properties: list[str] | None) -> list[Measure]:
        wanted = None if properties is None else {p.strip().lower() for p in properties}
        kept = [m for m in self.spec.measures if wanted is None or m.property.strip().lower() in wanted]
        return kept or self.spec.measures[:1]

    def _wide(self, expand_timeslices: bool, measures: list[Measure]) -> DataFrame:
        """The fact with its measures side by side: series_id, the fact attributes,
        period_start and _m0, _m1, ..."""
        s = self.spec
        band = s.band if s.band is not None else F.lit(1)
        if expand_timeslices and s.timeslice is not None:
            # each fact row in its own timeslice; 'All Periods' is rolled up
            # from the aggregated cells, never by duplicating rows
            ts = [s.timeslice_id.cast("int").alias("timeslice_id"), s.timeslice.alias("timeslice")]
        else:
            ts = [F.lit(0).alias("timeslice_id"), F.lit(DEFAULT_TIMESLICE).alias("timeslice")]
        return s.fact.select(
            F.col(s.fact_key).cast("long").alias("series_id"), band.cast("int").alias("band"), *ts,
            F.col(s.start).cast("timestamp").alias("period_start"),
            *[F.col(m.column).cast("double").alias(f"_m{i}") for i, m in enumerate(measures)])

    def _by_property(self, wide: DataFrame, measures: list[Measure], keep: list[str], values) -> DataFrame:
        """One row for each measure: ``keep``, property and the fields of ``values(i)``."""
        each = F.array(*[F.struct(F.lit(m.property).alias("property"), *values(i)) for i, m in enumerate(measures)])
        return wide.select(*keep, F.inline(each))

    def observations(self, expand_timeslices: bool = False, properties: list[str] | None = None) -> DataFrame:
        measures = self._measures(properties)
        keep = ["series_id", *self.fact_attrs, "period_start"]
        f = self._by_property(self._wide(expand_timeslices, measures), measures, keep, lambda i: [F.col(f"_m{i}").alias("value")])
        return f.select("series_id", "property", "band", "timeslice_id", "timeslice", "period_start", "value")

    def partials(self, wanted: DataFrame, day: bool, expand_timeslices: bool = False, properties: list[str] | None = None) -> DataFrame:
        """Measures are aggregated side by side, for the dimension keys that any rule wants;
        only the partials become a row for each property."""
        measures = self._measures(properties)
        places = placed_by(wanted)
        keys = wanted.groupBy(*places, "series_id").agg(F.max("_daily").alias("_daily"))
        f = self._wide(expand_timeslices, measures)
        f = f.join(keys, "series_id") if day or places else f.join(keys, "series_id", "left_semi")
        grain = [*places, "series_id", *self.fact_attrs, "month_start"]
        f = f.withColumn("month_start", month_start("period_start"))
        if day:
            f, grain = f.withColumn("day", F.when(F.col("_daily"), F.dayofmonth("period_start"))), [*grain, "day"]
        # the counts side by side: mostly alike, so they take little room in a compressed shuffle
        sums = [f(f"_m{i}").alias(f"{to}{i}") for f, to in ((F.sum, "_v"), (F.count, "_n")) for i in range(len(measures))]
        return self._by_property(dealt(f.groupBy(*grain).agg(*sums)), measures, grain, lambda i: [F.col(f"_v{i}").alias("value"), F.col(f"_n{i}").alias("n")])

    def observed(self, expand_timeslices: bool = False, properties: list[str] | None = None) -> DataFrame:
        measures = self._measures(properties)
        seen = self._wide(expand_timeslices, measures).select("series_id", "timeslice").distinct()
        return self._by_property(seen, measures, ["series_id", "timeslice"], lambda i: [])

    def declared_units(self) -> DataFrame:
        return local_frame(self.spark, [(m.property, m.unit) for m in self.spec.measures], "property string, unit string")

    def period_starts(self) -> DataFrame:
        return self.spec.fact.select(F.col(self.spec.start).cast("timestamp").alias("period_start"))


# ---------------------------------------------------------------------------
# The test star (TPC-H-like tables) as a solution analog.
# ---------------------------------------------------------------------------
# The analog's property catalogue (property, fact column, unit).
LINEITEM_MEASURES = [
    Measure("Quantity", "l_quantity", "units"),
    Measure("Discount", "l_discount", "fraction"),
    Measure("Extended Price", "l_extendedprice", "USD"),
    Measure("Tax", "l_tax", "fraction"),
]
# Analog class names.
SUPPLIER_CLASS = "Supplier"
NATION_CLASS = "Nation"


_SCHEMAS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table; its footer schema is inferred once per file version and
    then given to the reader (no inference job on later reads)."""
    import os

    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    try:
        key = (path, os.stat(path).st_mtime_ns)
    except OSError:
        key = None
    schema = _SCHEMAS.get(key) if key else None
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    df = spark.read.parquet(path)
    if key:
        _SCHEMAS[key] = df.schema
    return df


def read_fact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """read_table(), with shuffles in as many partitions as its splits call for (no job: splits
    are planned from the sizes of its files)."""
    fact = read_table(spark, sf_dir, name)
    bound_tasks(spark, fact.rdd.getNumPartitions())
    return fact


def supplier_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier ⋈ nation ⋈ region. No hint: Catalyst broadcasts nation and
    region from their file-size statistics (spark.sql.autoBroadcastJoinThreshold)
    and AQE re-checks at runtime; a large dimension gets a shuffle join."""
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nat.join(reg, nat.n_regionkey == reg.r_regionkey, "left")
    return sup.join(geo, sup.s_nationkey == geo.n_nationkey, "left")


def lineitem_source(spark: SparkSession, sf_dir: str) -> StarSource:
    """lineitem as the fact: series = (supplier, property), object = supplier name,
    parent = nation, category = region, band = line number, timeslice = return flag
    (id = its character code), period start = ship date."""
    li = read_fact(spark, sf_dir, "lineitem")
    spec = StarSpec(
        fact=li,
        fact_key="l_suppkey",
        dimension=supplier_dimension(spark, sf_dir),
        dim_key="s_suppkey",
        measures=LINEITEM_MEASURES,
        start="l_shipdate",
        attrs={
            "child_name": F.col("s_name"),
            "parent_name": F.col("n_name"),
            "child_class": F.lit(SUPPLIER_CLASS),
            "parent_class": F.lit(NATION_CLASS),
            "child_category": F.col("r_name"),
            "parent_category": F.col("r_name"),
        },
        band=F.col("l_linenumber"),
        timeslice=F.col("l_returnflag"),
        timeslice_id=F.ascii(F.col("l_returnflag")),
    )
    return StarSource(spark, spec)



# The events analog (users as series, event types as timeslices).
EVENT_MEASURES = [Measure("Value", "value", "USD")]
USER_CLASS = "User"


def events_source(spark: SparkSession, sf_dir: str) -> StarSource:
    """events as the fact: series = (user, 'Value'), object 'User#<id>', one
    band, timeslice = event type (id from its first letter and length),
    period start = the event's timestamp. The series catalogue is the distinct
    users of the fact (one aggregation; there is no user table)."""
    ev = read_fact(spark, sf_dir, "events")
    users = ev.select("user_id").where(F.col("user_id").isNotNull()).distinct()
    spec = StarSpec(
        fact=ev,
        fact_key="user_id",
        dimension=users,
        dim_key="user_id",
        measures=EVENT_MEASURES,
        start="ts",
        attrs={
            "child_name": F.concat(F.lit("User#"), F.col("user_id").cast("string")),
            "child_class": F.lit(USER_CLASS),
        },
        timeslice=F.col("event_type"),
        timeslice_id=F.ascii(F.col("event_type")) * 1000 + F.length(F.col("event_type")),
    )
    return StarSource(spark, spec)
