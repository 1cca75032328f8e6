"""The simulator's Parquet solution layout: ``data/`` (hive-partitioned by
``dataFileId``), ``fullkeyinfo/`` and ``period/``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence import schemas
from cadence.functions.text import norm, object_name
from cadence.sources.base import Source


# Read schema of the fact table including the partition column, so the
# partition value comes back as BIGINT.
FACT_READ = T.StructType(schemas.FACT.fields + [T.StructField("dataFileId", T.LongType())])


class SolutionSource(Source):
    """One solution. Built from three DataFrames so that tests can pass their own;
    :func:`open_solution` reads them from a base path."""

    key_cols = ["series_id", "datafile_id"]
    fact_attrs: list[str] = []

    def __init__(self, spark: SparkSession, fact: DataFrame, fullkeyinfo: DataFrame, period: DataFrame):
        self.spark = spark
        self._fact = fact
        self._fki = fullkeyinfo
        self._period = period

    def series(self) -> DataFrame:
        f = self._fki
        return f.select(
            F.col("SeriesId").cast("long").alias("series_id"),
            F.col("DataFileId").cast("long").alias("datafile_id"),
            object_name("ChildObjectName", "ParentObjectName").alias("object"),
            F.col("ChildObjectName").alias("child_name"),
            F.col("ParentObjectName").alias("parent_name"),
            F.col("ChildClassName").alias("child_class"),
            F.col("ParentClassName").alias("parent_class"),
            F.col("ChildObjectCategoryName").alias("child_category"),
            F.col("ParentObjectCategoryName").alias("parent_category"),
            F.col("PropertyName").alias("property"),
            F.col("UnitValue").alias("unit"),
            F.col("KeyId").cast("long").alias("key_id"),
            F.col("BandId").cast("int").alias("band"),
            F.col("TimesliceId").cast("int").alias("timeslice_id"),
            F.col("TimesliceName").alias("timeslice"),
        )

    def facts(self) -> DataFrame:
        """The fact as it is stored."""
        return self._fact

    def filtered(self, phase=None, sample=None, model=None, period_type=None) -> SolutionSource:
        """The solution kept to series of these phases, samples, models and period types: names,
        or lists of them, matched without case and outer blanks. With ``period_type`` the periods
        are kept to the types of the series left, so that a period id that stands for a period
        of several types is joined once."""
        fki, period = self._fki, self._period
        for column, names in (("PhaseName", phase), ("SampleName", sample), ("ModelName", model), ("PeriodTypeName", period_type)):
            if names is not None:
                names = [names] if isinstance(names, str) else list(names)
                fki = fki.where(norm(column).isin([n.strip().lower() for n in names]))
        if period_type is not None:
            period = period.join(fki.select("PeriodTypeId").distinct(), "PeriodTypeId", "left_semi")
        return SolutionSource(self.spark, self._fact, fki, period)

    def sample_weights(self, sampleweight: DataFrame) -> DataFrame:
        """(series_id, datafile_id, weight): each series' weight by its phase and sample; series
        whose sample is not listed are left out."""
        w = sampleweight.groupBy("PhaseId", "SampleId").agg(F.max("Value").alias("weight"))
        f = self._fki.select(F.col("SeriesId").cast("long").alias("series_id"), F.col("DataFileId").cast("long").alias("datafile_id"), "PhaseId", "SampleId")
        return f.join(w, ["PhaseId", "SampleId"]).select("series_id", "datafile_id", "weight").distinct()

    def periods(self) -> DataFrame:
        """(PeriodId, period_start), as the fact is joined with it."""
        return self._period.select(
            F.col("PeriodId").cast("int").alias("PeriodId"),
            F.col("StartDate").cast("timestamp").alias("period_start"),
        )

    def observations(self, expand_timeslices: bool = False, properties: list[str] | None = None) -> DataFrame:
        d = self._fact.select(
            F.col("SeriesId").cast("long").alias("series_id"),
            F.col("dataFileId").cast("long").alias("datafile_id"),
            F.col("PeriodId").cast("int").alias("PeriodId"),
            F.col("Value").cast("double").alias("value"),
        )
        return d.join(self.periods(), "PeriodId", "inner").drop("PeriodId")

    def repeated_periods(self) -> DataFrame:
        return self._period.groupBy(F.col("PeriodId").alias("period")).agg(F.count("*").alias("n")).where("n > 1")

    def period_starts(self) -> DataFrame:
        return self._period.select(F.col("StartDate").cast("timestamp").alias("period_start"))


def open_solution(spark: SparkSession, base: str, cache_dimensions: bool = True) -> SolutionSource:
    """Read a solution from ``base``. The fact stays a lazy scan (with the
    ``dataFileId`` partition column, so partition pruning works); the two
    dimensions are read once and cached."""
    base = base.rstrip("/")
    fact = spark.read.schema(FACT_READ).parquet(f"{base}/data")
    fki = spark.read.parquet(f"{base}/fullkeyinfo")
    period = spark.read.parquet(f"{base}/period")
    if cache_dimensions:
        fki = fki.cache()
        period = period.cache()
    return SolutionSource(spark, fact, fki, period)
