"""Incremental partials: a growing fact is aggregated once, as it arrives.

A stream over the fact's files turns each batch of new files into partials (series, day, sum
and count) and adds them to a store. Sums and counts add up, so a report over the store equals
one over the whole fact, and reads a row per series and day instead of the fact.

A store is a folder: ``batches/batch=N`` has the partials of one batch; ``merged/upto=N`` those
of all batches up to N, merged into one row a series and day; ``manifest`` has a row for every
folder that is whole; ``stream`` is the stream's own checkpoint. A batch is written as a folder
of its own and counts once its row is in the manifest, so a batch that failed half-way is
written anew and one that is replayed changes nothing. The checkpoint lies inside the store
because batch numbers only mean something together with it.

Defined cases: a value whose period is not known yet is stored under its period id and joined
with the periods of the reader, so it counts as soon as its period does; a period id with n rows
counts n times; nulls count as no value; NaN makes its series' day NaN, as in the whole fact.
Files are taken once, by name: one that is rewritten in place is not read again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadence.functions.calendar import month_start
from cadence.plans.sizing import local_frame
from cadence.sources.base import dealt, placed_by
from cadence.sources.solution import FACT_READ, SolutionSource

KEYS = ["series_id", "datafile_id", "date", "period"]
STORED = "series_id long, datafile_id long, date date, period int, value double, n long"
MANIFEST = "kind string, batch long"
MERGE_EVERY = 32


class PartialStore:
    """The partials of one solution's fact under ``path``, a folder that driver and executors
    share. ``merge_every``: batches after which all that is stored is merged into one folder."""

    def __init__(self, spark: SparkSession, path: str, merge_every: int = MERGE_EVERY):
        self.spark = spark
        self.path = path.rstrip("/")
        self.merge_every = merge_every

    def _whole(self) -> tuple[int, list[int]]:
        """The last batch of the newest merged folder (-1: none), and the batches after it. What
        comes back is one number, and at most ``merge_every`` more with the batch at work."""
        try:
            rows = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1, []
        upto = rows.agg(F.max(F.when(F.col("kind") == "merged", F.col("batch")))).first()[0]
        upto = -1 if upto is None else upto
        later = rows.where((F.col("kind") == "batch") & (F.col("batch") > upto)).select("batch").distinct().collect()
        return upto, sorted(r[0] for r in later)

    def _record(self, kind: str, batch: int) -> None:
        local_frame(self.spark, [(kind, batch)], MANIFEST).coalesce(1).write.mode("append").json(f"{self.path}/manifest")

    def _stored(self, upto: int, batches: list[int]) -> DataFrame:
        paths = [f"{self.path}/batches/batch={b}" for b in batches]
        if upto >= 0:
            paths.append(f"{self.path}/merged/upto={upto}")
        if not paths:
            return local_frame(self.spark, [], STORED)
        return self.spark.read.schema(STORED).parquet(*paths)

    def add(self, facts: DataFrame, periods: DataFrame, batch: int) -> bool:
        """Store the partials of a batch of facts; false when the batch is already stored.
        ``periods``: (PeriodId, period_start)."""
        upto, later = self._whole()
        if batch <= upto or batch in later:
            return False
        if len(later) >= self.merge_every:
            self._merge(upto, later)
        rows = facts.select(
            F.col("SeriesId").cast("long").alias("series_id"), F.col("dataFileId").cast("long").alias("datafile_id"),
            F.col("PeriodId").cast("int").alias("PeriodId"), F.col("Value").cast("double").alias("value"))
        rows = rows.join(periods, "PeriodId", "left").withColumn("date", F.to_date("period_start"))
        rows = rows.withColumn("period", F.when(F.col("date").isNull(), F.col("PeriodId")))
        parts = rows.groupBy(*KEYS).agg(F.sum("value").alias("value"), F.count("value").alias("n"))
        parts.write.mode("overwrite").parquet(f"{self.path}/batches/batch={batch}")
        self._record("batch", batch)
        return True

    def _merge(self, upto: int, batches: list[int]) -> None:
        """All that is stored as one folder. Folders that it replaces stay for readers that
        have planned on them."""
        merged = self._stored(upto, batches).groupBy(*KEYS).agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
        merged.write.mode("overwrite").parquet(f"{self.path}/merged/upto={batches[-1]}")
        self._record("merged", batches[-1])

    def partials(self, periods: DataFrame) -> DataFrame:
        """(series_id, datafile_id, date, value, n) of all whole batches; a series and day may
        have several rows. Values still without a period are left out."""
        stored = self._stored(*self._whole())
        waiting = stored.where("date IS NULL").join(periods.withColumnRenamed("PeriodId", "period"), "period")
        waiting = waiting.withColumn("date", F.to_date("period_start")).where("date IS NOT NULL")
        keep = ["series_id", "datafile_id", "date", "value", "n"]
        return stored.where("date IS NOT NULL").select(*keep).unionByName(waiting.select(*keep))

    def follow(self, fact_path: str, source: SolutionSource, files_per_batch: int | None = None, once: bool = True) -> StreamingQuery:
        """A stream that adds the files under ``fact_path`` that it has not yet seen: all that are
        there (``once``), or as they come."""
        stream = self.spark.readStream.schema(FACT_READ)
        if files_per_batch:
            stream = stream.option("maxFilesPerTrigger", files_per_batch)
        out = stream.parquet(fact_path).writeStream.option("checkpointLocation", f"{self.path}/stream")
        if once:
            out = out.trigger(availableNow=True)
        return out.foreachBatch(lambda facts, batch: self.add(facts, source.periods(), batch) and None).start()


class StoredSource(SolutionSource):
    """A solution whose reports read a store's partials instead of its fact."""

    def __init__(self, solution: SolutionSource, store: PartialStore):
        super().__init__(solution.spark, solution.facts(), solution._fki, solution._period)
        self.store = store

    def filtered(self, **names) -> StoredSource:
        """As in :meth:`SolutionSource.filtered`, but for the period type, which the store has
        already joined."""
        if names.get("period_type") is not None:
            raise ValueError("period_type: filter the solution that fills the store")
        return StoredSource(super().filtered(**names), self.store)

    def partials(self, wanted: DataFrame, day: bool, expand_timeslices: bool = False, properties: list[str] | None = None) -> DataFrame:
        rows = self.store.partials(self.periods()).join(wanted, self.key_cols).withColumn("month_start", month_start("date"))
        grain = [*placed_by(wanted), *self.key_cols, "month_start"]
        if day:
            rows, grain = rows.withColumn("day", F.when(F.col("_daily"), F.dayofmonth("date"))), [*grain, "day"]
        return dealt(rows.groupBy(*grain).agg(F.sum("value").alias("value"), F.sum("n").alias("n")))

    def observed(self, expand_timeslices: bool = False, properties: list[str] | None = None) -> DataFrame:
        return self.store.partials(self.periods()).select(*self.key_cols).distinct()
