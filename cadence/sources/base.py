"""What the operators need from a data source.

A source exposes two relations in canonical column names
(:data:`cadence.schemas.SERIES_ATTRS`):

* ``series()`` — one row per series: what it measures and where it belongs.
  Small relative to the facts; rules are joined to it first.
* ``observations(expand_timeslices)`` — one row per fact value: the series key
  columns, the attributes that live on the fact side (``fact_attrs``),
  ``period_start`` and ``value``. It is lazy; column pruning and filters reach
  the Parquet scan.

Attributes listed in ``fact_attrs`` are matched after the fact join instead of
in the series selection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.calendar import month_start

#: A column of a selection: a number that all series of one object share. Rows dealt by it hold
#: all that an object's cells need, so what follows is aggregated without another shuffle.
PLACE = "_place"
PLACES = 1 << 20


def place(obj: str) -> Column:
    return F.pmod(F.hash(obj), F.lit(PLACES))


def placed_by(wanted: DataFrame) -> list[str]:
    return [PLACE] if PLACE in wanted.columns else []


def dealt(df: DataFrame) -> DataFrame:
    """Rows that carry a place are dealt by it."""
    return df.repartition(PLACE) if PLACE in df.columns else df


class Source:
    spark: SparkSession
    key_cols: list[str]
    fact_attrs: list[str] = []

    def series(self) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def observations(self, expand_timeslices: bool = False, properties: list[str] | None = None) -> DataFrame:  # pragma: no cover
        raise NotImplementedError

    def partials(self, wanted: DataFrame, day: bool, expand_timeslices: bool = False, properties: list[str] | None = None) -> DataFrame:
        """The fact aggregated ahead of any rule: key columns, ``fact_attrs``, month_start, with
        ``day`` also day (set for series whose ``_daily`` is true), and the sum ``value`` and
        number ``n`` of values. ``wanted``: (key columns, _daily) of the series to keep; with a
        place, the partials carry it and are dealt by it."""
        obs = self.observations(expand_timeslices=expand_timeslices, properties=properties)
        obs = obs.join(wanted, self.key_cols).withColumn("month_start", month_start("period_start"))
        grain = placed_by(wanted) + self.key_cols + list(self.fact_attrs) + ["month_start"]
        if day:
            obs, grain = obs.withColumn("day", F.when(F.col("_daily"), F.dayofmonth("period_start"))), grain + ["day"]
        return dealt(obs.groupBy(*grain).agg(F.sum("value").alias("value"), F.count("value").alias("n")))

    def observed(self, expand_timeslices: bool = False, properties: list[str] | None = None) -> DataFrame:
        """The distinct series keys (and timeslices, where the fact has them) that have rows."""
        keys = [*self.key_cols, *(["timeslice"] if "timeslice" in self.fact_attrs else [])]
        return self.observations(expand_timeslices=expand_timeslices, properties=properties).select(*keys).distinct()

    def period_starts(self) -> DataFrame:  # pragma: no cover
        """A relation with a ``period_start`` column covering the horizon."""
        raise NotImplementedError

    def repeated_periods(self) -> DataFrame | None:
        """(period, n): periods that the fact joins more than once; None where there is no
        period table."""
        return None

    def declared_units(self) -> DataFrame | None:
        """(property, unit) where a property's unit is part of the source's description; None
        where only its series tell."""
        return None
