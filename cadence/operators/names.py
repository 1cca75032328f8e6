"""Asset renaming and merge: mapped names replace source names (unmapped keep
theirs); several source names may map to one, and their cells are summed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.sources.base import PLACE, place


def rename(df: DataFrame, names: DataFrame | None, col: str = "object") -> DataFrame:
    """Left lookup of ``col`` in the name map (source_name, report_name)."""
    if names is None:
        return df
    m = names.select(F.col("source_name").alias("_src"), F.col("report_name").alias("_dst"))
    on = df[col] == F.col("_src")
    if PLACE in df.columns:  # the names are dealt as the objects are
        m = m.select("*", place("_src").alias("_src_place")).repartition("_src_place")
        on = on & (df[PLACE] == F.col("_src_place"))
    j = df.join(m, on, "left")
    return j.select(
        *[F.coalesce(F.col("_dst"), df[c]).alias(c) if c == col else df[c] for c in df.columns]
    )


def rename_and_merge(df: DataFrame, names: DataFrame | None, keys: list[str], value: str = "value",
                     band_merge: str = "sum") -> DataFrame:
    """Rename, then sum ``value`` over ``keys`` (which exclude what is merged away,
    e.g. the band); ``band_merge='mean'`` averages the rows of rates instead."""
    if band_merge not in ("sum", "mean"):
        raise ValueError(f"band_merge is 'sum' or 'mean', not {band_merge!r}")
    merged = F.sum(value)
    if band_merge == "mean":
        merged = F.when(F.col("rate"), F.avg(value)).otherwise(merged)
    return rename(df, names).groupBy(*keys).agg(merged.alias(value))
