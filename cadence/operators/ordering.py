"""Row numbers over a whole table, without a window over all rows.

The table is range-partitioned and sorted once and written as a lineage cut; a row's
number is its place in its partition plus the rows of the partitions before it. Only the
partitions' counts meet in one place. Keys that many rows share stay in one partition:
end the order with a column that tells rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.plans.sizing import cut

_PART, _PLACE, _BEFORE = "_numbered_part", "_numbered_place", "_numbered_before"
#: monotonically_increasing_id() has the row's place in its partition in these bits.
_PLACE_BITS = (1 << 33) - 1


def sorted_parts(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, with each row's partition and place."""
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias(_PART), F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)).alias(_PLACE))


def offsets(placed: DataFrame) -> DataFrame:
    """(part, rows before it): one row a partition."""
    sizes = placed.groupBy(_PART).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select(_PART, F.coalesce(before, F.lit(0)).alias(_BEFORE))


def numbered(df: DataFrame, order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with its rows' numbers in ``order``, from 1, as the column ``name``."""
    placed = cut(sorted_parts(df, order, partitions))
    # the counts are one row for each partition of the shuffle
    met = placed.join(F.broadcast(offsets(placed)), _PART)
    return met.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(_BEFORE) + F.col(_PLACE) + 1).alias(name))


def cumulated(df: DataFrame, order: list[Column], weight: str, name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with the sum of ``weight`` (whole numbers) over all rows ahead of it in ``order`` as
    the column ``name``. A running sum spans one partition; sums of partitions go ahead of it."""
    placed = cut(sorted_parts(df, order, partitions))
    ahead = Window.partitionBy(_PART).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(_PART).agg(F.sum(weight).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(_PART, F.coalesce(before, F.lit(0)).alias(_BEFORE))
    own = placed.withColumn(name, F.coalesce(F.sum(weight).over(ahead), F.lit(0)))
    met = own.join(F.broadcast(sums), _PART)  # one row for each partition of the shuffle
    return met.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(_BEFORE) + F.col(name)).cast("long").alias(name))
