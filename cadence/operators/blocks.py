"""Report blocks as long grids.

``monthly_grid`` builds every monthly rule at once (flat, monthly-summary,
nested, ratings and the components of stacked rules): cells -> clean ->
rename and merge bands/names -> unit factor -> report rows with their totals
-> [cut] -> 'Total' rows -> completion to every report column. ``daily_grid``
builds daily rules: day cells -> rename -> a list an object -> [cut] -> object × band × day
rows with their totals -> completion (sums, no 'Total' row). ``packed_values`` makes the
lists of daily rules, and in a report with daily rules those of all its rules, from one scan.

Output rows carry ``row_kind`` ('data' or 'total') and the block keys, so the
layout step never has to parse labels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.calendar import Calendar
from cadence.operators.cells import cell_values, rule_cells
from cadence.operators.names import rename, rename_and_merge
from cadence.operators.totals import CELLS, EXTRA, column_list, dense_cells, row_cells, total_row
from cadence.operators.units import apply_factors, unit_factors
from cadence.plans.sizing import cut
from cadence.schemas import BLOCK_KEYS
from cadence.sources.base import PLACE, Source
from cadence.sources.rules import Prepared

# The daily block's day column and its ordinal (after 'Total').
DAY_COLUMN = "Day_Id"
DAY_ORD = 1_000_000
DAYS_PER_MONTH = 31


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (block keys may be NULL);
    the result keeps the left side's key columns once."""
    lft, rgt = left.alias("_l"), right.alias("_r")
    cond = None
    for k in keys:
        e = F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}"))
        cond = e if cond is None else cond & e
    j = lft.join(rgt, cond, how)
    return j.select(*[F.col(f"_l.{c}").alias(c) for c in left.columns],
                    *[F.col(f"_r.{c}").alias(c) for c in right.columns if c not in keys])


def _cells(source: Source, p: Prepared, daily: bool | None, placed: bool = False) -> DataFrame:
    return rule_cells(source, p.sel, daily=daily, props=p.properties(), expand=p.needs_timeslices(),
                      kinds=p.kinds(), placed=placed)


#: The keys of an object's part of a block: a monthly report row, or an object's daily rows.
OBJECT_KEYS = BLOCK_KEYS + ["rate", "object"]


def packed_values(source: Source, p: Prepared, daily: bool | None) -> DataFrame:
    """(OBJECT_KEYS, is_daily, _values): clean cell values after renaming, those of an object and
    rule as one list of (band, day, month_start, value). A daily rule's (all of them with ``daily``,
    with None those that have a day) are never rates; of the others bands are merged, so their
    entries are its months. Partials are dealt by object once and everything up to the lists is
    aggregated where it lies; an object that several are renamed to may have several lists. A
    list is bounded by the object's rows in the report, and its keys are stored once."""
    cells = rename(cell_values(_cells(source, p, daily, placed=True)), p.names)
    is_daily = F.lit(True) if daily else F.col("day").isNotNull()
    keys = [PLACE, *OBJECT_KEYS, "is_daily"]
    cells = cells.withColumn("is_daily", is_daily).withColumns({
        "rate": F.col("rate") & ~F.col("is_daily"), "band": F.when(F.col("is_daily"), F.col("band"))})
    merged = cells.groupBy(*keys, "band", "day", "month_start").agg(F.sum("value").alias("value"))
    entry = F.struct("band", "day", "month_start", "value")
    return merged.groupBy(*keys).agg(F.collect_list(entry).alias("_values")).drop(PLACE)


def unpacked(packed: DataFrame, keep: list[str], entries: Column | str = "_values") -> DataFrame:
    """The lists of packed_values() as rows, those of one object side by side: grouping them by
    OBJECT_KEYS and more needs no other shuffle."""
    return packed.repartition(*OBJECT_KEYS).select(*OBJECT_KEYS, F.inline(entries)).select(*OBJECT_KEYS, *keep)


def monthly_values(source: Source, p: Prepared, names: DataFrame | None = None,
                   units: DataFrame | None = None, packed: DataFrame | None = None, band_merge: str = "sum") -> DataFrame:
    """(block keys, rate, object, month_start, value): per rule and object after
    renaming, band merge and unit scaling — sparse, before completion.
    ``packed`` (optional): packed_values() of ``p``, with summed bands."""
    keys = OBJECT_KEYS + ["month_start"]
    if packed is None:
        merged = rename_and_merge(cell_values(_cells(source, p, False)), names, keys, band_merge=band_merge)
    else:
        merged = unpacked(packed, ["month_start", "value"]).groupBy(*keys).agg(F.sum("value").alias("value"))
    if units is None or all(r["unit_to"] is None for r in p.sel_rows):
        return merged
    return apply_factors(merged, unit_factors(source, p.sel, units))


def _grid_cols(df: DataFrame) -> DataFrame:
    def c(x, t):
        return (F.col(x) if x in df.columns else F.lit(None)).cast(t).alias(x)

    return df.select(*BLOCK_KEYS, "rate", "row_kind", "object", c("band", "int"), c("day", "int"), c("row_idx", "int"),
                     "year", "col_ord", "col_label", "col_kind", "value")


def monthly_rows(source: Source, p: Prepared, cal: Calendar, with_total_row: bool = True,
                 packed: DataFrame | None = None, band_merge: str = "sum") -> DataFrame:
    """(block keys, rate, row_kind, object, _cells): the grid's report rows, before completion.
    ``packed`` (optional): this grid's values, already cut by the caller."""
    vals = monthly_values(source, p, p.names, p.units, packed=packed, band_merge=band_merge)
    rows = row_cells(vals, OBJECT_KEYS, cal)
    if with_total_row:
        rows = cut(rows, free=True)  # report-sized; read by the rows and by their totals
    keys = [*BLOCK_KEYS, "rate"]
    out = rows.select(*keys, F.lit("data").alias("row_kind"), "object", CELLS)
    if with_total_row:
        tot = total_row(rows, BLOCK_KEYS)
        out = out.unionByName(tot.select(*keys, F.lit("total").alias("row_kind"), F.lit(None).cast("string").alias("object"), CELLS))
    return out


def monthly_grid(source: Source, p: Prepared, cal: Calendar, with_total_row: bool = True, band_merge: str = "sum") -> DataFrame:
    """monthly_rows(), one cell per row and report column."""
    return _grid_cols(dense_cells(monthly_rows(source, p, cal, with_total_row, band_merge=band_merge), column_list(cal)))


def daily_columns(cal: Calendar) -> list[tuple]:
    return column_list(cal, extra=[(DAY_ORD, DAY_COLUMN, EXTRA, None)])


@dataclass
class DailyGrid:
    rows: DataFrame      # (block keys, rate, row_kind, object, band, day, row_idx, _cells): the report rows
    objects: DataFrame   # (block keys, rate, object): one per object block
    cal: Calendar

    @property
    def cells(self) -> DataFrame:
        """One row per (block, object, band, day, column)."""
        return _grid_cols(dense_cells(self.rows, daily_columns(self.cal), {DAY_ORD: F.col("day")}))


def daily_grid(source: Source, p: Prepared, cal: Calendar, packed: DataFrame | None = None) -> DailyGrid:
    """Daily rules: always summed, no unit factor. Rows = objects × bands × days
    1..31 within each rule (bands are crossed over all objects of the rule, as
    the report lays them out), every calendar month, ``Tot-Y``/``Total`` and the
    day number as the last column. ``packed`` (optional): the daily part of packed_values(),
    already cut by the caller."""
    if packed is None:
        packed = cut(packed_values(source, p, True), free=True, placed=True)

    # Bands of a rule are few; their rank numbers the rows inside an object's block. One row a
    # block (a rule) is broadcast, so that objects need not meet on a key that a rule has once.
    seen = packed.select(*BLOCK_KEYS, F.explode(F.array_distinct("_values.band")).alias("band"))
    bands = seen.groupBy(*BLOCK_KEYS).agg(F.sort_array(F.collect_set(F.struct("band"))).alias("_bands"))
    lists = null_safe_join(packed.select(*OBJECT_KEYS, "_values"), F.broadcast(bands), BLOCK_KEYS)

    # every row of an object once without a month, beside its values: rows and values meet in the
    # grouping by row, and a row without values stays
    values = F.transform(F.filter("_values", lambda v: v["day"].isNotNull()), lambda v: F.struct(
        v["band"].alias("band"), v["day"].alias("day"), v["month_start"].alias("month_start"), v["value"].alias("value"), F.lit(None).cast("int").alias("row_idx")))
    blank = F.flatten(F.transform("_bands", lambda b, i: F.transform(F.sequence(F.lit(1), F.lit(DAYS_PER_MONTH)), lambda d: F.struct(
        b["band"].alias("band"), d.alias("day"), F.lit(None).cast("date").alias("month_start"), F.lit(None).cast("double").alias("value"),
        (i * DAYS_PER_MONTH + d - 1).cast("int").alias("row_idx")))))
    row_keys = OBJECT_KEYS + ["band", "day"]
    rows = unpacked(lists, ["band", "day", "month_start", "value", "row_idx"], F.concat(values, blank))
    merged = rows.groupBy(*row_keys, "month_start").agg(F.sum("value").alias("value"), F.max("row_idx").alias("row_idx"))
    out = row_cells(merged, row_keys, cal, rate_col=None, keep=("row_idx",))
    return DailyGrid(out.withColumn("row_kind", F.lit("data")), packed.select(*OBJECT_KEYS).distinct(), cal)
