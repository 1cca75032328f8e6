"""Row totals, 'Total' rows and grid completion on sparse cells.

Absent cells read 0, and 0 adds nothing to a sum and is skipped by the
non-zero mean, so every total is computed on the cells that exist:

* row totals: ``Tot-Y`` per year and ``Total`` — sums, or for rate rows the mean
  of the non-zero months (0 when none); the rate ``Total`` averages months, not
  year totals;
* 'Total' row: per column, the sum over rows, or for rate blocks the mean of the
  non-zero row values — over the total columns too.

A report row carries its cells as a map (column ordinal -> value, ``_cells``) that holds
what is not 0. Completion comes last: the literal column list is exploded over the rows
and each cell is looked up, so nothing wide or dense is ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.calendar import (
    TOTAL_LABEL,
    TOTAL_ORD,
    YEAR_TOTAL_PREFIX,
    YEAR_TOTAL_SLOT,
    Calendar,
    month_ord,
)
from cadence.functions.numeric import nonzero_mean

# Column kinds.
MONTH, YEAR_TOTAL, GRAND_TOTAL, EXTRA = "month", "year_total", "total", "extra"


def column_list(cal: Calendar, totals: bool = True, extra: list | None = None) -> list[tuple]:
    """(col_ord, col_label, col_kind, year): months, then per year ``Tot-Y``,
    then ``Total`` (when ``totals``), then ``extra`` columns."""
    cols = [(y * 100 + ms.month, lab, MONTH, y) for ms, y, lab in cal.months]
    if totals:
        cols += [(y * 100 + YEAR_TOTAL_SLOT, f"{YEAR_TOTAL_PREFIX}{y}", YEAR_TOTAL, y) for y in cal.years]
        cols.append((TOTAL_ORD, TOTAL_LABEL, GRAND_TOTAL, None))
    return cols + list(extra or [])


#: The column of a report row that holds its cells: column ordinal -> value, absent cells 0.0.
CELLS = "_cells"


def _columns_array(cols: list[tuple]) -> Column:
    """The report's columns as a literal array of (year, col_ord, col_label, col_kind)."""
    def text(x):
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"

    items = ", ".join(
        f"named_struct('year', CAST({'NULL' if year is None else year} AS INT), 'col_ord', {o}, 'col_label', {text(label)}, 'col_kind', {text(kind)})"
        for o, label, kind, year in cols)
    return F.expr(f"array({items})")


def _sum_or_mean(entries: Column, rate: Column) -> Column:
    """The sum of the entries' values, or for rates the mean of those that are not zero."""
    total = F.aggregate(entries, F.lit(0.0), lambda a, e: a + e["v"])
    n = F.size(F.filter(entries, lambda e: e["v"] != 0.0))
    return F.when(rate & (n > 0), total / n).otherwise(total)


def row_cells(values: DataFrame, row_keys: list[str], cal: Calendar, rate_col: str | None = "rate",
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Sparse (row_keys, month_start, value), a value for each month -> one row a report row
    with ``_cells``: its months, ``Tot-Y`` and ``Total``. A group is a row's months, so no
    more than the calendar has. Undated values are in no month or year, so in no total;
    their row stays. ``keep``: columns that a row has once, where they are not NULL."""
    entry = F.struct(month_ord("month_start").alias("o"), F.col("value").alias("v"))
    rows = values.groupBy(*row_keys).agg(
        F.collect_list(F.when(F.col("month_start").isNotNull(), entry)).alias("_e"), *[F.max(c).alias(c) for c in keep])
    e, rate = F.col("_e"), F.col(rate_col) if rate_col else F.lit(False)

    def in_year(y: int) -> Column:
        return F.filter(e, lambda x: x["o"].between(y * 100, y * 100 + YEAR_TOTAL_SLOT - 1))

    years = [F.struct(F.lit(y * 100 + YEAR_TOTAL_SLOT).alias("o"), _sum_or_mean(in_year(y), rate).alias("v")) for y in cal.years]
    total = F.struct(F.lit(TOTAL_ORD).alias("o"), _sum_or_mean(e, rate).alias("v"))
    all_ = F.filter(F.concat(e, F.array(*years, total)), lambda x: x["v"] != 0.0)
    return rows.select(*row_keys, *keep, F.map_from_entries(all_).alias(CELLS))


def total_row(rows: DataFrame, block_keys: list[str], rate_col: str | None = "rate") -> DataFrame:
    """Per block the ``Total`` row of its rows' cells: by column their sum, or non-zero mean."""
    keys = block_keys + ([rate_col] if rate_col else [])
    t = rows.select(*keys, F.explode_outer(CELLS).alias("col_ord", "value")).groupBy(*keys, "col_ord").agg(
        F.sum("value").alias("_sum"), nonzero_mean("value").alias("_nzm"))
    rate = F.col(rate_col) if rate_col else F.lit(False)
    entry = F.struct("col_ord", F.when(rate, F.col("_nzm")).otherwise(F.col("_sum")).alias("v"))
    # one entry a report column
    return t.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.when(F.col("col_ord").isNotNull(), entry))).alias(CELLS))


def dense_cells(rows: DataFrame, cols: list[tuple], extra_values: dict | None = None) -> DataFrame:
    """Report rows -> one cell per row and report column, absent cells 0.0: the literal column
    list exploded over the rows, each cell a lookup in its row's map, all in generated code.
    ``extra_values`` adds computed columns {col_ord: Column}."""
    long = rows.select("*", F.inline(_columns_array(cols)))
    value = F.coalesce(F.col(CELLS)[F.col("col_ord")], F.lit(0.0))
    for o, expr in (extra_values or {}).items():
        value = F.when(F.col("col_ord") == o, F.coalesce(expr.cast("double"), F.lit(0.0))).otherwise(value)
    return long.withColumn("value", value).drop(CELLS)
