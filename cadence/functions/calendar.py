"""Calendar: month buckets, column labels and column ordinals.

Column ordinals are integers so that report order never depends on parsing
labels: a month is ``year*100 + month``, a year total ``year*100 + 13`` and the
grand total :data:`TOTAL_ORD`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Report column texts.
MONTH_FORMAT = "MMM-yyyy"          # e.g. Jan-2026
YEAR_TOTAL_PREFIX = "Tot-"         # e.g. Tot-2026
TOTAL_LABEL = "Total"
YEAR_TOTAL_SLOT = 13
TOTAL_ORD = 999999


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(ts) -> Column:
    return F.trunc(_col(ts).cast("timestamp").cast("date"), "month")


def month_label(ts) -> Column:
    return F.date_format(_col(ts), MONTH_FORMAT)


def month_ord(ts) -> Column:
    t = _col(ts)
    return (F.year(t) * 100 + F.month(t)).cast("int")


def year_total_label(year) -> Column:
    return F.concat(F.lit(YEAR_TOTAL_PREFIX), _col(year).cast("string"))


@dataclass(frozen=True)
class Calendar:
    """The months of a solution, in date order. Small by construction: one entry
    per calendar month of the horizon."""

    months: tuple  # of (datetime.date month_start, int year, str label)

    @property
    def years(self) -> list[int]:
        return sorted({y for _, y, _ in self.months})

    @property
    def labels(self) -> list[str]:
        return [lab for _, _, lab in self.months]

    def column_labels(self) -> list[str]:
        """Month labels with ``Tot-Y`` after each year's months, ``Total`` last."""
        out: list[str] = []
        for y in self.years:
            out.extend(lab for _, yy, lab in self.months if yy == y)
            out.append(f"{YEAR_TOTAL_PREFIX}{y}")
        out.append(TOTAL_LABEL)
        return out

    def month_array(self) -> Column:
        """The months as a literal array of structs, for completing grids with a
        generator instead of a join."""
        items = ", ".join(
            f"named_struct('month_start', DATE'{ms.isoformat()}', 'year', CAST({y} AS INT), "
            f"'col_label', '{lab}', 'col_ord', CAST({y * 100 + ms.month} AS INT))"
            for ms, y, lab in self.months
        )
        return F.expr(f"array({items})")


def calendar_frame(period_starts: DataFrame, col: str = "period_start") -> DataFrame:
    """Distinct months of the period starts: (month_start, year, col_label, col_ord)."""
    ms = month_start(col)
    return (
        period_starts.select(ms.alias("month_start"))
        .where(F.col("month_start").isNotNull())
        .distinct()
        .select(
            "month_start",
            F.year("month_start").alias("year"),
            month_label("month_start").alias("col_label"),
            month_ord("month_start").alias("col_ord"),
        )
    )


def collect_calendar(period_starts: DataFrame, col: str = "period_start") -> Calendar:
    frame = calendar_frame(period_starts, col)
    rows = frame.orderBy("month_start").collect()  # one row a month of the horizon
    return Calendar(tuple((r["month_start"], int(r["year"]), r["col_label"]) for r in rows))
