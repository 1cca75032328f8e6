"""Numeric expressions: zero/NULL/NaN cleaning, non-zero means, report rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c) -> Column:
    """NULL and NaN both become 0.0 (the pivot's fill)."""
    x = _col(c).cast("double")
    return F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0))


def nonzero_mean(c) -> Column:
    """Mean of the non-zero values, 0.0 when there are none. Input must be clean."""
    return F.coalesce(F.avg(F.nullif(_col(c), F.lit(0.0))), F.lit(0.0))


def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 (never an error under ANSI mode)."""
    return F.when(_col(den) > 0, _col(num) / _col(den))


#: From here on doubles have no more than three decimal places: rounding changes nothing.
_WHOLE = 1e13


def round4(c) -> Column:
    """Report rounding to 4 places, made exact: the double is first fixed to 10
    decimal places so float noise cannot push a tie either way. Infinities, NaN and
    numbers too large to have a fourth place stay as they are."""
    x = _col(c).cast("double")
    near = F.when(F.abs(x) < F.lit(_WHOLE), x)
    exact = F.when(F.abs(x) < F.lit(_WHOLE), F.round(near.cast("decimal(38,10)"), 4).cast("double")).otherwise(x)
    # whole numbers, most of all the zeros of a completed grid, need no decimals (-0.0 becomes 0.0)
    return F.when(x == F.rint(x), x + F.lit(0.0)).otherwise(exact)


# The same rounding for the SQL oracle.
def round4_sql(expr: str) -> str:
    near = f"CASE WHEN abs({expr}) < {_WHOLE!r} THEN {expr} END"
    return f"CASE WHEN abs({expr}) < {_WHOLE!r} THEN CAST(ROUND(CAST({near} AS DECIMAL(38,10)), 4) AS DOUBLE) ELSE {expr} END"
