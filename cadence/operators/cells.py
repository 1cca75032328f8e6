"""Metric cells: the fact aggregated per rule, object, band and month (or day).

One plan for all rules, whatever their number: the fact is scanned once, kept to
the series that some rule wants, and aggregated per series and month (day only
for series that a daily rule wants) to sum and count, so means stay exact; a star's
measures side by side. Only those partials meet the rules; a fact row is never copied per rule. Which side
of a join is broadcast is left to Catalyst and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.numeric import clean, safe_ratio
from cadence.functions.text import DEFAULT_TIMESLICE, norm

ALL_PERIODS_N = DEFAULT_TIMESLICE.lower()
from cadence.operators.select import select_series
from cadence.schemas import BLOCK_KEYS
from cadence.sources.base import PLACE, Source, dealt, place

CELL_KEYS = BLOCK_KEYS + ["rate", "object", "band", "month_start"]


def _rule_properties(rules: DataFrame) -> list[str]:
    # Rules are a config table (bounded); their property names steer pruning.
    return [r[0] for r in rules.select("property").where(F.col("property").isNotNull()).distinct().collect()]


def _needs_timeslices(rules: DataFrame) -> bool:
    return rules.where(F.col("_r_ts").isNull() | (F.col("_r_ts") != "all periods")).limit(1).count() > 0


def rule_cells(source: Source, rules: DataFrame, daily: bool | None = False,
               *, props: list[str] | None = None,
               expand: bool | None = None, kinds: set | None = None, weights: DataFrame | None = None,
               placed: bool = False) -> DataFrame:
    """(block keys, rate, object, band, month_start[, day], v_sum, v_cnt).

    ``daily=None`` serves monthly and daily rules from the same scan: ``day``
    is set only on daily rules' cells (NULL for the others).
    ``props``, ``expand`` and ``kinds`` describe the (collected) rules; when
    absent they are read from ``rules``. ``weights`` (key columns, weight) multiplies each
    series' partials, sum and count, so weighted means merge like plain ones; a series
    without a weight counts once. ``placed``: the partials are dealt by their object's place,
    once, and the cells carry it: a rule's copies of them are not shuffled again."""
    props = _rule_properties(rules) if props is None else props
    sel = select_series(source, rules, kinds, props)
    places = [PLACE] if placed else []
    if placed:
        sel = sel.select("*", place("object").alias(PLACE))
    expand = _needs_timeslices(rules) if expand is None else expand
    with_day = daily is None or daily
    wanted = sel.groupBy(*places, *source.key_cols).agg(F.max((F.col("kind") == "daily") | F.lit(bool(daily))).alias("_daily"))
    parts = source.partials(wanted, with_day, expand, props)
    if weights is not None:
        w = F.coalesce(F.col("weight"), F.lit(1.0))
        parts = parts.join(weights.select(*source.key_cols, "weight"), source.key_cols, "left")
        parts = parts.withColumn("value", F.col("value") * w).withColumn("n", F.col("n") * w).drop("weight")
    grain = ["month_start"] + (["day"] if with_day else [])
    keys = places + CELL_KEYS + (["day"] if with_day else [])

    ts_fact_side = "timeslice" in source.fact_attrs

    cond = F.lit(True)
    for k in [*places, *source.key_cols]:
        cond = cond & (F.col(f"p.{k}") == F.col(f"s.{k}"))
    if ts_fact_side:
        # Facts carry their own timeslice; a rule for 'All Periods' takes
        # every timeslice and is rolled up after the aggregation.
        r_ts = F.col("s._r_ts")
        cond = cond & (r_ts.isNull() | (r_ts == ALL_PERIODS_N) | (norm("p.timeslice") == r_ts))

    rollup = ts_fact_side and expand
    if rollup:
        keys = keys + ["_r_ts", "_rolled"]

    def key(k):
        if k == "day" and daily is None:
            return F.when(F.col("s.kind") == "daily", F.col("p.day")).alias("day")
        return F.col(f"p.{k}" if k in places + grain + source.fact_attrs else f"s.{k}")

    j = parts.alias("p").join(dealt(sel).alias("s"), cond).select(*[key(k) for k in keys if k != "_rolled"], "value", "n")
    if rollup:
        j = _roll_up_timeslices(j)
    out = j.groupBy(*keys).agg(F.sum("value").alias("v_sum"), F.sum("n").alias("v_cnt"))
    return out.drop("_r_ts", "_rolled") if rollup else out


def _roll_up_timeslices(parts: DataFrame) -> DataFrame:
    """A rule's partials per timeslice -> those of the cells it asked for: one timeslice, 'All
    Periods', or (no timeslice) all of them. Only partials are copied, never fact rows, and
    sum and count add up, so means stay exact."""
    ts_cols = ["timeslice_id", "timeslice"]
    own = F.struct(F.lit(False).alias("_rolled"), F.col("timeslice_id").cast("int").alias("timeslice_id"), "timeslice")
    whole = F.struct(F.lit(True).alias("_rolled"), F.lit(0).alias("timeslice_id"), F.lit(DEFAULT_TIMESLICE).alias("timeslice"))
    r_ts = F.col("_r_ts")
    keep = r_ts.isNull() | (F.col("_rolled") == (r_ts == ALL_PERIODS_N))
    return parts.select(*[c for c in parts.columns if c not in ts_cols], F.inline(F.array(own, whole))).where(keep)


def cell_values(cells: DataFrame) -> DataFrame:
    """Sum, or mean for rate rules, cleaned: NULL and NaN read 0."""
    v = F.when(F.col("rate"), safe_ratio("v_sum", "v_cnt")).otherwise(F.col("v_sum"))
    return cells.select(*[c for c in cells.columns if c not in ("v_sum", "v_cnt")], clean(v).alias("value"))
