"""User-level operators over a source and a rule set.

Each function plans all the selected rules together (one fact scan) and
returns a DataFrame; nothing is collected except the calendar and the rule
tables, which are small by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.calendar import Calendar, collect_calendar, month_label
from cadence.functions.numeric import round4
from cadence.functions.text import DEFAULT_TIMESLICE, norm
from cadence.operators.blocks import daily_grid, monthly_grid, monthly_values
from cadence.operators.cells import cell_values, rule_cells
from cadence.operators.select import select_series
from cadence.operators.units import ambiguous_units, unit_factors
from cadence.sources.base import Source
from cadence.sources.rules import Prepared, RuleSet, prepare

MONTHLY_KINDS = {"flat", "nested", "stacked", "ratings"}


def calendar_of(source: Source) -> Calendar:
    return collect_calendar(source.period_starts())


def cells_of(source: Source, p: Prepared, daily: bool = False) -> DataFrame:
    return rule_cells(source, p.sel, daily=daily, props=p.properties(), expand=p.needs_timeslices(),
                      kinds=p.kinds())


def metric_cells(source: Source, rs: RuleSet, rule_ords=None, which: str = "standard", daily: bool = False) -> DataFrame:
    """The pivot input as long cells: per rule, object, band and month (and
    day): the sum, or the mean for rate rules; NULL/NaN read 0."""
    p = prepare(rs, which, rule_ords)
    c = cells_of(source, p, daily)
    if daily:
        c = c.withColumn("rate", F.lit(False))
    return cell_values(c)


def weighted_cells(source: Source, rs: RuleSet, weights: DataFrame, rule_ords=None, which: str = "standard", daily: bool = False) -> DataFrame:
    """metric_cells() with weighted series: ``weights`` is one row (key columns, weight) a series.
    A sum rule's cell is the sum of weight times value, a rate's the weighted mean."""
    p = prepare(rs, which, rule_ords)
    c = rule_cells(source, p.sel, daily=daily, props=p.properties(), expand=p.needs_timeslices(), kinds=p.kinds(), weights=weights)
    return cell_values(c)


def monthly_values_of(source: Source, p: Prepared) -> DataFrame:
    return monthly_values(source, p, p.names, p.units)


def metric_matrix(source: Source, rs: RuleSet, rule_ord: int, cal: Calendar | None = None) -> DataFrame:
    """One rule as the wide matrix: object × month columns (explicit calendar
    values, absent months 0.0), bands and names merged."""
    cal = cal or calendar_of(source)
    p = prepare(rs, "standard", [rule_ord]).only(MONTHLY_KINDS)
    vals = monthly_values_of(source, p)
    long = vals.select("object", month_label("month_start").alias("col_label"), round4("value").alias("value"))
    wide = long.groupBy("object").pivot("col_label", cal.labels).agg(F.first("value"))
    return wide.na.fill(0.0, subset=cal.labels)


def monthly_block(source: Source, rs: RuleSet, rule_ords=None, which: str = "standard",
                  cal: Calendar | None = None, with_total_row: bool = True, band_merge: str = "sum") -> DataFrame:
    """Monthly grids of the selected rules. ``band_merge`` says how the band values of a rate
    become one: their sum (the default) or their mean."""
    cal = cal or calendar_of(source)
    p = prepare(rs, which, rule_ords).only(MONTHLY_KINDS)
    return monthly_grid(source, p, cal, with_total_row=with_total_row, band_merge=band_merge)


def daily_block(source: Source, rs: RuleSet, rule_ords=None, cal: Calendar | None = None) -> DataFrame:
    cal = cal or calendar_of(source)
    p = prepare(rs, "standard", rule_ords).only({"daily"})
    return daily_grid(source, p, cal).cells


def rule_units(source: Source, rs: RuleSet, rule_ords=None, which: str = "standard") -> DataFrame:
    p = prepare(rs, which, rule_ords)
    return unit_factors(source, p.sel, p.units)


def no_data_rules(source: Source, rs: RuleSet, which: str = "standard") -> DataFrame:
    """Rules whose selection finds no series with data: only the fact's distinct series
    keys (and timeslices, where the fact has them) meet the selection, no cell is built."""
    p = prepare(rs, which)
    sel = select_series(source, p.sel, p.kinds(), p.properties()).alias("s")
    seen = source.observed(expand_timeslices=p.needs_timeslices(), properties=p.properties())
    match = F.lit(True)
    for k in source.key_cols:
        match = match & (F.col(f"f.{k}") == F.col(f"s.{k}"))
    if "timeslice" in source.fact_attrs:
        r_ts = F.col("s._r_ts")
        match = match & (r_ts.isNull() | (r_ts == DEFAULT_TIMESLICE.lower()) | (norm("f.timeslice") == r_ts))
    fed = sel.join(seen.alias("f"), match, "left_semi").select("rule_ord")
    return p.rules.join(fed, "rule_ord", "left_anti").select("rule_ord", "header", "property")


def report_findings(source: Source, rs: RuleSet) -> DataFrame:
    """What a user should know before trusting a report, ordered: (report, kind, rule_ord,
    subject, n). ``no data``: a rule finds no fact. ``no unit rule``: a rule asks for a unit
    that no conversion leads to (its factor is 1). ``several units``: a property's series are
    stored in n units. ``period repeats``: a period id has n rows, so its values count n times."""
    def rows(df, report, kind, rule, subject, n):
        return df.select(F.lit(report).alias("report"), F.lit(kind).alias("kind"), rule.cast("int").alias("rule_ord"),
                         subject.cast("string").alias("subject"), n.cast("long").alias("n"))

    none = F.lit(None)
    parts = [rows(ambiguous_units(source), "source", "several units", none, F.col("property"), F.col("n_units"))]
    repeats = source.repeated_periods()
    if repeats is not None:
        parts.append(rows(repeats, "source", "period repeats", none, F.col("period"), F.col("n")))
    for which, table in (("standard", rs.standard), ("ratings", rs.ratings)):
        if table is None:
            continue
        parts.append(rows(no_data_rules(source, rs, which), which, "no data", F.col("rule_ord"), F.col("property"), none))
        units = rule_units(source, rs, which=which).where("unit_missing AND unit_to IS NOT NULL")
        change = F.concat(F.coalesce("db_unit", F.lit("?")), F.lit(" to "), F.col("unit_to"))
        parts.append(rows(units, which, "no unit rule", F.col("rule_ord"), change, none))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy("report", "kind", "rule_ord", "subject")
