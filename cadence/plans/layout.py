"""Layout: block grids -> ``report_cells`` (one row per report cell, with
section and row ordinals as data) -> text lines.

Row order is a sort key, not a position: (rule, parent, group, sub, object,
band, day, component), NULLs first. ``sub`` orders the kinds of rows inside a
block: title 0, header 1, data 2, component 3, total 4, spacer 5.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.calendar import Calendar
from cadence.functions.numeric import round4
from cadence.functions.text import alias_label, nested_subheader
from cadence.operators.blocks import DAY_ORD, DailyGrid, daily_columns
from cadence.operators.names import rename
from cadence.operators.ordering import numbered
from cadence.operators.totals import CELLS, column_list, dense_cells

TOTAL_ROW_LABEL = "Total"

SUB_TITLE, SUB_HEADER, SUB_DATA, SUB_COMPONENT, SUB_TOTAL, SUB_SPACER = 0, 1, 2, 3, 4, 5


def _cells(df: DataFrame, report: str, section: Column, section_ord: Column, *, parent=None, group=None, sub,
           obj=None, band=None, day=None, comp=None, row_kind, row_label, col_ord=None, col_label=None, value=None,
           text=None, kept: tuple[str, ...] = ()) -> DataFrame:
    def c(x, t):
        if x is None:
            return F.lit(None).cast(t)
        return (F.col(x) if isinstance(x, str) else x).cast(t)

    return df.select(
        F.lit(report).alias("report"),
        section_ord.cast("long").alias("section_ord"),
        section.alias("section"),
        F.col("rule_ord").cast("int").alias("rule_ord"),
        c(parent, "string").alias("s_parent"),
        c(group, "string").alias("s_group"),
        F.lit(sub).cast("int").alias("s_sub") if isinstance(sub, int) else c(sub, "int").alias("s_sub"),
        c(obj, "string").alias("s_obj"),
        c(band, "int").alias("s_band"),
        c(day, "int").alias("s_day"),
        c(comp, "int").alias("s_comp"),
        F.lit(row_kind).alias("row_kind") if isinstance(row_kind, str) else row_kind.alias("row_kind"),
        c(row_label, "string").alias("row_label"),
        c(col_ord, "int").alias("col_ord"),
        c(col_label, "string").alias("col_label"),
        c(value, "double").alias("value"),
        c(text, "string").alias("text"),
        *kept,
    )


def _row_cells(rows: DataFrame, cols: list[tuple], *place, **what) -> DataFrame:
    """Report rows as cells: a row's keys and labels are worked out once, before completion."""
    laid = _cells(rows, *place, kept=(CELLS,), **what)
    names = [c for c in laid.columns if c != CELLS]
    # the daily block's last column shows the row's day
    return dense_cells(laid.drop("col_ord", "col_label", "value"), cols, {DAY_ORD: F.col("s_day")}).select(*names)


def _rule_info(rules: DataFrame) -> DataFrame:
    return F.broadcast(rules.select(
        F.col("rule_ord").alias("_ri_rule"), "header", "kind", "summary", "class", "categories",
        F.col("property").alias("_ri_prop"), "alias", "parent_class", "summary_text",
    ))


def _with_rule(rows: DataFrame, rules: DataFrame) -> DataFrame:
    ri = _rule_info(rules)
    return rows.join(ri, rows.rule_ord == ri._ri_rule, "inner").drop("_ri_rule")


def standard_cells(monthly: DataFrame | None, daily: DailyGrid | None, rules: DataFrame, names: DataFrame | None,
                   cal: Calendar, components=None, report: str = "Standard") -> DataFrame:
    """Lay out the standard report from its monthly report rows and its daily grid: sections
    are headers in first-seen rule order; blocks follow rule order."""
    sec = rules.groupBy("header").agg(F.min("rule_ord").alias("_sec_ord"))
    sec_b = F.broadcast(sec.withColumnRenamed("header", "_sec_header"))

    def with_section(df):
        return df.join(sec_b, df.header == sec_b._sec_header, "inner").drop("_sec_header")

    parts = []
    section, section_ord = F.col("header"), F.col("_sec_ord")
    cols = column_list(cal)
    if monthly is not None:
        m = with_section(_with_rule(monthly, rules))

        # flat: data rows by object, then the Total row.
        flat = m.where((F.col("kind") == "flat") & ~F.col("summary"))
        parts.append(_row_cells(flat, cols, report, section, section_ord, sub=F.when(F.col("row_kind") == "data", SUB_DATA).otherwise(SUB_TOTAL),
                                obj="object", row_kind=F.col("row_kind"),
                                row_label=F.when(F.col("row_kind") == "data", F.col("object")).otherwise(F.lit(TOTAL_ROW_LABEL))))
        # monthly-summary: only the Total row, labelled class-categories-property-Total.
        summ = m.where(F.col("summary") & (F.col("kind") == "flat") & (F.col("row_kind") == "total"))
        parts.append(_row_cells(summ, cols, report, section, section_ord, sub=SUB_TOTAL, row_kind="summary",
                                row_label=F.col("summary_text")))
        # nested: per parent a sub-header, the parent's rows, its Total row and a spacer.
        nest = m.where(F.col("kind") == "nested")
        nest = nest.where(~F.col("summary") | (F.col("row_kind") == "total"))
        nest_label = F.when(F.col("summary"), F.col("summary_text")) \
            .when(F.col("row_kind") == "data", F.col("object")).otherwise(F.lit(TOTAL_ROW_LABEL))
        parts.append(_row_cells(nest, cols, report, section, section_ord, parent="parent",
                                sub=F.when(F.col("row_kind") == "data", SUB_DATA).otherwise(SUB_TOTAL), obj="object",
                                row_kind=F.col("row_kind"), row_label=nest_label))
        heads = nest.select("rule_ord", "header", "_sec_ord", "parent", "parent_class").distinct()
        heads = rename(heads.withColumn("object", F.col("parent")), names).withColumnRenamed("object", "_mapped_parent")
        parts.append(_cells(heads, report, section, section_ord, parent="parent", sub=SUB_TITLE, row_kind="title",
                            row_label=nested_subheader(F.col("_mapped_parent"), F.col("parent_class"))))
        parts.append(_cells(heads, report, section, section_ord, parent="parent", sub=SUB_SPACER, row_kind="spacer",
                            row_label=F.lit("")))

        # stacked components: per object of the primary component a header row, the
        # object row (sum of components), one row per component, a spacer.
        st = m.where((F.col("kind") == "stacked") & (F.col("row_kind") == "data"))
        parts.extend(_stacked_cells(st, rules, report, section, section_ord, cal, components))

    if daily is not None:
        d = with_section(_with_rule(daily.rows, rules))
        objs = with_section(_with_rule(daily.objects, rules))
        parts.extend(_daily_cells(d, objs, report, section, section_ord, cal))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _stacked_cells(st: DataFrame, rules: DataFrame, report: str, section: Column, section_ord: Column,
                   cal: Calendar, components=None) -> list[DataFrame]:
    from cadence.sources.rules import FUEL_COMPONENTS

    comps = list(components or FUEL_COMPONENTS)
    primary = min(i for i, c in enumerate(comps) if c[1])
    keys = ["rule_ord", "header", "_sec_ord", "object"]
    # an object's components, one map each, side by side: its cells are lookups, nothing dense is shuffled
    by_comp = F.map_from_entries(F.collect_list(F.when(F.col("component").isNotNull(), F.struct("component", CELLS))))
    objs = st.groupBy(*keys).agg(by_comp.alias("_comps")).where(F.col("_comps")[primary].isNotNull())
    cols = objs.select("*", F.inline(cal.month_array())).drop("month_start", "year")

    def cell(i: int) -> Column:
        return F.coalesce(F.col("_comps")[i][F.col("col_ord")], F.lit(0.0))

    # component rows: every listed component for every primary object; absent -> 0
    comp_arr = F.array(*[F.struct(F.lit(i).alias("comp"), F.lit(c[0]).alias("label"), cell(i).alias("value")) for i, c in enumerate(comps)])
    parts = [_cells(cols.select(*keys, "col_ord", "col_label", F.inline(comp_arr)), report, section, section_ord, group="object", sub=SUB_COMPONENT, comp="comp",
                    row_kind="component", row_label=F.col("label"), col_ord="col_ord", col_label="col_label",
                    value="value")]
    total = reduce(lambda a, i: a + cell(i), range(1, len(comps)), cell(0))
    parts.append(_cells(cols.withColumn("value", total), report, section, section_ord, group="object", sub=SUB_DATA, row_kind="data",
                        row_label="object", col_ord="col_ord", col_label="col_label", value="value"))
    hdr = objs.select(*keys, F.inline(cal.month_array()))
    parts.append(_cells(hdr, report, section, section_ord, group="object", sub=SUB_HEADER, row_kind="header",
                        row_label=F.lit(""), col_ord="col_ord", col_label="col_label", text="col_label"))
    parts.append(_cells(objs, report, section, section_ord, group="object", sub=SUB_SPACER, row_kind="spacer",
                        row_label=F.lit("")))
    return parts


def _daily_cells(d: DataFrame, objs: DataFrame, report: str, section: Column, section_ord: Column, cal: Calendar) -> list[DataFrame]:
    """Per object: a title row, its band × day rows (labelled by their running
    number, blank for the first) with the Day_Id column, a spacer."""
    lab = F.when(F.col("row_idx") == 0, F.lit(" ")).otherwise(F.col("row_idx").cast("string"))
    parts = [_row_cells(d, daily_columns(cal), report, section, section_ord, group="object", sub=SUB_DATA, band="band", day="day",
                        row_kind="data", row_label=lab)]
    parts.append(_cells(objs, report, section, section_ord, group="object", sub=SUB_TITLE, row_kind="title",
                        row_label="object"))
    parts.append(_cells(objs, report, section, section_ord, group="object", sub=SUB_SPACER, row_kind="spacer",
                        row_label=F.lit("")))
    return parts


def ratings_cells(monthly: DataFrame, rules: DataFrame, cal: Calendar, report: str = "Ratings") -> DataFrame:
    """One section per timeslice (ordered by timeslice id); rows `object:alias`,
    no Total row."""
    m = _with_rule(monthly, rules).where(F.col("row_kind") == "data")
    return _row_cells(m, column_list(cal), report, F.col("timeslice"), F.col("timeslice_id"), sub=SUB_DATA, obj="object", row_kind="data",
                      row_label=alias_label(F.col("object"), F.col("alias")))


# ---------------------------------------------------------------------------
# Text view (the CSV-like report file)
# ---------------------------------------------------------------------------
def number_text(v) -> Column:
    """A number as the report prints it: rounded to 4 places, trailing zeros
    dropped but one decimal kept (1.5, 20.0, 0.2272)."""
    r = round4(v)
    s = F.regexp_replace(F.format_string("%.4f", r), "0+$", "")
    s = F.when(s.endswith("."), F.concat(s, F.lit("0"))).otherwise(s)
    # whole numbers (below 2**53 a double's digits are those of the bigint) need no formatter
    return F.when((r == F.rint(r)) & (F.abs(r) < F.lit(float(2**53))), F.concat(r.cast("bigint").cast("string"), F.lit(".0"))).otherwise(s)


def _csv_field(c: Column) -> Column:
    """Quote a field holding a comma, quote or line break (RFC 4180)."""
    needs = c.rlike('[",\\r\\n]')
    return F.when(needs, F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))).otherwise(c)


ROW_SORT = ["s_parent", "s_group", "s_sub", "s_obj", "s_band", "s_day", "s_comp"]


def report_lines(cells: DataFrame) -> DataFrame:
    """report_cells -> (report, section_ord, line_key..., line) text lines:
    section title, header line, one line per row, blank line. Each line is
    built by its own group (one report row), never a whole section."""
    cols = cells.where(F.col("col_label").isNotNull()).groupBy("report", "section_ord", "section").agg(
        F.sort_array(F.collect_set(F.struct("col_ord", "col_label"))).alias("_cols")
    )
    # header: '' then the section's columns in ordinal order (bounded by the calendar)
    header = cols.select(
        "report", "section_ord", "section", F.lit(1).alias("_lk"),
        F.concat(F.lit(","), F.array_join(F.transform("_cols", lambda x: _csv_field(x["col_label"])), ",")).alias("line"),
        F.lit(None).cast("int").alias("rule_ord"), *[F.lit(None).alias(c) for c in ROW_SORT],
    )
    title = cols.select("report", "section_ord", "section", F.lit(0).alias("_lk"), _csv_field(F.col("section")).alias("line"),
                        F.lit(None).cast("int").alias("rule_ord"), *[F.lit(None).alias(c) for c in ROW_SORT])
    blank = cols.select("report", "section_ord", "section", F.lit(3).alias("_lk"), F.lit("").alias("line"),
                        F.lit(None).cast("int").alias("rule_ord"), *[F.lit(None).alias(c) for c in ROW_SORT])
    rk = ["report", "section_ord", "section", "rule_ord"] + ROW_SORT + ["row_label"]
    txt = F.coalesce(F.col("text"), F.when(F.col("value").isNotNull(), number_text(F.col("value"))), F.lit(""))
    rows = cells.groupBy(*rk).agg(
        F.map_from_entries(F.collect_list(
            F.when(F.col("col_ord").isNotNull(), F.struct("col_ord", txt.alias("t")))
        )).alias("_m")
    ).join(F.broadcast(cols.select("report", "section_ord", "_cols")), ["report", "section_ord"], "inner")
    body = rows.select(
        "report", "section_ord", "section", F.lit(2).alias("_lk"),
        F.concat(
            _csv_field(F.coalesce(F.col("row_label"), F.lit(""))), F.lit(","),
            F.array_join(F.transform("_cols", lambda x: F.coalesce(_csv_field(F.col("_m")[x["col_ord"]]), F.lit(""))), ","),
        ).alias("line"),
        "rule_ord", *ROW_SORT,
    )
    out = title.unionByName(header).unionByName(body).unionByName(blank)
    return out.withColumnRenamed("_lk", "line_kind")


LINE_ORDER = ["report", "section_ord", "line_kind", "rule_ord"] + ROW_SORT


def ordered_lines(lines: DataFrame) -> DataFrame:
    return lines.orderBy(*[F.col(c).asc_nulls_first() for c in LINE_ORDER])


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Lines with ``line_no``, their number in their section (from 1)."""
    known = numbered(lines, [F.col(c).asc_nulls_first() for c in LINE_ORDER], "_line")
    first = known.groupBy("report", "section_ord").agg(F.min("_line").alias("_first"))
    return known.join(first, ["report", "section_ord"]).withColumn("line_no", F.col("_line") - F.col("_first") + 1).drop("_line", "_first")


def write_lines(lines: DataFrame, path: str, parts: int | None = None, by_section: bool = True) -> None:
    """Lines as text, a folder for each section (or, not ``by_section``, one for all): ranges of the whole order, so a section
    of any size is dealt over as many files as it has ranges; the files' numbers are their
    order. ``parts`` is the number of ranges; by default what adaptive execution makes of it."""
    order = [F.col(c).asc_nulls_first() for c in ["section_ord", *(c for c in LINE_ORDER if c not in ("report", "section_ord"))]]
    dealt = lines.repartitionByRange(parts, *order) if parts else lines.repartitionByRange(*order)
    rows = dealt.sortWithinPartitions(*order)
    if by_section:
        rows.select("section_ord", "line").write.mode("overwrite").partitionBy("section_ord").text(path)
    else:
        rows.select("line").write.mode("overwrite").text(path)
