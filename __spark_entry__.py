"""

Every query reads the given tables (lineitem as the fact of a solution analog,
supplier ⋈ nation ⋈ region as its series dimension) through the engine in
``cadence``; the rule tables are configuration (``cadence.analog``). Floats are
rounded to 4 places on both sides, the report's own precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence import analog
from cadence import oracle as O
from cadence.api import (
    daily_block,
    metric_cells,
    metric_matrix,
    monthly_block,
    no_data_rules,
    report_findings,
    rule_units,
)
from cadence.functions.calendar import calendar_frame
from cadence.functions.numeric import round4
from cadence.functions.numeric import round4_sql as R4
from cadence.session import configure
from cadence.sources.star import lineitem_source

SMOKE_DIR = "/root/testdata/sf0.001"


def _src(spark: SparkSession, sf_dir: str):
    configure(spark)
    return lineitem_source(spark, sf_dir)


def _rs(spark, ords=None, names=True, units=True, ratings=None):
    std = analog.STANDARD if ords is None else analog.rules_by_ord(ords)
    return analog.ruleset(spark, standard=std, ratings=ratings if ratings is not None else [], names=names, units=units)


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def q_calendar(spark, sf):
    return calendar_frame(_src(spark, sf).period_starts())


def _cells_q(spark, sf, ords, extra=None):
    std = analog.rules_by_ord(ords) + (extra or [])
    rs = analog.ruleset(spark, standard=std, ratings=[])
    c = metric_cells(_src(spark, sf), rs)
    return c.select("rule_ord", "object", "band", "month_start", round4("value").alias("value"))


def q_metric_cells_sum(spark, sf):
    return _cells_q(spark, sf, [1])


def q_metric_cells_rate(spark, sf):
    return _cells_q(spark, sf, [2])


FILTER_RULE = (10, "( 7 ) Filtered", "Supplier", "AsiaEurope", "Quantity", "monthly", False, None)


def q_filter_category(spark, sf):
    return _cells_q(spark, sf, [], [FILTER_RULE])


def q_monthly_matrix(spark, sf):
    src = _src(spark, sf)
    return metric_matrix(src, _rs(spark, [1]), 1)


def q_name_map_merge(spark, sf):
    from cadence.operators.blocks import monthly_values
    from cadence.sources.rules import prepare

    p = prepare(_rs(spark, [1], units=False))
    v = monthly_values(_src(spark, sf), p, p.names, None)
    return v.select("rule_ord", "object", "month_start", round4("value").alias("value"))


def q_unit_scale(spark, sf):
    u = rule_units(_src(spark, sf), _rs(spark, [1, 2, 3, 4, 8, 9]))
    return u.select("rule_ord", "db_unit", "unit_to", round4("factor").alias("factor"), "unit_missing")


def _block_q(spark, sf, ords, with_total_row=True):
    g = monthly_block(_src(spark, sf), _rs(spark, ords), with_total_row=with_total_row)
    return g.select("rule_ord", "row_kind", "object", "col_label", round4("value").alias("value"))


def q_flat_block_sum(spark, sf):
    return _block_q(spark, sf, [1])


def q_flat_block_rate(spark, sf):
    return _block_q(spark, sf, [2])


def q_monthly_summary(spark, sf):
    from cadence.plans.reports import standard_report

    rs = _rs(spark, [3, 4])
    cells = standard_report(_src(spark, sf), rs)
    return cells.where(F.col("row_kind") == "summary").select(
        "rule_ord", "row_label", "col_label", round4("value").alias("value"))


def q_daily_block(spark, sf):
    g = daily_block(_src(spark, sf), _rs(spark, [7]))
    g = g.where(F.col("col_kind") != "extra")
    return g.select("rule_ord", "object", "band", "day", "col_label", round4("value").alias("value"))


def q_nested_block(spark, sf):
    g = monthly_block(_src(spark, sf), _rs(spark, [6]))
    return g.select("rule_ord", "parent", "row_kind", "object", "col_label", round4("value").alias("value"))


def q_ratings_block(spark, sf):
    rs = analog.ruleset(spark, standard=[], ratings=[analog.RATINGS[0]])
    g = monthly_block(_src(spark, sf), rs, which="ratings", with_total_row=False)
    return g.select("rule_ord", "timeslice", "object", "col_label", round4("value").alias("value"))


def _ratings_cells(spark, sf):
    from cadence.plans.reports import timeslice_report

    return timeslice_report(_src(spark, sf), analog.ruleset(spark, standard=[]))


def q_timeslice_report(spark, sf):
    c = _ratings_cells(spark, sf)
    return c.select("section", "section_ord", "rule_ord", "row_label", "col_label", round4("value").alias("value"))


def q_stacked_components(spark, sf):
    from cadence.plans.reports import standard_report

    c = standard_report(_src(spark, sf), _rs(spark, [5]))
    return c.select(F.col("s_group").alias("object"), "row_kind", "row_label", "s_comp", "col_label",
                    round4("value").alias("value"), "text")


def q_emissions_block(spark, sf):
    from cadence.plans.reports import emissions_report

    c = emissions_report(_src(spark, sf), analog.ruleset(spark, standard=[], ratings=[]))
    return c.select("rule_ord", "row_kind", "row_label", "col_label", round4("value").alias("value"))


REPORT_COLS = ["section", "section_ord", "rule_ord", "row_kind", "row_label", "s_parent", "s_group", "s_band",
               "s_day", "s_comp", "col_label"]


def q_rule_driven_report(spark, sf):
    from cadence.plans.reports import standard_report

    c = standard_report(_src(spark, sf), _rs(spark))
    return c.select(*REPORT_COLS, round4("value").alias("value"), "text")


def q_report_lines(spark, sf):
    from cadence.plans.layout import report_lines

    lines = report_lines(_ratings_cells(spark, sf))
    return lines.select("section_ord", "line_kind", "rule_ord", "s_obj", "line")


def _written_report(spark, sf, parts=None):
    import uuid

    from cadence.plans.reports import write_report
    from cadence.session import checkpoint_dir

    out = f"{checkpoint_dir(spark).rstrip('/')}/report-text-{uuid.uuid4().hex}"
    write_report(_ratings_cells(spark, sf), out, "Ratings_Report", parts)
    return f"{out}/Ratings_Report"


def q_sections_from_text(spark, sf):
    from cadence.plans.reports import read_report

    cells = read_report(spark, _written_report(spark, sf), text=True)
    return cells.select("section", "row_label", "col_label", "value")


#: Ranges of lines that report_text_parts writes, so that sections span several files.
TEXT_PARTS = 24


def q_report_text_parts(spark, sf):
    from cadence.plans.reports import report_text

    return report_text(spark, f"{_written_report(spark, sf, TEXT_PARTS)}_text")


def _perturbed(cells):
    """The generated side of the diff check: section A scaled within tolerance,
    section R shifted for one asset, section N missing a rule."""
    v = round4("value")
    v = (F.when(F.col("section") == "A", v * F.lit(1.0 + 1e-7))
         .when((F.col("section") == "R") & F.col("row_label").startswith("S-ONE"), v + F.lit(1.0))
         .otherwise(v))
    return cells.where(~((F.col("section") == "N") & (F.col("rule_ord") == 3))).withColumn("value", v)


def q_report_diff(spark, sf):
    from cadence.operators.diff import diff_sections, keyed

    cells = _ratings_cells(spark, sf).withColumn("text", F.lit(None).cast("string"))
    gold = keyed(cells.withColumn("value", round4("value")), ["rule_ord", "s_obj"])
    gen = keyed(_perturbed(cells), ["rule_ord", "s_obj"])
    return diff_sections(gold, gen)


EVENTS_DAILY = (1, "( 9 ) Daily Events", "User", "All", "Value", "daily", False, None)


def q_daily_events(spark, sf):
    from cadence.sources.star import events_source

    configure(spark)
    rs = analog.ruleset(spark, standard=[EVENTS_DAILY], ratings=[])
    g = daily_block(events_source(spark, sf), rs)
    g = g.where(F.col("col_kind") != "extra")
    return g.select("rule_ord", "object", "band", "day", "col_label", round4("value").alias("value"))


EVENTS_RATING = (1, "User", "All", "Value", "usd", None)


def q_events_timeslice_report(spark, sf):
    from cadence.plans.reports import timeslice_report
    from cadence.sources.star import events_source

    configure(spark)
    rs = analog.ruleset(spark, standard=[], ratings=[EVENTS_RATING])
    c = timeslice_report(events_source(spark, sf), rs)
    return c.select("section", "section_ord", "rule_ord", "row_label", "col_label", round4("value").alias("value"))


def q_no_data_rules(spark, sf):
    return no_data_rules(_src(spark, sf), _rs(spark))


FINDING_RULE = (10, "( 7 ) Filtered", "Supplier", "AsiaEurope", "Quantity", "monthly", False, "furlongs")


def q_report_findings(spark, sf):
    rs = analog.ruleset(spark, standard=analog.STANDARD + [FINDING_RULE])
    return report_findings(_src(spark, sf), rs)


def q_solution_findings(spark, sf):
    configure(spark)
    return report_findings(analog.solution(spark, sf), analog.ruleset(spark, standard=[analog.STANDARD[0], FINDING_RULE], ratings=[analog.RATINGS[1]]))


def q_solution_flat_block(spark, sf):
    configure(spark)
    g = monthly_block(analog.solution(spark, sf), _rs(spark, [1]))
    return g.select("rule_ord", "row_kind", "object", "col_label", round4("value").alias("value"))


def q_object_name_fallback(spark, sf):
    configure(spark)
    g = monthly_block(analog.solution(spark, sf, blank_names=True), _rs(spark, [1], names=False))
    return g.select("rule_ord", "row_kind", "object", "col_label", round4("value").alias("value"))


def q_solution_timeslice_report(spark, sf):
    configure(spark)
    rs = analog.ruleset(spark, standard=[], ratings=[analog.RATINGS[0]])
    g = monthly_block(analog.solution(spark, sf), rs, which="ratings", with_total_row=False)
    return g.select("rule_ord", "timeslice", "object", "col_label", round4("value").alias("value"))


def q_series_statistics(spark, sf):
    from cadence.operators.statistics import QUARTILES, series_statistics

    configure(spark)
    rows = analog.sampled_solution(spark, sf).facts()
    out = series_statistics(rows, ["SeriesId"], "Value", "PeriodId")
    real = ["Sum", "Min", "Max", "StandardDeviation", "Mode", *QUARTILES]
    return out.select(*(round4(c).alias(c) if c in real else c for c in out.columns))


SAMPLED_RULES = [(11, "( 9 ) Sums", "Supplier", "All", "Quantity", "monthly", False, None),
                 (12, "( 9 ) Means", "Supplier", "AsiaEurope", "Quantity", "monthly", True, None)]


def q_filtered_cells(spark, sf):
    configure(spark)
    src = analog.sampled_solution(spark, sf).filtered(phase="ST Schedule", model=" base", sample=["S0", "s2"], period_type="INTERVAL")
    c = metric_cells(src, analog.ruleset(spark, standard=SAMPLED_RULES, ratings=[]))
    return c.select("rule_ord", "object", "band", "month_start", round4("value").alias("value"))


def q_weighted_cells(spark, sf):
    from cadence.api import weighted_cells

    configure(spark)
    src = analog.sampled_solution(spark, sf).filtered(period_type="Interval")
    weights = src.sample_weights(analog.sample_weights(spark))
    c = weighted_cells(src, analog.ruleset(spark, standard=SAMPLED_RULES, ratings=[]), weights)
    return c.select("rule_ord", "object", "band", "month_start", round4("value").alias("value"))


def q_incremental_cells(spark, sf):
    """The fact comes in two appends, each taken up by the stream; the cells are those of the store."""
    import uuid

    from cadence.session import checkpoint_dir
    from cadence.streaming.partials import PartialStore, StoredSource

    configure(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/incremental-{uuid.uuid4().hex}"
    src = analog.solution(spark, sf)
    store = PartialStore(spark, f"{base}/partials")
    for appended in ("SeriesId % 3 = 0", "SeriesId % 3 <> 0"):
        src.facts().where(appended).write.mode("append").partitionBy("dataFileId").parquet(f"{base}/data")
        store.follow(f"{base}/data", src, FILES_PER_BATCH).awaitTermination()
    c = metric_cells(StoredSource(src, store), _rs(spark, [1]))
    return c.select("rule_ord", "object", "band", "month_start", round4("value").alias("value"))


def q_published_report(spark, sf):
    """The Ratings report as a publication, read back as the current one; the second call finds it whole."""
    import uuid

    from cadence.plans.publish import publish, read_current
    from cadence.session import checkpoint_dir

    src = _src(spark, sf)
    out = f"{checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex}"
    for _ in range(2):
        publish(src, analog.ruleset(spark, standard=[]), out, "first")
    cells = read_current(spark, out, "Ratings_Report")
    return cells.select("section", "row_label", "col_label", round4("value").alias("value"))


#: Files of an append that incremental_cells takes into one batch.
FILES_PER_BATCH = 16


#: Column -> predicate that schema_contract holds the test star's values against.
DOMAINS = {"band": "band BETWEEN 1 AND 6", "value": "value < 50000", "property": "property IN ('Quantity', 'Discount', 'Tax')"}


def q_schema_contract(spark, sf):
    from cadence.plans.contract import check_source

    return check_source(_src(spark, sf), DOMAINS)


# ---------------------------------------------------------------------------
# Oracle side
# ---------------------------------------------------------------------------
def _cells_sql(rule) -> str:
    ro, _, cls, group, prop, _, rate, _ = rule
    pred = O.where(prop, cls, O.categories(cls, group))
    return f"""
    WITH obs AS ({O.OBS}), cell AS ({O.cells_sql(prop, rate, pred)})
    SELECT {ro} AS rule_ord, object, band, month_start, {R4(O.clean())} AS value FROM cell
    """


def _monthly_matrix_sql() -> str:
    inner = O.flat_rule_sql(1, total_row=False)
    # every month of the tables, by name: a view cannot store a PIVOT without a list
    names = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    months = [f"{m}-{y}" for y in range(1995, 2002) for m in names][:83]
    cells = ", ".join(f'COALESCE("{m}", 0.0) AS "{m}"' for m in months)
    listed = ", ".join(O.q(m) for m in months)
    return f"""
    SELECT object, {cells} FROM (
        PIVOT (SELECT object, col_label, value FROM ({inner}) b
               WHERE row_kind = 'data' AND col_label NOT LIKE 'Tot%')
        ON col_label IN ({listed}) USING first(value) GROUP BY object)
    """


def _name_map_sql() -> str:
    pred = O.where("Quantity", "Supplier", O.categories("Supplier", "All"))
    return f"""
    WITH obs AS ({O.OBS}), cell AS ({O.cells_sql('Quantity', False, pred)}),
    cl AS (SELECT object, band, month_start, {O.clean()} AS v FROM cell)
    SELECT 1 AS rule_ord, COALESCE(nm.dst, c.object) AS object, c.month_start, {R4('SUM(c.v)')} AS value
    FROM cl c LEFT JOIN ({O.names_cte()}) nm ON c.object = nm.src GROUP BY ALL
    """


def _unit_scale_sql() -> str:
    rules = ", ".join(
        f"({r[0]}, {O.q(r[4])}, {O.q(None if O.blank(r[7]) else r[7].strip())})"
        for r in analog.STANDARD if r[0] in (1, 2, 3, 4, 8, 9)
    )
    props = ", ".join(f"({O.q(p)}, {O.q(u)})" for p, (_, u) in O.MEASURES.items())
    units = ", ".join(f"({i}, {O.q(a)}, {O.q(b)}, {c!r})" for i, (a, b, c) in enumerate(analog.UNITS))
    return f"""
    WITH r(rule_ord, prop, unit_to) AS (VALUES {rules}),
    p(prop, unit) AS (SELECT * FROM (VALUES {props}) v(prop, unit) WHERE EXISTS (SELECT 1 FROM supplier)),
    u(o, uf, ut, rate) AS (VALUES {units}),
    ru AS (SELECT r.rule_ord, p.unit AS db_unit, r.unit_to FROM r LEFT JOIN p ON lower(trim(r.prop)) = p.prop),
    m AS (SELECT ru.*, u.rate, row_number() OVER (PARTITION BY ru.rule_ord ORDER BY u.o NULLS LAST) AS rn
          FROM ru LEFT JOIN u ON lower(ru.db_unit) = lower(u.uf) AND lower(trim(ru.unit_to)) = lower(u.ut))
    SELECT rule_ord, db_unit, unit_to, {R4('COALESCE(rate, 1.0)')} AS factor, rate IS NULL AS unit_missing
    FROM m WHERE rn = 1
    """


def _summary_sql() -> str:
    parts = []
    for ro in (3, 4):
        _, _, cls, group, prop, _, _, _ = O.std_rule(ro)
        cats = O.categories(cls, group)
        label = f"{cls.strip()}-{'-'.join(cats) if cats else 'all'}-{prop.strip()}-Total"
        parts.append(f"SELECT rule_ord, {O.q(label)} AS row_label, col_label, value FROM ({O.flat_rule_sql(ro)}) b "
                     f"WHERE row_kind = 'total'")
    return " UNION ALL ".join(parts)


def _daily_sql() -> str:
    _, _, cls, _, prop, _, _, _ = O.std_rule(7)
    pred = O.where(prop, cls)
    return f"""
    WITH obs AS ({O.OBS}), cal AS ({O.CAL}),
    cell AS ({O.cells_sql(prop, False, pred, daily=True)}),
    cl AS (SELECT object, band, month_start, day, {O.clean()} AS v FROM cell),
    mapped AS (SELECT COALESCE(nm.dst, c.object) AS object, c.band, c.month_start, c.day, SUM(c.v) AS v
               FROM cl c LEFT JOIN ({O.names_cte()}) nm ON c.object = nm.src GROUP BY ALL),
    objs AS (SELECT DISTINCT object FROM mapped), bands AS (SELECT DISTINCT band FROM mapped),
    days AS (SELECT CAST(range AS INTEGER) AS day FROM range(1, 32)),
    grid AS (SELECT o.object, b.band, d.day, cal.month_start, COALESCE(m.v, 0.0) AS v
             FROM objs o CROSS JOIN bands b CROSS JOIN days d CROSS JOIN cal
             LEFT JOIN mapped m ON m.object = o.object AND m.band = b.band AND m.day = d.day
                               AND m.month_start = cal.month_start),
    rws AS (
      SELECT object, band, day, strftime(month_start, '%b-%Y') AS col_label, v FROM grid
      UNION ALL SELECT object, band, day, 'Tot-' || CAST(year(month_start) AS VARCHAR), SUM(v) FROM grid
                GROUP BY object, band, day, year(month_start)
      UNION ALL SELECT object, band, day, 'Total', SUM(v) FROM grid GROUP BY object, band, day)
    SELECT 7 AS rule_ord, object, band, day, col_label, {R4('v')} AS value FROM rws
    """


def _daily_events_sql() -> str:
    return f"""
    WITH obs AS (SELECT 'User#' || CAST(user_id AS VARCHAR) AS object, 1 AS band,
                        CAST(date_trunc('month', ts) AS DATE) AS month_start, CAST(day(ts) AS INTEGER) AS day,
                        CAST(value AS DOUBLE) AS v
                 FROM events WHERE user_id IS NOT NULL),
    cal AS (SELECT DISTINCT CAST(date_trunc('month', ts) AS DATE) AS month_start FROM events WHERE ts IS NOT NULL),
    cell AS (SELECT object, band, month_start, day, SUM(v) AS v FROM obs GROUP BY ALL),
    mapped AS (SELECT COALESCE(nm.dst, c.object) AS object, c.band, c.month_start, c.day, SUM({O.clean('c.v')}) AS v
               FROM cell c LEFT JOIN ({O.names_cte()}) nm ON c.object = nm.src GROUP BY ALL),
    objs AS (SELECT DISTINCT object FROM mapped), bands AS (SELECT DISTINCT band FROM mapped),
    days AS (SELECT CAST(range AS INTEGER) AS day FROM range(1, 32)),
    grid AS (SELECT o.object, b.band, d.day, cal.month_start, COALESCE(m.v, 0.0) AS v
             FROM objs o CROSS JOIN bands b CROSS JOIN days d CROSS JOIN cal
             LEFT JOIN mapped m ON m.object = o.object AND m.band = b.band AND m.day = d.day
                               AND m.month_start = cal.month_start),
    rws AS (
      SELECT object, band, day, strftime(month_start, '%b-%Y') AS col_label, v FROM grid
      UNION ALL SELECT object, band, day, 'Tot-' || CAST(year(month_start) AS VARCHAR), SUM(v) FROM grid
                GROUP BY object, band, day, year(month_start)
      UNION ALL SELECT object, band, day, 'Total', SUM(v) FROM grid GROUP BY object, band, day)
    SELECT 1 AS rule_ord, object, band, day, col_label, {R4('v')} AS value FROM rws
    """


def _events_timeslice_sql() -> str:
    return f"""
    WITH obs AS (SELECT 'User#' || CAST(user_id AS VARCHAR) AS object, 1 AS band,
                        CAST(date_trunc('month', ts) AS DATE) AS month_start,
                        event_type AS tsn, ascii(event_type) * 1000 + length(event_type) AS ts_id,
                        CAST(value AS DOUBLE) AS v
                 FROM events WHERE user_id IS NOT NULL),
    obs2 AS (SELECT * FROM obs UNION ALL SELECT object, band, month_start, 'All Periods', 0, v FROM obs),
    cal AS (SELECT DISTINCT CAST(date_trunc('month', ts) AS DATE) AS month_start FROM events WHERE ts IS NOT NULL),
    cell AS (SELECT tsn, ts_id, object, band, month_start, SUM(v) AS v FROM obs2 GROUP BY ALL),
    mapped AS (SELECT c.tsn, c.ts_id, COALESCE(nm.dst, c.object) AS object, c.month_start, SUM({O.clean('c.v')}) AS v
               FROM cell c LEFT JOIN ({O.names_cte()}) nm ON c.object = nm.src GROUP BY ALL),
    objs AS (SELECT DISTINCT tsn, ts_id, object FROM mapped),
    grid AS (SELECT o.tsn, o.ts_id, o.object, cal.month_start, COALESCE(m.v, 0.0) AS v
             FROM objs o CROSS JOIN cal LEFT JOIN mapped m
             ON m.object = o.object AND m.tsn = o.tsn AND m.month_start = cal.month_start),
    rws AS (
      SELECT tsn, ts_id, object, strftime(month_start, '%b-%Y') AS col_label, v FROM grid
      UNION ALL SELECT tsn, ts_id, object, 'Tot-' || CAST(year(month_start) AS VARCHAR), SUM(v) FROM grid
                GROUP BY tsn, ts_id, object, year(month_start)
      UNION ALL SELECT tsn, ts_id, object, 'Total', SUM(v) FROM grid GROUP BY tsn, ts_id, object)
    SELECT tsn AS section, CAST(ts_id AS BIGINT) AS section_ord, 1 AS rule_ord, object || ':usd' AS row_label,
           col_label, {R4('v')} AS value FROM rws
    """


def _ratings_sql(rules=None) -> str:
    rules = analog.RATINGS if rules is None else rules
    return " UNION ALL ".join(O.ratings_rule_sql(r) for r in rules)


def _timeslice_report_sql() -> str:
    return f"""SELECT ts AS section, CAST(ts_id AS BIGINT) AS section_ord, rule_ord, row_label, col_label, value
               FROM ({_ratings_sql()}) x"""


def _stacked_sql() -> str:
    pq = O.where("Quantity", "Supplier", O.categories("Supplier", "All"))
    pt = O.where("Tax", "Supplier", O.categories("Supplier", "Europe"))
    comps = ", ".join(f"({i}, {O.q(c[0])})" for i, c in enumerate(analog.COMPONENTS))

    def mapped(prop, pred):
        return (f"SELECT COALESCE(nm.dst, c.object) AS object, c.month_start, SUM({O.clean('c.v')}) AS v "
                f"FROM ({O.cells_sql(prop, False, pred)}) c LEFT JOIN ({O.names_cte()}) nm ON c.object = nm.src "
                f"GROUP BY ALL")

    return f"""
    WITH obs AS ({O.OBS}), cal AS ({O.CAL}),
    prim AS ({mapped('Quantity', pq)}), st AS ({mapped('Tax', pt)}),
    objs AS (SELECT DISTINCT object FROM prim),
    comps(ord, label) AS (VALUES {comps}),
    comp AS (SELECT o.object, c.ord, c.label, cal.month_start,
                    CASE c.ord WHEN 0 THEN COALESCE(p.v, 0.0) WHEN 2 THEN COALESCE(s.v, 0.0) ELSE 0.0 END AS v
             FROM objs o CROSS JOIN comps c CROSS JOIN cal
             LEFT JOIN prim p ON p.object = o.object AND p.month_start = cal.month_start
             LEFT JOIN st s ON s.object = o.object AND s.month_start = cal.month_start)
    SELECT object, 'component' AS row_kind, label AS row_label, ord AS s_comp,
           strftime(month_start, '%b-%Y') AS col_label, {R4('v')} AS value, NULL AS text FROM comp
    UNION ALL SELECT object, 'data', object, NULL, strftime(month_start, '%b-%Y'), {R4('SUM(v)')}, NULL
              FROM comp GROUP BY object, month_start
    UNION ALL SELECT o.object, 'header', '', NULL, strftime(cal.month_start, '%b-%Y'), NULL,
              strftime(cal.month_start, '%b-%Y') FROM objs o CROSS JOIN cal
    UNION ALL SELECT object, 'spacer', '', NULL, NULL, NULL, NULL FROM objs
    """


def _emissions_sql() -> str:
    parts = []
    for ro, _, cls, gas, pattern, unit, prop in analog.EMISSIONS:
        sql = O.rounded(O.block_sql(ro, prop, False, O.where(prop, cls, (), parent=gas), O.factor(prop, unit)))
        if pattern.strip().lower() == "monthly-summary":
            label = O.q(f"{cls.strip()}-{gas.strip()}-Total")
            parts.append(f"SELECT rule_ord, 'summary' AS row_kind, {label} AS row_label, col_label, value "
                         f"FROM ({sql}) b WHERE row_kind = 'total'")
        else:
            parts.append(f"SELECT rule_ord, row_kind, CASE WHEN row_kind = 'total' THEN 'Total' ELSE object END "
                         f"AS row_label, col_label, value FROM ({sql}) b")
    return " UNION ALL ".join(parts)


def _section_ords():
    first = {}
    for r in analog.STANDARD:
        first.setdefault(r[1], r[0])
    return first


def _rule_driven_sql() -> str:
    sec = _section_ords()

    def hdr(ro):
        h = O.std_rule(ro)[1]
        return O.q(h), sec[h]

    cols = "section, section_ord, rule_ord, row_kind, row_label, s_parent, s_group, s_band, s_day, s_comp, col_label, value, text"
    parts = []
    for ro in (1, 2):
        h, so = hdr(ro)
        parts.append(f"""SELECT {h} AS section, CAST({so} AS BIGINT) AS section_ord, rule_ord, row_kind,
            CASE WHEN row_kind = 'total' THEN 'Total' ELSE object END AS row_label, NULL AS s_parent,
            NULL AS s_group, NULL AS s_band, NULL AS s_day, NULL AS s_comp, col_label, value, NULL AS text
            FROM ({O.flat_rule_sql(ro)}) b""")
    summ = _summary_sql()
    h, so = hdr(3)
    parts.append(f"""SELECT {h}, CAST({so} AS BIGINT), rule_ord, 'summary', row_label, NULL, NULL, NULL, NULL, NULL,
        col_label, value, NULL FROM ({summ}) b""")
    h, so = hdr(5)
    parts.append(f"""SELECT {h}, CAST({so} AS BIGINT), 5, row_kind, row_label, NULL, object, NULL, NULL, s_comp,
        col_label, value, text FROM ({_stacked_sql()}) b""")
    h, so = hdr(6)
    nest = O.nested_rule_sql(6)
    parts.append(f"""SELECT {h}, CAST({so} AS BIGINT), rule_ord, row_kind,
        CASE WHEN row_kind = 'total' THEN 'Total' ELSE object END, parent, NULL, NULL, NULL, NULL, col_label, value, NULL
        FROM ({nest}) b""")
    parts.append(f"""SELECT DISTINCT {h}, CAST({so} AS BIGINT), rule_ord, 'title', COALESCE(nm.dst, b.parent), b.parent,
        NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM ({nest}) b LEFT JOIN ({O.names_cte()}) nm ON b.parent = nm.src""")
    parts.append(f"""SELECT DISTINCT {h}, CAST({so} AS BIGINT), rule_ord, 'spacer', '', parent,
        NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM ({nest}) b""")
    h, so = hdr(7)
    daily = _daily_sql()
    parts.append(f"""WITH d AS ({daily}),
        r AS (SELECT DISTINCT object, band, day FROM d),
        lab AS (SELECT object, band, day, row_number() OVER (PARTITION BY object ORDER BY band, day) - 1 AS idx FROM r)
        SELECT {h}, CAST({so} AS BIGINT), 7, 'data', CASE WHEN l.idx = 0 THEN ' ' ELSE CAST(l.idx AS VARCHAR) END,
               NULL, d.object, d.band, d.day, NULL, d.col_label, d.value, NULL
        FROM d JOIN lab l ON d.object = l.object AND d.band = l.band AND d.day = l.day
        UNION ALL
        SELECT {h}, CAST({so} AS BIGINT), 7, 'data', CASE WHEN idx = 0 THEN ' ' ELSE CAST(idx AS VARCHAR) END,
               NULL, object, band, day, NULL, 'Day_Id', CAST(day AS DOUBLE), NULL FROM lab
        UNION ALL
        SELECT DISTINCT {h}, CAST({so} AS BIGINT), 7, 'title', object, NULL, object, NULL, NULL, NULL, NULL, NULL, NULL FROM r
        UNION ALL
        SELECT DISTINCT {h}, CAST({so} AS BIGINT), 7, 'spacer', '', NULL, object, NULL, NULL, NULL, NULL, NULL, NULL FROM r""")
    return " UNION ALL ".join(f"SELECT * FROM ({p_})" for p_ in parts)


COL_ORD_SQL = ("CASE WHEN col_label = 'Total' THEN 999999 WHEN col_label LIKE 'Tot-%' "
               "THEN CAST(substr(col_label, 5) AS INTEGER) * 100 + 13 "
               "ELSE year(strptime(col_label, '%b-%Y')) * 100 + month(strptime(col_label, '%b-%Y')) END")
NUM_TXT = ("CASE WHEN ends_with(regexp_replace(printf('%.4f', value), '0+$', ''), '.') "
           "THEN regexp_replace(printf('%.4f', value), '0+$', '') || '0' "
           "ELSE regexp_replace(printf('%.4f', value), '0+$', '') END")


def _report_lines_sql() -> str:
    cells = f"SELECT *, {COL_ORD_SQL} AS col_ord FROM ({_ratings_sql()}) x"
    return f"""
    WITH c AS ({cells}),
    secs AS (SELECT DISTINCT ts, ts_id FROM c),
    cols AS (SELECT DISTINCT ts_id, col_ord, col_label FROM c)
    SELECT CAST(ts_id AS BIGINT) AS section_ord, 0 AS line_kind, NULL::INTEGER AS rule_ord, NULL::VARCHAR AS s_obj, ts AS line FROM secs
    UNION ALL SELECT CAST(ts_id AS BIGINT), 1, NULL, NULL, ',' || string_agg(col_label, ',' ORDER BY col_ord) FROM cols GROUP BY ts_id
    UNION ALL SELECT CAST(ts_id AS BIGINT), 2, rule_ord, object, row_label || ',' || string_agg({NUM_TXT}, ',' ORDER BY col_ord)
              FROM c GROUP BY ts_id, rule_ord, object, row_label
    UNION ALL SELECT CAST(ts_id AS BIGINT), 3, NULL, NULL, '' FROM secs
    """


def _series_statistics_sql() -> str:
    real = {"Sum": "sum(v)", "Min": "min(v)", "Max": "max(v)", "StandardDeviation": "stddev_pop(v)", "Median": "quantile_cont(v, 0.5)",
            "FirstQuartile": "quantile_cont(v, 0.25)", "ThirdQuartile": "quantile_cont(v, 0.75)"}
    return f"""
    WITH o AS (SELECT l_suppkey * 1000 + (l_orderkey % 3) * 100 + CASE WHEN l_returnflag = 'R' THEN 30 ELSE 40 END + CASE WHEN l_linenumber <= 3 THEN 1 ELSE 2 END AS "SeriesId",
                      CAST(l_quantity AS DOUBLE) AS v, CAST(date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS VARCHAR) AS p FROM lineitem),
    h AS (SELECT *, CAST('0x' || substr(md5(concat_ws('|', coalesce(p, ''), coalesce(CAST(CAST(v AS DECIMAL(38,10)) AS VARCHAR), ''))), 1, 12) AS BIGINT) AS d FROM o),
    m AS (SELECT "SeriesId", v AS "Mode" FROM (SELECT "SeriesId", v, count(*) AS n FROM o WHERE v IS NOT NULL GROUP BY ALL)
          QUALIFY row_number() OVER (PARTITION BY "SeriesId" ORDER BY n DESC, v) = 1),
    s AS (SELECT "SeriesId", {", ".join(f'{R4(f"{e}")} AS "{k}"' for k, e in real.items())}, CAST(count(v) AS INTEGER) AS "ValueCount",
                 lpad(lower(to_hex(CAST(sum(d::HUGEINT) % {16**12} AS BIGINT))), 12, '0') AS "SeriesHash" FROM h GROUP BY "SeriesId")
    SELECT s.*, {R4('"Mode"')} AS "Mode" FROM s LEFT JOIN m USING ("SeriesId")
    """


def _sampled_sql(kept: str, weight: str) -> str:
    """SAMPLED_RULES over lineitem: rows that are ``kept``, each with ``weight``."""
    cats = O.where("Quantity", "Supplier", O.categories("Supplier", "AsiaEurope"))
    return f"""
    WITH o AS (SELECT *, {weight} AS w FROM (
        SELECT s_name AS object, n_name AS parent, r_name AS category, l_orderkey % 3 AS sample, CASE WHEN l_returnflag = 'R' THEN 3 ELSE 4 END AS phase,
               CASE WHEN l_linenumber <= 3 THEN 1 ELSE 2 END AS model, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, CAST(l_quantity AS DOUBLE) AS v
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
        WHERE l_shipdate IS NOT NULL) x WHERE {kept}),
    c AS (SELECT 11 AS rule_ord, object, month_start, sum(w * v) AS v FROM o GROUP BY ALL
          UNION ALL SELECT 12, object, month_start, CASE WHEN sum(w) > 0 THEN sum(w * v) / sum(w) END FROM o WHERE {cats} GROUP BY ALL)
    SELECT rule_ord, object, 1 AS band, month_start, {R4(O.clean())} AS value FROM c
    """


def _weighted_cells_sql() -> str:
    weights = " ".join(f"WHEN phase = {p} AND sample = {n} THEN {w}" for p, n, w in analog.SAMPLE_WEIGHTS)
    return _sampled_sql("true", f"CASE {weights} ELSE 1.0 END::DOUBLE")


def _schema_contract_sql() -> str:
    from cadence.plans.contract import OBSERVATIONS, SERIES

    fact = ("band", "timeslice_id", "timeslice")
    have = {"series": {k: v for k, v in SERIES.items() if k not in fact}, "observations": {**OBSERVATIONS, **{k: SERIES[k] for k in fact}}}
    required = {"series": ("object", "property", "key_id"), "observations": tuple(OBSERVATIONS)}
    keys = {"series": ("key_id",), "observations": ("series_id", "property", *fact, "period_start")}
    rows = []
    for rel, columns in have.items():
        for c, kind in columns.items():
            tests = [("present", kind, "0"), ("type", kind, "0")]
            tests += [("null", "no nulls", f"count(*) FILTER ({c} IS NULL)")] * (c in required[rel])
            tests += [("domain", DOMAINS[c], f"count(*) FILTER (NOT ({DOMAINS[c]}))")] if c in DOMAINS else []
            rows += [f"SELECT {O.q(rel)}, {O.q(c)}, {O.q(rule)}, {O.q(want)}, {O.q(kind)}, count(*), {bad} FROM {rel}" for rule, want, bad in tests]
        key = ", ".join(keys[rel])
        rows.append(f"SELECT {O.q(rel)}, {O.q('+'.join(keys[rel]))}, 'key', 'unique', NULL, coalesce(sum(n), 0)::BIGINT, coalesce(sum(n - 1), 0)::BIGINT "
                    f"FROM (SELECT count(*) AS n FROM {rel} GROUP BY {key})")
    measures = "(VALUES ('Quantity', 0), ('Discount', 1), ('Extended Price', 2), ('Tax', 3)) m(property, idx)"
    return f"""
    WITH series AS (
        SELECT s_name AS object, s_name AS child_name, n_name AS parent_name, 'Supplier' AS child_class, 'Nation' AS parent_class, r_name AS child_category,
               r_name AS parent_category, property, CASE idx WHEN 0 THEN 'units' WHEN 2 THEN 'USD' ELSE 'fraction' END AS unit, s_suppkey * 4 + idx AS key_id
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey, {measures}),
    observations AS (
        SELECT l_suppkey AS series_id, property, l_linenumber AS band, 0 AS timeslice_id, 'All Periods' AS timeslice, l_shipdate AS period_start,
               CAST(CASE idx WHEN 0 THEN l_quantity WHEN 1 THEN l_discount WHEN 2 THEN l_extendedprice ELSE l_tax END AS DOUBLE) AS value
        FROM lineitem, {measures}),
    f(relation, "column", rule, expected, actual, n_rows, n_bad) AS ({" UNION ALL ".join(rows)})
    SELECT * FROM f
    """


def _report_text_parts_sql() -> str:
    return f"""
    SELECT CAST(section_ord AS INTEGER) AS section_ord, line,
           row_number() OVER (PARTITION BY section_ord ORDER BY line_kind, rule_ord NULLS FIRST, s_obj NULLS FIRST) AS line_no
    FROM ({_report_lines_sql()}) x
    """


def _sections_from_text_sql() -> str:
    return f"SELECT ts AS section, row_label, col_label, value FROM ({_ratings_sql()}) x"


def _report_diff_sql() -> str:
    return f"""
    WITH c AS (SELECT ts AS section, rule_ord, row_label, col_label, value FROM ({_ratings_sql()}) x),
    gold AS (SELECT * FROM c),
    gen AS (SELECT section, rule_ord, row_label, col_label,
                   CASE WHEN section = 'A' THEN value * (1.0 + 1e-7)
                        WHEN section = 'R' AND starts_with(row_label, 'S-ONE') THEN value + 1.0
                        ELSE value END AS value
            FROM c WHERE NOT (section = 'N' AND rule_ord = 3)),
    kg AS (SELECT g.*, row_label || '#' || CAST(o.occ AS VARCHAR) AS row_key FROM gold g JOIN
           (SELECT section, row_label, rule_ord, row_number() OVER (PARTITION BY section, row_label ORDER BY rule_ord) AS occ
            FROM (SELECT DISTINCT section, row_label, rule_ord FROM gold)) o USING (section, row_label, rule_ord)),
    kn AS (SELECT g.*, row_label || '#' || CAST(o.occ AS VARCHAR) AS row_key FROM gen g JOIN
           (SELECT section, row_label, rule_ord, row_number() OVER (PARTITION BY section, row_label ORDER BY rule_ord) AS occ
            FROM (SELECT DISTINCT section, row_label, rule_ord FROM gen)) o USING (section, row_label, rule_ord)),
    j AS (SELECT COALESCE(a.section, b.section) AS section, a.value AS gold, b.value AS gen
          FROM kg a FULL JOIN kn b ON a.section = b.section AND a.row_key = b.row_key AND a.col_label = b.col_label),
    per AS (SELECT section, COUNT(*) AS n_cells,
                   SUM(CASE WHEN (gold IS NULL AND gen IS NULL) THEN 0
                            WHEN gold IS NULL OR gen IS NULL THEN 1
                            WHEN (isnan(gold) AND isnan(gen)) OR abs(gen - gold) <= 1e-5 + 1e-5 * abs(gen) THEN 0
                            ELSE 1 END) AS n_mismatch FROM j GROUP BY section),
    sg AS (SELECT section, COUNT(DISTINCT row_key) AS rows_gold, COUNT(DISTINCT col_label) AS cols_gold FROM kg GROUP BY section),
    sn AS (SELECT section, COUNT(DISTINCT row_key) AS rows_gen, COUNT(DISTINCT col_label) AS cols_gen FROM kn GROUP BY section),
    s AS (SELECT COALESCE(sg.section, sn.section) AS section, rows_gold, cols_gold, rows_gen, cols_gen
          FROM sg FULL JOIN sn ON sg.section = sn.section),
    f AS (SELECT s.*, rows_gold IS NOT NULL AS in_golden, rows_gen IS NOT NULL AS in_generated,
                 CAST(COALESCE(per.n_cells, 0) AS BIGINT) AS n_cells, CAST(COALESCE(per.n_mismatch, 0) AS BIGINT) AS n_mismatch
          FROM s LEFT JOIN per ON s.section = per.section),
    v AS (SELECT *, CASE WHEN NOT in_generated THEN 'missing in generated'
                         WHEN NOT in_golden THEN 'missing in golden'
                         WHEN rows_gold <> rows_gen OR cols_gold <> cols_gen THEN 'shape mismatch'
                         WHEN n_mismatch > 0 THEN 'data mismatch' ELSE 'ok' END AS status FROM f)
    SELECT section, in_golden, in_generated, rows_gold, rows_gen, cols_gold, cols_gen, n_cells, n_mismatch, status,
           status = 'ok' AS passed FROM v
    """


def _no_data_sql() -> str:
    parts = []
    for ro, header, cls, group, prop, pattern, _, _ in analog.STANDARD:
        c = cls.strip()
        if header == analog.FUEL:
            preds = [O.where(comp[1], c, O.categories(c, comp[2] if len(comp) > 2 and comp[2] else group))
                     for comp in analog.COMPONENTS if comp[1]]
            pred = " OR ".join(f"({x})" for x in preds)
        elif pattern == "daily":
            pred = O.where(prop, c)
        elif "." in c:
            pred = "TRUE"  # nested: checked through the parents below
            parent_cls = c.split(".")[0]
            items = O.cat_filter_items(O.categories(parent_cls, group))
            inl = f"lower(trim(category)) IN ({', '.join(O.q(x) for x in items)})" if items else "TRUE"
            pred = f"{O.where(prop)} AND {'TRUE' if parent_cls.lower() == 'nation' else 'FALSE'} AND lower(trim(parent)) IN (SELECT lower(trim(parent)) FROM obs WHERE {inl})"
        else:
            pred = O.where(prop, c, O.categories(c, group))
        parts.append(f"SELECT {ro} AS rule_ord, {O.q(header)} AS header, {O.q(prop.strip())} AS property "
                     f"WHERE NOT EXISTS (SELECT 1 FROM obs WHERE {pred})")
    return f"WITH obs AS ({O.OBS}) " + " UNION ALL ".join(parts)


def _report_findings_sql() -> str:
    return f"""
    SELECT 'standard' AS report, 'no data' AS kind, rule_ord, property AS subject, CAST(NULL AS BIGINT) AS n FROM ({_no_data_sql()}) d
    UNION ALL SELECT 'standard', 'no unit rule', {FINDING_RULE[0]}, 'units to {FINDING_RULE[7]}', NULL WHERE EXISTS (SELECT 1 FROM supplier)
    """


def _solution_findings_sql() -> str:
    units = "count(DISTINCT CASE WHEN l_linenumber = 7 THEN 'crates' ELSE 'units' END)"
    return f"""
    SELECT 'source' AS report, 'several units' AS kind, CAST(NULL AS INTEGER) AS rule_ord, 'quantity' AS subject, {units} AS n
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey HAVING {units} > 1
    UNION ALL SELECT 'standard', 'no unit rule', {FINDING_RULE[0]}, 'units to {FINDING_RULE[7]}', NULL WHERE EXISTS (SELECT 1 FROM lineitem)
    UNION ALL SELECT 'ratings', 'no data', {analog.RATINGS[1][0]}, '{analog.RATINGS[1][3]}', NULL
    """


def _object_name_fallback_sql() -> str:
    blank = f"(SELECT * REPLACE (CASE WHEN s_suppkey % {analog.BLANK_EVERY} = 0 THEN ' ' ELSE s_name END AS s_name) FROM supplier)"
    return O.flat_rule_sql(1, names=False).replace("JOIN supplier s", f"JOIN {blank} s")


def _registry():
    return {
        "calendar": (q_calendar, f"""
            SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
                   CAST(year(l_shipdate) AS INTEGER) AS year,
                   strftime(CAST(date_trunc('month', l_shipdate) AS DATE), '%b-%Y') AS col_label,
                   CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS col_ord
            FROM lineitem WHERE l_shipdate IS NOT NULL"""),
        "metric_cells_sum": (q_metric_cells_sum, _cells_sql(O.std_rule(1))),
        "metric_cells_rate": (q_metric_cells_rate, _cells_sql(O.std_rule(2))),
        "filter_category": (q_filter_category, _cells_sql(FILTER_RULE)),
        "monthly_matrix": (q_monthly_matrix, _monthly_matrix_sql()),
        "name_map_merge": (q_name_map_merge, _name_map_sql()),
        "unit_scale": (q_unit_scale, _unit_scale_sql()),
        "flat_block_sum": (q_flat_block_sum, O.flat_rule_sql(1)),
        "flat_block_rate": (q_flat_block_rate, O.flat_rule_sql(2)),
        "monthly_summary": (q_monthly_summary, _summary_sql()),
        "daily_block": (q_daily_block, _daily_sql()),
        "nested_block": (q_nested_block, O.nested_rule_sql(6)),
        "ratings_block": (q_ratings_block, f"SELECT rule_ord, ts AS timeslice, object, col_label, value "
                                           f"FROM ({O.ratings_rule_sql(analog.RATINGS[0])}) x"),
        "timeslice_report": (q_timeslice_report, _timeslice_report_sql()),
        "stacked_components": (q_stacked_components, _stacked_sql()),
        "emissions_block": (q_emissions_block, _emissions_sql()),
        "rule_driven_report": (q_rule_driven_report, _rule_driven_sql()),
        "report_lines": (q_report_lines, _report_lines_sql()),
        "sections_from_text": (q_sections_from_text, _sections_from_text_sql()),
        "report_text_parts": (q_report_text_parts, _report_text_parts_sql()),
        "report_diff": (q_report_diff, _report_diff_sql()),
        "no_data_rules": (q_no_data_rules, _no_data_sql()),
        "daily_events": (q_daily_events, _daily_events_sql()),
        "events_timeslice_report": (q_events_timeslice_report, _events_timeslice_sql()),
        "report_findings": (q_report_findings, _report_findings_sql()),
        "solution_findings": (q_solution_findings, _solution_findings_sql()),
        "solution_flat_block": (q_solution_flat_block, O.flat_rule_sql(1)),
        "solution_timeslice_report": (q_solution_timeslice_report, f"SELECT rule_ord, ts AS timeslice, object, col_label, value "
                                                                   f"FROM ({O.ratings_rule_sql(analog.RATINGS[0])}) x"),
        "object_name_fallback": (q_object_name_fallback, _object_name_fallback_sql()),
        "series_statistics": (q_series_statistics, _series_statistics_sql()),
        "filtered_cells": (q_filtered_cells, _sampled_sql("phase = 4 AND model = 1 AND sample IN (0, 2)", "1.0::DOUBLE")),
        "weighted_cells": (q_weighted_cells, _weighted_cells_sql()),
        "incremental_cells": (q_incremental_cells, _cells_sql(O.std_rule(1))),
        "published_report": (q_published_report, _sections_from_text_sql()),
        "schema_contract": (q_schema_contract, _schema_contract_sql()),
    }


def _llm():
    """Queries and SQL of the optional subpackage; none where it is not there."""
    try:
        from cadence.llm import registry
    except ModuleNotFoundError as e:
        if e.name is None or e.name.split(".")[-1] not in ("llm", "registry", "corpus_pipeline"):
            raise
        return {}, {}
    return registry.QUERIES, registry.ORACLES


def entry(spark: SparkSession) -> DataFrame:
    return q_flat_block_sum(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in _registry().items()} | _llm()[0]


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _registry().items() if v[1] is not None} | _llm()[1]
