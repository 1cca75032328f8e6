"""The reports: Standard (blueprint_std) and Ratings/Timeslice (blueprint_rat),
each planned over the facts for all its rules at once, and the pipeline that
writes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.api import MONTHLY_KINDS, calendar_of, report_findings
from cadence.functions.calendar import Calendar
from cadence.operators.blocks import daily_grid, monthly_rows, packed_values
from cadence.plans.sizing import cut
from cadence.plans.layout import ratings_cells, report_lines, standard_cells, write_lines
from cadence.sources.base import Source
from cadence.sources.report_text import read_report_cells, read_report_lines
from cadence.sources.rules import RuleSet, prepare


def standard_report(source: Source, rs: RuleSet, cal: Calendar | None = None, rule_ords=None) -> DataFrame:
    """report_cells of the Standard report."""
    cal = cal or calendar_of(source)
    p = prepare(rs, "standard", rule_ords)
    kinds = p.kinds()
    monthly = daily = None
    if kinds & MONTHLY_KINDS and "daily" in kinds:
        # One fact scan for every rule: daily rules' values keep their day,
        # the others have none. The lists are report-sized: cut them once.
        packed = cut(packed_values(source, p, None), free=True, placed=True)
        monthly = cut(monthly_rows(source, p.only(MONTHLY_KINDS), cal, packed=packed.where("NOT is_daily")), free=True)
        daily = daily_grid(source, p.only({"daily"}), cal, packed=packed.where("is_daily"))
    elif kinds & MONTHLY_KINDS:
        # The rows feed several layout branches: cut them once, before completion (report-sized).
        monthly = cut(monthly_rows(source, p.only(MONTHLY_KINDS), cal), free=True)
    elif "daily" in kinds:
        daily = daily_grid(source, p.only({"daily"}), cal)
    return standard_cells(monthly, daily, p.rules, p.names, cal, rs.components)


def emissions_report(source: Source, rs: RuleSet, cal: Calendar | None = None) -> DataFrame:
    """report_cells of emission rules (series under a gas parent), laid out as
    flat blocks or monthly summaries."""
    cal = cal or calendar_of(source)
    p = prepare(rs, "emissions")
    monthly = cut(monthly_rows(source, p, cal))
    return standard_cells(monthly, None, p.rules, p.names, cal, rs.components, report="Emissions")


def timeslice_report(source: Source, rs: RuleSet, cal: Calendar | None = None) -> DataFrame:
    """report_cells of the Ratings report: every rule in every timeslice, the
    timeslice a grouping key of one job."""
    cal = cal or calendar_of(source)
    p = prepare(rs, "ratings")
    monthly = cut(monthly_rows(source, p, cal, with_total_row=False))
    return ratings_cells(monthly, p.rules, cal)


def write_report(cells: DataFrame, out_dir: str, name: str, parts: int | None = None) -> None:
    """Parquet cells (the real sink); from them, the text view: a folder for each section,
    whose lines are in order over its files; and an index of the files: the number of the
    first line of each in its section, and how many it has. ``parts``: text ranges to write."""
    out_dir = out_dir.rstrip("/")
    cells.write.mode("overwrite").parquet(f"{out_dir}/{name}_cells")
    write_lines(report_lines(cells.sparkSession.read.schema(cells.schema).parquet(f"{out_dir}/{name}_cells")), f"{out_dir}/{name}_text", parts)
    text_index(cells.sparkSession, f"{out_dir}/{name}_text").write.mode("overwrite").json(f"{out_dir}/{name}_index")


SECTION = r"section_ord=(-?\d+)$"


def report_text(spark, path: str) -> DataFrame:
    """(section_ord, line_no, line) of a written report's text: lines counted from 1 in their section."""
    lines = read_report_lines(spark, path)
    return lines.select(F.regexp_extract("file", SECTION, 1).cast("int").alias("section_ord"), (F.col("pos") + 1).alias("line_no"), "line")


def text_index(spark, path: str) -> DataFrame:
    """(section_ord, path, first_line, n_lines): one row for each text file."""
    n = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n_lines"))
    n = n.withColumn("section_ord", F.regexp_extract(F.regexp_replace("path", "/[^/]*$", ""), SECTION, 1).cast("int"))
    part = F.regexp_extract("path", r"/part-(\d+)", 1).cast("long")
    before = F.sum("n_lines").over(Window.partitionBy("section_ord").orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    return n.select("section_ord", "path", (F.coalesce(before, F.lit(0)) + 1).alias("first_line"), "n_lines")


def run(source: Source, rs: RuleSet, out_dir: str, golden_dir: str | None = None) -> dict:
    """Both reports (when their rules are given) and the findings on source and rules ->
    ``out_dir``; with ``golden_dir``, validate against it and raise when a section fails."""
    cal = calendar_of(source)
    written = {}
    if rs.standard is not None:
        write_report(standard_report(source, rs, cal), out_dir, "Standard_Report")
        written["standard"] = f"{out_dir}/Standard_Report_cells"
    if rs.ratings is not None:
        write_report(timeslice_report(source, rs, cal), out_dir, "Ratings_Report")
        written["ratings"] = f"{out_dir}/Ratings_Report_cells"
    report_findings(source, rs).write.mode("overwrite").json(f"{out_dir.rstrip('/')}/report_findings")
    if golden_dir:
        names = tuple(n for n, k in (("Standard_Report", "standard"), ("Ratings_Report", "ratings")) if k in written)
        findings = validate(source.spark, golden_dir, out_dir, out_dir, names)
        failed = findings.where("NOT passed").select("report", "section", "status").collect()
        if failed:
            raise RuntimeError(f"validation against {golden_dir} failed: {[tuple(r) for r in failed]}")
    return written


def read_report(spark, path: str, text: bool = False) -> DataFrame:
    """Report cells from a written report: the Parquet cells when present (and
    ``text`` is false), else the sectioned text (golden files)."""
    from pyspark.errors import AnalysisException

    if not text:
        try:
            c = spark.read.parquet(f"{path}_cells")
            return c.select("section", "row_label", "col_label", "value", "text", "rule_ord", "s_parent",
                            "s_group", "s_sub", "s_obj", "s_band", "s_day", "s_comp")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    for target in (f"{path}_text", path):
        try:
            c = read_report_cells(spark, target)
            return c.select("section", "row_label", "col_label", "value", "text", "row_no")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no report cells or text at {path}")


def validate(spark, golden_dir: str, generated_dir: str, out_dir: str | None = None,
             reports=("Standard_Report", "Ratings_Report")) -> DataFrame:
    """Golden vs generated for each report: findings per section
    (report, section, presence, shapes, mismatches, status); written as JSON to
    ``out_dir`` when given. The caller fails the run when any ``passed`` is false."""
    from cadence.operators.diff import diff_sections, keyed, verdicts

    parts = []
    for name in reports:
        gold = read_report(spark, f"{golden_dir.rstrip('/')}/{name}")
        gen = read_report(spark, f"{generated_dir.rstrip('/')}/{name}")
        structural = ["rule_ord", "s_parent", "s_group", "s_sub", "s_obj", "s_band", "s_day", "s_comp"]
        order = structural
        if "row_no" in gold.columns or "row_no" in gen.columns:
            # A text golden file: compare text with text, rows paired by their
            # position inside the section.
            gold = read_report(spark, f"{golden_dir.rstrip('/')}/{name}", text=True)
            gen = read_report(spark, f"{generated_dir.rstrip('/')}/{name}", text=True)
            order = ["row_no"]
        f = diff_sections(keyed(gold, order), keyed(gen, order))
        parts.append(f.select(F.lit(name).alias("report"), "*"))
    findings = parts[0]
    for p_ in parts[1:]:
        findings = findings.unionByName(p_)
    findings = findings.orderBy("report", "section")
    if out_dir:
        path = f"{out_dir.rstrip('/')}/validation_findings"
        findings.write.mode("overwrite").json(path)
        findings = spark.read.schema(findings.schema).json(path).orderBy("report", "section")
        verdicts(findings).write.mode("overwrite").json(f"{out_dir.rstrip('/')}/validation_verdicts")
    return findings
