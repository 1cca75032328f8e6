"""Resumable publishing of reports.

A publication is a run of reports under a name, ``out_dir/runs/<name>``. It is made in steps:
the report cells (the only step that reads the fact), then each section's text, then the index
and the findings. Each finished step is a row in ``out_dir/manifest``; a step that failed
half-way has none. Publishing again under the same name goes on after the last finished step, and
a finished publication is left as it is. Readers follow the manifest's last ``published`` row, so
the old output stays the current one until the new one is whole; nothing is renamed or deleted,
which object stores do neither at once nor cheaply.

Defined cases: a name stands for one state of rules and source. The rules are digested, and another
set of rules under a known name is an error; of the source's data the caller knows, and gives new data
a new name. A report without sections is published empty. A step's files count only with its
row, so what a lost run left behind is overwritten.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.api import calendar_of, report_findings
from cadence.plans.layout import report_lines, write_lines
from cadence.plans.reports import read_report, standard_report, text_index, timeslice_report, validate
from cadence.plans.sizing import local_frame
from cadence.sources.base import Source
from cadence.sources.rules import RuleSet

MANIFEST = "at timestamp, run string, step string, detail string"
RUN_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
REPORTS = {"standard": ("Standard_Report", standard_report), "ratings": ("Ratings_Report", timeslice_report)}


class Manifest:
    """The finished steps under ``out_dir``: one row each, never changed."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark = spark
        self.path = f"{out_dir.rstrip('/')}/manifest"

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).json(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return local_frame(self.spark, [], MANIFEST)

    def record(self, run: str, step: str, detail: str = "") -> None:
        row = local_frame(self.spark, [(run, step, detail)], "run string, step string, detail string")
        row.select(F.current_timestamp().alias("at"), "*").coalesce(1).write.mode("append").json(self.path)

    def steps(self, run: str) -> dict[str, str]:
        """step -> detail of a run: a few rows for each report and one a section."""
        return {r["step"]: r["detail"] for r in self.rows().where(F.col("run") == run).select("step", "detail").collect()}


def rules_digest(rs: RuleSet) -> str:
    """An order-free digest of the rule tables."""
    parts = []
    for name in ("standard", "ratings", "emissions", "groups", "units", "names"):
        table = getattr(rs, name)
        if table is not None:
            of = F.xxhash64(F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"}))
            n, low, high = table.agg(F.count("*"), F.sum(of.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftright(of, 32))).first()
            parts.append(f"{name}:{n}:{low}:{high}")
    return ";".join([*parts, f"components:{rs.components}", f"fuel:{rs.fuel_header}"])


def publish(source: Source, rs: RuleSet, out_dir: str, run: str, golden_dir: str | None = None) -> str:
    """Write the reports of ``rs`` under ``out_dir`` as publication ``run``, going on where an
    earlier call stopped; with ``golden_dir``, a publication that does not pass against it is not
    made current and raises. Returns the publication's folder."""
    if not RUN_NAME.fullmatch(run):
        raise ValueError(f"{run!r} does not name a run: letters, digits, '.', '_' and '-'")
    spark, manifest = source.spark, Manifest(source.spark, out_dir)
    base, done, digest = f"{out_dir.rstrip('/')}/runs/{run}", manifest.steps(run), rules_digest(rs)
    if "rules" not in done:
        manifest.record(run, "rules", digest)
    elif done["rules"] != digest:
        raise ValueError(f"run {run!r} was begun with other rules")
    if "published" in done:
        return base

    def step(name: str, work) -> None:
        if name not in done:
            work()
            manifest.record(run, name)
            done[name] = ""

    cal = None
    names = [name for which, (name, _) in REPORTS.items() if getattr(rs, which) is not None]
    for which, (name, report) in REPORTS.items():
        if name not in names:
            continue
        if f"{name}/cells" not in done:
            cal = cal or calendar_of(source)
            step(f"{name}/cells", lambda: report(source, rs, cal).write.mode("overwrite").partitionBy("section_ord").parquet(f"{base}/{name}_cells"))
        cells = spark.read.parquet(f"{base}/{name}_cells")
        ords = sorted(r[0] for r in cells.select("section_ord").distinct().collect())  # one a section title
        for o in ords:
            folder = f"{base}/{name}_text/section_ord={o}"
            step(f"{name}/section_ord={o}", lambda: write_section(cells.where(F.col("section_ord") == o), folder))
        if ords:
            step(f"{name}/index", lambda: text_index(spark, f"{base}/{name}_text").write.mode("overwrite").json(f"{base}/{name}_index"))
    step("findings", lambda: report_findings(source, rs).write.mode("overwrite").json(f"{base}/report_findings"))
    if golden_dir and names:
        failed = validate(spark, golden_dir, base, base, tuple(names)).where("NOT passed").select("report", "section", "status").collect()
        if failed:
            raise RuntimeError(f"validation against {golden_dir} failed: {[tuple(r) for r in failed]}")
    step("published", lambda: None)
    return base


def write_section(cells: DataFrame, folder: str) -> None:
    """One section's text, in as many part files as its ranges of lines."""
    write_lines(report_lines(cells), folder, by_section=False)


def current(spark: SparkSession, out_dir: str) -> str | None:
    """The folder of the publication that readers are to take; None when none is whole."""
    last = Manifest(spark, out_dir).rows().where("step = 'published'").agg(F.max_by("run", "at")).first()[0]
    return None if last is None else f"{out_dir.rstrip('/')}/runs/{last}"


def read_current(spark: SparkSession, out_dir: str, name: str, text: bool = False) -> DataFrame:
    """The current publication's report, as read_report() gives it."""
    base = current(spark, out_dir)
    if base is None:
        raise FileNotFoundError(f"nothing is published in {out_dir}")
    return read_report(spark, f"{base}/{name}", text)
