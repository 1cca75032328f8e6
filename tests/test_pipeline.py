"""Rule tables from files, the full pipeline to files, and validation."""

import uuid

import pytest
from pyspark.sql import functions as F

from cadence import analog
from cadence.plans.reports import run, validate
from cadence.session import checkpoint_dir
from cadence.sources.rules import load_rules
from cadence.sources.star import lineitem_source
from tests.conftest import SF_SMALL


def _write_csv(path, header, rows):
    import csv

    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


@pytest.fixture(scope="module")
def rule_dir(spark):
    import os
    from urllib.parse import urlparse

    d = f"{urlparse(checkpoint_dir(spark)).path}/rules-{uuid.uuid4().hex}"
    os.makedirs(d)
    _write_csv(f"{d}/Blueprint_std.csv", [" header ", "class", "GROUP", "Property", "pattern", "rate", "unit"],
               [r[1:6] + ("TRUE" if r[6] else "false", r[7] or "") for r in analog.STANDARD if r[0] in (1, 2, 6)])
    _write_csv(f"{d}/Blueprint_rat.csv", ["Class", "Group", "Property", "Alias"],
               [r[1:5] for r in analog.RATINGS])
    _write_csv(f"{d}/Groups.csv", ["Class", "Group", "Assets"], analog.GROUPS)
    _write_csv(f"{d}/UnitConversion.csv", ["UnitFrom", "UnitTo", "ConversionRate"], analog.UNITS)
    _write_csv(f"{d}/Generator_name_map.csv", ["asset", "asset_in_report"], [r[1:] for r in analog.NAMES])
    return d


def test_load_rules_normalises_headers_and_order(spark, rule_dir):
    rs = load_rules(spark, rule_dir, name_columns=("asset", "asset_in_report"))
    rows = rs.standard.orderBy("rule_ord").collect()
    assert [r["rule_ord"] for r in rows] == [1, 2, 3]
    assert rows[1]["Rate"] is True and rows[0]["Rate"] is False
    assert rs.ratings.columns[-1] == "Unit"  # missing column added
    last = {r["source_name"]: r["report_name"] for r in
            rs.names.groupBy("source_name").agg(F.max_by("report_name", "map_ord").alias("report_name")).collect()}
    assert last["Supplier#000000003"] == "S-THREE-LAST"


def test_blank_rate_is_an_error(spark, rule_dir):
    import os
    import shutil

    d = f"{rule_dir}-bad"
    shutil.copytree(rule_dir, d)
    _write_csv(f"{d}/Blueprint_std.csv", ["Header", "Class", "Group", "Property", "Pattern", "Rate", "Unit"],
               [("( 1 ) X", "Supplier", "All", "Quantity", "monthly", "", "")])
    with pytest.raises(ValueError, match="Rate"):
        load_rules(spark, d)
    assert os.path.isdir(d)


def test_run_and_validate(spark, rule_dir):
    src = lineitem_source(spark, SF_SMALL)
    rs = load_rules(spark, rule_dir, name_columns=("asset", "asset_in_report"))
    rs.components = analog.COMPONENTS
    out = f"{checkpoint_dir(spark)}/out-{uuid.uuid4().hex}"
    run(src, rs, out)
    # the generated reports validate against themselves, from cells and from text
    f = validate(spark, out, out)
    assert f.where("NOT passed").count() == 0
    import shutil
    from urllib.parse import urlparse

    local_out = urlparse(out).path
    text_only = f"{urlparse(checkpoint_dir(spark)).path}/gold-{uuid.uuid4().hex}"
    shutil.copytree(f"{local_out}/Ratings_Report_text", f"{text_only}/Ratings_Report_text")
    g = validate(spark, text_only, out, reports=("Ratings_Report",))
    assert g.count() == 4 and g.where("NOT passed").isEmpty()


def test_run_writes_findings_and_verdicts(spark, rule_dir):
    src = lineitem_source(spark, SF_SMALL)
    rs = load_rules(spark, rule_dir, name_columns=("asset", "asset_in_report"))
    rs.standard = None
    gold, out = (f"{checkpoint_dir(spark)}/{n}-{uuid.uuid4().hex}" for n in ("gold", "out"))
    run(src, rs, gold)
    run(src, rs, out, golden_dir=gold)
    verdicts = [tuple(r) for r in spark.read.json(f"{out}/validation_verdicts").select("report", "passed", "n_failed").collect()]
    assert sorted(verdicts, key=str) == [("Ratings_Report", True, 0), (None, True, 0)]
    cells = spark.read.parquet(f"{out}/Ratings_Report_cells")
    cells.where("section != 'R'").write.parquet(f"{out}-cut/Ratings_Report_cells")
    f = validate(spark, gold, f"{out}-cut", f"{out}-cut", reports=("Ratings_Report",))
    assert [(r["section"], r["passed"]) for r in f.collect()] == [("A", True), ("All Periods", True), ("N", True), ("R", False)]
    assert {r["passed"] for r in spark.read.json(f"{out}-cut/validation_verdicts").collect()} == {False}
