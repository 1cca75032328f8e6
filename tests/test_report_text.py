"""Report text over many files and splits: writing, line numbers, sections."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from cadence import analog
from cadence.plans.layout import numbered_lines, ordered_lines, report_lines, write_lines
from cadence.plans.reports import read_report, report_text, text_index, timeslice_report, write_report
from cadence.session import checkpoint_dir
from cadence.sources.report_text import parse_sections, read_report_cells, read_report_lines
from cadence.sources.star import lineitem_source
from tests.conftest import SF_SMALL


def folder(spark) -> str:
    return f"{checkpoint_dir(spark).removeprefix('file:')}/text-{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def ratings(spark):
    return timeslice_report(lineitem_source(spark, SF_SMALL), analog.ruleset(spark, standard=[])).cache()


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of a few hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("256", "64")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def test_section_of_many_parts_reads_back_whole(spark, ratings):
    out = folder(spark)
    write_report(ratings, out, "R", parts=24)
    files = [len([f for f in os.listdir(f"{out}/R_text/{d}") if f.startswith("part-")]) for d in os.listdir(f"{out}/R_text") if d.startswith("section_ord=")]
    assert max(files) >= 4
    back = read_report(spark, f"{out}/R", text=True).select("section", "row_label", "col_label", "value")
    mine = ratings.select("section", "row_label", "col_label", F.round("value", 4).alias("value"))
    assert back.count() == mine.count() and back.exceptAll(mine).count() == 0


def test_lines_keep_their_numbers(spark, ratings):
    lines = report_lines(ratings)
    out = f"{folder(spark)}/R_text"
    write_lines(lines, out, parts=24)
    want: dict = {}
    for r in ordered_lines(lines).collect():
        want.setdefault(int(r["section_ord"]), []).append(r["line"])
    got = {k: [None] * len(v) for k, v in want.items()}
    for r in report_text(spark, out).collect():
        got[r["section_ord"]][r["line_no"] - 1] = r["line"]
    assert got == want
    for r in numbered_lines(lines).collect():
        assert want[int(r["section_ord"])][r["line_no"] - 1] == r["line"]
    index = text_index(spark, out).orderBy("section_ord", "first_line").collect()
    assert len(index) > len(want)
    for r in index:
        with open(r["path"].removeprefix("file:")) as f:
            assert f.read().split("\n")[:-1] == want[r["section_ord"]][r["first_line"] - 1 :][: r["n_lines"]]


def plain_cells(text: str) -> list:
    """Sections of one text, line by line."""
    out, title, header, row, above = [], None, None, -1, True
    for line in (x.rstrip() for x in text.split("\n")):
        blank = line.strip() == ""
        if not blank and "," not in line and (line.strip().startswith("(") or above):
            title, header, row = line.strip(), None, -1
        elif not blank and header is None:
            header = line.split(",")
        elif not blank:
            row += 1
            label, *fields = line.split(",")
            for i, x in enumerate(fields, 1):
                number = x.replace(".", "", 1).lstrip("-").isdigit()
                out.append((title, row, label, i, header[i] if i < len(header) else None, float(x) if number else None, x if x and not number else None))
        above = blank
    return sorted(out, key=str)


def test_one_file_is_read_in_several_splits(spark, small_splits):
    at = folder(spark)
    os.makedirs(at)
    text = ""
    for k in range(60):  # titles fall just before, on and behind the splits' edges
        text += f"( {k} ) Section {'x' * (k % 37)}\n" if k % 3 else f"\nPlain title {k}{'y' * (k % 11)}\n"
        text += ",Jan-2026,Feb-2026,Total\n" + "".join(f"row {i},{i}.5,text {k},{'' if i % 2 else 7}\n" for i in range(k % 9))
        text += "\n" * (k % 4)
    with open(f"{at}/report.csv", "w") as f:
        f.write(text)
    lines = read_report_lines(spark, at)
    assert lines.select("split").distinct().count() >= 8
    assert [r["line"] for r in lines.orderBy("pos").collect()] == text.split("\n")[:-1]
    cells = parse_sections(lines)
    got = [tuple(r) for r in cells.select("section", "row_no", "row_label", "col_pos", "col_label", "value", "text").collect()]
    assert sorted(got, key=str) == plain_cells(text) and len(got) > 300


def test_data_ahead_of_a_title_is_an_error(spark, small_splits):
    at = folder(spark)
    os.makedirs(at)
    with open(f"{at}/report.csv", "w") as f:
        f.write("row,1\n" * 200)
    with pytest.raises(Exception, match="before the first section title"):
        read_report_cells(spark, at).collect()
