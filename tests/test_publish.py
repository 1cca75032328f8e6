"""Publications: stopped half-way and gone on with, and what readers see meanwhile."""

import uuid

import pytest

from cadence import schemas
from cadence.plans import publish as P
from cadence.plans.publish import Manifest, current, publish, read_current
from cadence.plans.reports import read_report, report_text, run
from cadence.session import checkpoint_dir
from cadence.sources.rules import RuleSet, rows_frame
from tests.fixture import solution

STANDARD = [(1, "( 1 ) A", "Generator", "All", "Generation", "monthly", False, None), (2, "( 2 ) B", "Generator", "THERMAL", "Generation", "monthly", True, None)]
RATINGS = [(1, "Generator", "All", "Generation", "gen", None)]


def rules(spark, standard=STANDARD):
    return RuleSet(standard=rows_frame(spark, standard, schemas.BLUEPRINT_STD), ratings=rows_frame(spark, RATINGS, schemas.BLUEPRINT_RAT),
                   groups=rows_frame(spark, [("Generator", "All", "all"), ("Generator", "THERMAL", "Thermal")], schemas.GROUPS), units=None, names=None)


@pytest.fixture
def out(spark):
    return f"{checkpoint_dir(spark)}/pub-{uuid.uuid4().hex}"


def rows(df):
    return sorted(map(tuple, df.select("section", "row_label", "col_label", "value", "text").collect()), key=repr)


def test_a_stopped_publication_is_finished(spark, out, monkeypatch):
    src, rs, calls = solution(spark), rules(spark), []
    write = P.write_section

    def stops(cells, folder):
        calls.append(folder)
        if len(calls) == 2:
            write(cells, folder)  # files are there, the step is not
            raise RuntimeError("lost")
        write(cells, folder)

    with monkeypatch.context() as m:
        m.setattr(P, "write_section", stops)
        with pytest.raises(RuntimeError, match="lost"):
            publish(src, rs, out, "v1")
    assert current(spark, out) is None
    with pytest.raises(FileNotFoundError):
        read_current(spark, out, "Standard_Report")
    assert "Standard_Report/section_ord=1" not in Manifest(spark, out).steps("v1") or "Standard_Report/section_ord=2" not in Manifest(spark, out).steps("v1")

    again = []
    reports = {k: (n, lambda *a, f=f, n=n: again.append(n) or f(*a)) for k, (n, f) in P.REPORTS.items()}
    with monkeypatch.context() as m:
        m.setattr(P, "REPORTS", reports)
        m.setattr(P, "write_section", lambda cells, folder: again.append(folder) or write(cells, folder))
        assert publish(src, rs, out, "v1") == current(spark, out) == f"{out}/runs/v1"
    assert "Standard_Report" not in again and "Ratings_Report" in again  # its cells were finished
    assert calls[0] not in again and calls[1] in again

    plain = f"{out}-plain"
    run(src, rs, plain)
    for name in ("Standard_Report", "Ratings_Report"):
        assert rows(read_current(spark, out, name)) == rows(read_report(spark, f"{plain}/{name}"))
        lines = [sorted(map(tuple, report_text(spark, f"{d}/{name}_text").collect())) for d in (plain, f"{out}/runs/v1")]
        assert lines[0] == lines[1] and lines[0]


def test_a_whole_publication_is_left_as_it_is(spark, out, monkeypatch):
    src, rs = solution(spark), rules(spark)
    publish(src, rs, out, "v1")
    monkeypatch.setattr(P, "REPORTS", {k: (n, lambda *a: pytest.fail("made anew")) for k, (n, _) in P.REPORTS.items()})
    n = Manifest(spark, out).rows().count()
    publish(src, rs, out, "v1")
    assert Manifest(spark, out).rows().count() == n


def test_the_old_output_stays_until_the_new_one_is_whole(spark, out, monkeypatch):
    src, rs = solution(spark), rules(spark)
    publish(src, rs, out, "v1")
    old = rows(read_current(spark, out, "Standard_Report"))
    fewer = rules(spark, STANDARD[:1])
    with monkeypatch.context() as m:
        m.setattr(P, "report_findings", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            publish(src, fewer, out, "v2")
    assert current(spark, out).endswith("/v1") and rows(read_current(spark, out, "Standard_Report")) == old
    publish(src, fewer, out, "v2")
    assert current(spark, out).endswith("/v2") and len(rows(read_current(spark, out, "Standard_Report"))) < len(old)


def test_a_publication_that_fails_validation_is_not_current(spark, out):
    src, rs = solution(spark), rules(spark)
    golden = publish(src, rs, out, "v1")
    with pytest.raises(RuntimeError, match="missing in generated"):
        publish(src, rules(spark, STANDARD[:1]), out, "v2", golden_dir=golden)
    assert current(spark, out).endswith("/v1")
    publish(src, rs, out, "v3", golden_dir=golden)
    assert current(spark, out).endswith("/v3")


def test_names_and_rules(spark, out):
    src = solution(spark)
    publish(src, rules(spark), out, "v1")
    with pytest.raises(ValueError, match="other rules"):
        publish(src, rules(spark, STANDARD[:1]), out, "v1")
    with pytest.raises(ValueError, match="does not name"):
        publish(src, rules(spark), out, "../v1")
