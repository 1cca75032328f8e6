"""Timeslices rolled up from per-timeslice cells, against a brute-force
pandas computation on the raw events table."""

import pandas as pd
import pytest

from cadence import analog
from cadence.plans.reports import timeslice_report
from cadence.sources.star import events_source
from tests.conftest import SF_SMALL


def test_events_timeslice_totals_match_brute_force(spark):
    rs = analog.ruleset(spark, standard=[], ratings=[(1, "User", "All", "Value", "usd", None)])
    cells = timeslice_report(events_source(spark, SF_SMALL), rs)
    got = {(r["section"], r["row_label"]): r["value"]
           for r in cells.where("col_label = 'Total'").select("section", "row_label", "value").collect()}

    ev = pd.read_parquet(f"{SF_SMALL}/events.parquet")
    ev = ev[ev.user_id.notna()]
    per_type = ev.groupby(["event_type", "user_id"])["value"].sum()
    all_types = ev.groupby("user_id")["value"].sum()
    want = {(t, f"User#{u}:usd"): v for (t, u), v in per_type.items()}
    want.update({("All Periods", f"User#{u}:usd"): v for u, v in all_types.items()})

    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9, abs=1e-9)

    order = [r[0] for r in cells.select("section", "section_ord").distinct().orderBy("section_ord").collect()]
    assert order[0] == "All Periods" and len(order) == 1 + ev.event_type.nunique()
