"""The micro-solution of FIXTURES.md §4 (expected numbers computed independently)."""

import datetime as dt
import math

from cadence import schemas
from cadence.sources.rules import RuleSet, rows_frame
from cadence.sources.solution import SolutionSource

PERIODS = {1: dt.datetime(2026, 1, 5), 2: dt.datetime(2026, 1, 20), 3: dt.datetime(2026, 2, 10),
           4: dt.datetime(2027, 1, 5)}

# SeriesId, child, parent, category, band, timeslice id, timeslice
SERIES = [
    (1, "G1", "Sys", "Thermal", 1, 0, "All Periods"),
    (2, "G1", "Sys", "Thermal", 2, 0, "All Periods"),
    (3, " ", "R1", "Renewable", 1, 0, "All Periods"),
    (4, "G2", "Sys", "thermal ", 1, 0, "All Periods"),
    (5, "G1", "Sys", "Thermal", 1, 1, "Peak"),
]

DATA = [(1, 1, 1.0), (1, 2, 3.0), (1, 3, 10.0), (1, 4, 5.0), (2, 1, 2.0), (3, 1, math.nan), (3, 3, 7.0),
        (4, 2, 0.0), (4, 3, 4.0), (5, 1, 100.0)]

COLS = ["Jan-2026", "Feb-2026", "Tot-2026", "Jan-2027", "Tot-2027", "Total"]

EXPECTED_SUM = {
    "G1": [6, 10, 16, 5, 5, 21], "G2": [0, 4, 4, 0, 0, 4], "R1": [0, 7, 7, 0, 0, 7], "Total": [6, 21, 27, 5, 5, 32],
}
EXPECTED_RATE = {
    "G1": [4, 10, 7, 5, 5, 6.3333], "G2": [0, 4, 4, 0, 0, 4], "R1": [0, 7, 7, 0, 0, 7],
    "Total": [4, 7, 6, 5, 5, 5.7778],
}
EXPECTED_THERMAL = {"G1": [6, 10, 16, 5, 5, 21], "G2": [0, 4, 4, 0, 0, 4], "Total": [6, 14, 20, 5, 5, 25]}


def solution(spark) -> SolutionSource:
    fact = spark.createDataFrame(
        [(s, p, v, 1, 0) for s, p, v in DATA],
        "SeriesId bigint, PeriodId int, Value double, EpochId bigint, dataFileId bigint",
    )
    fki = spark.createDataFrame(
        [(100 + sid, sid, 0, band, "Region", parent, cat, child, "System", "Generator", "Generation", "GWh", tsid, ts)
         for sid, child, parent, cat, band, tsid, ts in SERIES],
        schemas.FULLKEYINFO,
    )
    period = spark.createDataFrame(
        [(pid, 1, pid, start, start, 1, pid) for pid, start in PERIODS.items()], schemas.PERIOD,
    )
    return SolutionSource(spark, fact, fki, period)


def ruleset(spark, rules, groups=(("Generator", "Thermal", "THERMAL"),), names=None, units=None) -> RuleSet:
    return RuleSet(
        standard=rows_frame(spark, rules, schemas.BLUEPRINT_STD),
        ratings=None,
        groups=rows_frame(spark, list(groups), schemas.GROUPS),
        units=rows_frame(spark, units, schemas.UNIT_CONVERSION) if units else None,
        names=rows_frame(spark, names, schemas.NAME_MAP) if names else None,
    )
