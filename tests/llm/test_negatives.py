"""Hard negatives against brute force in Python's integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.llm import negatives
from cadence.llm.tables import ship_code

NAN, INF = float("nan"), float("inf")


def brute(rows, anchors, positives=5, most=10, low=30, high=90):
    whole = {}
    for i, v, y in rows:
        if i is None or y is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole[i] = min(whole.get(i, (v, y)), (v, y))
    floor = lambda x: int(x) * 256 if abs(x) >= 2.0**53 else int(np.floor(256 * x))
    whole = {i: ([floor(x) for x in v], y) for i, (v, y) in whole.items()}
    clamp = lambda x: min(max(x, -(2**63)), 2**63 - 1)
    out = set()
    for a in anchors:
        if a not in whole:
            continue
        q, own = whole[a]
        scores = sorted((-sum(x * y for x, y in zip(q, v)), i, y) for i, (v, y) in whole.items() if i != a and len(v) == len(q))
        for s, p, _ in [r for r in scores if r[2] == own][:positives]:
            met = [(n, t) for t, n, y in scores if y != own and low * -s <= 100 * -t <= high * -s][:most]
            out |= {(a, p, k + 1, n, clamp(-s), clamp(-t)) for k, (n, t) in enumerate(met)}
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(21)
    base = rng.standard_normal((6, 12))
    out = [(i, [float(x) for x in base[i % 6] + 0.7 * rng.standard_normal(12)], i % 4) for i in range(300)]
    out += [(1000 + i, out[7][1], i % 2) for i in range(60)]  # one common vector, with ties
    out += [(2000, None, 1), (2001, [], 1), (2100, [NAN] * 12, 1), (2002, [None] + [1.0] * 11, 1), (2003, out[3][1], None), (None, out[3][1], 1), (2004, [INF] * 12, 2)]
    out += [(2200, [1.0, 2.0], 0), (2201, [1.0, 1.9], 0), (2202, [0.5, 1.0], 1), (2300, [0.0] * 3, 0), (2301, [1.0] * 3, 0), (2302, [1.0] * 3, 1)]
    out += [(5, out[5][1], 3), (5, out[6][1], 0), (100, out[100][1], 0)]  # ids that repeat
    out += [(3000 + i, [float(x) * 10.0**e for x in rng.standard_normal(5)], i % 3) for i, e in enumerate([300, 299, 200, 30, 12, 9, 1, 0, 0, 307])]
    out += [(4000 + i, [x, 1.0, 1.0, 1.0], i % 2) for i, x in enumerate([1e300, 1e200, 6e199, 1e20, 1e9, 2e9, 1.5])]
    return out


def test_against_brute_force(spark, rows):
    ship_code(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("dim", F.lit(1)).withColumn("slice", F.lit("x")).withColumn("n", F.lit(2))
    anchors = sorted({i for i, _, _ in rows if i is not None and (i % 20 == 0 or i >= 3000)})
    want = brute(rows, anchors)
    assert len(want) > 500 and any(abs(r[5]) > 2**62 for r in want)
    got = negatives.hard_negatives(df, spark.createDataFrame([(i,) for i in anchors * 2], "vec_id long")).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_blocks_do_not_change_results(spark, rows, monkeypatch):
    ship_code(spark)
    some = [r for r in rows if r[0] is not None and r[0] < 2000]
    df = spark.createDataFrame(some, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(negatives, "SLICE_NUMBERS", 12 * 90)
    monkeypatch.setattr(negatives, "BLOCK_NUMBERS", 12 * 7)
    anchors = df.where("vec_id % 10 = 0")
    got = negatives.hard_negatives(df, anchors, positives=3, negatives=4, low=10, high=80).collect()
    want = brute(some, {r[0] for r in some if r[0] % 10 == 0}, 3, 4, 10, 80)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_empty_tables(spark, rows):
    ship_code(spark)
    df = spark.createDataFrame(rows[:20], "vec_id long, embedding array<double>, label int")
    assert negatives.hard_negatives(df.limit(0), df.limit(0)).count() == 0
    assert negatives.hard_negatives(df, df.limit(0)).count() == 0
    assert negatives.hard_negatives(df.where("label = 1"), df).count() == 0


@pytest.mark.parametrize("top", [1, 300, 2**20, 2**30, 2**70])
def test_packed_products_are_exact(top):
    rng = np.random.default_rng(top % 97)
    draw = lambda n: [[int(x) * top // 1000 for x in r] for r in rng.integers(-1000, 1001, (n, 9))]
    rows, values = draw(7), draw(31)
    kind = float if top < 2**40 else object
    packed = negatives.Packed(np.array(values, kind), max(sum(map(abs, r)) for r in rows))
    assert (packed.fields > 1) == (top != 2**20) and packed.scores(np.array(rows, kind)).tolist() == [[sum(x * y for x, y in zip(a, b)) for b in values] for a in rows]


def test_order_of_texts_is_that_of_numbers():
    numbers = [0, 1, 9, 10, 99, 100, 10**40, -1, -9, -10, -99, -100, -(10**40)]
    assert sorted(numbers, key=negatives._order) == sorted(numbers)
