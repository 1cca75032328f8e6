"""Mixing: targets against a plain loop, exact flights, and what the mix takes."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.llm import mixing, registry
from cadence.llm.tables import ship_code
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes: dict) -> dict:
    """Targets by sharing the excess over and over."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - 3 * sizes[s]) for s in free)
        over = {s for s in free if target[s] >= 3 * sizes[s]}
        for s in over:
            target[s] = 3.0 * sizes[s]
        free -= over
    return target


def check_mix(rows, got):
    """``rows``: (doc_id, text, source); ``got``: rows of op11's columns and source."""
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = plain_targets(sizes)
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((d or -1, len(WORD.findall(t or ""))) for d, t, _ in rows)
    taken, longest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        s = r["source"]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) <= 1e-6 * max(1, want[s])
        times = r["target"] / sizes[s] if sizes[s] else 0
        assert r["size"] * int(times + 1e-9) <= r["taken"] <= min(3, int(times) + 1) * r["size"] and r["taken"] % max(1, r["size"]) == 0
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s]
    return taken, want


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(31)
    out = []
    for s, n in (("hot", 900), ("b", 300), ("c", 40), ("d", 3), ("e", 1), (None, 60), ("é", 25), ("\U0001f600", 9), ("￿", 9), ("tiny", 1)):
        out += [(len(out) + i, " \t".join(["w"] * int(rng.integers(1, 400))) + " ", s) for i in range(n)]
    out += [(5000, None, "b"), (5001, "", "b"), (5002, " \n\x0b\x0c\r ", "none at all"), (None, "x y z", "hot"), (None, "x y w", "hot"), (7, "x y", "hot"), (7, "x y", "hot"), (7, "x y", "hot"), (8, "z " * 70000, "hot")]
    return out


def frame(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("_unit", F.lit(2))
    return df.repartition(parts)


def test_mix_against_plain_targets(spark, rows):
    ship_code(spark)
    run = lambda parts, block: mixing.spread(mixing.copies(frame(spark, rows, parts), block)).withColumn("taken", F.col("size") * F.col("copies")).collect()
    for block in (128, 1 << 14):
        got = run(3, block)
        taken, want = check_mix(rows, got)
        for s in ("b", "c", None, *(["hot"] if block > 128 else [])):  # enough documents to come close
            assert abs(taken[s] - want[s]) <= 3 + 0.002 * want[s]
        key = lambda r: (str(r["doc_id"]), r["size"], str(r["source"]), r["taken"])
        assert sorted(map(key, got)) == sorted(map(key, run(7, block)))


def test_equal_rows_are_one_unit(spark):
    ship_code(spark)
    rows = [(None, "a b c", "a")] * 70000 + [(i, "q " * 50, "b") for i in range(400)] + [(900 + i, "r " * 500, "c") for i in range(900)]
    got = mixing.spread(mixing.copies(frame(spark, rows))).withColumn("taken", F.col("size") * F.col("copies")).collect()
    taken, want = check_mix(rows, got)
    assert abs(taken["a"] - want["a"]) <= 3


def test_mixed_documents_are_the_copies(spark, rows):
    ship_code(spark)
    docs = frame(spark, rows)
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    ids = sorted((str(r["doc_id"]), str(r["source"])) for r in got.collect())
    want = []
    for r in mixing.spread(mixing.copies(docs)).collect():
        want += [(str(r["doc_id"]), str(r["source"]))] * r["copies"]
    assert ids == sorted(want)
    assert mixing.mixed_documents(docs.limit(0)).count() == 0 and mixing.spread(mixing.copies(docs.limit(0))).count() == 0


def test_flight_keeps_words_and_documents():
    rng = np.random.default_rng(32)
    group = np.repeat(np.arange(30), rng.integers(1, 900, 30))
    n = len(group)
    p, size, key = rng.random(n), rng.integers(1, 2000, n).astype(float), rng.integers(0, 2**63, n).astype(np.uint64)
    size[: n // 3] = 40  # ties
    got = mixing.flight(p.copy(), size, key, group)
    for g in range(30):
        own = group == g
        assert ((got[own] > 0) & (got[own] < 1)).sum() <= 2
        assert abs(got[own].sum() - p[own].sum()) < 1e-5 and abs(got[own] @ size[own] - p[own] @ size[own]) < 1e-2


def test_flight_is_fair():
    rng = np.random.default_rng(33)
    p, size = np.array([0.1, 0.2, 0.3, 0.5, 0.7, 0.9, 0.4, 0.6]), np.array([5.0, 9, 2, 7, 7, 1, 30, 4])
    runs = np.array([mixing.flight(p.copy(), size, rng.integers(0, 2**63, 8).astype(np.uint64), np.zeros(8, int)) for _ in range(3000)])
    assert np.abs(runs.mean(axis=0) - p).max() < 0.04


def test_query(spark):
    got = registry.QUERIES["op11_mixing"](spark, SF)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    of = {d: s for d, _, s in rows}
    check_mix(rows, [r.asDict() | {"source": of[r["doc_id"]]} for r in got.collect()])
