"""Near-duplicate vectors: dense groups around the threshold, against brute force, and how many rows they make."""

import numpy as np
import pyarrow as pa
import pytest

from cadence.llm import graph, lsh
from cadence.llm.tables import ship_code


def brute(ids, values):
    unit = lsh.units(np.array(values))
    near = unit @ unit.T >= lsh.LEAST
    np.fill_diagonal(near, False)
    comp = np.arange(len(ids))
    while True:
        low = np.array([min([comp[i], *comp[near[i]]]) for i in range(len(ids))])
        if (low == comp).all():
            break
        comp = low
    return {(ids[i], int(near[i].sum()), ids[comp[i]], bool(comp[i] == i)) for i in range(len(ids))}


@pytest.fixture(scope="module")
def dense():
    """Vectors of one group whose cosines lie on both sides of the threshold, and one far from it."""
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(16)
    centre /= np.linalg.norm(centre)
    values = [(centre + 0.05 * rng.standard_normal(16)).tolist() for _ in range(400)]
    values += [(centre + 0.075 * rng.standard_normal(16)).tolist() for _ in range(200)]
    return list(range(1, 602)), [*values, rng.standard_normal(16).tolist()]


def test_a_dense_group_makes_no_pair_rows(spark, dense, monkeypatch):
    ship_code(spark)
    ids, values = dense
    seen = []
    real = graph.link_buckets

    def watched(members, verify, settle):
        def settled(at):
            links = settle(at)
            seen.append((at.count(), links.count(), at.select("c").distinct().count()))
            return links

        return real(members, verify, settled)

    monkeypatch.setattr(graph, "link_buckets", watched)
    monkeypatch.setattr(lsh, "BLOCK_ROWS", 128)
    vectors = spark.createDataFrame(list(zip(ids, values)), "vec_id long, embedding array<double>")
    got = {tuple(r) for r in lsh.near_vectors(vectors).collect()}
    assert got == brute(ids, values)
    assert seen
    for rows, links, apart in seen:
        assert links <= rows and apart > 1


def test_blocks_of_a_bucket_join_all_that_is_linked():
    """A chain whose ends are far apart, in two blocks; each component but the first needs one link."""
    turn = np.linspace(0, 1.5, 12)
    unit = np.stack([np.cos(turn), np.sin(turn)], axis=1)
    own = np.arange(12) % 2
    links = []
    for i, j in ((0, 0), (0, 1), (1, 1)):
        at = np.flatnonzero((own == i) | (own == j))
        table = pa.RecordBatch.from_arrays([pa.array([7] * len(at)), pa.array([i] * len(at)), pa.array([j] * len(at)), pa.array(own[at]), pa.array(at), pa.array(at), pa.array(unit[at].tolist())],
                                           names=["key", "i", "j", "own", "node", "c", "unit"])
        for out in lsh._joined([table]):
            links += list(zip(out.column("a").to_pylist(), out.column("b").to_pylist()))
    above = list(range(12))
    for a, b in links:
        above = [above[a] if x == above[b] else x for x in above]
        assert unit[a] @ unit[b] >= lsh.LEAST
    assert len(set(above)) == 1 and len(links) <= 3 * 11


def test_vectors_of_other_lengths_in_a_bucket_are_not_compared():
    table = pa.RecordBatch.from_arrays([pa.array([7] * 4), pa.array([0] * 4), pa.array([0] * 4), pa.array([0] * 4), pa.array([1, 2, 3, 4]), pa.array([1, 2, 3, 4]), pa.array([[1.0, 0.0], [1.0, 0.0, 0.0], [1.0, 0.0], [0.0, 1.0, 0.0]])],
                                       names=["key", "i", "j", "own", "node", "c", "unit"])
    out = [tuple(p) for b in lsh._joined([table]) for p in zip(b.column("a").to_pylist(), b.column("b").to_pylist())]
    assert out == [(1, 3)]


def test_many_small_groups_at_a_time_equal_one_by_one(monkeypatch):
    """Rows of many buckets over several batches, small and large, whole and cut into two blocks."""
    rng = np.random.default_rng(3)
    rows = []
    for key in range(60):
        n = int(rng.integers(1, 12)) if key % 7 else 150
        centre = rng.standard_normal(6)
        unit = lsh.units(centre + 0.35 * rng.standard_normal((n, 6)))
        own, j = rng.integers(0, 2, n) * (key % 2), key % 2
        rows += [(key, 0, j, int(own[r]), 1000 * key + r, 1000 * key + int(rng.integers(0, n)), unit[r].tolist()) for r in range(n)]
    columns = [pa.array(x) for x in zip(*rows)]
    batch = pa.RecordBatch.from_arrays(columns, names=["key", "i", "j", "own", "node", "c", "unit"])
    comp = {r[4]: (r[0], r[5]) for r in rows}

    def classes(few, size):
        monkeypatch.setattr(lsh, "FEW", few)
        above = {x: x for x in set(comp.values())}
        pairs = [p for b in lsh._joined([batch.slice(k, size) for k in range(0, len(rows), size)]) for p in zip(b.column("a").to_pylist(), b.column("b").to_pylist())]
        for a, b in pairs:
            old, new = above[comp[b]], above[comp[a]]
            assert old != new
            above = {k: new if v == old else v for k, v in above.items()}
        return {frozenset(k for k in above if above[k] == v) for v in above.values()}

    want = classes(1, len(rows))
    assert len(want) < len(set(comp.values()))
    assert classes(64, len(rows)) == classes(64, 37) == classes(1, 5) == classes(64, 5) == want
