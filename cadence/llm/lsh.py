"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosines.

A normalised vector is projected on Gaussian directions; each projection,
shifted and cut into cells of ``WIDTH``, is one hash, and ``HASHES`` of them
together are the key of one of ``TABLES`` tables. Vectors that share a key are
candidates, and every link is settled by the exact cosine in double precision.
A pair with a cosine of exactly 0.95 shares no key with a probability of 0.003,
one of 0.98 with less than 1e-6. Two unrelated vectors share a table's key with a
probability of 2e-6: with far more than 1e7 vectors, raise HASHES by 3 and
TABLES by half for each further factor of ten.

Bitwise equal vectors are one class. Links found through shared keys give the
components: each vector is first compared with one hub, then buckets that still
span several components are compared block by block inside tasks, which return
only links that join up what is apart. Inside a component all pairs are compared
in blocks in the same way, so each vector's links are counted. No pair that does
not join anything becomes a row.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and come back alone. Vectors of different
lengths are not compared. Rows that repeat a vec_id each come back and count as
vectors; a null vec_id links with nothing and has a null component.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import graph
from cadence.llm.tables import cut, read
from cadence.llm.words import mix

LEAST = 0.95
TABLES, HASHES, WIDTH = 64, 18, 2.0
BLOCK_ROWS = 2048
#: Groups of up to so many rows are compared many at a time.
FEW = 64
FOLD = np.random.Generator(np.random.PCG64(31)).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SALT = mix(np.arange(1, TABLES + 1, dtype=np.uint64))

_directions: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def directions(dim: int) -> tuple[np.ndarray, np.ndarray]:
    if dim not in _directions:
        rng = np.random.Generator(np.random.PCG64(32 + dim))
        _directions[dim] = rng.standard_normal((dim, TABLES * HASHES)), rng.uniform(0, WIDTH, TABLES * HASHES)
    return _directions[dim]


def units(values: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that no square overflows."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def table_keys(unit: np.ndarray) -> np.ndarray:
    """Each row's key in every table."""
    a, b = directions(unit.shape[1])
    cells = np.floor((unit @ a + b) / WIDTH).astype(np.int64).view(np.uint64).reshape(-1, TABLES, HASHES)
    return mix((cells * FOLD).sum(axis=2, dtype=np.uint64) + SALT).view(np.int64)


def _matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def _hashed(batches):
    """Digest, table keys and unit vector; nulls for vectors that link with nothing."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            lists = part.column("embedding").to_pylist()
            hi, lo, keys, unit = ([None] * len(lists) for _ in range(4))
            for dim in {len(x) for x in lists if x}:
                rows = [i for i, x in enumerate(lists) if x and len(x) == dim and None not in x]
                if not rows:
                    continue
                values = np.array([lists[i] for i in rows], np.float64)
                ok = np.isfinite(values).all(axis=1) & values.any(axis=1)
                rows, values = np.array(rows)[ok], values[ok]
                if len(rows):
                    u = units(values)
                    for i, v, x, key in zip(rows.tolist(), values, u, table_keys(u)):
                        hi[i], lo[i] = np.frombuffer(hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest(), np.int64).tolist()
                        keys[i], unit[i] = key, x
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(unit, pa.list_(pa.float64()))],
                names=["vec_id", "hi", "lo", "keys", "unit"])


def _linked(batches):
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        x, y = batch.column("ua"), batch.column("ub")
        sizes = np.asarray(pc.list_value_length(x))
        same = sizes == np.asarray(pc.list_value_length(y))
        for dim in np.unique(sizes[same]).tolist():
            rows = np.flatnonzero(same & (sizes == dim))
            take = pa.array(rows)
            keep[rows] = np.einsum("ij,ij->i", _matrix(x.take(take), dim), _matrix(y.take(take), dim)) >= LEAST
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])


def _whole(batches):
    """Rows sorted by (key, i, j) -> tables of whole groups, with each row's group number."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        at = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("key", "i", "j")])
        cuts = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
        if len(cuts):  # the last group may go on in the next batch
            held[-1] = batch.slice(0, cuts[-1])
            yield pa.Table.from_batches(held).combine_chunks()
            held = [batch.slice(cuts[-1])]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _joined(batches):
    """Of two blocks of a bucket (or one with itself), links that join up all of its
    components that are linked there: at most one fewer than the components. Groups of
    up to FEW rows are compared together, by their rows' distance."""
    for table in _whole(batches):
        if not table.num_rows:
            continue
        at = np.stack([np.asarray(table.column(c)).astype(np.int64) for c in ("key", "i", "j")])
        starts = np.concatenate([[0], np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1, [table.num_rows]])
        sizes = np.diff(starts)
        nodes, c, own = (np.asarray(table.column(x)) for x in ("node", "c", "own"))
        dims = np.asarray(pc.list_value_length(table.column("unit")))
        alike = dims.min() == dims.max()
        out: list[tuple[int, int]] = []
        if alike:
            out += _few(np.repeat(np.where(sizes <= FEW, np.arange(len(sizes)), -1), sizes), c, own, at[1] != at[2], _matrix(table.column("unit"), int(dims[0])))
        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if hi - lo > (FEW if alike else 1):
                out += [(lo + x, lo + y) for x, y in _many(at[1, lo], at[2, lo], own[lo:hi], c[lo:hi], dims[lo:hi], table.column("unit").combine_chunks().slice(lo, hi - lo))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(nodes[[p[k] for p in out]], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _few(group, c, own, crossing, unit) -> list[tuple[int, int]]:
    """Joining links within each of many small groups; rows of group -1 have none."""
    left, right = [], []
    for far in range(1, FEW):
        x = np.flatnonzero((group[far:] == group[:-far]) & (group[far:] >= 0))
        if not len(x):
            break
        # Two blocks: only pairs across them; the blocks have groups of their own for the rest.
        x = x[(c[x] != c[x + far]) & (~crossing[x] | (own[x] != own[x + far]))]
        near = x[np.einsum("ij,ij->i", unit[x], unit[x + far]) >= LEAST]
        left += near.tolist()
        right += (near + far).tolist()
    above: dict = {}

    def root(x):
        while above.setdefault(x, x) != x:
            above[x] = x = above[above[x]]
        return x

    out = []
    for x, y in zip(left, right):
        if (p := root((group[x], c[x]))) != (q := root((group[y], c[y]))):
            above[p] = q
            out.append((x, y))
    return out


def _many(i, j, own, c, dims, units_) -> list[tuple[int, int]]:
    """Joining links within one group."""
    c, out = c.copy(), []
    for dim in np.unique(dims).tolist():
        left, right = np.flatnonzero((own == i) & (dims == dim)), np.flatnonzero((own == j) & (dims == dim))
        if not len(left) or not len(right):
            continue
        x, y = (_matrix(units_.take(pa.array(rows)), dim) for rows in (left, right))
        for at in range(0, len(left), 512):
            near = x[at : at + 512] @ y.T >= LEAST
            for row, of in zip(left[at : at + 512].tolist(), near):
                met = right[of]
                for other in met[np.unique(c[met], return_index=True)[1]].tolist():
                    if c[other] != c[row]:
                        out.append((row, other))
                        c[c == c[other]] = c[row]
    return out


def _count(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """For every vector of the left block, the rows of the right block that it links with."""
    if not left.num_rows or not right.num_rows:
        return pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    nodes, others = np.asarray(left.column("node")), np.asarray(right.column("node"))
    weight = np.asarray(right.column("weight"))
    dim = len(left.column("unit")[0])
    x, y = _matrix(left.column("unit"), dim), _matrix(right.column("unit"), dim)
    n = np.empty(len(nodes), np.int64)
    for at in range(0, len(nodes), 512):
        links = (x[at : at + 512] @ y.T >= LEAST) & (nodes[at : at + 512, None] != others[None, :])
        n[at : at + 512] = links @ weight
    return pa.table({"node": nodes, "n": n})


def near_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept: see the module's docstring."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    hashed = cut(rows.mapInArrow(_hashed, "vec_id long, hi long, lo long, keys array<long>, unit array<double>"))
    usable = hashed.where("vec_id IS NOT NULL AND hi IS NOT NULL")
    classes = cut(usable.groupBy("hi", "lo").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight")))
    nodes = cut(usable.join(classes, ["hi", "lo"]).where("vec_id = node").select("node", "weight", "keys", "unit").dropDuplicates(["node"]))

    def verify(pairs):
        side = lambda c: nodes.select(F.col("node").alias(c), F.col("unit").alias(f"u{c}"))
        return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_linked, "a long, b long")

    def settle(at):
        at = at.withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        at = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        group = [F.col("key"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")]
        at = at.select(*group, "own", "node", "c").join(nodes.select("node", "unit"), "node").select("key", "i", "j", "own", "node", "c", "unit")
        return at.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_joined, "a long, b long").distinct()

    members = nodes.select(F.explode("keys").alias("key"), "node")
    comps = cut(graph.link_buckets(members, verify, settle))
    held = cut(nodes.drop("keys").join(comps, "node").withColumn("dim", F.size("unit")))
    sizes = held.groupBy("component").count().select("component", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks"))
    held = held.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = held.select("component", "dim", F.col("own").alias("i"), every.alias("j"), "node", "unit")
    same = (F.col(c).alias(c) for c in ("component", "dim", "node", "weight", "unit"))
    right = held.select(every.alias("i"), F.col("own").alias("j"), *same)
    key = ["component", "dim", "i", "j"]
    counts = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    named = classes.join(comps, "node", "left").join(counts, "node", "left")
    named = named.select("hi", "lo", F.coalesce("component", "node").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"))
    out = hashed.select("vec_id", "hi", "lo").join(named, ["hi", "lo"], "left")
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    linked = F.when(F.col("vec_id").isNotNull(), F.col("n"))
    return out.select("vec_id", F.coalesce(linked, F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(False)).alias("kept"))


def op7_lsh(spark, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


ORACLE = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
     WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
       AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
      WHERE list_inner_product(x.e, y.e) / sqrt(list_inner_product(x.e, x.e)) / sqrt(list_inner_product(y.e, y.e)) >= {LEAST}),
r(node, reach) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.b FROM r JOIN l ON r.reach = l.a),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, c.component_id = e.vec_id AS kept
FROM embeddings e JOIN c ON c.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""
