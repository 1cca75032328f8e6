"""Exact top-k search by Fagin's threshold algorithm.

Candidates are dealt into slices. In each slice every dimension has its list
of candidates sorted by that component. For a query the lists are read in step,
each from the end where its product with the query is largest; what is met is
scored in full, and reading stops as soon as the products at the lists'
current depth add up to less than the k-th score so far, since nothing
unmet can then reach it (an equal sum goes on: a tie may have a smaller id).
When most of a slice has been met, the rest is scored at once.

Components become floor(256 * x), so scores are exact integers.

Queries go against all slices in blocks: each (query block, slice) pair is
one group of bounded size, and only its k best leave it.

Defined cases: vectors that are null, empty or hold null or non-finite
components, and rows without an id, take no part. Rows that repeat an id count
as one vector, the least of them. Vectors of different lengths are not
compared. Scores beyond 64 bits stop at its ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.tables import cut, read

K, QUERY_STEP = 5, 50
SLICE_ROWS, BLOCK_ROWS = 16384, 1024
FIRST_DEPTH = 32
LONG = (-(2**63), 2**63 - 1)


def quantised(table: pa.Table, dim: int) -> np.ndarray:
    """floor(256 * x) as doubles that hold integers."""
    flat = table.column("embedding").combine_chunks()
    return np.floor(256.0 * np.asarray(flat.flatten(), np.float64)).reshape(-1, dim)


def threshold_search(query: np.ndarray, own: int, values: np.ndarray, ids: np.ndarray, lists: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best candidates. ``lists``: for every dimension
    the candidates by ascending component. Stops by the threshold."""
    n, used = len(ids), np.flatnonzero(query)
    met = ids == own
    best_ids, best = np.zeros(0, np.int64), np.zeros(0, values.dtype)
    depth, rising = 0, query[used] < 0
    while depth < n:
        deeper = min(n, max(FIRST_DEPTH, 2 * depth))
        fresh = np.zeros(n, bool)
        if len(used):
            fresh[lists[depth:deeper, used[rising]].ravel()] = True
            fresh[lists[n - deeper : n - depth, used[~rising]].ravel()] = True
        fresh &= ~met
        met |= fresh
        if 2 * met.sum() > n or not len(used):  # most of it is met: the rest at once
            fresh |= ~met
            deeper = n
        rows = np.flatnonzero(fresh)
        best_ids, best = np.concatenate([best_ids, ids[rows]]), np.concatenate([best, values[rows] @ query])
        if len(best) > k:
            order = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[order], best[order]
        depth = deeper
        if depth < n and len(best) == k:
            edge = np.where(rising, values[lists[depth - 1, used], used], values[lists[n - depth, used], used])
            if best.min() > edge @ query[used]:
                break
    return best_ids, best


def _search(k: int):
    def group(key, left: pa.Table, right: pa.Table) -> pa.Table:
        dim = int(np.asarray(key[-1]).item() if not hasattr(key[-1], "as_py") else key[-1].as_py())
        out: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            queries, values = quantised(left, dim), quantised(right, dim)
            names, ids = np.asarray(left.column("vec_id")), np.asarray(right.column("vec_id"))
            if np.abs(queries).max() * np.abs(values).max() * dim >= 2.0**52:  # doubles would round
                queries, values = ([[int(x) for x in row] for row in m.tolist()] for m in (queries, values))
                queries, values = np.array(queries, object), np.array(values, object)
            lists = np.argsort(values, axis=0, kind="stable")
            for name, query in zip(names.tolist(), queries):
                got, scores = threshold_search(query, name, values, ids, lists, k)
                out[0].extend([name] * len(got))
                out[1].extend(got.tolist())
                out[2].extend(min(max(int(x), LONG[0]), LONG[1]) for x in scores.tolist())
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query_id", "vec_id", "score"), out)})

    return group


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the vectors that take part, one row for each id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(ok).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best vectors."""
    vectors, queries = cut(usable(vectors).withColumn("dim", F.size("embedding"))), usable(queries).withColumn("dim", F.size("embedding"))
    n, m = vectors.count(), queries.count()
    slices, blocks = max(1, -(-n // SLICE_ROWS)), max(1, -(-m // BLOCK_ROWS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    left = queries.withColumn("block", deal(blocks, 1)).withColumn("slice", every(slices))
    right = vectors.withColumn("slice", deal(slices, 2)).withColumn("block", every(blocks))
    key = ["block", "slice", "dim"]
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_topk(spark, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


ORACLE = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % {QUERY_STEP} = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}"""
