"""Hard-negative mining by Kronecker-packed products.

Components become floor(256 * x). Several candidates share one wide integer for
each dimension: their components, biased to be at least 0, stand in fields that
are wide enough for a whole inner product. One product of an anchor's component
with that integer serves all its fields at once; after the sum over dimensions
the fields hold the candidates' inner products, which are unpacked and rid of
the bias. The wide integer is the 53-bit one that a double holds, so the sums
run as one matrix product and are exact; where one field needs more than 53
bits, Python's integers take its place.

Anchors meet the candidates in blocks: candidates are dealt into slices of
SLICE_NUMBERS components, anchors into blocks of BLOCK_NUMBERS, and each (block,
slice) pair is one group of bounded size that only its best rows leave. With n
rows and m anchors of d components, m * ceil(n * d / SLICE_NUMBERS) + n *
ceil(m * d / BLOCK_NUMBERS) rows are shuffled in each of two passes: the first
finds every anchor's positives, the second its negatives for each of them.

Defined cases: rows with a null id or label, a null or empty vector, or one with
null or non-finite components take no part. Rows
that repeat an id count as one, the least of them by (vector, label). Vectors of
different lengths are not compared. Scores beyond 64 bits stop at its ends, in
what is returned only. An anchor without positives has no rows, nor has a
positive whose score is negative. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.tables import cut, read

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
ANCHOR_STEP, SHIFT_STEP, LABELS = 100, 7, 10
SLICE_NUMBERS, BLOCK_NUMBERS = 1 << 19, 1 << 21
#: Scores that a task holds at a time.
RUN_SCORES = 1 << 21
WORD_BITS = 53
LONG = (-(2**63), 2**63 - 1)


class Packed:
    """Rows of integers, packed for products with rows whose components' absolute
    values add up to ``most`` at most."""

    def __init__(self, values: np.ndarray, most: int):
        self.n, self.low = len(values), int(values.min())
        above = values - self.low
        self.reach = most * int(above.max())  # no biased product is farther from 0
        self.width = max(1, (2 * self.reach).bit_length())
        self.fields = WORD_BITS // self.width
        if not self.fields:
            self.fields, above = 8, np.array([[int(x) for x in row] for row in above.tolist()], object)
        gap = -self.n % self.fields
        above = np.concatenate([above, np.zeros((gap, above.shape[1]), above.dtype)])
        unit = lambda j: 2 ** (j * self.width) if above.dtype == object else float(2 ** (j * self.width))
        self.words = sum(above[j :: self.fields] * unit(j) for j in range(self.fields)).T
        self.middle = sum(self.reach << (j * self.width) for j in range(self.fields))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Inner products of ``rows`` with all packed rows, as integers."""
        if self.words.dtype == object:
            rows = np.array([[int(x) for x in row] for row in rows.tolist()], object)
            got, mask = rows @ self.words + self.middle, (1 << self.width) - 1
        else:
            got, mask = (rows @ self.words).astype(np.int64) + self.middle, np.int64((1 << self.width) - 1)
        out = np.empty((len(rows), got.shape[1] * self.fields), got.dtype)
        for j in range(self.fields):
            out[:, j :: self.fields] = (got >> (j * self.width)) & mask
        total = rows.sum(axis=1).astype(got.dtype)
        return out[:, : self.n] - self.reach + self.low * total[:, None]


def quantised(table: pa.Table) -> np.ndarray:
    """floor(256 * x) as doubles that hold integers; Python's integers where doubles cannot hold the products."""
    flat = np.asarray(table.column("embedding").combine_chunks().flatten(), np.float64)
    if np.abs(flat).max(initial=0) < 2.0**32:
        return np.floor(256.0 * flat).reshape(table.num_rows, -1)
    return np.array([int(x) * 256 if abs(x) >= 2.0**53 else int(np.floor(256.0 * x)) for x in flat.tolist()], object).reshape(table.num_rows, -1)


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, in order; ties to the earlier place."""
    if len(scores) > k and scores.dtype != object:
        rows = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return rows[np.argsort(-scores[rows], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")[:k]


def _blocks(left: pa.Table, right: pa.Table):
    """(places of anchors, their scores against ``right``) of one group, in runs."""
    anchors, values = quantised(left), quantised(right)
    if values.dtype != anchors.dtype:
        anchors, values = (np.array([[int(x) for x in row] for row in m.tolist()], object) for m in (anchors, values))
    packed = Packed(values, int(np.abs(anchors).sum(axis=1).max()))
    step = max(1, RUN_SCORES // len(values))
    for a in range(0, len(anchors), step):
        yield range(a, min(a + step, len(anchors))), packed.scores(anchors[a : a + step])


def _whole(x) -> int:
    return min(max(int(x), LONG[0]), LONG[1])


def _order(x) -> str:
    """A text for a whole number of any size; texts are in the numbers' order."""
    digits = str(abs(int(x)))
    if x >= 0:
        return f"1{len(digits):05d}{digits}"
    return f"0{99999 - len(digits):05d}" + "".join(str(9 - int(d)) for d in digits)


def _table(columns: dict, schema: list[tuple]) -> pa.Table:
    return pa.table({c: pa.array(columns[c], kind) for c, kind in schema})


def _positives(k: int):
    kinds = [("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("score", pa.string()), ("order", pa.string())]

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict = {c: [] for c, _ in kinds}
        if left.num_rows and right.num_rows:
            right = right.sort_by("vec_id")
            ids, labels = np.asarray(right.column("vec_id")), np.asarray(right.column("label"))
            names, own = np.asarray(left.column("vec_id")), np.asarray(left.column("label"))
            for run, scores in _blocks(left, right):
                for i, line in zip(run, scores):
                    same = np.flatnonzero((labels == own[i]) & (ids != names[i]))
                    rows = same[best(line[same], k)]
                    out["anchor_id"] += [names[i]] * len(rows)
                    out["positive_id"] += ids[rows].tolist()
                    out["score"] += [str(int(x)) for x in line[rows]]
                    out["order"] += [_order(x) for x in line[rows]]
        return _table(out, kinds)

    return group


def _negatives(k: int, low: int, high: int):
    kinds = [("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("negative_id", pa.int64()), ("negative_score", pa.int64()), ("order", pa.string())]

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict = {c: [] for c, _ in kinds}
        if left.num_rows and right.num_rows:
            right = right.sort_by("vec_id")
            ids, labels = np.asarray(right.column("vec_id")), np.asarray(right.column("label"))
            names, own, met = np.asarray(left.column("vec_id")), np.asarray(left.column("label")), left.column("positives").to_pylist()
            for run, scores in _blocks(left, right):
                for i, line in zip(run, scores):
                    sought = [(p["positive_id"], int(p["score"])) for p in met[i]]
                    # whole bounds of low * p <= 100 * s <= high * p
                    ranges = [(-(-low * p // 100), high * p // 100) for _, p in sought]
                    wide = np.flatnonzero((line >= min(a for a, _ in ranges)) & (line <= max(b for _, b in ranges)) & (labels != own[i]))
                    near = line[wide]
                    for (name, p), (a, b) in zip(sought, ranges):
                        rows = np.flatnonzero((near >= a) & (near <= b))
                        rows = rows[best(near[rows], k)]
                        out["anchor_id"] += [names[i]] * len(rows)
                        out["positive_id"] += [name] * len(rows)
                        out["positive_score"] += [_whole(p)] * len(rows)
                        out["negative_id"] += ids[wide[rows]].tolist()
                        out["negative_score"] += [_whole(x) for x in near[rows]]
                        out["order"] += [_order(x) for x in near[rows]]
        return _table(out, kinds)

    return group


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding and dim of the rows that take part, one for each id."""
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & fit
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")).where(ok)
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("embedding", "label")).alias("r"))
    return rows.select("vec_id", "r.label", "r.embedding", F.size("r.embedding").alias("dim"))


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for
    each anchor (a column ``vec_id`` of ids in ``vectors``) and each of its
    ``positives`` best rows of the same label, the ``negatives`` best rows of other
    labels that score between ``low`` and ``high`` percent of the positive."""
    rows = cut(usable(vectors))
    named = rows.join(anchors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi")
    all_, of = rows.groupBy("dim").agg(F.count("*").alias("n")), named.groupBy("dim").agg(F.count("*").alias("m"))
    number = lambda n, most: F.ceil(F.col(n) * F.col("dim") / F.lit(most)).cast("int")
    sizes = all_.join(of, "dim").select("dim", number("n", SLICE_NUMBERS).alias("slices"), number("m", BLOCK_NUMBERS).alias("blocks"))
    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    key = ["dim", "slice", "block"]
    right = rows.join(sizes, "dim").withColumn("slice", deal("slices", 1)).withColumn("block", every("blocks"))
    right = right.select(*(F.col(c).alias(c) for c in ("vec_id", "label", "embedding", *key)))  # names of its own for cogroup
    dealt = lambda left: left.join(sizes, "dim").withColumn("block", deal("blocks", 2)).withColumn("slice", every("slices")).groupBy(*key)

    met = dealt(named).cogroup(right.groupBy(*key)).applyInArrow(_positives(positives), "anchor_id long, positive_id long, score string, order string")
    first = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("order"), "positive_id"))
    chosen = met.withColumn("at", first).where(F.col("at") <= positives).groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "score")).alias("positives"))
    sought = cut(named.join(chosen, "vec_id"))
    found = dealt(sought).cogroup(right.groupBy(*key)).applyInArrow(_negatives(negatives, low, high), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long, order string")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("order"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % SHIFT_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), vectors.where(F.col("vec_id") % ANCHOR_STEP == 0))


ORACLE = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % {SHIFT_STEP} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS anchor_id, c.vec_id AS vec_id, q.label = c.label AS same, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % {ANCHOR_STEP} = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
       AND {LOW} * positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""
