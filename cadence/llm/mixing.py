"""Mixing sources to target weights by the cube method.

Targets. Sources in code point order, null last, weigh 1, 2, 3, repeating, and
share the whole size of all documents by weight. No source gives more than MOST
times its size: what is above is shared anew, by weight, among the others until
none is above.

Copies. A document of a source with ratio r = target / size is taken floor(r)
times whole, and once more with probability p = r - floor(r). Which ones is
decided by balanced sampling: in the flight the p of a few documents move along
the null-space of the constraints (sum of p * size and sum of p stay as they
are: words and documents) until one of them is 0 or 1 and another document takes
its place. Documents of more than LARGE times the mean size of their block go first, each
against all others of the block at once. Every lane of documents ends with two open ones at most; open ones
meet in new lanes until one lane is left. LANDING documents of a source stay out
of its flight; with what is still open they are the landing problem, where all
choices are weighed and the one nearest to the words and documents still due is
taken.

Scale. A source of any size is dealt into blocks of about BLOCK documents by a
hash, so a hot source is many groups; each round settles all but a few documents
a block, and the next works on what is open. Only (id, source, size) rows move, no text.
Rows equal in these three are one unit with a count: k of them are surely taken,
one more with the rest of the probability. All choices come from hashes of the
rows, so reruns agree, however Spark deals the rows.

Defined cases: null and empty texts, or ones of white space alone, have size 0;
a source of size 0 has target 0. Rows that repeat an id, or have a null one, are
documents of their own. Other columns are not read; :func:`mixed_documents`
returns them as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.tables import cut, free_name, read
from cadence.llm.words import mix
from cadence.operators.ordering import numbered

WEIGHTS, MOST = (1, 2, 3), 3
WORD, SPACES = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"
BLOCK, LANE, LANDING, LARGE = 16384, 64, 10, 2
#: Equal rows that one task writes at a time.
RUN = 1 << 16
NEAR, ABSORB = 1e-9, 0.9


# ---------------------------------------------------------------- targets
def targets(rows: DataFrame) -> DataFrame:
    """(source, n, source_size, target) of rows (source, n, size: n documents of that size)."""
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    at = F.pmod(F.col("_at") - 1, F.lit(len(WEIGHTS))).cast("int")
    known = numbered(sizes, [F.col("source").asc_nulls_last()], "_at").withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in WEIGHTS]), at + 1))
    known = cut(known.drop("_at"))
    cap = F.col("source_size") * MOST
    total, rest, weights = known.agg(F.sum("source_size")).first()[0] or 0, None, None
    while True:  # each round caps one more source at least; the share of a weight only grows
        full = F.lit(False) if rest is None else cap.cast("decimal(38,0)") * weights <= F.col("weight").cast("decimal(10,0)") * F.lit(rest).cast("decimal(27,0)")
        got = known.agg(F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        now = (total - (got[0] or 0), got[1] or 0)
        if now == (rest, weights) or not now[1]:
            break
        rest, weights = now
    share = F.lit(0.0) if not weights else F.lit(rest).cast("double") * F.col("weight") / F.lit(weights).cast("double")
    return known.select("source", "n_docs", "source_size", F.least(cap.cast("double"), share).alias("target"))


# ---------------------------------------------------------------- flight
def _uniform(key: np.ndarray) -> np.ndarray:
    return (mix(key) >> np.uint64(11)).astype(np.float64) / 2.0**53


def _snapped(p: np.ndarray) -> np.ndarray:
    p = np.where(p < NEAR, 0.0, p)
    return np.where(p > 1 - NEAR, 1.0, p)


def _lanes(p: np.ndarray, size: np.ndarray, key: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
    """Moves ``p`` in place, in all lanes [start, end) side by side, until each has two open at most."""
    held = np.stack([starts, starts + 1, starts + 2])  # three documents of each lane
    upto = starts + 3
    live = np.flatnonzero(upto <= ends)
    while len(live):
        at = held[:, live]
        x, s = p[at], size[at]
        u = np.stack([s[1] - s[2], s[2] - s[0], s[0] - s[1]])
        flat = ~u.any(axis=0)
        u[:, flat] = np.array([[1.0], [-1.0], [0.0]])
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - x) / u, np.where(u < 0, -x / u, np.inf)).min(axis=0)
            down = np.where(u > 0, x / u, np.where(u < 0, (x - 1) / u, np.inf)).min(axis=0)
        draw = _uniform(key[at[0]] ^ (key[at[1]] * np.uint64(3)) ^ (key[at[2]] * np.uint64(5)))
        step = np.where(draw * (up + down) < down, up, -down)
        p[at] = _snapped(x + step * u)
        going = np.ones(len(live), bool)
        while True:  # settled ones give their places to the lane's next
            gone = (p[held[:, live]] == 0) | (p[held[:, live]] == 1)
            which = np.flatnonzero(going & gone.any(axis=0))
            if not len(which):
                break
            place, lane = gone[:, which].argmax(axis=0), live[which]
            more = upto[lane] < ends[lane]
            held[place[more], lane[more]] = upto[lane[more]]
            upto[lane[more]] += 1
            going[which[~more]] = False
        live = live[going]


def flight(p: np.ndarray, size: np.ndarray, key: np.ndarray, group: np.ndarray) -> np.ndarray:
    """``p`` of rows sorted by group, moved until each group has two open rows at most."""
    p = _snapped(p.astype(np.float64))
    while True:
        open_ = np.flatnonzero((p > 0) & (p < 1))
        if not len(open_):
            return p
        of = group[open_]
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        n = np.diff(np.append(first, len(of)))
        if n.max() <= 2:
            return p
        starts = np.concatenate([np.arange(a, a + m, LANE) for a, m in zip(first.tolist(), n.tolist())])
        ends = np.minimum(starts + LANE, np.repeat(first + n, -(-n // LANE)))
        q = p[open_]
        _lanes(q, size[open_], key[open_], starts, ends)
        p[open_] = q


def settle_large(p: np.ndarray, size: np.ndarray, key: np.ndarray, large: np.ndarray) -> None:
    """Settles the ``large`` ones of a group in place, the largest first. A large document
    moves against all open ones at once, along the null-space vector that weighs them by
    p * (1 - p): three at a time, it would still be open when all others are settled. One
    that is larger than all others of its block can make up for stays open."""
    for g in large[np.argsort(-size[large], kind="stable")].tolist():
        while 0 < p[g] < 1:
            rest = np.flatnonzero((p > 0) & (p < 1))
            rest = rest[rest != g]
            s, w = size[rest], p[rest] * (1 - p[rest])
            a, b, c = w.sum(), w @ s, w @ (s * s)
            if (1 - p[g]) * size[g] > ABSORB * (p[rest] @ s) or p[g] * size[g] > ABSORB * ((1 - p[rest]) @ s):
                break  # more than the others can make up for
            if a * c - b * b > NEAR * a * c:  # words and documents
                one, each = np.linalg.solve([[a, b], [b, c]], [1.0, size[g]])
                u = np.append(-w * (one + each * s), 1.0)
            else:  # all of one size: words alone
                u = np.append(-w * s * (size[g] / c), 1.0)
            at = np.append(rest, g)
            x = p[at]
            with np.errstate(divide="ignore", invalid="ignore"):
                up = np.where(u > 0, (1 - x) / u, np.where(u < 0, -x / u, np.inf)).min()
                down = np.where(u > 0, x / u, np.where(u < 0, (x - 1) / u, np.inf)).min()
            draw = _uniform(key[g : g + 1] + np.uint64(len(rest)))[0]
            p[at] = _snapped(x + (up if draw * (up + down) < down else -down) * u)


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """0 or 1 for each of a few open documents: the choice whose words and documents
    come nearest to what is due."""
    n = len(p)
    choice = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    words, docs = choice @ size - p @ size, choice.sum(axis=1) - p.sum()
    return choice[np.argmin(np.abs(words) / max(size.mean(), 1.0) + np.abs(docs) / 64)]


def settled(p: np.ndarray, size: np.ndarray, key: np.ndarray, group: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One round over rows sorted by (group, key): groups that are ``last`` end at 0 or 1."""
    out, kept = _snapped(p.astype(np.float64)), np.zeros(len(p), bool)
    for rows in np.split(np.arange(len(p)), np.flatnonzero(np.diff(group)) + 1):
        q, s = out[rows], size[rows]
        open_ = np.flatnonzero((q > 0) & (q < 1))
        if len(open_) > LANDING + 2:
            large = s[open_] > LARGE * s[open_].mean()
            settle_large(q, s, key[rows], open_[large])
            out[rows] = q
            open_ = open_[~large & (q[open_] > 0) & (q[open_] < 1)]
        if last[rows[0]]:
            kept[rows[open_[:LANDING]]] = True
    out[~kept] = flight(out[~kept], size[~kept], key[~kept], group[~kept])
    rest = np.flatnonzero(last & (out > 0) & (out < 1))
    if len(rest):
        for rows in np.split(rest, np.flatnonzero(np.diff(group[rest])) + 1):
            out[rows] = landing(out[rows], size[rows])
    return out


UNIT = "unit_key long, doc_id long, source string, size long, n long, sure long, p double"
_NAMES = [x.split()[0] for x in UNIT.split(", ")]


def _round(table: pa.Table) -> pa.Table:
    """One round over the blocks of one group of units."""
    table = table.sort_by([("source", "ascending"), ("block", "ascending"), ("unit_key", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
    source = table.column("source").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    block = np.asarray(table.column("block"))
    group = np.cumsum(np.append(0, (source[1:] != source[:-1]) | (block[1:] != block[:-1])))
    key = np.asarray(table.column("unit_key")).astype(np.int64).view(np.uint64)
    last = np.asarray(table.column("blocks")) == 1
    p = settled(np.asarray(table.column("p")), np.asarray(table.column("size")).astype(np.float64), key, group, last)
    return table.select(_NAMES[:-1]).append_column("p", pa.array(p))


def _unit() -> list:
    """What tells units apart: id, source and size, the words of the text."""
    words = F.length(F.regexp_replace(F.regexp_replace("text", WORD, "x"), SPACES, ""))
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(words, F.lit(0)).cast("long").alias("size")]


def copies(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, source, size, n, source_size, target, sure, more): of the n rows with
    this id, source and size ``more`` are taken sure + 1 times and the others ``sure`` times."""
    units = cut(docs.select(*_unit()).groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")))
    goals = cut(targets(units))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = units.join(goals, units["source"].eqNullSafe(goals["source"])).drop(goals["source"]).withColumn("ratio", ratio)
    part = (F.col("ratio") - F.floor("ratio")) * F.col("n")
    key = F.xxhash64(F.coalesce("source", F.lit("")), F.coalesce(F.col("doc_id"), F.lit(-1)), F.col("size"), F.col("doc_id").isNull())
    units = units.withColumn("sure", F.floor("ratio")).withColumn("more", F.floor(part)).withColumn("p", part - F.floor(part)).withColumn("unit_key", key)
    known = cut(units)
    rows = known.select("unit_key", "doc_id", "source", "size", "n", "sure", "p")
    open_ = rows.where("p > 0 AND p < 1")
    done = None
    while True:
        n = open_.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("m"))
        total, most = n.agg(F.sum("m"), F.max("m")).first()
        if not total:
            break
        dealt = open_.join(n, open_["source"].eqNullSafe(n["_source"])).withColumn("blocks", F.ceil(F.col("m") / block).cast("int"))
        # blocks of small sources share a task's group; a group holds a few blocks' rows
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("unit_key", F.lit(int(most))), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("part", F.pmod(F.xxhash64("source", "block"), F.lit(max(1, -(-int(total) // block)))))
        moved = cut(dealt.select(*_NAMES, "block", "blocks", "part").groupBy("part").applyInArrow(_round, UNIT))
        ended = moved.where("p <= 0 OR p >= 1")
        done = ended if done is None else done.union(ended)
        open_ = moved.where("p > 0 AND p < 1")
    taken = known.select("doc_id", "source", "size", "n", "source_size", "target", "sure", "more", "unit_key", "p")
    if done is None:
        return taken.drop("unit_key", "p")
    plus = done.where("p >= 1").select("unit_key", F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.lit(1).alias("_plus"))
    same = (taken["unit_key"] == plus["unit_key"]) & taken["doc_id"].eqNullSafe(plus["_doc"]) & taken["source"].eqNullSafe(plus["_source"]) & (taken["size"] == plus["_size"])
    return taken.join(plus, same, "left").select("doc_id", "source", "size", "n", "source_size", "target", "sure", (F.col("more") + F.coalesce("_plus", F.lit(0))).alias("more"))


def spread(counted: DataFrame) -> DataFrame:
    """copies() as one row for each document, with ``copies``, the times it is taken.
    Equal rows are written in runs of RUN, so that no task writes all of a hot one."""
    runs = counted.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN) * RUN, F.lit(RUN).cast("long"))))
    many = runs.where(F.col("n") > RUN).repartition("doc_id", "size", "_from")
    runs = runs.where(F.col("n") <= RUN).union(many)
    rows = runs.withColumn("_i", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + RUN, F.col("n")) - 1)))
    return rows.select("doc_id", "source", "size", "source_size", "target", "_i", (F.col("sure") + (F.col("_i") < F.col("more")).cast("long")).alias("copies"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken. Of rows equal in
    id, source and size those with the smaller hashes of their text come first."""
    at, i, time = (free_name(docs, c) for c in ("_unit", "_i", "_time"))
    keyed = numbered(docs.withColumn(at, F.struct(*_unit())), [F.col(at), F.xxhash64("text")], i)
    first = keyed.groupBy(at).agg(F.min(i).alias("_first"))
    known = copies(docs).select(F.struct("doc_id", "source", "size").alias("_key"), F.col("sure").alias("_sure"), F.col("more").alias("_more"))
    known = known.join(first, F.col("_key").eqNullSafe(F.col(at))).select("_key", "_first", "_sure", "_more")
    times = F.col("_sure") + (F.col(i) - F.col("_first") < F.col("_more")).cast("long")
    met = keyed.join(known, F.col(at).eqNullSafe(F.col("_key"))).where(times > 0)
    return met.select(*docs.columns, F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias(time)).select(*docs.columns)


def op11_mixing(spark, sf_dir: str) -> DataFrame:
    rows = spread(copies(read(spark, sf_dir, "documents")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
