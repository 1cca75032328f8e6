"""Near-duplicate documents by b-bit MinHash.

Each document's set of word shingles gets ``PERMUTATIONS`` minima. Bands of
``ROWS`` minima are bucket keys; documents that share a bucket are candidates.
Of every minimum only the low ``BITS`` bits are kept, packed bit plane by bit
plane into longs; the share of equal lanes, corrected for lanes that agree by
chance, estimates a candidate's similarity with a few bit counts. Candidates
whose estimate is far under the threshold are dropped; the others are settled
exactly on their full sets.

Documents with equal sets are one class, linked through its smallest doc_id, so
thousands of copies cost one member. A pair with a similarity of exactly 0.75
is missed by all bands with a probability of 2e-5, and by the estimate with
less than 1e-6.

Defined cases: null or empty text, or text without words: empty set, linked
with nothing. Rows that repeat a doc_id each come back, with the component of their
own text; a link of one of them counts for all.
A null doc_id comes back with a null component and ``kept`` false. Columns
other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import graph
from cadence.llm.tables import byte_rows, cut, free_name, lean, read, row_runs, thinned
from cadence.llm.words import mix, shingle_sets

BANDS, ROWS, BITS = 40, 5, 2
PERMUTATIONS = BANDS * ROWS
#: A link needs DENOMINATOR * intersection >= NUMERATOR * union.
NUMERATOR, DENOMINATOR = 75, 100
#: Candidates under this estimate are dropped: five standard deviations under 0.75.
LEAST_ESTIMATE = 0.56
LANES = -(-PERMUTATIONS // 64)
#: A block of a bucket holds about so many documents and shingles at most.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 500_000

_rng = np.random.Generator(np.random.PCG64(21))
MULTIPLY = (_rng.integers(0, 2**31, (PERMUTATIONS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
ADD = _rng.integers(0, 2**32, (PERMUTATIONS, 1), dtype=np.uint64).astype(np.uint32)
FOLD = _rng.integers(1, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BAND_SALT = mix(np.arange(1, BANDS + 1, dtype=np.uint64))

SIGNATURE = "doc_id long, n_shingles long, set_hi long, set_lo long, bands array<long>, planes array<long>"


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of every permutation over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(PERMUTATIONS, 2**32 - 1, np.uint32)
    for at in range(0, len(x), 256):
        np.minimum(low, (MULTIPLY * x[None, at : at + 256] + ADD).min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    return mix((low.astype(np.uint64).reshape(BANDS, ROWS) * FOLD).sum(axis=1, dtype=np.uint64) + BAND_SALT).view(np.int64)


def bit_planes(low: np.ndarray) -> np.ndarray:
    """The low BITS bits of every minimum: LANES longs for each bit."""
    lanes = np.zeros((BITS, LANES * 64), np.uint8)
    for j in range(BITS):
        lanes[j, :PERMUTATIONS] = (low >> np.uint32(j)) & np.uint32(1)
    return np.packbits(lanes, axis=1, bitorder="little").view(np.int64).ravel()


def _signatures(batches):
    for batch in batches:
        data, offsets = byte_rows(batch.column("text"))
        sizes, digests, bands, planes = [], [], [], []
        for lo, hi in row_runs(offsets):
            for shingles in shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]):
                sizes.append(len(shingles))
                digests.append(np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64))
                if len(shingles):
                    low = minima(shingles)
                    bands.append(band_keys(low))
                    planes.append(bit_planes(low))
                else:
                    bands.append(np.zeros(0, np.int64))
                    planes.append(np.zeros(0, np.int64))
        if not sizes:
            continue
        lists = lambda rows: pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)), pa.array(np.concatenate(rows)))
        digests = np.array(digests)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]), lists(bands), lists(planes)],
            names=["doc_id", "n_shingles", "set_hi", "set_lo", "bands", "planes"])


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, set size, digest of the set, band keys and bit planes."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(lean(_signatures), SIGNATURE)


def estimate(x: str, y: str):
    """Collision-corrected similarity of two packed signatures, by bit counts."""
    equal = None
    for lane in range(LANES):
        differ = None
        for bit in range(BITS):
            d = F.col(x)[bit * LANES + lane].bitwiseXOR(F.col(y)[bit * LANES + lane])
            differ = d if differ is None else differ.bitwiseOR(d)
        n = F.bit_count(differ)
        equal = n if equal is None else equal + n
    chance = 1.0 / (1 << BITS)
    return (F.lit(1.0) - equal / F.lit(float(PERMUTATIONS)) - F.lit(chance)) / F.lit(1.0 - chance)


def is_link(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both) > 0


def _exact(batches):
    """Of pairs with both texts, those that are links on their full sets."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        (da, oa), (db, ob) = (byte_rows(batch.column(c)) for c in ("text_a", "text_b"))
        hub: tuple[bytes, np.ndarray] = (b"", np.zeros(0, np.uint64))  # neighbours often share it
        for i in range(batch.num_rows):
            own, other = da[oa[i] : oa[i + 1]], db[ob[i] : ob[i + 1]]
            if hub[0] != (raw := other.tobytes()):
                hub = raw, shingle_sets(other, np.array([0, len(other)]))[0]
            keep[i] = is_link(shingle_sets(own, np.array([0, len(own)]))[0], hub[1])
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])


def _wide(column) -> np.ndarray:
    column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), -1)  # all lists of one length


def _groups(batches):
    """Sorted rows -> the rows of each (key, i, j)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        at = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("key", "i", "j")])
        if not batch.num_rows:
            continue
        cuts = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if held and tuple(at[:, lo]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = tuple(at[:, lo])
    if held:
        yield pa.Table.from_batches(held)


def _likely(table: pa.Table):
    """Of two blocks of a bucket (or one with itself): row numbers of the pairs, in
    different components, that their packed signatures make likely."""
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    own, c = np.asarray(table.column("own")), np.asarray(table.column("c"))
    planes = _wide(table.column("planes")).view(np.uint64).reshape(len(own), BITS, LANES)
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    chance = 1.0 / (1 << BITS)
    for lo in range(0, len(left), 64):
        rows = left[lo : lo + 64]
        differ = np.zeros((len(rows), len(right)), np.int64)
        for lane in range(LANES):
            unlike = planes[rows, 0, lane][:, None] ^ planes[right, 0, lane][None, :]
            for bit in range(1, BITS):
                unlike |= planes[rows, bit, lane][:, None] ^ planes[right, bit, lane][None, :]
            differ += np.bitwise_count(unlike)
        likely = (1 - differ / PERMUTATIONS - chance) / (1 - chance) >= LEAST_ESTIMATE
        likely &= c[rows][:, None] != c[right][None, :]
        if i == j:
            likely &= rows[:, None] < right[None, :]
        x, y = np.nonzero(likely)
        yield rows[x], right[y]


def _likely_members(batches):
    """The rows that have a likely partner in their group."""
    for table in _groups(batches):
        has = np.zeros(table.num_rows, bool)
        for x, y in _likely(table):
            has[x] = has[y] = True
        if has.any():
            yield from table.filter(pa.array(has)).combine_chunks().to_batches()


def _settled(batches):
    """Links of the likely pairs, on their full sets; of each group those that join
    up what is not joined yet. A pair is left to the first bucket that it shares."""
    for table in _groups(batches):
        nodes, c, bands = np.asarray(table.column("node")), np.asarray(table.column("c")), _wide(table.column("bands"))
        data, off = byte_rows(table.column("text"))
        at = int(np.flatnonzero(bands[0] == table.column("key")[0].as_py())[0])
        sets: dict = {}
        above: dict = {}

        def root(x):
            while above.setdefault(x, x) != x:
                above[x] = x = above[above[x]]
            return x

        def shingles(k):
            if k not in sets:
                sets[k] = shingle_sets(data[off[k] : off[k + 1]], np.array([0, off[k + 1] - off[k]]))[0]
            return sets[k]

        out: tuple[list, list] = ([], [])
        for x, y in _likely(table):
            first = ~(bands[x, :at] == bands[y, :at]).any(axis=1)
            for m, n in zip(x[first].tolist(), y[first].tolist()):
                if (p := root(c[m])) != (q := root(c[n])) and is_link(shingles(m), shingles(n)):
                    above[p] = q
                    out[0].append(nodes[m])
                    out[1].append(nodes[n])
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])


class Verifier:
    """Links among candidates: first the estimate, then the full sets. Texts are
    fetched once for each document that reaches the second step."""

    def __init__(self, reps: DataFrame, docs: DataFrame):
        self.reps, self.held = reps, None
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def texts(self, wanted: DataFrame) -> DataFrame:
        wanted = wanted.toDF("doc_id").distinct()
        if self.held is not None:
            wanted = wanted.join(self.held.select("doc_id"), "doc_id", "left_anti")
        wanted = cut(wanted)
        new = cut(thinned(self.docs, "doc_id", wanted).join(wanted, "doc_id", "left_semi"))
        self.held = new if self.held is None else self.held.union(new)
        return self.held

    def pairs(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) those that are links."""
        side = lambda c: self.reps.select(F.col("node").alias(c), F.col("planes").alias(f"p{c}"))
        likely = pairs.join(side("a"), "a").join(side("b"), "b").where(estimate("pa", "pb") >= LEAST_ESTIMATE)
        likely = cut(likely.select("a", "b"))
        texts = self.texts(likely.select(F.explode(F.array("a", "b"))))
        text = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
        both = likely.join(text("a"), "a").join(text("b"), "b").select("a", "b", "text_a", "text_b")
        return both.mapInArrow(lean(_exact), "a long, b long").distinct()

    def buckets(self, at: DataFrame) -> DataFrame:
        """Links that join up the open buckets' nodes, found block by block."""
        at = at.join(self.reps, "node")
        size = at.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
        at = at.select("key", "node", "c", "bands", "planes").join(size, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        at = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        at = at.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
        at = at.select("key", "i", "j", "own", "node", "c", "bands", "planes")
        group = ("key", "i", "j")
        kind = "key long, i int, j int, own int, node long, c long, bands array<long>, planes array<long>"
        likely = cut(at.repartition(*group).sortWithinPartitions(*group).mapInArrow(lean(_likely_members), kind))
        texts = self.texts(likely.select("node")).select(F.col("doc_id").alias("node"), "text")
        rows = likely.join(texts, "node").select(*likely.columns, "text")
        return rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(lean(_settled), "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: see the module's docstring."""
    signed = cut(signatures(docs))
    classes = signed.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("set_hi", "set_lo").agg(F.min("doc_id").alias("node"))
    classes = cut(classes)
    reps = cut(signed.join(classes, ["set_hi", "set_lo"]).where("doc_id = node").select("node", "n_shingles", "bands", "planes").dropDuplicates(["node", "planes"]))
    members = reps.select(F.explode("bands").alias("key"), "node")
    links = Verifier(reps, docs)
    comps = graph.link_buckets(members, links.pairs, links.buckets)
    named = classes.join(comps, "node", "left").select("set_hi", "set_lo", F.coalesce("component", "node").alias("c"))
    out = signed.drop("bands", "planes").join(named, ["set_hi", "set_lo"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("c"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """Of each group of near duplicates the row with its smallest doc_id (of rows that
    repeat it, the one whose text has the least digest); rows with a null doc_id all
    stay. Rows are told apart by a number of their own, not by their doc_id: a row
    goes only if another row of its own component stays."""
    name = free_name(docs, "_row")
    rows = cut(docs.withColumn(name, F.monotonically_increasing_id()))  # cut: numbers stay as they are
    known = rows.where("doc_id IS NOT NULL")
    found = near_duplicates(known.select(F.col(name).alias("doc_id"), "text")).select(F.col("doc_id").alias("_id"), F.col("component_id").alias("_c"))
    rank = F.struct(F.col("doc_id").cast("long"), F.md5(F.col("text").cast("binary")), F.col(name)).alias("_rank")
    ranks = known.select(F.col(name).alias("_id"), rank)
    found = cut(found.join(ranks, "_id"))
    first = found.groupBy("_c").agg(F.min("_rank").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    gone = found.join(first, "_c").where("_rank <> _first").select(F.col("_id").alias(name))
    return rows.join(gone, name, "left_anti").select(*docs.columns)


def op1_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
