"""Shards of bounded size by extendible hashing, in DataFrame operations only.

A document's key is hashed to 60 bits. The directory is indexed by the hash's
leading bits; a bucket that exceeds the byte limit, and only such a bucket, is
split on its next bit until it fits. Rather than one pass over the documents
for each bit, they are summed once for ``STEP`` bits, the splits are worked
out on these sums, and only documents of buckets that are still too large
take part in the next round.

Defined cases: rows that repeat a key cannot be told apart by any bit, so a
bucket with one distinct hash is never split, even if it exceeds the limit (as
one document above the limit does). A null doc_id hashes like the empty string;
a null text has 0 bytes. An empty table has no shards. Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.tables import cut, read

BITS, STEP = 60, 12
#: Bytes of text a shard may hold.
LIMIT = 4 << 20


def _prefix(h, depth: int):
    return F.shiftright(h, BITS - depth) if depth else F.lit(0).cast("long")


def shards(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, shard_id (the bucket's hash bits; '' if there is only
    one), depth (how many) and shard_bytes (the bucket's total)."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    h = F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")
    rows = cut(docs.select("doc_id", h.alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")))
    done, depth = None, 0
    while True:
        deeper = depth + STEP
        cell = _prefix(F.col("h"), deeper).alias("cell")
        cells = rows.groupBy(cell).agg(F.sum("n_bytes").alias("b"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        tried = cut(cells.withColumn("depth", F.explode(F.sequence(F.lit(depth), F.lit(deeper)))))
        tried = tried.withColumn("bucket", F.expr(f"shiftright(cell, {deeper} - depth)"))
        sums = tried.groupBy("depth", "bucket").agg(F.sum("b").alias("shard_bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("lo") == F.col("hi"))).select("depth", "bucket", "shard_bytes")
        leaf = tried.select("cell", "depth", "bucket").join(fits, ["depth", "bucket"])
        leaf = leaf.groupBy("cell").agg(F.min(F.struct("depth", "bucket", "shard_bytes")).alias("leaf")).select("cell", "leaf.*")
        directory = cut(leaf)
        placed = rows.withColumn("cell", cell).join(directory, "cell", "left")
        shard = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("lpad(bin(bucket), depth, '0')"))
        closed = placed.where("depth IS NOT NULL").select("doc_id", "n_bytes", shard.alias("shard_id"), F.col("depth").cast("int").alias("depth"), "shard_bytes")
        done = closed if done is None else done.unionByName(closed)
        depth = deeper
        left = tried.select("cell").distinct().join(directory, "cell", "left_anti")
        if depth >= BITS or left.isEmpty():
            return done
        rows = cut(placed.where("depth IS NULL").select("doc_id", "h", "n_bytes"))


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    return shards(read(spark, sf_dir, "documents"))


ORACLE = f"""
WITH d AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h,
                  CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes FROM documents),
t AS (SELECT d.*, k.depth, h >> ({BITS} - k.depth) AS bucket FROM d, (SELECT unnest(range(0, {BITS + 1})) AS depth) k),
s AS (SELECT depth, bucket, sum(n_bytes) AS shard_bytes, min(h) = max(h) AS one FROM t GROUP BY depth, bucket),
f AS (SELECT t.doc_id, t.h, t.n_bytes, t.depth, t.bucket, s.shard_bytes,
             row_number() OVER (PARTITION BY t.doc_id, t.h ORDER BY t.depth) AS rn
      FROM t JOIN s USING (depth, bucket) WHERE s.shard_bytes <= {LIMIT} OR s.one)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(bucket), CAST(depth AS INTEGER), '0') END AS shard_id,
       CAST(depth AS INTEGER) AS depth, CAST(shard_bytes AS BIGINT) AS shard_bytes FROM f WHERE rn = 1"""
