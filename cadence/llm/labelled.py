"""Bounded training samples and scoring, shared by the two classifiers.

The sample: of each class the ``half`` labelled rows with the smallest hashes of
their doc_id, without those whose doc_id's crc32 is a multiple of 5 (held out),
and without texts above ``MOST_BYTES``; one row for each doc_id, that with the least
text. The bound is on the rows that a model is fitted on, once, in one task; every
document is scored. The classes' shares
are counted over all training labels.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cadence.llm.tables import byte_rows, lean, row_runs

HALF, MOST_BYTES, FOLDS = 1500, 1 << 16, 5


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def training(labels: DataFrame, label: str) -> DataFrame:
    """(_id, _label) of all training labels. A doc_id with several labels takes the least."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
    return known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min(label).cast("int").alias("_label"))


def sample(docs: DataFrame, labels: DataFrame, label: str, half: int = HALF) -> tuple[DataFrame, float]:
    """(text, label) of the sample, and the log odds of label 1 over all training
    labels."""
    known = training(labels, label)
    n = {int(r["_label"]): r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    odds = math.log((n.get(1, 0) + 1) / (n.get(0, 0) + 1))
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(half)
        chosen = part if chosen is None else chosen.union(part)
    # at most 2 * half rows of two numbers
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").where(F.octet_length("text").between(1, MOST_BYTES)).join(F.broadcast(chosen), "_id")
    rows = rows.groupBy("_id", "_label").agg(F.min("text").alias("text"))
    return rows.select("text", "_label", F.xxhash64("_id").alias("_order")), odds


def fitted(rows: DataFrame, fit):
    """``fit`` of a sample (a table of text, _label and _order, in order), called in one task
    on an executor; only what it returns comes to the driver, as a pickle."""
    def once(batches):
        batches = list(batches)
        table = pa.Table.from_batches(batches, None if batches else pa.schema([("text", pa.string()), ("_label", pa.int32()), ("_order", pa.int64())]))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(table.sort_by("_order")))], pa.binary())], names=["model"])

    # at most 2 * half rows of MOST_BYTES
    got = rows.repartition(1).mapInArrow(lean(once), "model binary").collect()
    return pickle.loads(bytes(got[0]["model"])) if got else None


def scored(docs: DataFrame, score_rows, name: str) -> DataFrame:
    """``docs`` with a column ``name``: score_rows(bytes, offsets) of ``text``."""
    def rows(batches):
        for batch in batches:
            data, off = byte_rows(batch.column("text"))
            got = [score_rows(data[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in row_runs(off)]
            yield batch.append_column(name, pa.array(np.concatenate(got) if got else np.zeros(0), pa.float64()))

    return docs.mapInArrow(lean(rows), StructType([*docs.schema.fields, StructField(name, DoubleType())]))

