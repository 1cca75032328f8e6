"""Reading, lineage cuts and Arrow access shared by the operators."""

from __future__ import annotations

import contextlib
import ctypes
import pathlib
import sys
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import functions as F

from cadence.plans.sizing import cut

__all__ = ["byte_rows", "cut", "free_name", "lean", "read", "row_runs", "ship_code", "thinned"]

#: Rows that a task hands to Python at a time: texts are long.
BATCH_ROWS = 1000
#: Bytes of text that a task turns into arrays at a time.
RUN_BYTES = 1 << 20


def ship_code(spark) -> None:
    """Sends this package to the executors, once for each Spark context, so that
    their Python workers need no copy of it on their path; and sets the session's
    Arrow batches to BATCH_ROWS."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    sc = spark.sparkContext
    if getattr(sc, "_cadence_shipped", False):
        return
    top = pathlib.Path(__file__).resolve().parent.parent
    path = f"{tempfile.mkdtemp(dir=SparkFiles.getRootDirectory())}/cadence-code.zip"  # Spark serves it and removes it in the end
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(path)
    sys.path[:] = [p for p in sys.path if not p.endswith("cadence-code.zip")]
    sc._cadence_shipped = True


def lean(rows):
    """``rows``, a function for mapInArrow, with a worker that hands freed memory back after
    each task: workers live on, and the next stage's may need it."""
    def run(batches):
        yield from rows(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # a system without malloc_trim keeps it
            ctypes.CDLL(None).malloc_trim(0)

    return run


def read(spark, sf_dir: str, table: str):
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(docs, name: str) -> str:
    """``name``, with underscores added while the table has such a column."""
    while name in docs.columns:
        name += "_"
    return name


#: Bits of the filter that thinned() sends to every task: 4 MB.
FILTER_BITS = 25


def thinned(rows, column: str, ids):
    """``rows`` without most of those whose ``column`` is not among ``ids`` (one
    column): a hash filter of a fixed size, ahead of an exact join on the same
    column, so that the join shuffles few rows that it drops. The more ids, the
    less the filter keeps out; it never keeps out a row that the join needs."""
    h = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS))
    hashed = ids.select(h(F.col(ids.columns[0])).alias("h"))
    maps = hashed.groupBy(F.bitmap_bucket_number("h").alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("_map"))
    at = F.bitmap_bit_position(h(F.col(column)))
    byte = F.conv(F.hex(F.substring(F.col("_map"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    met = rows.join(F.broadcast(maps), F.bitmap_bucket_number(h(F.col(column))) == F.col("_part"))
    return met.where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*rows.columns)


def byte_rows(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow binary column as one array, and the offsets of its
    rows in it (one more than rows). A null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[off[0] : off[-1]], off - off[0]


def row_runs(offsets: np.ndarray, limit: int = RUN_BYTES):
    """(lo, hi) runs of rows of about ``limit`` bytes; a longer row is a run of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi
