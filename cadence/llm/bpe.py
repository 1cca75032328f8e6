"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is read once on the driver (its size is that of a vocabulary,
not of the data) and broadcast. Long texts are cut at safe boundaries before
the library's pattern sees them: between a visible ASCII character and a
following space or line feed, or between an ASCII letter and digit. No match
of the pattern spans such a place and none looks across it to the left, so the
parts' ids are the whole text's ids. A text without such a place is encoded
whole.

Defined cases: a null or empty text has no ids and decodes to no bytes; bytes
that are not UTF-8 are read as U+FFFD; rows that repeat a doc_id or hold a null
one each come back. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.tables import byte_rows, read, row_runs

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Texts above so many bytes are encoded part by part.
PART_BYTES = 1 << 16
SAFE = re.compile(rb"(?<=[!-~])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")

_encodings: dict[int, tiktoken.Encoding] = {}


def load_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoding(ranks: bytes) -> tiktoken.Encoding:
    """The encoding of a rank file's content, built once in each worker."""
    if (key := hash(ranks)) not in _encodings:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return _encodings[key]


def parts(text: bytes, limit: int = PART_BYTES):
    """The text cut at the first safe boundary behind every ``limit`` bytes."""
    at = 0
    while len(text) - at > limit:
        m = SAFE.search(text, at + limit)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def ids_of(text: bytes, enc: tiktoken.Encoding) -> np.ndarray:
    if len(text) <= PART_BYTES:
        return np.array(enc.encode_ordinary(text.decode("utf-8", "replace")), "<u4")
    return np.concatenate([np.array(enc.encode_ordinary(p.decode("utf-8", "replace")), "<u4") for p in parts(text)])


def encode(docs: DataFrame, rank_path: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers, one after another)."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(rank_path))

    def rows(batches):
        enc = encoding(ranks.value)
        for batch in batches:
            data, off = byte_rows(batch.column("text"))
            for lo, hi in row_runs(off):
                held = [ids_of(data[off[i] : off[i + 1]].tobytes(), enc).tobytes() for i in range(lo, hi)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(held, pa.binary())], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(rows, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, rank_path: str) -> DataFrame:
    """doc_id, ids and the raw bytes that the ids stand for."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(rank_path))

    def rows(batches):
        enc = encoding(ranks.value)
        for batch in batches:
            data, off = byte_rows(batch.column("ids"))
            for lo, hi in row_runs(off, 1 << 22):
                held = [enc.decode_bytes(np.frombuffer(data[off[i] : off[i + 1]].tobytes(), "<u4").tolist()) for i in range(lo, hi)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "ids")), pa.array(held, pa.binary())], names=["doc_id", "ids", "bytes"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(rows, f"doc_id {kind}, ids binary, bytes binary")


def op10_bpe(spark, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    out = decode(encode(read(spark, sf_dir, "documents"), path), path)
    return out.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
