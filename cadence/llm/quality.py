"""Quality classifier on subword embeddings.

Words and byte n-grams of 3 to 5 bytes (spaces included) are hashed into one
table of learned vectors, and a word that repeats the one before it also counts
as one more, fixed entry; a document is the mean of its features' vectors, and
a softmax over two classes scores it. Both are fitted by plain stochastic
gradient descent in numpy on the sample of :mod:`cadence.llm.labelled`; the
sample's equal classes are put right by the classes' true odds.

Since the output is linear in the mean, a fitted model is one number for each
table entry, and scoring a document is a mean of these numbers.

Defined cases: null or empty text has no features and scores the classes'
share among all training labels (one half without labels). Rows that repeat a
doc_id, or have a null one, are scored on their own. Only text is an input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import labelled
from cadence.llm.tables import byte_rows, free_name, read
from cadence.llm.words import segments, word_hashes

BITS, DIM, EPOCHS, RATE = 18, 12, 8, 1.5
GRAMS, REPEAT = (3, 4, 5), 0
#: A document with at least this score is good.
LEAST_SCORE = 0.3
LETTER = np.random.Generator(np.random.PCG64(41)).integers(0, 2**32, 256, dtype=np.uint64).astype(np.uint32)
STEP = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1], np.uint32)


def features(data: np.ndarray, offsets: np.ndarray):
    """(table entries, their rows) of every kind of feature in turn; a long run of texts is
    read in segments that end behind a word."""
    before = None
    for at, end in segments(data, offsets):
        inside = offsets[(offsets > at) & (offsets < end)]
        first = int(np.searchsorted(offsets, at, "right")) - 1
        words, of = word_hashes(data[at:end], np.concatenate([[at], inside, [end]]) - at, lower=False)
        rows = np.append(first, np.searchsorted(offsets, inside, "right") - 1)[of]
        yield (words >> np.uint64(64 - BITS)).astype(np.int64), rows
        again = rows[1:][(words[1:] == words[:-1]) & (rows[1:] == rows[:-1])]
        if len(words):
            if before == (words[0], rows[0]):
                again = np.append(rows[0], again)
            before = (words[-1], rows[-1])
        yield np.full(len(again), REPEAT), again
        letters = LETTER[data[at : end + max(GRAMS) - 1]]
        row = np.searchsorted(offsets, np.arange(at, at + len(letters)), "right") - 1
        for size in GRAMS:
            n = min(end - at, len(letters) - size + 1)
            if n <= 0:
                break
            h = sum((letters[j : n + j] * STEP[j] for j in range(size)), np.zeros(n, np.uint32))
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D + 2 * size)
            same = row[:n] == row[size - 1 : n + size - 1]
            yield (h >> np.uint32(32 - BITS)).astype(np.int64)[same], row[:n][same]


def _counted(table: pa.Table):
    """Each document's distinct features and their shares."""
    data, off = byte_rows(table.column("text").cast(pa.binary()))
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        entry, n = np.unique(np.concatenate([e for e, _ in features(data[a:b], np.array([0, b - a]))]), return_counts=True)
        yield entry.astype(np.int32), (n / n.sum()).astype(np.float32)


def learn(table: pa.Table) -> tuple[np.ndarray, float] | None:
    """One number for each table entry, and a constant, of a sample; None without both classes."""
    truth = np.asarray(table.column("_label"))
    if len(set(truth.tolist())) < 2:
        return None
    ids, shares = zip(*_counted(table))
    rng = np.random.Generator(np.random.PCG64(42))
    table = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(truth), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(truth)):
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            mean = shares[i] @ table[ids[i]]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[truth[i]] -= 1  # the loss by the outputs
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * np.float32(0.1) * p
            table[ids[i]] -= rate * shares[i][:, None] * back
    share = truth.mean()
    return table @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]) - float(np.log(share / (1 - share)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", half: int = labelled.HALF) -> tuple[np.ndarray, float]:
    """One number for each table entry, and a constant: a document's log odds."""
    rows, odds = labelled.sample(docs, labels, label, half)
    weights, constant = labelled.fitted(rows, learn) or (np.zeros(1 << BITS, np.float32), 0.0)
    return weights, constant + odds


def scores(weights: np.ndarray, constant: float, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    total, count = np.zeros(n), np.zeros(n)
    for entry, row in features(data, offsets):
        total += np.bincount(row, weights[entry], n)
        count += np.bincount(row, minlength=n)
    return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + constant)))


def with_quality(docs: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """``docs`` with the score, between 0 and 1, as column ``name``."""
    weights, constant = fit(docs, labels)
    weights = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** BITS numbers
    return labelled.scored(docs, lambda data, offsets: scores(weights.value, constant, data, offsets), name)


def good_documents(docs: DataFrame, labels: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    name = free_name(docs, "_score")
    return with_quality(docs, labels, name).where(F.col(name) >= least).drop(name)


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = with_quality(docs, read(spark, sf_dir, "labels"), "score")
    return out.select("doc_id", labelled.held_out().alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))
