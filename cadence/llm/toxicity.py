"""Toxicity by a convolutional text classifier.

Lower-cased words (runs of letters and digits; any byte above 0x7F counts as
one) are hashed into two tables of learned vectors, so that a rare word that
falls on another's entry in one table differs in the other. Filters over one,
two and three words, the largest value of each over the windows that begin at the
document's own words, and one logistic output follow. All is fitted in numpy by stochastic gradients on most
of the sample of :mod:`cadence.llm.labelled`.

All labelled training rows that were not fitted on are then scored and counted
by language, score bin and label; from these counts each language gets the
threshold with the best F1, and the score is shifted so that the threshold of the
text's language becomes one half. The language is told from the text, by its
function words (texts without one of ``FUNCTION_WORDS`` count as one more language); a
language with fewer than ``LEAST_ROWS`` such rows of a label takes the threshold
of all.

Defined cases: null or empty text scores like a text of unknown words. Rows
that repeat a doc_id, or have a null one, are scored on their own. Without
labels of both classes every score is the share of label 1 (one half without
labels). Only text is an input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import labelled
from cadence.llm.tables import byte_rows, free_name, lean, read, row_runs, thinned
from cadence.llm.words import word_hashes

BITS, HALF_DIM, FILTERS, WIDTHS = 17, 8, 12, (1, 2, 3)
EPOCHS, BATCH, RATE, CALIBRATION, LEAST_ROWS = 8, 16, 0.02, 5, 40
LEAST_TEXTS, DROP, DECAY = 4, 0.3, 3e-3
#: Width of the bins that logits are counted in, and the last bin on either side.
BIN, LAST_BIN = 1 / 256, 1 << 14
PAD = max(WIDTHS) - 1
#: Words of one text whose windows are read at a time.
MOST_WORDS = 1 << 17
GAP = np.ones(256, bool)
GAP[0x80:] = False
for lo, hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    GAP[lo:hi] = False

#: Function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on be by this are from or an",
    "fr": "le la les des et un une en du que qui dans pour par sur est pas au avec ce",
    "de": "der die und das den von zu mit ist des im für auf nicht ein eine dem sich als auch",
    "es": "el los las del y una por con para se su al lo como más pero sus este ya o",
}


def _function_hashes() -> tuple[np.ndarray, np.ndarray]:
    text = "\n".join(FUNCTION_WORDS.values()).encode()
    lines = np.cumsum([0] + [len(x.encode()) + 1 for x in FUNCTION_WORDS.values()])
    lines[-1] -= 1
    hashes, of = word_hashes(np.frombuffer(text, np.uint8), lines, gap=GAP)
    order = np.argsort(hashes)
    return hashes[order], of[order]


FUNCTION_HASHES, FUNCTION_LANG = _function_hashes()


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(data, offsets, gap=GAP)


def languages(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Each text's language by its function words; one more than the last if it has none."""
    k = len(FUNCTION_WORDS)
    at = np.minimum(np.searchsorted(FUNCTION_HASHES, hashes), len(FUNCTION_HASHES) - 1)
    hit = FUNCTION_HASHES[at] == hashes
    met = np.bincount(rows[hit] * k + FUNCTION_LANG[at[hit]], minlength=n * k).reshape(n, k)
    return np.where(met.any(axis=1), met.argmax(axis=1), k)


def padded(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes with PAD zeros behind each text's, and where each text starts. A text
    without words has one zero more, as its only word."""
    count = np.bincount(rows, minlength=n)
    starts = np.concatenate([[0], np.cumsum(np.maximum(count, 1) + PAD)])
    out = np.zeros(starts[-1], np.uint64)
    out[np.arange(len(hashes)) + (starts[:-1] - np.cumsum(count) + count)[rows]] = hashes
    return out, starts


def entries(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries in the two tables; entry 0 is the padding's."""
    a = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    b = ((hashes >> np.uint64(8)) & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return np.where(hashes == 0, 0, np.maximum(a, 1)), np.where(hashes == 0, 0, np.maximum(b, 1))


class Model:
    """Tables, filters and output, with what calibration adds."""

    def __init__(self, seed: int = 51):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.tables = [rng.normal(0, 0.1, (1 << BITS, HALF_DIM)).astype(np.float32) for _ in range(2)]
        for t in self.tables:
            t[0] = 0
        self.filters = [rng.normal(0, 0.3, (w * 2 * HALF_DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.constant = 0.0
        self.thresholds = np.zeros(len(FUNCTION_WORDS) + 1)

    def maxima(self, hashes: np.ndarray, starts: np.ndarray, where: bool = False):
        """Each text's largest value of every filter (texts by filters); and the
        vectors and places it comes from, if asked for."""
        a, b = entries(hashes)
        x = np.concatenate([self.tables[0][a], self.tables[1][b]], axis=1)
        pads = (starts[1:, None] - 1 - np.arange(PAD)).ravel()
        top, places = [], []
        for w, f, bias in zip(WIDTHS, self.filters, self.bias):
            m = len(x) - w + 1
            d = 2 * HALF_DIM
            value = x[:m] @ f[:d]
            for j in range(1, w):
                value += x[j : j + m] @ f[j * d : (j + 1) * d]
            value[pads[pads < m]] = -np.inf  # windows that begin there reach into the next text
            best = np.maximum.reduceat(value, starts[:-1], axis=0)
            top.append(np.maximum(best + bias, 0))
            if where:
                at = np.empty(best.shape, np.int64)
                for i, (s, e) in enumerate(zip(starts[:-1], np.append(starts[1:-1], m))):
                    at[i] = value[s:e].argmax(axis=0) + s
                places.append(at)
        return (np.concatenate(top, axis=1), x, (a, b), places) if where else np.concatenate(top, axis=1)

    def logits(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if len(starts) == 2 and len(hashes) > MOST_WORDS:  # one long text: part by part
            top = None
            for a in range(0, len(hashes) - PAD, MOST_WORDS):
                part = hashes[a : a + MOST_WORDS + PAD]  # the words behind take the place of the padding
                got = self.maxima(part, np.array([0, len(part)]))
                top = got if top is None else np.maximum(top, got)
        else:
            top = self.maxima(hashes, starts)
        return top @ self.out + self.constant

    def learn(self, texts: list[np.ndarray], truth: np.ndarray, seed: int = 52) -> None:
        """Adam on filters and output, and on the table entries that a batch touches."""
        rng = np.random.Generator(np.random.PCG64(seed))
        state: dict = {}

        def step(name, value, grad, rate, rows=None):
            m, v = state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
            at = slice(None) if rows is None else rows
            m[at] = 0.9 * m[at] + 0.1 * grad
            v[at] = 0.99 * v[at] + 0.01 * grad * grad
            value[at] -= rate * m[at] / (np.sqrt(v[at]) + 1e-6)

        # words of a few texts only would be learned by heart: they stay unknown
        seen, n = np.unique(np.concatenate([np.unique(t) for t in texts]), return_counts=True)
        common = seen[n >= LEAST_TEXTS]
        texts = [np.where(np.isin(t, common), t, np.uint64(0)) for t in texts]
        known = entries(common)
        for t, e in zip(self.tables, known):
            used = t[e].copy()
            t[:] = 0
            t[e] = used
        d, steps, done = 2 * HALF_DIM, EPOCHS * (-(-len(texts) // BATCH)), 0
        constant = np.zeros(1, np.float32)
        for _ in range(EPOCHS):
            order = rng.permutation(len(texts))
            for lo in range(0, len(order), BATCH):
                rate = RATE * (1 - done / steps)
                done += 1
                pick = order[lo : lo + BATCH]
                n = np.array([len(texts[i]) for i in pick])
                hashes, starts = padded(np.concatenate([texts[i] for i in pick]), np.repeat(np.arange(len(pick)), n), len(pick))
                top, x, (a, b), places = self.maxima(hashes, starts, where=True)
                top *= (rng.random(top.shape) >= DROP) / np.float32(1 - DROP)
                p = 1 / (1 + np.exp(-(top @ self.out + constant[0])))
                err = ((p - truth[pick]) / len(pick)).astype(np.float32)
                back = np.outer(err, self.out) * (top > 0)
                step("out", self.out, top.T @ err + DECAY * self.out, rate)
                step("constant", constant, np.array([err.sum()], np.float32), rate)
                dx: list = []
                for k, (w, f) in enumerate(zip(WIDTHS, self.filters)):
                    g = back[:, k * FILTERS : (k + 1) * FILTERS]
                    df = np.zeros_like(f)
                    for j in range(w):
                        at = places[k] + j
                        df[j * d : (j + 1) * d] = np.einsum("tfd,tf->df", x[at], g)
                        live = np.nonzero(g)
                        dx.append((at[live], f[j * d : (j + 1) * d].T[live[1]] * g[live][:, None]))
                    step(f"filter{k}", f, df + DECAY * f, rate)
                    step(f"bias{k}", self.bias[k], g.sum(axis=0), rate)
                at, grad = np.concatenate([q for q, _ in dx]), np.concatenate([q for _, q in dx])
                for t, e, part in ((0, a[at], grad[:, :HALF_DIM]), (1, b[at], grad[:, HALF_DIM:])):
                    rows, of = np.unique(e, return_inverse=True)
                    total = np.zeros((len(rows), HALF_DIM), np.float32)
                    np.add.at(total, of, part)
                    rows, total = rows[rows != 0], total[rows != 0]
                    step(f"table{t}", self.tables[t], total + DECAY * self.tables[t][rows], rate, rows)
        self.constant = float(constant[0])

    def calibrate(self, lang: np.ndarray, bins: np.ndarray, truth: np.ndarray, n: np.ndarray, weight: float) -> None:
        """The threshold with the best F1 for all and for each language, from the
        numbers ``n`` of rows by language, bin and label; rows of label 0 stand for
        ``weight`` rows each."""

        def best(own):
            at, of = np.unique(bins[own], return_inverse=True)
            one, zero = (np.bincount(of, n[own] * (truth[own] == k), len(at)) for k in (1, 0))
            hit, miss = (x.sum() - np.cumsum(x)[:-1] for x in (one, zero))
            cuts = (at[1:] + at[:-1] + 1) / 2 * BIN
            return float(max(zip(2 * hit / (hit + miss * weight + one.sum()), cuts))[1]) if len(cuts) else 0.0

        everywhere = best(np.ones(len(n), bool))
        for k in range(len(self.thresholds)):
            own = lang == k
            enough = n[own & (truth == 1)].sum() >= LEAST_ROWS and n[own & (truth == 0)].sum() >= LEAST_ROWS
            self.thresholds[k] = best(own) if enough else everywhere

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        hashes, rows = words_of(data, offsets)
        z = self.logits(*padded(hashes, rows, n)) - self.thresholds[languages(hashes, rows, n)]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def learned(table: pa.Table) -> tuple[Model, np.ndarray] | None:
    """A model fitted on most of a sample, and the hashes of the rows it saw; None without both classes."""
    truth, order = np.asarray(table.column("_label")), np.asarray(table.column("_order"))
    held = np.isin(order, np.unique(order)[::CALIBRATION])
    if len(set(truth[~held].tolist())) < 2:
        return None
    data, off = byte_rows(table.column("text").cast(pa.binary()))
    texts = [words_of(data[a:b], np.array([0, b - a]))[0] for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
    model = Model()
    model.learn([t for t, h in zip(texts, held) if not h], truth[~held])
    return model, np.unique(order[~held])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", half: int = labelled.HALF) -> Model | float:
    """A calibrated model; or, without labels of both classes, the log odds."""
    rows, odds = labelled.sample(docs, labels, label, half)
    got = labelled.fitted(rows, learned)
    if got is None:
        return odds
    model, seen = got
    lang, bins, truth, n = unfitted(model, docs, labels, label, seen)
    if len(set(truth.tolist())) == 2:
        model.calibrate(lang, bins, truth, n, float(np.exp(-odds) * n[truth == 1].sum() / n[truth == 0].sum()))
    return model


def unfitted(model: Model, docs: DataFrame, labels: DataFrame, label: str, fitted: np.ndarray) -> np.ndarray:
    """Language, bin of the logit, label and number of all labelled training rows but
    those fitted on, which ``fitted`` has the hashes of. Texts are scored where they
    lie; only numbers are shuffled, and only counts come to the driver."""
    known = labelled.training(labels, label)
    rows = thinned(docs.select(F.col("doc_id").cast("long").alias("_id"), "text"), "_id", known.select("_id"))
    sampled = F.coalesce(F.octet_length("text").between(1, labelled.MOST_BYTES), F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast((model, fitted))  # of a fixed size

    def score(batches):
        model, fitted = shared.value
        for batch in batches:
            batch = batch.filter(pa.array(~(np.asarray(batch.column("sampled")) & np.isin(np.asarray(batch.column("order")), fitted))))
            data, off = byte_rows(batch.column("text"))
            for a, b in row_runs(off):
                hashes, of = words_of(data[off[a] : off[b]], off[a : b + 1] - off[a])
                bins = np.clip(np.floor(model.logits(*padded(hashes, of, b - a)) / BIN), -LAST_BIN, LAST_BIN).astype(np.int32)
                lang = languages(hashes, of, b - a).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("_id").slice(a, b - a), pa.array(lang), pa.array(bins)], names=["_id", "lang", "bin"])

    found = rows.select("_id", "text", sampled.alias("sampled"), F.xxhash64("_id").alias("order")).mapInArrow(lean(score), "_id long, lang int, bin int")
    counts = found.join(known, "_id").groupBy("lang", "bin", "_label").agg(F.count("*").alias("n")).collect()
    shared.unpersist()
    return np.array([tuple(r) for r in counts], np.int64).reshape(-1, 4).T


def with_toxicity(docs: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """``docs`` with the score, between 0 and 1, as column ``name``."""
    model = fit(docs, labels)
    if isinstance(model, float):
        return docs.withColumn(name, F.lit(1 / (1 + np.exp(-model))).cast("double"))
    model = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size
    return labelled.scored(docs, lambda data, offsets: model.value.scores(data, offsets), name)


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    name = free_name(docs, "_score")
    return with_toxicity(docs, labels, name).where(F.col(name) < 0.5).drop(name)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = with_toxicity(docs, read(spark, sf_dir, "labels"), "score")
    return out.select("doc_id", labelled.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
