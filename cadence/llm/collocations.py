"""Phrase collocation mining by prefix-free parsing.

Texts are split into pieces at punctuation and line ends, and pieces into words.
Each text's words are parsed into chunks: a chunk begins where the text does, and where
the hash of the next OVERLAP words is a multiple of TRIGGER (and every LONGEST
words where none is), so equal passages are cut alike wherever they stand. Inside a
chunk a line end stands between pieces. A chunk runs OVERLAP words into the next one,
within the piece that its end cuts, so each phrase of up to
OVERLAP + 1 words that starts in a chunk lies whole in it, and it is counted there
only: phrases that start in the overlap are the next chunk's. The distinct
chunks are the dictionary, with their frequencies in the parse; phrases are counted
inside distinct chunks, each weighted by its chunk's frequency. What the corpus
repeats is read once.

Counting. For each position of a distinct chunk one window is counted, the words
from there on, four at most; a shorter phrase's count is the sum over the windows
that begin with it. A window stops ahead of a word pair or triple that cannot be
frequent: hash buckets of pair counts, and then of the triples of such pairs, as
many as the corpus asks for up to 2**MOST_BITS, tell which can. They only ever keep
too many, so counts of phrases that reach ``least`` are exact, and equal those of
the plain way.

A phrase's score is 2000000 * a / (l + r), rounded down, for its worst cut in two.

Defined cases: null texts are empty; a null language is ``und``. Rows that repeat an
id are documents of their own; only text and lang are read. Ties rank by phrase.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.tables import byte_rows, cut, read, row_runs
from cadence.llm.words import LOWER, SEGMENT, mix, segments, word_hashes

LONGEST_PHRASE, LEAST, INSIDE, TOP = 4, 30, 80, 2000
OVERLAP, TRIGGER, LONGEST = LONGEST_PHRASE - 1, 16, 64
SCALE, NO_LANG = 2_000_000, "und"
FEWEST_BITS, MOST_BITS, BYTES_A_BUCKET = 14, 27, 48
RANK_PARTS = 64
#: log2 of the buckets that are summed up together.
BLOCK_BITS = 14
#: Bytes between pieces, and between the words of a piece.
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True
GAP = BREAK | BLANK
PAIR = np.random.Generator(np.random.PCG64(13)).integers(1, 2**63, OVERLAP, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _spans(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of words, and for each word whether a piece begins with it."""
    gap = GAP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(~gap & (np.append(True, gap[:-1]) | edge[:-1]))
    ends = np.flatnonzero(~gap & (np.append(gap[1:], True) | edge[1:])) + 1
    # A piece begins where a break or a text's edge lies between two words
    cuts = np.concatenate([np.flatnonzero(BREAK[data]), offsets[:-1]])
    at = np.searchsorted(starts, np.sort(cuts), "left")
    first = np.zeros(len(starts) + 1, bool)
    first[at] = True
    return starts, ends, first[:-1]


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
    """Words a to b (b not included) of each row, joined by one blank, or a line end ahead of
    a word that begins a piece."""
    length = ends - starts + 1  # with the blank behind
    run = np.append(0, np.cumsum(length))
    joined = np.full(run[-1], 0x20, np.uint8)
    joined[run[1:][np.flatnonzero(first[1:])] - 1] = 0x0A
    total = int((ends - starts).sum())
    from_ = np.arange(total) + np.repeat(starts - np.append(0, np.cumsum(ends - starts))[:-1], ends - starts)
    to = np.arange(total) + np.repeat(np.arange(len(starts)), ends - starts)
    joined[to] = data[from_]
    sizes = run[b] - run[a] - 1
    off = np.append(0, np.cumsum(sizes))
    take = np.arange(off[-1]) + np.repeat(run[a] - off[:-1], sizes)
    return pa.Array.from_buffers(pa.large_string(), len(a), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(joined[take])])


def chunks(data: np.ndarray, offsets: np.ndarray, upto: int | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The chunks of texts, how many of their last words are overlap, and their rows.
    Words from byte ``upto`` on are overlap only."""
    data = LOWER[data]
    starts, ends, first = _spans(data, offsets)
    n = len(starts)
    if not n:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    words, rows = word_hashes(data, offsets, lower=False, gap=GAP)
    piece = np.flatnonzero(first)
    last = np.repeat(np.append(piece[1:], n), np.diff(np.append(piece, n)))  # where each word's piece ends
    mark = np.append(True, rows[1:] != rows[:-1])
    if n > OVERLAP:
        h = np.zeros(n - OVERLAP + 1, np.uint64)
        for j in range(OVERLAP):
            h += words[j : j + len(h)] * PAIR[j]
        mark[: len(h)] |= mix(h) % np.uint64(TRIGGER) == 0
    begin = np.flatnonzero(mark)
    since = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    mark |= (since > 0) & (since % LONGEST == 0)
    mine = n if upto is None else int(np.searchsorted(starts, upto, "left"))
    if mine < n:
        mark[mine] = True
    begin = np.flatnonzero(mark)
    stop = np.append(begin[1:], n)
    begin, stop = begin[begin < mine], stop[begin < mine]
    end = np.minimum(stop + OVERLAP, last[stop - 1])
    return _texts(data, starts, ends, first, begin, end), end - stop, rows[begin]


def runs(data: np.ndarray, offsets: np.ndarray):
    """(first row, bytes, offsets, upto) of runs of texts of about a MB; a longer text is
    cut behind a word, and its run has the OVERLAP words that follow."""
    for a, b in row_runs(offsets):
        text = data[offsets[a] : offsets[b]]
        if b - a > 1 or len(text) <= 2 * SEGMENT:
            yield a, text, offsets[a : b + 1] - offsets[a], None
            continue
        for at, end in segments(text, np.array([0, len(text)]), GAP):
            ahead, step = end, 256
            while ahead < len(text) and len(_spans(text[end:ahead], np.array([0, ahead - end]))[0]) <= OVERLAP:
                ahead, step = min(len(text), ahead + step), 2 * step
            yield a, text[at:ahead], np.array([0, ahead - at]), end - at


def _parse(batches):
    """Chunks of a batch of texts with their languages, counted."""
    for batch in batches:
        data, off = byte_rows(batch.column("text"))
        langs = batch.column("lang")
        for a, part, edges, upto in runs(data, off):
            text, tail, row = chunks(part, edges, upto)
            table = pa.table({"lang": langs.take(pa.array(row + a)), "chunk": text, "tail": pa.array(tail.astype(np.int32))})
            got = table.group_by(["lang", "chunk", "tail"]).aggregate([([], "count_all")])
            yield from got.select(["lang", "chunk", "tail", "count_all"]).rename_columns(["lang", "chunk", "tail", "n"]).cast(pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("tail", pa.int32()), ("n", pa.int64())])).to_batches()


def dictionary(docs: DataFrame) -> DataFrame:
    """(lang, chunk, tail, n): the distinct chunks and their frequencies. The last
    ``tail`` words of a chunk are counted in another."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    parsed = rows.mapInArrow(_parse, "lang string, chunk string, tail int, n long")
    return parsed.groupBy("lang", "chunk", "tail").agg(F.sum("n").alias("n"))


def _words(batch: pa.RecordBatch):
    """A batch of the dictionary as arrays: its bytes, words' starts and ends and what begins a
    piece, their chunks, whether they are counted, hashes of the pairs that begin with them (with
    the language), and whether there is a pair."""
    data, off = byte_rows(batch.column("chunk").cast(pa.binary()))
    starts, ends, first = _spans(data, off)
    words, row = word_hashes(data, off, lower=False, gap=GAP)
    lang = batch.column("lang").dictionary_encode()
    own, at = word_hashes(*byte_rows(lang.dictionary.cast(pa.binary())), lower=False, gap=np.zeros(256, bool))
    tongue = np.zeros(len(lang.dictionary), np.uint64)
    tongue[at] = own
    own_words = np.bincount(row, minlength=len(off) - 1)
    counted = own_words - np.asarray(batch.column("tail"))
    place = np.arange(len(row)) - np.repeat(np.cumsum(own_words) - own_words, own_words)
    pair = np.zeros(len(row), np.uint64)
    same = (row[1:] == row[:-1]) & ~first[1:]
    pair[:-1][same] = mix(words[:-1] * PAIR[0] + words[1:] * PAIR[1] + tongue[lang.indices.to_numpy()][row[:-1]])[same]
    more = np.append(same, False)  # another word follows
    return (data, starts, ends, first), row, place < counted[row], pair, more


#: Rows of the dictionary that are turned into arrays at a time.
PART_ROWS = 1 << 13


def _parts(batch: pa.RecordBatch):
    for a in range(0, batch.num_rows, PART_ROWS):
        yield batch.slice(a, PART_ROWS)


def _chances(pair: np.ndarray, more: np.ndarray, bits: int, tables: list):
    """For two words and more: hashes of the phrases that begin with each word, and
    whether they can be frequent as far as ``tables`` tell (one more than tables)."""
    key, can = pair, more
    for table in [*tables, None]:
        if table is not None:
            bucket = key >> np.uint64(64 - bits)
            can = can & ((table[(bucket >> np.uint64(3)).astype(np.int64)] >> (bucket & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
        yield key, can
        key = mix(key * PAIR[0] + np.append(key[1:], np.uint64(0)) * PAIR[1])
        can = can & np.append(can[1:], False)


def _summed(buckets: np.ndarray, n: np.ndarray, least: int):
    """Distinct buckets and their sums; beyond ``least`` all sums are alike."""
    bucket, inverse = np.unique(buckets, return_inverse=True)
    return bucket, np.minimum(np.bincount(inverse, n, len(bucket)), least)


#: Buckets that a task holds ahead of handing on their sums.
HELD = 1 << 22


def _sums(bits: int, least: int, tables: list):
    """Sums of a task's buckets for phrases of len(tables) + 2 words: (block, places in it, sums)."""
    def packed(buckets, n):
        bucket, total = _summed(np.concatenate(buckets), np.concatenate(n), least)
        cuts = np.flatnonzero(np.diff(bucket >> np.uint64(BLOCK_BITS), prepend=np.uint64(2**63))) if len(bucket) else []
        low = (bucket & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.uint16)
        for a in range(0, len(cuts), 256):
            at = [*zip(cuts[a : a + 256].tolist(), [*cuts[a + 1 : a + 257].tolist(), len(bucket)])]
            yield pa.RecordBatch.from_arrays([pa.array([int(bucket[x]) >> BLOCK_BITS for x, _ in at], pa.int32()), pa.array([low[x:y].tobytes() for x, y in at], pa.binary()), pa.array([total[x:y].astype(np.uint32).tobytes() for x, y in at], pa.binary())], names=["block", "place", "n"])

    def rows(batches):
        buckets, n, held = [], [], 0
        read_in = [t.value for t in tables]
        for batch in batches:
            for part in _parts(batch):
                _, row, counted, pair, more = _words(part)
                *_, (key, can) = _chances(pair, more, bits, read_in)
                at = np.flatnonzero(counted & can)
                got = _summed(key[at] >> np.uint64(64 - bits), np.asarray(part.column("n")).astype(np.float64)[row[at]], least)
                buckets.append(got[0])
                n.append(got[1])
                held += len(got[0])
                if held > HELD:
                    yield from packed(buckets, n)
                    buckets, n, held = [], [], 0
        if held:
            yield from packed(buckets, n)

    return rows


def _frequent(least: int):
    """Bits of the buckets of each block that reach ``least``."""
    def rows(batches):
        sums: dict = {}
        for batch in batches:
            for block, place, n in zip(*(batch.column(c).to_pylist() for c in ("block", "place", "n"))):
                own = sums.setdefault(block, np.zeros(1 << BLOCK_BITS, np.uint32))
                at = np.frombuffer(place, np.uint16)
                own[at] = np.minimum(own[at] + np.frombuffer(n, np.uint32), least)
        for block, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(own >= least, bitorder="little").tobytes()], pa.binary())], names=["block", "bits"])

    return rows


def _table(chunked: DataFrame, bits: int, least: int, tables: list):
    """Broadcast bits of the buckets that reach ``least``: 2**bits / 8 bytes, 16 MB at most."""
    sums = chunked.mapInArrow(_sums(bits, least, tables), "block int, place binary, n binary").repartition("block")
    span = 1 << (BLOCK_BITS - 3)
    table = np.zeros((1 << bits) // 8, np.uint8)
    for r in sums.mapInArrow(_frequent(least), "block int, bits binary").collect():
        table[r["block"] * span : (r["block"] + 1) * span] = np.frombuffer(r["bits"], np.uint8)
    return chunked.sparkSession.sparkContext.broadcast(table)


def _singles(batches):
    for batch in batches:
        for part in _parts(batch):
            text, row, counted, _, _ = _words(part)
            at = np.flatnonzero(counted)
            table = pa.table({"lang": part.column("lang").take(pa.array(row[at])), "word": _texts(*text, at, at + 1), "n": part.column("n").take(pa.array(row[at]))})
            got = table.group_by(["lang", "word"]).aggregate([("n", "sum")]).select(["lang", "word", "n_sum"]).rename_columns(["lang", "word", "n"])
            yield from got.cast(pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])).to_batches()


def _windows(bits: int, tables: list):
    """Windows of two words or more whose pairs and triples can all be frequent; ``words``: how many words."""
    kinds = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])

    def rows(batches):
        read_in = [t.value for t in tables]
        for batch in batches:
            for part in _parts(batch):
                text, row, counted, pair, more = _words(part)
                size = np.ones(len(row), np.int64)
                for _, can in _chances(pair, more, bits, read_in):
                    size += can
                at = np.flatnonzero(counted & (size > 1))
                table = pa.table({"lang": part.column("lang").take(pa.array(row[at])), "words": pa.array(size[at].astype(np.int32)), "phrase": _texts(*text, at, at + size[at]), "n": part.column("n").take(pa.array(row[at]))})
                got = table.group_by(["lang", "words", "phrase"]).aggregate([("n", "sum")]).select(["lang", "words", "phrase", "n_sum"]).rename_columns(kinds.names)
                yield from got.cast(kinds).to_batches()

    return rows


def counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all phrases that occur ``least`` times, and (lang, n) of all words."""
    spark = docs.sparkSession
    chunked = cut(dictionary(docs))
    singles = cut(chunked.mapInArrow(_singles, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f")))
    totals = singles.groupBy("lang").agg(F.sum("f").alias("n"))
    size = chunked.agg(F.sum(F.octet_length("chunk"))).first()[0] or 0
    bits = min(MOST_BITS, max(FEWEST_BITS, math.ceil(math.log2(size / BYTES_A_BUCKET + 1))))
    tables: list = []
    for _ in range(2):  # pairs, then triples
        tables.append(_table(chunked, bits, least, tables))
    windows = chunked.mapInArrow(_windows(bits, tables), "lang string, words int, phrase string, n long")
    level = cut(windows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f")))
    for table in tables:
        table.unpersist()
    out = singles.where(F.col("f") >= least).select("lang", F.lit(1).alias("words"), F.col("word").alias("phrase"), "f")
    for n in range(LONGEST_PHRASE, 1, -1):  # a phrase's count: all windows that begin with it
        begin = level.where(F.col("words") >= n).select("lang", F.when(F.col("words") == n, F.col("phrase")).otherwise(F.substring_index("phrase", " ", n)).alias("phrase"), "f")
        sums = begin.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
        out = out.union(sums.select("lang", F.lit(n).alias("words"), "phrase", "f"))
    return cut(out), totals


def _part(a, n):
    """Words a to a + n - 1, counted from 1, of the column ``ws``."""
    return F.array_join(F.slice("ws", a, n), " ")


def collocations(docs: DataFrame, least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases."""
    known, totals = counts(docs, least)
    big = lambda c: F.col(c).cast("decimal(20,0)")
    phrases = known.where("words > 1").withColumn("ws", F.split("phrase", " "))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select("lang", "phrase", F.col("f").alias("a"), "k", _part(F.lit(1), F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    l = known.select(F.col("lang"), F.col("phrase").alias("first"), F.col("f").alias("l"))  # noqa: E741
    r = known.select(F.col("lang"), F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(l, ["lang", "first"]).join(r, ["lang", "rest"])
    # score is at most 1000000: a is not above l or r
    scored = scored.withColumn("score", F.expr(f"(CAST(a AS DECIMAL(20,0)) * {SCALE}) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))").cast("long"))
    worst = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("w")).select("lang", "phrase", "w.a", "w.l", "w.r", "w.score")
    within = F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.array_join(F.slice("ws", i, n), " ")))
    longer = phrases.where("words > 2").select("lang", "f", F.explode(F.flatten(within)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    met = worst.join(longer, ["lang", "phrase"], "left")
    left = met.where(F.col("longer").isNull() | (big("longer") * 100 < big("a") * inside)).drop("longer")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # first within a part of a language, so that one window never holds all of a hot one
    some = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    rows = collocations(read(spark, sf_dir, "documents").select("lang", "text"))
    return rows.withColumn("rank", F.col("rank").cast("long"))


ORACLE = rf"""
WITH d AS (SELECT coalesce(lang, '{NO_LANG}') AS lang,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT row_number() OVER () AS id, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT lang, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase, m AS words
      FROM p, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(ws) >= m),
f AS (SELECT lang, phrase, words, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, phrase, words, f, string_split(phrase, ' ') AS ws FROM f WHERE words > 1 AND f >= {LEAST}),
k AS (SELECT *, unnest(range(1, words)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, k.k, k.f AS a, l.f AS l, r.f AS r, (CAST({SCALE} AS HUGEINT) * k.f) // (l.f + r.f) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.ws[1:k.k], ' ')
             JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.ws[k.k + 1:k.words], ' ')),
w AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, f, words, ws, unnest(range(2, words)) AS m FROM c WHERE words > 2),
j AS (SELECT lang, f, unnest(list_transform(range(1, words - m + 2), lambda x: array_to_string(ws[x:x + m - 1], ' '))) AS phrase FROM i),
x AS (SELECT lang, phrase, max(f) AS longer FROM j GROUP BY ALL),
o AS (SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank, w.phrase, a, l, r, n.n, CAST(score AS BIGINT) AS score
      FROM w JOIN n ON n.lang = w.lang LEFT JOIN x ON x.lang = w.lang AND x.phrase = w.phrase
      WHERE x.longer IS NULL OR CAST(100 AS HUGEINT) * x.longer < CAST({INSIDE} AS HUGEINT) * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= {TOP}"""
