"""Documents packed into training sequences along a space-filling curve.

A document's words, hashed, are summed up to a vector in ``AXES`` dimensions
(a random projection of its bag of words); the vector's place on a Hilbert
curve puts documents with similar words next to each other. Documents are
range-sorted by that place and each range is packed in order: a document's
tokens fill up the open sequence and go on in the next. What is left at the end
of a range is cut into pieces whose lengths are powers of two, each a sequence of its own,
since sequences of such lengths are not padded. So no sequence is padded.

Ranges are cut where the places' quantiles lie. A place ends with bits of the
doc_id's hash, so thousands of equal documents spread over several ranges.

Token ids are those of the tokenizers library. Texts are split as its
byte-level rule does, on arrays of code points, and each distinct piece is
encoded once while it is known; new pieces go to the library many in a string, in
which its rule splits them again, and are told apart by the bytes that ids stand for.
Texts with characters outside the Latin blocks are encoded whole by the library. The string of an added token such as <|endoftext|> in a text is
ordinary text, as in the call that the README of public_tokenizers gives.

Defined cases: a null or empty text has the end token only; rows that repeat a
doc_id, or have a null one, are packed on their own. An empty table has no
pieces. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.tables import byte_rows, cut, lean, read, row_runs
from cadence.llm.words import mix, powers, word_hashes

SEQUENCE, END = 2048, 1
AXES, AXIS_BITS, TIE_BITS = 4, 10, 20
#: Bytes of text in a range; in a stretch that is split at a time.
RANGE_BYTES, STRETCH = 32 << 20, 2 << 20
#: Slots for known pieces are two to this power; ids that a worker keeps for them; new pieces the library gets in one string.
SLOT_BITS, KNOWN_IDS, JOINED = 20, 1 << 22, 64
TOKENIZER = "byte_bpe_50k.json"


# -- the curve ---------------------------------------------------------------
def hilbert_place(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits`` bits in each of their
    columns: the axes are turned into the curve's transposed place, whose bits
    are then interleaved."""
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(axes):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[:, -1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t[:, None]
    place = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            place = (place << 1) | ((x[:, i] >> bit) & 1)
    return place


def curve_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each text's place on the curve."""
    n = len(offsets) - 1
    words, rows = word_hashes(data, offsets)
    count = np.maximum(np.bincount(rows, minlength=n), 1)
    cells = np.empty((n, AXES), np.int64)
    for i in range(AXES):
        part = ((words >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.float64) / 32768 - 1
        mean = np.bincount(rows, part, n) / count
        cells[:, i] = np.clip((mean + 0.25) * 2 * (1 << AXIS_BITS), 0, (1 << AXIS_BITS) - 1)
    return hilbert_place(cells, AXIS_BITS)


def _placed(batches):
    for batch in batches:
        data, off = byte_rows(batch.column("text"))
        got = [curve_places(data[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in row_runs(off)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(got) if got else np.zeros(0, np.int64)), batch.column("tie"), pa.array(np.diff(off))], names=["place", "tie", "n"])


# -- tokens ------------------------------------------------------------------
class Splitter:
    """Token ids of many texts at once, by the tokenizers library."""

    LATIN = 0x280  # all that lead bytes up to 0xC9 open
    CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

    def __init__(self, path_or_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(path_or_json)
        self.library.encode_special_tokens = True
        split = self.library.pre_tokenizer.pre_tokenize_str
        kinds = np.zeros(self.LATIN, np.int8)  # 0 white space, 1 letter, 2 number, 3 other: as the library's own rule has it
        for c in range(self.LATIN):
            for kind, mate in ((1, "a"), (2, "1"), (3, "!")):
                if len(split(chr(c) + mate)) == 1 and len(split(mate + chr(c))) == 1:
                    kinds[c] = kind
                    break
        self.kinds = kinds
        self.letter = np.random.Generator(np.random.PCG64(61)).integers(1, 2**63, self.LATIN, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.id_bytes = np.zeros(1 << 16, np.int64)  # a byte is a character of the name
        self.id_bytes[list(vocabulary.values())] = [len(x) for x in vocabulary]
        self.forget()

    def forget(self) -> None:
        """Known pieces: in the slot that its hash's high bits name, a piece's hash, and where its ids are in
        ``pool`` and how many. A later piece takes a slot over."""
        self.keys = np.zeros(1 << SLOT_BITS, np.uint64)
        self.at = np.zeros(1 << SLOT_BITS, np.int64)
        self.size = np.zeros(1 << SLOT_BITS, np.int32)
        self.pool, self.used = np.zeros(KNOWN_IDS, "<u2"), 0

    def whole(self, text: bytes) -> bytes:
        return np.array(self.library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u2").tobytes()

    def piece_starts(self, chars: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where pieces start in texts laid end to end; ``edges``: where texts do."""
        n = len(chars)
        kind = self.kinds[chars]
        first = np.zeros(n + 1, bool)
        first[edges] = True
        last = first[1:]
        before = np.concatenate([[np.int8(-1)], kind[:-1]])
        after = np.concatenate([kind[1:], [np.int8(-1)]])
        blank = np.concatenate([[False], chars[:-1] == 0x20])
        white = kind == 0
        start = np.where(
            white,
            (before != 0) | (~last & (after != 0)),  # a run of white space; its last character if more text follows
            np.where(before == 0, ~blank, before != kind))
        start |= first[:n]
        # contractions open with an apostrophe that no run of other characters and no blank takes in
        at = np.flatnonzero((chars == 0x27) & (first[:n] | (before == 1) | (before == 2) | ((before == 0) & ~blank)))
        if len(at):
            pad = np.concatenate([chars, [0, 0]])
            stop = np.append(np.flatnonzero(first[:n]), n)
            room = stop[np.searchsorted(stop, at, "right")] - at - 1
            size = np.zeros(len(at), np.int64)
            for c in self.CONTRACTIONS:
                fits = (room >= len(c)) & (size == 0)
                for j, x in enumerate(c):
                    fits &= pad[at + 1 + j] == ord(x)
                size[fits] = len(c)
            at, size = at[size > 0], size[size > 0]
            start[at + 1] = False
            start[(at + 2)[size == 2]] = False
            follow = at + 1 + size
            start[follow[follow < n]] = True
        return np.flatnonzero(start)

    def piece_ids(self, text: str, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece's ids are in ``pool``, and how many; unknown pieces are encoded."""
        if self.used > KNOWN_IDS:
            self.forget()
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        at, sizes = self.at[slot], self.size[slot].astype(np.int64)
        new = np.flatnonzero((self.keys[slot] != hashes) | (sizes == 0))
        if len(new):
            keys, where, of = np.unique(hashes[new], return_index=True, return_inverse=True)
            where = new[where]
            ids, size = self.encoded(text, chars, starts[where], ends[where])
            if self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool[: self.used], np.zeros(len(ids) + KNOWN_IDS, "<u2")])
            self.pool[self.used : self.used + len(ids)] = ids
            opens = self.used + np.cumsum(size) - size
            self.used += len(ids)
            at[new], sizes[new] = opens[of], size[of]
            self.keys[slot[where]], self.at[slot[where]], self.size[slot[where]] = keys, opens, size
        return at, sizes

    def encoded(self, text: str, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after another, and how many each has. Pieces without white space but for a
        blank in front go many in a string, behind a line feed where no blank opens them; the
        library's rule splits there and nowhere else."""
        white = np.concatenate([[0], np.cumsum(self.kinds[chars] == 0)])
        wide = np.concatenate([[0], np.cumsum(chars >= 0x80)])  # two bytes each
        blank = chars[starts] == 0x20
        apart = (white[ends] - white[starts] > blank) | (blank & (ends - starts == 1))
        order = np.concatenate([np.flatnonzero(~apart), np.flatnonzero(apart)])
        joined = len(order) - int(apart.sum())
        fed = ~blank[order]
        fed[joined:] = False
        pieces = [("\n" if f else "") + text[a:b] for f, a, b in zip(fed.tolist(), starts[order].tolist(), ends[order].tolist())]
        strings = ["".join(pieces[i : min(i + JOINED, joined)]) for i in range(0, joined, JOINED)] + pieces[joined:]
        got = self.library.encode_batch_fast(strings, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, "<u2") for e in got])
        length = (ends - starts + wide[ends] - wide[starts])[order]
        stop = np.cumsum(length + fed)
        behind = np.concatenate([[0], np.cumsum(self.id_bytes[ids])])  # bytes up to each id
        first, last = np.searchsorted(behind, stop - length), np.searchsorted(behind, stop)
        if behind[-1] != stop[-1] or (behind[first] != stop - length).any() or (behind[last] != stop).any():
            # ids that do not stand for a piece's bytes, as those of a tokenizer that normalises: one by one
            got = [e.ids for e in self.library.encode_batch_fast([text[a:b] for a, b in zip(starts.tolist(), ends.tolist())], add_special_tokens=False)]
            return np.concatenate([np.array(x, "<u2") for x in got]), np.array([len(x) for x in got])
        size = np.empty(len(order), np.int64)
        size[order] = last - first
        opens = np.empty(len(order), np.int64)
        opens[order] = first
        closes = np.cumsum(size)
        return ids[np.arange(int(closes[-1])) + np.repeat(opens - (closes - size), size)], size

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Ids of every text as little-endian unsigned 16-bit integers."""
        n = len(offsets) - 1
        out: list[bytes] = [b""] * n
        # lead bytes above 0xC9 open characters beyond the Latin blocks, or are no UTF-8
        odd = np.zeros(n, bool)
        wide = np.flatnonzero(data > 0xC9)
        odd[np.searchsorted(offsets, wide, "right") - 1] = True
        plain = [i for i in range(n) if not odd[i] and offsets[i + 1] > offsets[i]]
        joined = b"".join(data[offsets[i] : offsets[i + 1]].tobytes() for i in plain) if odd.any() else data.tobytes()
        try:
            text = joined.decode()
        except UnicodeDecodeError:  # not UTF-8
            plain, text, odd = [], "", np.ones(n, bool)
        for i in np.flatnonzero(odd):
            out[i] = self.whole(data[offsets[i] : offsets[i + 1]].tobytes())
        if not plain:
            return out
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        raw = np.frombuffer(joined, np.uint8)
        at_byte = np.concatenate([[0], np.cumsum([offsets[i + 1] - offsets[i] for i in plain])])
        edges = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[at_byte]
        starts = self.piece_starts(chars, edges[:-1])
        ends = np.append(starts[1:], len(chars))
        p, inv = powers(len(chars) + 1)
        total = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum(self.letter[chars] * p[: len(chars)], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64))
        at, sizes = self.piece_ids(text, chars, starts, ends, hashes)
        stops = np.cumsum(sizes)
        every = self.pool[np.arange(int(stops[-1])) + np.repeat(at - (stops - sizes), sizes)]
        cuts = np.concatenate([[0], stops])[np.searchsorted(starts, edges)]
        for k, i in enumerate(plain):
            out[i] = every[cuts[k] : cuts[k + 1]].tobytes()
        return out


_splitters: dict[int, Splitter] = {}


def splitter(tokenizer: str) -> Splitter:
    if (key := hash(tokenizer)) not in _splitters:
        _splitters[key] = Splitter(tokenizer)
    return _splitters[key]


# -- packing -----------------------------------------------------------------
def piece_rows(lengths: np.ndarray, size: int = SEQUENCE) -> list[np.ndarray]:
    """Pieces of documents of the given token counts, laid end to end: document,
    start in it, length, sequence and offset there. Sequences hold ``size``
    tokens; the rest behind the last full one is cut into powers of two."""
    stops = np.cumsum(lengths)
    total = int(stops[-1]) if len(stops) else 0
    full, rest = divmod(total, size)
    edges = [np.arange(full + 1) * size]
    at = full * size
    for bit in range(size.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            at += 1 << bit
            edges.append(np.array([at]))
    edges = np.concatenate(edges)
    starts = stops - lengths
    begin = np.unique(np.concatenate([edges[:-1], starts]))
    doc = np.searchsorted(starts, begin, "right") - 1
    sequence = np.searchsorted(edges, begin, "right") - 1
    return [doc, begin - starts[doc], np.append(begin[1:], total) - begin, sequence, begin - edges[sequence]]


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _packed(batches):
    """Rows of one range in order -> pieces. What does not fill a sequence yet waits
    for the next rows; sequences are numbered within the range."""
    base, number = (TaskContext.get().partitionId() << 36), 0
    waiting: list[tuple] = []  # (doc_id, tokens in all, start of what is left, ids left)

    def flush(final: bool):
        nonlocal waiting, number
        lengths = np.array([len(w[3]) for w in waiting], np.int64)
        doc, start, length, sequence, offset = piece_rows(lengths)
        full = int(lengths.sum()) // SEQUENCE
        take = np.ones(len(doc), bool) if final else sequence < full
        rows = ([], [], [], [], [], [], [])
        for d, s, n, q, o in zip(*(x[take].tolist() for x in (doc, start, length, sequence, offset))):
            name, tokens, at, ids = waiting[d]
            for column, value in zip(rows, (name, at + s, n, zlib.crc32(ids[s : s + n].astype("<u4").tobytes()), tokens, base + number + q, o)):
                column.append(value)
        if final:
            waiting = []
        else:
            left = {}
            for d, s, n in zip(*(x[~take].tolist() for x in (doc, start, length))):
                left.setdefault(d, s)
            waiting = [(w[0], w[1], w[2] + left[d], w[3][left[d] :]) for d, w in enumerate(waiting) if d in left]
            number += full
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    size = 0
    for batch in batches:
        for name, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
            ids = np.frombuffer(ids.as_buffer(), "<u2")
            waiting.append((name, len(ids), 0, ids))
            size += len(ids)
            if size > 1 << 20:
                yield flush(False)
                size = sum(len(w[3]) for w in waiting)
    if waiting:
        yield flush(True)


def pack(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    spark = docs.sparkSession
    tie = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long"))), F.lit(1 << TIE_BITS)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"), tie.alias("tie"))
    place = F.expr(f"place * {1 << TIE_BITS} + tie").alias("place")
    places = cut(rows.select("text", "tie").mapInArrow(lean(_placed), "place long, tie long, n long").select(place, "n"))
    total = places.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_BYTES))
    bounds = []
    if ranges > 1:
        quantiles = [i / ranges for i in range(1, ranges)]
        bounds = places.agg(F.percentile_approx("place", quantiles, 100 * ranges)).first()[0]
    bounds = np.array(sorted(set(bounds)), np.int64)
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())  # a vocabulary's size, not the data's
    end = np.array([END], "<u2").tobytes()

    def tokens(batches):
        split = splitter(tokenizer.value)
        for batch in batches:
            data, off = byte_rows(batch.column("text"))
            ties = np.asarray(batch.column("tie"))
            for a, b in row_runs(off, STRETCH):
                part, at = data[off[a] : off[b]], off[a : b + 1] - off[a]
                place = curve_places(part, at) * (1 << TIE_BITS) + ties[a:b]
                ids = [x + end for x in split.ids(part, at)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.searchsorted(bounds, place, "right").astype(np.int32)), pa.array(place), batch.column("doc_id").slice(a, b - a), pa.array(ids, pa.binary())],
                    names=["range", "place", "doc_id", "ids"])

    held = rows.mapInArrow(lean(tokens), "range int, place long, doc_id long, ids binary")
    held = held.repartitionById(len(bounds) + 1, F.col("range")).sortWithinPartitions("place", "doc_id", "ids")
    return held.select("doc_id", "ids").mapInArrow(lean(_packed), PIECE)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
