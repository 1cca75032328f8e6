"""Operators on documents against brute force, on whole tables with odd rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from cadence.llm import bpe, bwt, minhash, packing, sharding, suffix, words
from cadence.llm.tables import ship_code


def shingles(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0d]+", text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_words_hash_alike_wherever_they_stand():
    texts = ["A b  C\tlong", "", "long c b a", "x" * 50]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0] + [len(t) for t in texts])
    h, row = words.word_hashes(data, off)
    assert row.tolist() == [0, 0, 0, 0, 2, 2, 2, 2, 3]
    assert h[:4].tolist() == h[7:3:-1][[0, 1, 2, 3]].tolist()[:3] + [h[4]]


def test_words_of_a_text_longer_than_a_segment(monkeypatch):
    text = (" ".join(f"w{i}" for i in range(400)) + " " + "y" * 300 + " end").encode()
    whole = words.word_hashes(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    monkeypatch.setattr(words, "SEGMENT", 64)
    cut = words.word_hashes(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    assert whole.tolist() == cut.tolist() and len(whole) == 402


def test_minhash_components(spark, docs, texts, empty):
    ship_code(spark)
    got = [r.asDict() for r in minhash.near_duplicates(docs).collect()]
    assert len(got) == len(texts)
    sets = [shingles(t) for _, t in texts]
    ids = [i for i, _ in texts]
    above = list(range(len(ids)))

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and ids[i] is not None and ids[j] is not None:
                n = len(sets[i] & sets[j])
                if n and 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                    above[root(i)] = root(j)
    want = Counter()
    for i, (doc, s) in enumerate(zip(ids, sets)):
        if doc is None:
            want[(None, len(s), None, False)] += 1
            continue
        c = min(ids[j] for j in range(len(ids)) if ids[j] is not None and root(j) == root(i)) if s else doc
        want[(doc, len(s), c, c == doc)] += 1
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == want
    assert minhash.near_duplicates(empty).count() == 0


def test_near_dedup_keeps_unlike_rows_of_one_doc_id(spark):
    ship_code(spark)
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(120)) for x in "abcd")
    near = lambda t: t + " changed"
    kept = [(5, None), (5, ""), (5, a), (6, b), (8, c), (9, d), (9, "short one"), (None, a), (None, a)]
    gone = [(7, near(a)), (8, near(b)), (10, near(b)), (10, c)]  # 8 and 10 hold unlike texts
    rows = [(*r, i) for i, r in enumerate(kept + gone + [(11, "x y z"), (11, "x y z")])]  # of the last two one stays
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long").repartition(4)
    out = minhash.without_near_duplicates(docs)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(kept + [(11, "x y z")])
    pair = spark.createDataFrame([(3, a), (3, near(a)), (4, near(a))], "doc_id long, text string")
    assert [r["doc_id"] for r in minhash.without_near_duplicates(pair).collect()] == [3]
    assert minhash.without_near_duplicates(docs.limit(0)).count() == 0


def test_estimate_corrects_chance():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 1400, dtype=np.uint64)
    x, y = np.unique(pool[:1200]), np.unique(pool[200:])  # similarity 1000 / 1400
    px, py = (minhash.bit_planes(minhash.minima(s)).view(np.uint64).reshape(minhash.BITS, minhash.LANES) for s in (x, y))
    differ = np.bitwise_count((px[0] ^ py[0]) | (px[1] ^ py[1])).sum()
    assert abs((1 - differ / minhash.PERMUTATIONS - 0.25) / 0.75 - 1000 / 1400) < 0.15


def test_later_copies_by_transform():
    rng = np.random.default_rng(3)
    for letters, least in ((2, 3), (2, 9), (3, 5), (26, 4)):
        text = rng.integers(97, 97 + letters, 400).astype(np.uint8)
        text[200:260] = text[20:80]
        text[::90] = text[-1] = 255
        valid = np.array([255 not in text[i : i + least] and i + least <= 400 for i in range(400)])
        seen, want = set(), np.zeros(400, bool)
        for i in np.flatnonzero(valid):
            s = text[i : i + least].tobytes()
            want[i] = s in seen
            seen.add(s)
        assert (bwt.later_copies(text, valid, least) == want).all()


def brute_repeats(texts):
    """Flags by bytes for each distinct (doc_id, text), in document order."""
    order = sorted(set(texts), key=lambda x: (x[0] is not None, x[0] or 0, zlib.crc32((x[1] or "").encode()) if x[1] is not None else 0))
    seen, out = set(), {}
    for key in order:
        b = (key[1] or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            if b[s : s + 100] in seen:
                gone[s : s + 100] = True
            else:
                seen.add(b[s : s + 100])
        out[key] = (np.frombuffer(b, np.uint8), gone)
    return out


def test_suffix_dedup(spark, docs, texts, empty, monkeypatch, tmp_path):
    ship_code(spark)
    want = Counter()
    truth = brute_repeats(texts)
    for key in texts:
        b, gone = truth[key]
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        want[(key[0], len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(b[~gone].tobytes()).hexdigest())] += 1
    rows = suffix.with_flags(docs, ["doc_id"]).mapInArrow(suffix._digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    assert Counter(tuple(r) for r in rows.collect()) == want
    assert sum(k[2] for k in want) > 1000
    for c in ("_null", "_text", "_flags", "_ord", "_tie", "_row", "a.b"):
        docs = docs.withColumn(c, F.lit(5))
    cut = suffix.without_repeats(docs)
    assert cut.columns == docs.columns and cut.select("_flags", "`a.b`").distinct().collect() == [(5, 5)]
    assert cut.columns == docs.columns and cut.count() == len(texts)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in cut.collect())
    assert suffix.without_repeats(empty).count() == 0


def test_packing(spark, docs, texts, empty):
    ship_code(spark)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    library.encode_special_tokens = True
    want = Counter()
    for doc, text in texts:
        want[(doc, tuple(library.encode(text or "", add_special_tokens=False).ids) + (packing.END,))] += 1
    rows = [r.asDict() for r in packing.pack(docs, public_tokenizers.path(packing.TOKENIZER)).collect()]
    used = Counter()
    for r in rows:
        fits = [k for k in want if k[0] == r["doc_id"] and len(k[1]) == r["doc_tokens"] and r["ids_crc32"] == zlib.crc32(np.array(k[1][r["start"] : r["start"] + r["length"]], "<u4").tobytes())]
        assert fits and 0 < r["length"] <= packing.SEQUENCE
        used[r["doc_id"]] += r["length"]
    total = Counter()
    for (doc, ids), n in want.items():
        total[doc] += len(ids) * n
    assert used == total
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE and (at == packing.SEQUENCE or at & (at - 1) == 0)
    assert packing.pack(empty, public_tokenizers.path(packing.TOKENIZER)).count() == 0


def test_hilbert_curve_steps_to_neighbours():
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    place = packing.hilbert_place(cells, 3)
    assert sorted(place.tolist()) == list(range(512))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_split_pieces_are_the_librarys():
    split = packing.Splitter(open(public_tokenizers.path(packing.TOKENIZER), encoding="utf-8").read())
    rng = np.random.default_rng(8)
    alphabet = list("ab1 '  \n\t.,sSrevmlLdtT\u00e9\u00a0\u0085\u00df\u00b2\u00aa\u0240") + ["'s", "'ve", "'ll", " '"]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 30))) for _ in range(3000)] + ["\u4f60 a", "", "  ", "\u0301x"]
    raw = [t.encode() for t in texts]
    got = split.ids(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))
    assert got == [np.array(split.library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]


def test_split_at_the_end_of_the_latin_blocks():
    split = packing.Splitter(open(public_tokenizers.path(packing.TOKENIZER), encoding="utf-8").read())
    rng = np.random.default_rng(10)
    alphabet = list("ab1 '.\n") + [chr(c) for c in (0x24F, 0x250, 0x259, 0x27F, 0x280, 0x294, 0x2B0)]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 12))) for _ in range(2000)] + ["g\u0259l\u0259c\u0259k", *(a + chr(c) + b for c in range(0x240, 0x290) for a, b in ((" ", "a"), ("1", "'s")))]
    raw = [t.encode() for t in texts]
    got = split.ids(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))
    assert got == [np.array(split.library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]


class Counted:
    """A tokenizer that counts the strings it is given."""

    def __init__(self, library):
        self.library, self.n = library, 0

    def encode_batch_fast(self, strings, **more):
        self.n += len(strings)
        return self.library.encode_batch_fast(strings, **more)


def test_new_pieces_go_to_the_library_many_at_a_time():
    split = packing.Splitter(open(public_tokenizers.path(packing.TOKENIZER), encoding="utf-8").read())
    words = [f"{a}{b}{c}é" for a in "bdkw" for b in "aeiou" for c in "lmnrst"]
    texts = [" ".join(words), " ".join(w + "'ll \n\t" + w.upper() + " ?!" for w in words), "", " ", "\n", "it's  \u00a0'x' " * 30]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    want = [split.whole(t.encode()) for t in texts]
    split.library = counted = Counted(split.library)
    assert split.ids(data, off) == want
    assert 0 < counted.n < len(words) / 4
    seen = counted.n
    assert split.ids(data, off) == want and counted.n == seen  # all known
    split.forget()
    split.id_bytes[:] = 7  # as for a tokenizer whose names tell nothing of the bytes
    assert split.ids(data, off) == want and counted.n > 2 * len(words)


def test_known_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_IDS", 64)
    monkeypatch.setattr(packing, "SLOT_BITS", 4)  # most pieces share a slot with another
    split = packing.Splitter(open(public_tokenizers.path(packing.TOKENIZER), encoding="utf-8").read())
    for k in range(20):
        text = " ".join(f"w{k}x{i % 40}y the" for i in range(60)).encode()
        assert split.ids(np.frombuffer(text, np.uint8), np.array([0, len(text)])) == [split.whole(text)]
        assert split.used <= 64 + 40 * 8 + 200 and len(split.keys) == 16


def test_bpe_round_trip(spark, docs, texts, empty):
    ship_code(spark)
    path = public_tokenizers.path(bpe.RANKS)
    enc = bpe.encoding(bpe.load_ranks(path))
    assert isinstance(enc, tiktoken.Encoding)
    got = Counter((r["doc_id"], bytes(r["ids"]), bytes(r["bytes"])) for r in bpe.decode(bpe.encode(docs, path), path).collect())
    want = Counter((d, np.array(enc.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for d, t in texts)
    assert got == want
    assert bpe.encode(empty, path).count() == 0


def test_safe_parts_do_not_change_ids():
    enc = bpe.encoding(bpe.load_ranks(public_tokenizers.path(bpe.RANKS)))
    rng = np.random.default_rng(9)
    for _ in range(200):
        text = "".join(rng.choice(list("ab1 '  \n.s\u00e9"), 200))
        ids = [i for p in bpe.parts(text.encode(), 20) for i in enc.encode_ordinary(p.decode())]
        assert ids == enc.encode_ordinary(text)


def test_shards(spark, docs, texts, empty):
    limit = 20_000
    got = sharding.shards(docs, limit).collect()
    size = [len((t or "").encode()) for _, t in texts]
    hashed = [format(int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15], 16), "060b") for d, _ in texts]
    want = Counter()
    for (doc, _), n, h in zip(texts, size, hashed):
        for depth in range(61):
            same = [k for k, x in enumerate(hashed) if x.startswith(h[:depth])]
            total = sum(size[k] for k in same)
            if total <= limit or len({hashed[k] for k in same}) == 1:
                want[(doc, n, h[:depth], depth, total)] += 1
                break
    assert Counter(tuple(r) for r in got) == want
    assert len({r["shard_id"] for r in got}) > 10
    assert sharding.shards(empty, limit).count() == 0
