"""Phrase counts and scores against a plain count in Python."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.llm import collocations
from cadence.llm.tables import ship_code

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", p)


def brute(rows, least=30, inside=80, top=2000):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            total[lang] += len(ws)
            f.update((lang, tuple(ws[i : i + n])) for n in (1, 2, 3, 4) for i in range(len(ws) - n + 1))
    cand = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    scored = []
    for (lang, ws), a in cand.items():
        score, k = min((2000000 * a // (f[lang, ws[:k]] + f[lang, ws[k:]]), k) for k in range(1, len(ws)))
        longer = [v for (g, other), v in cand.items() if g == lang and len(other) > len(ws) and any(other[i : i + len(ws)] == ws for i in range(len(other)))]
        if not any(100 * v >= inside * a for v in longer):
            scored.append((lang, score, a, " ".join(ws), f[lang, ws[:k]], f[lang, ws[k:]]))
    out = []
    for lang in {s[0] for s in scored}:
        own = sorted((s for s in scored if s[0] == lang), key=lambda s: (-s[1], -s[2], s[3].encode()))[:top]
        out += [(lang, i + 1, p, a, l, r, total[lang], score) for i, (_, score, a, p, l, r) in enumerate(own)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(41)
    words = [f"w{i}" for i in range(40)] + ["É", "éa", " ", "x" * 300, "don't", "你好"]
    fixed = "A Stock  phrase of\tseven words here"
    out = []
    for i in range(700):
        n = int(rng.integers(0, 120))
        ws = [words[int(min(len(words) - 1, rng.geometric(0.2)))] for _ in range(n)]
        glue = [" ", " ", " ", " ", " ", "  ", "\t", ", ", ".\n", "; ", " ! "]
        text = "".join(w + glue[int(rng.integers(0, len(glue)))] for w in ws)
        out.append((text + (fixed if i % 3 else "") + " end", ["en", "fr", None, ""][i % 4]))
    out += [(out[5][0], "en")] * 70 + [(None, "en"), ("", "fr"), (" \t", None), ("...", "de"), ("one", "de")]
    out += [("a b " * 4000, "loop"), ("z " * 900 + "q", "en"), ("no gap " * 20, "it")]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i % 7, t, g) for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string").withColumn("n", F.lit(1)).withColumn("words", F.lit(2)).withColumn("phrase", F.lit("x")).repartition(4)


def test_against_brute_force(spark, rows):
    ship_code(spark)
    want = brute(rows)
    assert len(want) > 100
    got = collocations.collocations(frame(spark, rows))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_few_buckets_change_nothing(spark, rows, monkeypatch):
    ship_code(spark)
    monkeypatch.setattr(collocations, "BLOCK_BITS", 3)
    monkeypatch.setattr(collocations, "FEWEST_BITS", 4)
    monkeypatch.setattr(collocations, "MOST_BITS", 4)
    monkeypatch.setattr(collocations, "HELD", 20)
    assert sorted(tuple(r) for r in collocations.collocations(frame(spark, rows), least=12, inside=60, top=25).collect()) == brute(rows, 12, 60, 25)


def test_empty_table(spark, rows):
    ship_code(spark)
    assert collocations.collocations(frame(spark, rows).limit(0)).count() == 0


def test_scores_pass_64_bits(spark, monkeypatch):
    ship_code(spark)
    known = spark.createDataFrame([("en", 1, "a", 7 * 10**16), ("en", 1, "b", 5 * 10**16), ("en", 2, "a b", 4 * 10**16)], "lang string, words int, phrase string, f long")
    totals = spark.createDataFrame([("en", 9 * 10**17)], "lang string, n long")
    monkeypatch.setattr(collocations, "counts", lambda docs, least: (known, totals))
    assert [tuple(r) for r in collocations.collocations(None).collect()] == [("en", 1, "a b", 4 * 10**16, 7 * 10**16, 5 * 10**16, 9 * 10**17, 2000000 * 4 // 12)]


def counted(parts):
    """Phrase counts from the chunks of some texts."""
    f = Counter()
    for text, tail in parts:
        ends = [0]
        for ws in (piece.split(" ") for piece in text.split("\n")):
            ends.append(ends[-1] + len(ws))
            left = len(re.split("[ \n]", text)) - tail - ends[-2]
            f.update(tuple(ws[i : i + n]) for i in range(min(len(ws), left)) for n in (1, 2, 3, 4) if i + n <= len(ws))
    return f


@pytest.mark.parametrize("segment", [64, 1 << 20])
def test_chunks_count_each_phrase_once(rows, segment, monkeypatch):
    texts = [t or "" for t, _ in rows[:40]] + [" ".join(t or "" for t, _ in rows), "a " * 500, "word" * 100 + " b c. d"]
    raw = [t.encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw])
    monkeypatch.setattr(collocations, "SEGMENT", segment)
    monkeypatch.setattr("cadence.llm.words.SEGMENT", segment)
    monkeypatch.setattr(collocations, "row_runs", lambda offsets: ((i, i + 1) for i in range(len(offsets) - 1)))
    got = Counter()
    for a, part, edges, upto in collocations.runs(data, off):
        text, tail, row = collocations.chunks(part, edges, upto)
        assert row.max(initial=0) == 0
        got += counted(zip(text.to_pylist(), tail.tolist()))
    want = Counter()
    for t in texts:
        for ws in pieces(t):
            want.update(tuple(ws[i : i + n]) for n in (1, 2, 3, 4) for i in range(len(ws) - n + 1))
    assert got == want


def test_equal_passages_share_chunks():
    passage = " ".join(f"p{i * i % 97}" for i in range(400))
    split = []
    for head in ("", "other words before it ", "x "):
        raw = (head + passage).encode()
        split.append(set(collocations.chunks(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].to_pylist()))
    assert len(split[0] & split[1] & split[2]) >= 0.7 * len(split[0]) and len(split[0]) > 5
