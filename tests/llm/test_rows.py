"""Operators on vectors, conversations and labels, and the pipeline's stages."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cadence.llm import chat, labelled, lsh, quality, registry, topk, toxicity
from cadence.llm.tables import ship_code
from tests.llm.conftest import SF

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="session")
def vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((80, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in base[i % 3] + 0.02 * rng.standard_normal(8)]) for i in range(60)]
    rows += [(300, rows[5][1]), (301, rows[5][1]), (302, [2 * x for x in rows[5][1]])]
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [NAN] * 8), (404, [INF] + [1.0] * 7), (405, [None] + [1.0] * 7), (406, [1.0, 2.0]), (407, [1.0, 2.1]), (None, [1.0] * 8)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("node", F.lit(2)).withColumn("key", F.lit(3))


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


def test_top_k(spark, vectors):
    ship_code(spark)
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    whole = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows if i is not None and good(v)}
    want = set()
    for q in whole:
        if q % 50 == 0:
            scores = sorted((-int(whole[q] @ whole[c]), c) for c in whole if c != q and len(whole[c]) == len(whole[q]))
            want |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(scores[:5])}
    assert {tuple(r) for r in topk.top_k(vectors, vectors.where("vec_id % 50 = 0")).collect()} == want
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_threshold_stops_early_and_keeps_ties():
    values = np.zeros((4000, 2))
    values[:, 0] = np.arange(4000) // 2
    ids = np.arange(4000)[::-1].copy()
    lists = np.argsort(values, axis=0, kind="stable")
    got, scores = topk.threshold_search(np.array([1.0, 0.0]), -1, values, ids, lists, 3)
    assert got.tolist() == [0, 1, 2] and scores.tolist() == [1999, 1999, 1998]


def test_near_vectors(spark, vectors):
    ship_code(spark)
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if i is not None and good(v) and any(v)}
    links = {i: {j for j in unit if j != i and len(unit[j]) == len(unit[i]) and unit[i] @ unit[j] >= 0.95} for i in unit}
    want = set()
    for i, _ in rows:
        reach, open_ = {i}, [i]
        while open_:
            for j in links.get(open_.pop(), ()):
                if j not in reach:
                    reach.add(j)
                    open_.append(j)
        c = None if i is None else min(reach)
        want.add((i, len(links.get(i, ())), c, i is not None and c == i))
    assert {tuple(r) for r in lsh.near_vectors(vectors).collect()} == want
    assert lsh.near_vectors(vectors.limit(0)).count() == 0


def test_reply_trees_branch_and_rank(spark):
    ship_code(spark)
    rows = [(1, 1, None, 1.0, "user", "q"), (1, 2, 1, 0.5, "assistant", "poor"), (1, 3, 1, 2.0, "assistant", "good"), (1, 4, 3, 1.0, "user", "more"), (1, 5, 77, 0.1, "user", "orphan"), (None, 1, None, None, None, None)]
    messages = spark.createDataFrame(rows, "tree_id long, message_id long, parent_id long, score double, role string, text string")
    turns = chat.chosen_turns(messages, branches=2)
    text = {(r["tree_id"], r["branch"]): r["text"] for r in chat.format_turns(turns).collect()}
    assert text[(1, 1)] == "### user: q</turn>\n### assistant: good</turn>\n### user: more</turn>\n"
    assert text[(1, 2)] == "### user: q</turn>\n### assistant: poor</turn>\n"
    assert text[(None, 1)] == "### : </turn>\n"
    loop = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (1, 3, 2)], "tree_id long, message_id long, parent_id long")
    with pytest.raises(ValueError):
        chat.tree_paths(loop).count()


def test_format_reads_back(spark):
    ship_code(spark)
    hard = ["", "\\", "\\\\", "</turn>", "\\</turn>", "### user: x</turn>\n", "a: b", "####", "\\#", "\\:", chat.HARD, "x" * 70000, "\u00e9\n\n"]
    rows = [(5, i, "assistant" if i % 2 else f"ro:le{chr(92)}", t) for i, t in enumerate(hard)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.format_turns(chat.chosen_turns(chat.conversation_messages(conv)))).collect()[0]
    said = "".join(t for _, _, r, t in rows if r == "assistant")
    assert got["n_turns"] == len(hard) and got["loss_chars"] == len(said)
    assert got["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows).encode()).hexdigest()
    assert got["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


@pytest.fixture(scope="session")
def labels(spark):
    own = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic")
    odd = spark.createDataFrame([(900001, 1, 0), (900002, None, 1), (None, 1, 1), (900006, 7, 0), (900006, 1, 0), (900006, 0, 0)], "doc_id long, quality int, toxic int")
    return own.union(odd).withColumn("text", F.lit("clash"))


@pytest.mark.parametrize("fit", [quality.with_quality, toxicity.with_toxicity])
def test_classifiers_take_odd_rows(spark, docs, texts, labels, empty, fit):
    ship_code(spark)
    rows = fit(docs, labels, "_s").select("doc_id", "_s").collect()
    assert len(rows) == len(texts) and all(0 <= r["_s"] <= 1 for r in rows)
    assert {round(r["_s"], 9) for r in rows if r["doc_id"] in (900001, 900002)} and len({r["_s"] for r in rows if r["doc_id"] in (900001, 900002)}) == 1
    assert fit(empty, labels, "_s").count() == 0
    plain = fit(docs.limit(3), labels.limit(0), "_s").collect()
    assert [r["_s"] for r in plain] == [0.5] * 3


def test_held_out_accuracy(spark):
    ship_code(spark)
    sf = "/root/testdata/sf0.1"
    for name, label, least in (("op8_quality", "quality", 0.97), ("op4_toxicity", "toxic", 0.93)):
        got = registry.QUERIES[name](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", label), "doc_id").toPandas()
        assert (got["predicted"] == got[label]).mean() >= least
        assert len(got) > 500


def test_language_from_function_words():
    texts = ["the cat and the dog of it", "le chat et les chiens de la", "der Hund und die Katze", "el perro y los gatos", "xyz"]
    raw = [t.encode() for t in texts]
    h, r = toxicity.words_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw]))
    assert toxicity.languages(h, r, 5).tolist() == [0, 1, 2, 3, 4]


def text_arrays(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw])


def test_toxicity_scores_do_not_depend_on_neighbours():
    model = toxicity.Model()
    texts = ["a clean one", "", "grok blarg grok", "?!", "x", "two words", "\u00e9t\u00e9 " * 40, "last of all", " \t"]
    alone = [model.scores(*text_arrays([t]))[0] for t in texts]
    rng = np.random.default_rng(6)
    for _ in range(20):
        order = rng.permutation(len(texts))
        assert np.allclose(model.scores(*text_arrays([texts[i] for i in order])), [alone[i] for i in order], atol=1e-6)
    assert np.allclose(model.scores(*text_arrays(["", "?!"])), alone[1], atol=1e-6)


def test_toxicity_learns_from_its_own_windows():
    words = [toxicity.words_of(*text_arrays([t]))[0] for t in ["grok bad", "fine day", "", "?"] * 8]
    model = toxicity.Model()
    model.learn(words, np.array([1, 0, 0, 0] * 8))
    assert model.scores(*text_arrays(["grok bad", "fine day", "", "grok bad"])).round().tolist() == [1, 0, 0, 1]


def test_long_texts_are_read_in_parts(monkeypatch):
    text = " ".join(f"w{i * i % 89}" for i in range(3000)) + " grok blarg"
    model, whole = toxicity.Model(), text_arrays([text])
    z, entries = model.scores(*whole), [np.concatenate(x) for x in zip(*quality.features(*text_arrays(["a a b", text, "", "b b"])))]
    monkeypatch.setattr(toxicity, "MOST_WORDS", 100)
    monkeypatch.setattr("cadence.llm.words.SEGMENT", 64)
    assert np.allclose(model.scores(*whole), z, atol=1e-6)
    parts = [np.concatenate(x) for x in zip(*quality.features(*text_arrays(["a a b", text, "", "b b"])))]
    pairs = lambda x: sorted(zip(x[0].tolist(), x[1].tolist()))
    assert pairs(parts) == pairs(entries) and len(entries[0]) > 30000


@pytest.mark.parametrize("learn", ["quality", "toxic"])
def test_sample_is_bounded_by_doc_ids(spark, learn):
    ship_code(spark)
    many = [(7, f"copy {i} of one id") for i in range(20000)] + [(i, f"text {i}") for i in range(8, 60)]
    docs = spark.createDataFrame(many, "doc_id long, text string")
    rows, _ = labelled.sample(docs, docs.select("doc_id").distinct().withColumn(learn, (F.col("doc_id") % 2).cast("int")), learn, 10)
    assert rows.count() <= 20 and rows.select("_order").distinct().count() == rows.count()


def test_thresholds_come_from_all_unfitted_rows(spark, monkeypatch):
    ship_code(spark)
    rng = np.random.default_rng(12)
    rows = []
    for i in range(1600):
        lang, toxic = i % 4, i // 4 % 2
        said = list(toxicity.FUNCTION_WORDS.values())[lang].split()[:6] + [f"w{x}" for x in rng.integers(0, 40, 12)]
        said += ["grok"] * (toxic or lang == 3) + ["blarg"] * (toxic and lang == 3)  # a milder word in one language
        rows.append((i, " ".join(rng.permutation(said)), toxic))
    rows += [(2000 + i, "the of " + "y" * 70000 + " grok" * (i % 2), i % 2) for i in range(30)]  # too long to be fitted on
    both = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    seen = []
    calibrate = toxicity.Model.calibrate
    monkeypatch.setattr(toxicity.Model, "calibrate", lambda self, *a: (seen.append(a), calibrate(self, *a))[1])
    model = toxicity.fit(both.select("doc_id", "text"), both.select("doc_id", "toxic"), half=80)
    train = {r["doc_id"] for r in both.where(~labelled.held_out()).collect()}
    sample = sorted(r["_order"] for r in labelled.sample(both.select("doc_id", "text"), both.select("doc_id", "toxic"), "toxic", 80)[0].collect())
    fitted = set(sample) - set(sample[:: toxicity.CALIBRATION])
    order = {r["doc_id"]: r["h"] for r in both.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    rest = [r for r in rows if r[0] in train and order[r[0]] not in fitted]
    assert len(rest) > 1000 and seen[0][3].sum() == len(rest)
    data, off = text_arrays([t for _, t, _ in rest])
    hashes, of = toxicity.words_of(data, off)
    z, lang, truth = model.logits(*toxicity.padded(hashes, of, len(rest))), toxicity.languages(hashes, of, len(rest)), np.array([y for _, _, y in rest])
    f1 = lambda cut, own: 2 * ((z > cut) & own & (truth == 1)).sum() / (((z > cut) & own).sum() + (own & (truth == 1)).sum())
    for k in range(4):
        assert f1(model.thresholds[k], lang == k) >= max(f1(c, lang == k) for c in z[lang == k]) - 0.02
    assert len(set(model.thresholds[:4])) == 4


def test_training_sample_keeps_folds_apart(spark, docs, labels):
    rows, _ = labelled.sample(docs.withColumn("id", F.col("doc_id")), labels, "quality")
    assert rows.count() > 20
    held = labels.where(labelled.held_out()).where("doc_id is not null")
    assert held.count() > 5


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(registry.ORACLES[name]).df()
    got = registry.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    key = sorted(want.columns)
    assert sorted(map(str, got[key].itertuples(index=False, name=None))) == sorted(map(str, want[key].itertuples(index=False, name=None)))


def test_pipeline_stages(spark, docs, empty):
    plain = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), "n_chars")
    near = plain.where("doc_id < 900000 and size(split(text, ' ')) > 100").withColumn("doc_id", F.col("doc_id") + 800000)
    plain = plain.union(near.withColumn("text", F.concat("text", F.lit(" and a changed end")))).cache()
    before, seen = plain, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == plain.columns and 0 < after.count() <= before.count()
        before = spark.createDataFrame(after.collect(), after.schema)
        seen.append({r["doc_id"] for r in before.collect()})
    both = [i for i in seen[1] if i is not None and i + 800000 in seen[1]]
    assert len(both) > 20 and not any(i + 800000 in seen[2] for i in both)
    assert seen[3] == seen[2]
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert pieces.select("doc_id").distinct().count() == len({r["doc_id"] for r in before.collect()})
    none = plain.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
