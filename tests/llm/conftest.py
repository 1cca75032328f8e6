"""Documents with every odd case, beside the smallest test table."""

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * (seed % 5 + 1) + i * i // 3) % len(WORDS)] + str((seed * 31 + i * 17) % 97) for i in range(n))


def odd_rows():
    passage = sentence(99, 40)
    return [
        (900001, None), (900002, ""), (900003, " \t\n "), (900004, "two words"), (900005, "two words"), (900005, "two words"),
        (900006, sentence(1, 60)), (900007, sentence(1, 59) + " changed"), (900008, sentence(2, 30) + " " + passage + " " + sentence(3, 30)),
        (900009, sentence(4, 30) + " " + passage + " " + sentence(5, 30)), (900010, "a" * 3000), (900011, "ab" * 700 + "a" * 500),
        (900012, "x" * 70000 + " " + sentence(6, 9000)), (900013, "don't 's it's 12ab \n\n  tail  \u00a0\u00e9\u0301 \u4f60\u597d \U0001f600 <|endoftext|>"),
        (900014, "\u4f60\u597d\u4e16\u754c" * 60), (None, "no id here " + passage), (900016, "one text"), (900016, sentence(7, 80)), (900017, "\u00e9" * 300 + passage),
    ]


@pytest.fixture(scope="session")
def docs(spark):
    """Columns of documents with clashing extra ones."""
    rows = spark.createDataFrame(odd_rows(), "doc_id long, text string")
    own = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    names = ("node", "key", "a", "place", "flags", "label", "score", "ord")
    both = own.union(rows).withColumn("n_chars", F.length("text").cast("long"))
    return both.select("*", *(F.lit(i).alias(c) for i, c in enumerate(names))).repartition(3).cache()


@pytest.fixture(scope="session")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
