"""Small tables for the training-data operators: real text of the smallest
scale, and a table of awkward rows (nulls, empty and long texts, repeated
rows, clashing column names)."""

import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
CLASHES = ["id", "pos", "norm", "k1", "u", "v", "node", "component", "bands", "n_tokens", "score", "base",
           "spans", "kept", "items", "positive", "vec", "part", "_gone", "_left", "line", "words"]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def awkward_rows():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "étude", "ñandú", "straße", "中文", "x1", "7"]
    long = " ".join(rng.choices(words, k=40_000))
    same = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, None, "en"), (2, "", "en"), (3, "   \n\t\n", None), (4, long, "en"), (5, same, "en"), (6, same, "fr"),
            (7, same + " thirteen", "de"), (8, "a" * 100_000, "es"), (9, "!!! ??? ...", "en"),
            (10, "mail bob@example.com\nor +1 (980) 555-6268\x01 4539 1488 0343 6467\n10.0.0.1", "en"),
            (10, "mail bob@example.com\nor +1 (980) 555-6268\x01 4539 1488 0343 6467\n10.0.0.1", "en"),
            (11, "\n".join([same] * 3), "en"), (12, " lead and  trail 　x ", None)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    df = spark.createDataFrame(awkward_rows(), "doc_id long, text string, lang string")
    for c in CLASHES:
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
