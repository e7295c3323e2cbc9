"""Near-duplicate groups against brute force (operator 10)."""

import random
import re

import numpy as np

from conftest import SF001
from llm_fixtures import awkward, docs, nothing  # noqa: F401
from roomrate.llm import minhash
from roomrate.llm.components import components


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = {}
    for x, (_, s) in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(x)
    seen = set()
    for members in by.values():
        for x in members:
            for y in members:
                if x < y and (x, y) not in seen:
                    seen.add((x, y))
                    a, b = sets[x][1], sets[y][1]
                    n = len(a & b)
                    if 100 * n >= percent * (len(a) + len(b) - n):
                        root[find(x)] = find(y)
    low = {}
    for x, (i, _) in enumerate(sets):
        r = find(x)
        low[r] = min(low.get(r, i), i)
    return sorted(((i, len(s), low[find(x)], i == low[find(x)]) for x, (i, s) in enumerate(sets)), key=repr)


def check(df, k, percent):
    got = sorted((tuple(r) for r in minhash.near_duplicates(df, k, percent).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in df.collect()], k, percent)
    return got


def test_documents(spark):
    got = check(spark.read.parquet(f"{SF001}/documents.parquet"), 3, 85)
    assert sum(not r[3] for r in got) > 10


def test_awkward(awkward, nothing):
    check(awkward, 3, 85)
    check(awkward, 5, 80)
    assert minhash.near_duplicates(nothing).count() == 0


def test_chains_and_a_hot_group_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK_DOCS", 16)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows, word = [], iter(range(10**6))
    for i in range(150):  # near copies, some too far from most others
        w = list(base)
        for j in rng.sample(range(60), rng.randint(0, 6)):
            w[j] = f"x{next(word)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base)) for i in range(200)]  # exact copies
    for i in range(30):  # a chain: each like the next only
        rows.append((2000 + i, " ".join(f"c{j}" for j in range(6 * i, 6 * i + 100))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = check(df, 3, 85)
    assert len({c for i, _, c, _ in got if i >= 2000}) == 1


def test_signature_is_a_minhash():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = x[:2000], x[500:2500]
    sig = minhash.circulant_signature(np.concatenate([a, b]), np.array([0, 2000]), 512)
    assert abs((sig[0] == sig[1]).mean() - 1500 / 2500) < 0.07


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)]
    edges += [(5, 5), (7, None), (1, 2), (2, 1)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_null_ids(spark, awkward):
    """Rows without an id are linked with nothing and stay."""
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    more = [(None, rows[5][1]), (None, rows[5][1]), (None, None), (None, "only here, with no id at all, some words")]
    df = awkward.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = [tuple(r) for r in minhash.near_duplicates(df, 3, 85).collect()]
    assert sorted((r for r in got if r[0] is not None), key=repr) == brute(rows, 3, 85)
    assert sorted(r[2:] for r in got if r[0] is None) == [(None, True)] * 4
    left = minhash.drop_near_duplicates(df, shingle=3, percent=85).collect()
    assert sum(r.doc_id is None for r in left) == 4


def test_a_joined_cluster_is_shipped_once(spark, monkeypatch):
    """Near copies of one text over many chunks: no second round of texts."""
    monkeypatch.setattr(minhash, "CHUNK_DOCS", 16)
    shipped = []
    own = minhash._links
    monkeypatch.setattr(minhash, "_links", lambda rows, *a: (shipped.append(rows.count()), own(rows, *a))[1])
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join([*base[:i % 80], f"x{i}", *base[i % 80 + 1:]])) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(df, 3, 85).collect()
    assert {r.component_id for r in got} == {0}
    assert shipped[0] <= 240 + 40 and shipped[1] == 0


def test_no_task_holds_a_hub(spark):
    """A hub with many neighbours is dealt by salt, in both directions."""
    from pyspark.sql import functions as F

    from roomrate.llm import components as c

    star = spark.range(1, 20_001).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
    up = spark.range(30_000, 50_000).select(F.lit(10**6).cast("long").alias("u"), F.col("id").alias("v"))
    for edges in (star, up):
        salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(c.SALTS)))
        assert salted.groupBy("u", "salt").count().agg(F.max("count")).first()[0] < 200
        got = components(edges)
        assert got.select("component").distinct().count() == 1 and got.count() == 20_001
