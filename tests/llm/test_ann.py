"""Learned partitions against exact search (operator 5)."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from llm_fixtures import docs, nothing  # noqa: F401
from roomrate.llm import ann
from roomrate.llm.queries import QUERIES


def exact(ids, x, k):
    out = {}
    for i, q in zip(ids, x):
        if i % 20 == 0:
            s = x @ q
            order = np.lexsort((ids, -s))
            out[int(i)] = [(int(ids[j]), float(s[j])) for j in order if ids[j] != i][:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    hit = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hit / sum(map(len, want.values()))


def test_recall_on_embeddings(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], np.float64)
    got, want = found(QUERIES["op5_nearest"](spark, SF001)), exact(ids, x, 20)
    assert recall(got, want) >= 0.9
    by_id = dict(zip(ids.tolist(), x))
    for q, rows in got.items():
        assert len(rows) == 20 and q not in {i for i, _ in rows}
        for i, s in rows:
            assert abs(s - by_id[q] @ by_id[i]) < 1e-9
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))


def test_recall_with_all_parts_in_use(spark):
    """Vectors of the embeddings' law (unit norm, nearly isotropic, 64
    components), enough for the largest number of parts."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6400, 64))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    routers, probes = ann.fit(ann._usable(df, "vec_id", "embedding"))
    assert routers.parts == ann.MAX_PARTS and routers.under is None
    got, want = found(ann.nearest(df, lambda i: i % 20 == 0)), exact(np.arange(6400), x.astype(np.float64), 20)
    r = recall(got, want)
    print(f"probes {probes} recall {r:.4f}")
    assert r >= 0.9


def test_clusters_many_parts_and_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 128)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    x = (centres[rng.integers(0, 40, 4000)] + 0.3 * rng.normal(size=(4000, 16))).astype(np.float32)
    x[1000] *= 1.5 * np.linalg.norm(x, axis=1).max() / np.linalg.norm(x[1000])
    x[1000:2500] = x[1000]  # copies hold over a third, the longest vector of all
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got, want = found(ann.nearest(df, lambda i: i % 20 == 0)), exact(np.arange(4000), x.astype(np.float64), 20)
    assert recall(got, want) >= 0.9
    for q, near in got.items():  # of the copies, those of the smallest ids
        copies = [i for i, _ in near if 1000 <= i < 2500]
        assert copies == [i for i in range(1000, 2500) if i != q][:len(copies)]
    assert any(1000 <= i < 2500 for near in got.values() for i, _ in near)


def test_awkward_vectors(spark, nothing):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []),
            (20, [0.0, 1.0]), (7, [1.0, None]), (8, [1.0, 0.0, 0.0]), (20, [0.0, 1.0]), (None, [1.0, 1.0]),
            (9, [0.5, 0.5]), (40, [0.0, 0.0])]
    df = (spark.createDataFrame(rows, "vec_id long, embedding array<double>")
          .withColumn("id", F.lit("clash")).withColumn("part", F.lit(9)))
    got = found(ann.nearest(df, lambda i: i % 20 == 0, k=20))
    assert got == {0: [(1, 0.5), (9, 0.5), (20, 0.0)], 20: [(1, 0.5), (9, 0.5), (0, 0.0)]}
    assert ann.nearest(df.limit(0), lambda i: i % 20 == 0).count() == 0
    assert ann.nearest(df.filter("vec_id = 1"), lambda i: i % 20 == 0).count() == 0
    assert ann.nearest(df.filter("vec_id = 0"), lambda i: i % 20 == 0).count() == 0


def test_parts_are_balanced():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1000, 8)) + 3 * (np.arange(1000) < 700)[:, None]
    part = ann.balanced_parts(x, ann.neighbour_graph(x, 10), 8)
    assert np.bincount(part, minlength=8).max() <= np.ceil(1000 / 8 * ann.BALANCE)


@pytest.mark.parametrize("n", [50_000, 200_000])
def test_two_levels_on_clusters(spark, n):
    """Recall with a small share of the vectors scored, and rows sent in
    proportion to the vectors."""
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(600, 24))
    x = (centres[rng.integers(0, 600, n)] + 0.25 * rng.normal(size=(n, 24)))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": list(x)})).repartition(8)
    share = 20 if n < 100_000 else 200  # every row is indexed; of the larger table fewer are asked
    scored = []
    got = found(ann.nearest(df, lambda i: i % share == 0, scored=scored))
    y = x.astype(np.float64)
    want = {}
    for q in range(0, n, share * 4):
        s = y @ y[q]
        near = np.argpartition(-s, 21)[:22]
        want[q] = [(int(i), s[i]) for i in near[np.lexsort((near, -s[near]))] if i != q][:20]
    r = recall({q: got[q] for q in want}, want)
    print(f"n {n} recall {r:.4f} scored {scored[0][0] / scored[0][1]:.4f}")
    assert r >= 0.9 and scored[0][0] <= 0.25 * scored[0][1]


def test_isotropic_vectors_keep_one_level(spark, monkeypatch):
    monkeypatch.setattr(ann, "TWO_LEVELS", 3000)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4500, 64))
    df = spark.createDataFrame(pa.table({"id": np.arange(4500), "vec": list(x)}))
    routers, probes = ann.fit(df)
    assert routers.under is None and probes > routers.parts / 4
