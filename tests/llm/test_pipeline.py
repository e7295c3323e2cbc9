"""The corpus pipeline, stage by stage, against the operators' brute force."""

import sys

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF0001
from llm_fixtures import awkward, docs, nothing  # noqa: F401
from roomrate.llm import langid, minhash
from test_decontam import brute as windows
from test_lines import brute as repeated, dropped, norm
from test_minhash import brute as groups

sys.path.insert(0, ROOT)
corpus_pipeline = pytest.importorskip("corpus_pipeline")
STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_one_after_the_other(spark, docs):
    at = docs
    kept = STAGES["language"](spark, at, SF0001)
    out = {r.doc_id for r in langid.predict(at, langid.fit(at, ~langid.held_out("doc_id", 4, 2))).collect() if r.rejected}
    assert {i for i, _ in rows(kept)} == {i for i, _ in rows(at)} - out and kept.columns == docs.columns
    at = kept.cache()

    kept = STAGES["lines"](spark, at, SF0001).cache()
    gone = repeated(spark, rows(at))
    assert dropped(at) <= gone and len(dropped(at)) >= 0.98 * len(gone)
    gone = dropped(at)
    want = {}
    for i, t in rows(at):
        left = [x for p, x in enumerate(t.split("\n")) if (i, t, p) not in gone]
        if len(left) == t.count("\n") + 1 or norm("\n".join(left)):
            want[i] = "\n".join(left)
    assert dict(rows(kept)) == want and kept.columns == docs.columns
    at.unpersist()
    at = kept

    kept = STAGES["near_duplicates"](spark, at, SF0001).cache()
    assert {i for i, _ in rows(kept)} == {i for i, _, _, k in groups(rows(at), 5, 80) if k}
    assert kept.columns == docs.columns
    at.unpersist()
    at = kept

    kept = STAGES["decontamination"](spark, at, SF0001).cache()
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    assert {i for i, _ in rows(kept)} == {x[0] for x in windows(rows(at), bench) if not x[5]}
    assert kept.columns == docs.columns

    last = STAGES["encoding"](spark, kept, SF0001).collect()
    assert all(r.round_trip for r in last) and len(last) == kept.count()
    at.unpersist()
    kept.unpersist()


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, SF0001)
    assert got.count() > 50 and "ids_sha256" in got.columns


def test_every_stage_on_awkward_rows(spark, awkward, nothing):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, awkward, SF0001)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == awkward.columns
            assert out.dtypes == awkward.dtypes
        assert out.count() <= awkward.count()
        assert stage(spark, nothing, SF0001).count() == 0


def test_null_and_shared_ids(spark):
    """Rows without an id and an id of two texts go through every stage as
    documents of their own, clean lines whole."""
    body = {x: " ".join(f"{x}{i}th the and of" for i in range(30)) for x in "abcd"}
    shared = "a line that several documents hold word for word"
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    more = spark.createDataFrame(
        [(900001, body["a"] + "\n" + shared), (900001, body["b"] + "\n" + shared), (None, body["c"] + "\n" + shared),
         (None, body["d"])], "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit("x"))
    at = docs.unionByName(more, allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        at = stage(spark, at, SF0001)
        left = [r.text for r in at.filter("doc_id = 900001 or doc_id is null").collect()]
        assert sorted(t.split("\n")[0] for t in left) == sorted(body.values())
        assert sum(t.endswith(shared) for t in left) == 1


def test_near_duplicates_keep_the_first_of_each_group(awkward):
    left = sorted({i for i, _ in rows(minhash.drop_near_duplicates(awkward))})
    assert left == sorted(i for i, _, _, k in set(groups(rows(awkward), 5, 80)) if k)
