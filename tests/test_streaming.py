"""Scoring a file stream gives the same predictions as the batch path,
and a restart from the same checkpoint adds nothing."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF0001
from roomrate.operators.regress import gbt_fit, predict
from roomrate.plans.tables import PRICED_ORDER_FEATURES, priced_orders
from roomrate.streaming import score_stream


def test_stream_scoring_matches_batch_and_is_idempotent(spark):
    o = priced_orders(spark, SF0001)
    model = gbt_fit(o, PRICED_ORDER_FEATURES, "price", max_iter=3, key="o_orderkey")
    src = tempfile.mkdtemp(prefix="roomrate-stream-src-")
    o.repartition(3).write.mode("overwrite").parquet(os.path.join(src, "batch1"))
    out = tempfile.mkdtemp(prefix="roomrate-stream-out-")
    sink, ck = os.path.join(out, "sink"), os.path.join(out, "ck")
    schema = o.schema
    q = score_stream(spark, model, os.path.join(src, "batch1"), schema, sink, ck,
                     keep=["o_orderkey", "price"])
    q.awaitTermination(300)
    got = {r.o_orderkey: r.prediction for r in spark.read.parquet(sink).collect()}
    want = {r.o_orderkey: r.prediction
            for r in predict(model, o, keep=["o_orderkey"]).collect()}
    assert got == want
    again = score_stream(spark, model, os.path.join(src, "batch1"), schema, sink, ck,
                         keep=["o_orderkey", "price"])
    again.awaitTermination(300)
    assert spark.read.parquet(sink).count() == len(want)
    assert spark.read.parquet(sink).filter(F.col("prediction").isNull()).count() == 0


def test_stream_picks_up_new_files_once(spark):
    o = priced_orders(spark, SF0001)
    model = gbt_fit(o, PRICED_ORDER_FEATURES, "price", max_iter=2, key="o_orderkey")
    src = tempfile.mkdtemp(prefix="roomrate-stream-inc-")
    out = tempfile.mkdtemp(prefix="roomrate-stream-inc-out-")
    sink, ck = os.path.join(out, "sink"), os.path.join(out, "ck")
    first, second = o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 2 = 1")
    first.write.parquet(os.path.join(src, "part-a"))
    q = score_stream(spark, model, src, o.schema, sink, ck, keep=["o_orderkey"],
                     file_glob="*.parquet", max_files_per_trigger=1, recursive=True)
    q.awaitTermination(300)
    n1 = spark.read.parquet(sink).count()
    assert n1 == first.count()
    second.write.parquet(os.path.join(src, "part-b"))
    q = score_stream(spark, model, src, o.schema, sink, ck, keep=["o_orderkey"],
                     file_glob="*.parquet", max_files_per_trigger=1, recursive=True)
    q.awaitTermination(300)
    keys = [r.o_orderkey for r in spark.read.parquet(sink).collect()]
    assert len(keys) == len(set(keys)) == o.count()
