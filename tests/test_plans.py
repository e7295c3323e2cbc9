"""Plan shape: the properties the operators are designed for at scale,
asserted on the physical plan text."""

import contextlib
import io

from conftest import SF001
from roomrate.plans.catalog import QUERIES


def plan(df) -> str:
    conf = df.sparkSession.conf
    old = conf.get("spark.sql.maxMetadataStringLength")
    conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        return buf.getvalue()
    finally:
        conf.set("spark.sql.maxMetadataStringLength", old)


def test_projection_reaches_the_scan(spark):
    p = plan(QUERIES["project_subset"](spark, SF001))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in p


def test_comparables_predicates_are_pushed_to_parquet(spark):
    p = plan(QUERIES["comparables_filter"](spark, SF001))
    assert "EqualTo(c_mktsegment,HOUSEHOLD)" in p
    assert "GreaterThan(c_acctbal,0.0)" in p


def test_in_set_is_pushed(spark):
    p = plan(QUERIES["filter_in_set"](spark, SF001))
    assert "In(o_orderpriority" in p


def test_global_zscore_uses_one_merged_subquery_not_a_join(spark):
    p = plan(QUERIES["zscore_filter_k25"](spark, SF001))
    assert "Subquery" in p
    for bad in ("CartesianProduct", "NestedLoopJoin", "SortMergeJoin", "BroadcastHashJoin"):
        assert bad not in p
    # avg and stddev_pop come from one aggregate (one functions list holds both)
    import re
    assert any("avg(" in f and "stddev_pop(" in f
               for f in re.findall(r"functions=\[([^\]]*)\]", p))


def test_grouped_zscore_aggregates_and_broadcasts_no_window(spark):
    p = plan(QUERIES["zscore_filter_by_group"](spark, SF001))
    assert "Window" not in p
    assert "BroadcastHashJoin" in p
    assert "partial_avg" in p          # map-side partial aggregation


def test_frequency_filter_broadcasts_bounded_keys(spark):
    p = plan(QUERIES["frequency_filter"](spark, SF001))
    assert "LeftSemi" in p and "BroadcastExchange" in p
    assert "SortMergeJoin" not in p
    assert "partial_count" in p


def test_nearest_centre_has_no_join(spark):
    p = plan(QUERIES["assign_nearest"](spark, SF001))
    for bad in ("Join", "CartesianProduct"):
        assert bad not in p


def test_split_is_a_pure_projection(spark):
    p = plan(QUERIES["split_train"](spark, SF001))
    assert "Exchange" not in p and "Join" not in p


def test_hot_key_third_of_rows(spark):
    """One user owns a third of the rows: counts, per-group moments and the
    rare-category filter stay partial aggregates plus a broadcast of the
    per-key table, so the hot key never lands whole in one task."""
    import math

    from pyspark.sql import functions as F

    from roomrate.operators import aggregates as agg
    from roomrate.operators import filters as flt

    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("user_id"),
        ((F.col("id") * 7919) % 1000 / 10.0).alias("value"))
    rows = [(r.event_id, r.user_id, r.value) for r in df.collect()]
    counts = {}
    for _, u, _ in rows:
        counts[u] = counts.get(u, 0) + 1
    assert counts[0] == n // 3

    ann = agg.annotate_count(df, "user_id", "n")
    assert {(r.event_id, r.n) for r in ann.collect()} == {(e, counts[u]) for e, u, _ in rows}
    freq = flt.frequency_filter(df, "user_id", 1 / 200)
    assert freq.count() == sum(c for c in counts.values() if c * 200 > n)
    zg = flt.zscore_filter_by(df, "user_id", "value", 1.5)
    by = {}
    for _, u, v in rows:
        by.setdefault(u, []).append(v)
    want = 0
    for vs in by.values():
        m = sum(vs) / len(vs)
        sd = math.sqrt(sum((v - m) ** 2 for v in vs) / len(vs))
        want += sum(1 for v in vs if sd > 0 and abs((v - m) / sd) < 1.5)
    assert zg.count() == want
    for out in (ann, freq, zg):
        p = plan(out)
        assert "SortMergeJoin" not in p and "Window" not in p
        assert "BroadcastHashJoin" in p
