"""The layout that iterative fits read: follows the data alone, in bytes,
within a bound, heavy keys spread."""

import pytest
from pyspark.sql import functions as F

from roomrate.operators import layout


def test_partition_count_follows_bytes_and_is_bounded():
    mib = 1 << 20
    assert [layout.partition_count(n) for n in (0, 1, mib, mib + 1, 8 * mib, 64 * mib)] == [1, 1, 1, 2, 8, 64]
    assert layout.partition_count(1 << 30) == 64 and layout.partition_count(64 << 30) == 1024
    assert layout.partition_count(10**11 * 100) == layout.MAX_PARTITIONS
    counts = [layout.partition_count(2**i) for i in range(60)]
    assert counts == sorted(counts)


@pytest.fixture
def rows(spark):
    # a third of the rows has no key, a ninth one key
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 != 0, F.when(F.col("id") % 9 == 1, 7).otherwise(F.col("id"))).alias("k"),
        (F.col("id") * 0.5).alias("x"), F.concat(F.lit("name"), F.col("id") % 100).alias("s"))


def parts(df):
    out = {}
    for r in df.withColumn("p", F.spark_partition_id()).collect():
        out.setdefault(r.p, []).append((r.k, r.x, r.s))
    return out


def test_heavy_keys_spread(rows):
    sizes = [len(p) for p in parts(layout.lay_out(rows, "k", 24)).values()]
    assert len(sizes) == 24 and max(sizes) < 1.3 * 30_000 / 24 and min(sizes) > 0.7 * 30_000 / 24


def test_the_same_under_any_session_and_input_layout(spark, rows):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        seen = []
        for n, cut in (("3", 1), ("11", 6)):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(parts(layout.lay_out(rows.repartition(cut), "k", 10)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1] and sum(map(len, seen[0].values())) == 30_000


def test_light_keys_stay_together(spark):
    df = spark.range(5000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("x"))
    where = {}
    for p, rows in parts(layout.lay_out(df.withColumn("s", F.lit("")), "k", 4)).items():
        for k, _, _ in rows:
            where.setdefault(k, set()).add(p)
    # only keys of the buckets that a cut goes through are in two partitions
    assert sum(len(p) > 1 for p in where.values()) <= 3 * 6


def test_empty_table(spark, rows):
    assert layout.lay_out(rows.limit(0), "k").count() == 0
    assert layout.plan_layout(rows.limit(0), "k").partitions == 1
