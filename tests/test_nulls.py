"""Null keys, null features and bad rows: nothing is lost in silence."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from roomrate.operators.aggregates import annotate_count
from roomrate.operators.cluster import kmeans_assign, kmeans_fit
from roomrate.operators.encode import dummy_names, missing_counts, one_hot
from roomrate.operators.evaluate import error_metrics, metric_summary
from roomrate.operators.filters import (drop_empty_groups, frequency_filter, select_group,
                                        zscore_filter_by)
from roomrate.operators.joins import null_safe_join, semi_join_keys
from roomrate.operators.overlay import overlay_from_model
from roomrate.operators.regress import fit_per_group, gbt_fit, predict
from roomrate.operators.split import split_flag
from roomrate.plans.global_model import global_price_model
from roomrate.plans.tables import PRICED_ORDER_FEATURES, priced_orders
from roomrate.sources import corrupt_rows, read_delimited, release_staged, stage
from pyspark.sql import types as T


@pytest.fixture(scope="module")
def half_null(spark):
    return spark.createDataFrame([(i, "a" if i % 2 else None, float(i)) for i in range(20)],
                                 "id int, g string, x double")


def test_the_null_group_keeps_its_rows(half_null):
    assert annotate_count(half_null, "g").filter("count = 10").count() == 20
    assert frequency_filter(half_null, "g", 0.1).count() == 20
    assert zscore_filter_by(half_null, "g", "x").count() == 20
    assert select_group(half_null, "g", None).count() == 10
    flagged = half_null.withColumn("flag", (F.col("id") % 3 == 0).cast("int"))
    assert drop_empty_groups(flagged, "g", "flag").count() == 20
    assert semi_join_keys(half_null, half_null.select("g"), "g").count() == 20
    assert null_safe_join(half_null, half_null.groupBy("g").count(), "g").columns == ["id", "g", "x", "count"]


def test_nothing_stays_cached(spark, half_null):
    before = set(spark.sparkContext._jsc.getPersistentRDDs())  # other modules' fixtures
    annotate_count(half_null, "g").count()
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_a_null_group_is_fitted_and_scored(spark):
    o = split_flag(priced_orders(spark, SF0001), "o_orderkey")
    o = o.withColumn("g", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")))
    preds, metrics, models = fit_per_group(o, "g", ["cust_band"], "price", "o_orderkey", "is_train", max_iter=2)
    assert None in models and None in {r.g for r in metrics.collect()}
    tests = o.filter("is_train = 0 and g is null").count()
    assert preds.filter("g is null").count() == tests > 0


def _with_gaps(spark):
    return priced_orders(spark, SF0001).withColumn(
        "cust_band", F.when(F.col("o_orderkey") % 5 != 0, F.col("cust_band")))


def test_rows_with_missing_features_are_clustered_scored_and_counted(spark):
    o = _with_gaps(spark)
    km = kmeans_fit(o, ["cust_band", "price"], 3, key="o_orderkey")
    out = kmeans_assign(km, o)
    assert out.count() == o.count() and out.columns == [*o.columns, "cluster"]
    preds, _, model = global_price_model(o, "o_orderkey", PRICED_ORDER_FEATURES, "price", max_iter=2)
    tests = split_flag(o, "o_orderkey").filter("is_train = 0").count()
    assert preds.filter("prediction is not null").count() == tests
    n = missing_counts(o, ["cust_band"]).first()
    assert n.n_rows == o.count() and n.n_incomplete == n.cust_band == o.filter("cust_band is null").count()
    skipping = gbt_fit(o, ["cust_band"], "price", max_iter=1, key="o_orderkey", missing="skip")
    assert predict(skipping, o).count() == o.filter("cust_band is not null").count()


def test_overlay_leaves_training_rows_alone(spark):
    o = split_flag(_with_gaps(spark), "o_orderkey")
    model = gbt_fit(o.filter("is_train = 1"), ["cust_band"], "price", max_iter=1, key="o_orderkey")
    seen = o.withColumn("seen", F.col("price").cast("double"))
    out = overlay_from_model(seen, model, "is_train", "seen")
    assert out.columns == seen.columns and out.count() == o.count()
    assert out.filter("is_train = 1 and seen <> price").count() == 0


def test_summary_weighs_by_scored_rows(spark):
    rows = [("a", 10.0, 20.0)] * 10 + [("b", 10.0, 11.0)] * 90
    preds = spark.createDataFrame(rows, "g string, label double, prediction double")
    m = error_metrics(preds, by="g").withColumn("size", F.lit(100))
    s = metric_summary(m, "size").first()
    whole = error_metrics(preds).first()
    assert s.pooled_rmse == pytest.approx(whole.rmse) == pytest.approx((1090 / 100) ** 0.5)
    assert s.weighted_mape == pytest.approx(whole.mape) and s.total_size == 200


def test_fits_do_not_depend_on_the_session_or_the_layout(spark, monkeypatch):
    from roomrate.operators import layout

    # several partitions on a small table
    monkeypatch.setattr(layout, "SMALL", 10_000)
    assert layout.plan_layout(priced_orders(spark, SF0001).select("o_orderkey", "cust_band", "price"),
                              "o_orderkey").partitions >= 3
    o = priced_orders(spark, SF0001)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for n, layout in (("2", 1), ("9", 7)):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            laid = o.repartition(layout)
            km = kmeans_fit(laid, ["cust_band", "price"], 4, key="o_orderkey")
            centres = sorted(tuple(round(float(x), 6) for x in c) for c in km.stages[-1].clusterCenters())
            gbt = gbt_fit(laid, ["cust_band", "o_totalprice"], "price", max_iter=3, key="o_orderkey")
            p = {r.o_orderkey: round(r.prediction, 6) for r in predict(gbt, o).collect()}
            seen.append((centres, p))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1]


def test_dummies_of_any_script(spark):
    assert dummy_names("city", ["北京", "Москва", "a b", "a-b", "A b"])[:2] == ["city_北京", "city_Москва"]
    names = dummy_names("city", ["a b", "a-b", "!"])
    assert len(set(names)) == 3 and all(n.startswith("city") for n in names)
    df = spark.createDataFrame([("北京",), ("!",), ("?",), (None,)], "city string")
    assert [sum(r) for r in one_hot(df, "city").collect()] == [1, 1, 1, 0]


SCHEMA = T.StructType([T.StructField("price", T.IntegerType()), T.StructField("beds", T.IntegerType())])


def _file(text):
    p = os.path.join(tempfile.mkdtemp(prefix="roomrate-csv-"), "f.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_a_header_in_another_order_fails(spark):
    p = _file("beds,price\n2,100\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, p, SCHEMA).collect()
    assert [tuple(r) for r in read_delimited(spark, p, SCHEMA, by_position=True).collect()] == [(2, 100)]


def test_corrupt_rows_are_returned(spark):
    p = _file("price,beds\n1,2\n1,2,3\n4\n5,6\n")
    assert read_delimited(spark, p, SCHEMA).count() == 2
    assert sorted(r.line for r in corrupt_rows(spark, p, SCHEMA).collect()) == ["1,2,3", "4"]


def test_staged_values_and_release(spark):
    rows = [(1, "007"), (2, ""), (3, None), (4, "a/b=c")]
    df = spark.createDataFrame(rows, "id int, code string").repartition(4)
    back = stage(df, "codes", partition_by="code")
    assert back.dtypes == df.dtypes
    assert sorted(back.collect(), key=lambda r: r.id) == sorted(df.collect(), key=lambda r: r.id)
    hot = spark.range(4000).repartition(16).withColumn("g", (F.col("id") % 3).cast("int"))
    staged = stage(hot, "few-files", partition_by="g")
    assert len(staged.inputFiles()) <= 12  # not 16 x 3
    assert release_staged(spark) >= 2
    with pytest.raises(Exception):
        back.count()
