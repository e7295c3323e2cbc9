"""Model operators and plans: checked by invariants, since their exact
output is not expressible in SQL."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from roomrate.operators.cluster import assign_nearest, kmeans_assign, kmeans_fit
from roomrate.operators.evaluate import error_metrics
from roomrate.operators.regress import fit_per_group
from roomrate.operators.split import split, split_flag
from roomrate.plans.clustered import clustered_price_model, leak_free_cluster_model
from roomrate.plans.global_model import global_price_model
from roomrate.plans.tables import PRICED_ORDER_FEATURES, load, priced_orders


def test_global_model_learns_planted_price(spark):
    o = priced_orders(spark, SF001)
    preds, metrics, _ = global_price_model(o, "o_orderkey", PRICED_ORDER_FEATURES, "price",
                                           max_iter=10)
    _, test = split(o, "o_orderkey")
    n_test = test.count()
    assert preds.count() == n_test == preds.select("o_orderkey").distinct().count()
    m = metrics.first()
    std = o.select(F.stddev_pop("price")).first()[0]
    assert m.n == n_test
    assert m.rmse < 0.2 * std
    assert m.mape < 0.05


def _embeddings(spark, d):
    return load(spark, d, "embeddings").withColumn("emb", array_to_vector("embedding"))


def test_kmeans_ids_sizes_and_nearest_centre(spark):
    e = _embeddings(spark, SF001)
    km = kmeans_fit(e, ["emb"], 7, 123, key="vec_id")
    out = kmeans_assign(km, e)
    sizes = {r.cluster: r["count"] for r in out.groupBy("cluster").count().collect()}
    assert set(sizes) <= set(range(7)) and sum(sizes.values()) == e.count()
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(km.stages[-1].clusterCenters())]
    again = assign_nearest(out, "embedding", centres, name="nearest")
    assert again.filter(F.col("nearest") != F.col("cluster")).count() == 0


def test_kmeans_independent_of_input_layout(spark):
    e = _embeddings(spark, SF001)
    a = kmeans_assign(kmeans_fit(e.repartition(1), ["emb"], 5, 123, key="vec_id"), e)
    b = kmeans_assign(kmeans_fit(e.repartition(8), ["emb"], 5, 123, key="vec_id"), e)
    pa = {r.vec_id: r.cluster for r in a.collect()}
    pb = {r.vec_id: r.cluster for r in b.collect()}
    assert pa == pb


def test_fit_per_group_skips_groups_missing_a_half(spark):
    o = split_flag(priced_orders(spark, SF0001), "o_orderkey")
    # status P: training rows only -> cannot be scored
    o = o.withColumn("is_train", F.when(F.col("o_orderstatus") == "P", 1)
                     .otherwise(F.col("is_train")))
    preds, metrics, models = fit_per_group(o, "o_orderstatus", PRICED_ORDER_FEATURES, "price",
                                           "o_orderkey", "is_train", max_iter=3)
    assert {r.o_orderstatus for r in metrics.collect()} == {"F", "O"}
    assert set(models) == {"F", "O"}
    test_keys = o.filter("is_train = 0 and o_orderstatus != 'P'").count()
    assert preds.count() == test_keys == preds.select("o_orderkey").distinct().count()
    m = {r.o_orderstatus: r for r in metrics.collect()}
    again = {r.o_orderstatus: r for r in error_metrics(preds, "price", by="o_orderstatus").collect()}
    for g in m:
        assert m[g].rmse == pytest.approx(again[g].rmse)


def test_clustered_plan_invariants(spark):
    o = priced_orders(spark, SF0001)
    res = clustered_price_model(o, "o_orderkey", PRICED_ORDER_FEATURES, PRICED_ORDER_FEATURES,
                                "price", k=3, max_iter=3)
    rows = res.metrics.collect()
    assert 1 <= len(rows) <= 3
    assert all(0 <= r.cluster < 3 for r in rows)
    assert sum(r.size for r in rows) <= o.count()
    best = res.best.first()
    assert best.mape == min(r.mape for r in rows)
    s = res.summary.first()
    assert s.n_groups == len(rows) and s.best_rmse == min(r.rmse for r in rows)
    assert res.predictions.select("o_orderkey").distinct().count() == res.predictions.count()
    with pytest.raises(ValueError):
        clustered_price_model(o, "o_orderkey", PRICED_ORDER_FEATURES + ["price"],
                              PRICED_ORDER_FEATURES, "price", k=3)


def test_clustered_predictions_are_written_once(spark):
    """The predictions are a staged table: reading them scores nothing."""
    o = priced_orders(spark, SF0001)
    res = clustered_price_model(o, "o_orderkey", PRICED_ORDER_FEATURES, PRICED_ORDER_FEATURES,
                                "price", k=2, max_iter=2)
    files = res.predictions.inputFiles()
    assert files and all("/cluster-predictions-" in f for f in files)


def test_leak_free_plan_scores_only_test_rows(spark):
    o = priced_orders(spark, SF0001)
    res = leak_free_cluster_model(o, "o_orderkey", PRICED_ORDER_FEATURES, "price", k=4,
                                  max_iter=3)
    rows = res.metrics.collect()
    assert 1 <= len(rows) <= 4
    flagged = split_flag(o, "o_orderkey")
    test_keys = {r.o_orderkey for r in flagged.filter("is_train = 0").collect()}
    pred_keys = [r.o_orderkey for r in res.predictions.collect()]
    assert len(pred_keys) == len(set(pred_keys)) and set(pred_keys) <= test_keys
    # labels scored against are the real prices, not the overlaid ones
    real = {r.o_orderkey: float(r.price) for r in o.collect()}
    assert all(real[r.o_orderkey] == r.price for r in res.predictions.collect())


def test_assign_nearest_arrow_equals_sql(spark):
    from roomrate.operators.cluster import collect_centres, label_centres

    e = load(spark, SF001, "embeddings")
    centres = collect_centres(label_centres(e, "embedding", "label"), "label")
    a = assign_nearest(e, "embedding", centres, method="arrow").select("vec_id", "cluster")
    b = assign_nearest(e, "embedding", centres, method="sql").select("vec_id", "cluster")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert dict(a.dtypes)["cluster"] == "int"
    # a null vector gets a null id, not an error
    with_null = e.limit(3).union(e.limit(1).withColumn("embedding", F.lit(None)))
    got = assign_nearest(with_null, "embedding", centres).collect()
    assert sum(r.cluster is None for r in got) == 1


def test_kmeans_scaled_option(spark):
    o = priced_orders(spark, SF0001)
    km = kmeans_fit(o, PRICED_ORDER_FEATURES, 4, 123, key="o_orderkey", scale=True)
    out = kmeans_assign(km, o)
    assert "_scaled" not in out.columns and "_features" not in out.columns
    assert out.count() == o.count()
    assert {r.cluster for r in out.select("cluster").distinct().collect()} <= set(range(4))
