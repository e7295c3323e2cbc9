"""Relational operators on hand-made fixtures (FIXTURES.md section 4)."""

import math

import pytest
from pyspark.sql import functions as F

from roomrate.functions.geo import haversine_km, haversine_km_py
from roomrate.operators import aggregates as agg
from roomrate.operators import columns as cols
from roomrate.operators import evaluate as ev
from roomrate.operators import filters as flt
from roomrate.operators.comparables import distance_from_anchor, rank_by
from roomrate.operators.encode import dummy_name, one_hot, vocabulary
from roomrate.operators.joins import attach, join_small, semi_join_keys
from roomrate.operators.overlay import overlay_prediction
from roomrate.operators.split import split, split_flag, union_tagged


def test_zscore_strict_bound_and_constant_group(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 1.0)], "id int, x double")
    assert flt.zscore_filter(df, "x", 1.0).count() == 0          # |z| == k is dropped
    assert flt.zscore_filter(df, "x", 1.0001).count() == 2
    const = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, x double")
    assert flt.zscore_filter(const, "x", 2.5).count() == 0
    assert flt.zscore_filter(const, "x", 2.5, keep_constant=True).count() == 2
    g = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "a", 3.0), (4, "b", 9.0)],
                              "id int, g string, x double")
    kept = {r.id for r in flt.zscore_filter_by(g, "g", "x", 1.3).collect()}
    assert kept == {1, 2, 3}        # one-row group b: std 0 -> dropped


def test_zscore_null_policy(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (4, 3.0)], "id int, x double")
    assert {r.id for r in flt.zscore_filter(df, "x", 2.5).collect()} == {1, 2, 4}
    assert flt.zscore_filter(df, "x", 2.5, nan_policy="propagate").count() == 0
    with pytest.raises(ValueError):
        flt.zscore_filter(df, "x", 2.5, nan_policy="drop")


def test_zscore_matches_brute_force(spark):
    vals = [float(v) for v in [1, 2, 2, 3, 3, 3, 4, 50, -20, 7, 8, 9]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x double")
    m = sum(vals) / len(vals)
    sd = math.sqrt(sum((v - m) ** 2 for v in vals) / len(vals))
    want = {i for i, v in enumerate(vals) if abs((v - m) / sd) < 1.5}
    assert {r.id for r in flt.zscore_filter(df, "x", 1.5).collect()} == want


def test_frequency_filter_strict_share(spark):
    rows = [(i, "big") for i in range(197)] + [(197, "one"), (198, "two"), (199, "two")]
    df = spark.createDataFrame(rows, "id int, g string")
    # total 200, share 1/200 -> a value needs more than 1 row
    kept = flt.frequency_filter(df, "g", 1 / 200)
    assert {r.g for r in kept.select("g").distinct().collect()} == {"big", "two"}
    assert kept.count() == 199


def test_annotate_count_and_count_by(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, g string")
    assert {(r.id, r["count"]) for r in agg.annotate_count(df, "g").collect()} == \
        {(1, 2), (2, 2), (3, 1)}
    assert {(r.g, r["count"]) for r in agg.count_by(df, "g").collect()} == {("a", 2), ("b", 1)}
    assert agg.row_count(df).first()[0] == 3


def test_semi_join_with_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, v string")
    keys = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    got = sorted(r.id for r in semi_join_keys(df, keys, "id").collect())
    assert got == [1, 3]
    inner = join_small(df, keys.distinct(), "id", "inner")
    assert inner.count() == 2


def test_attach_casts_string_key(spark):
    left = spark.createDataFrame([(1, 10.0), (2, 20.0)], "listId int, price double")
    right = spark.createDataFrame([("1", 0), ("2", 1), ("x", 1)], "label string, cluster int")
    got = {(r.listId, r.cluster) for r in attach(left, right, "listId", "label").collect()}
    assert got == {(1, 0), (2, 1)}


def test_one_hot_names_and_unseen_values(spark):
    df = spark.createDataFrame(
        [(1, "Casa particular (Cuba)", "Entire home/apt"), (2, "Loft", "Private room")],
        "id int, propertyType string, roomType string")
    wide = one_hot(df, ["propertyType", "roomType"])
    assert set(wide.columns) == {"id", "propertyType_Casa_particular_Cuba", "propertyType_Loft",
                                 "roomType_Entire_home_apt", "roomType_Private_room"}
    assert dict(wide.dtypes)["propertyType_Loft"] == "int"
    # a value seen only at scoring time: all dummies 0
    test = spark.createDataFrame([(3, "Boat", "Shared room")], "id int, propertyType string, roomType string")
    vocab = {"propertyType": vocabulary(df, "propertyType"), "roomType": vocabulary(df, "roomType")}
    row = one_hot(test, ["propertyType", "roomType"], vocab=vocab).first()
    assert sum(row[c] for c in row.asDict() if c != "id") == 0
    # same value in two columns -> distinct names
    both = spark.createDataFrame([("x", "x")], "a string, b string")
    assert set(one_hot(both, ["a", "b"]).columns) == {"a_x", "b_x"}
    clash = spark.createDataFrame([("x", 1)], "a string, a_x int")
    with pytest.raises(ValueError):
        one_hot(clash, ["a"], drop_source=False)
    assert dummy_name("roomType", "Entire home/apt") == "roomType_Entire_home_apt"


def test_vocabulary_bound(spark):
    df = spark.range(50).withColumn("c", F.col("id").cast("string"))
    with pytest.raises(ValueError):
        vocabulary(df, "c", max_levels=10)
    assert vocabulary(df, "c", max_levels=50)[:3] == ["0", "1", "10"]


def test_columns_ops(spark):
    df = spark.createDataFrame([(1, "2", "x")], "id int, price string, t string")
    out = cols.move_last(df, "id", "listId")
    assert out.columns == ["price", "t", "listId"]
    assert cols.rename_columns(df, {"t": "type"}).columns == ["id", "price", "type"]
    assert cols.drop_columns(df, ["t"]).columns == ["id", "price"]
    assert cols.select_columns(df, ["t"]).columns == ["t"]
    cast = cols.bulk_cast(df, {"int": ["price"], "double": ["id"]})
    assert dict(cast.dtypes) == {"id": "double", "price": "int", "t": "string"}
    flagged = cols.flag_when(df, F.col("t") == "x", "is_x")
    assert flagged.first().is_x == 1
    assert cols.tag(df, "testTrain", 1).first().testTrain == 1
    rep = cols.replace_when(cast, F.col("t") == "x", "price", F.lit(9))
    assert rep.first().price == 9


def test_split_disjoint_complete_and_layout_free(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, test = split(df, "k", 70, 123)
    tr = {r.k for r in train.collect()}
    te = {r.k for r in test.collect()}
    assert not (tr & te) and len(tr | te) == 2000
    assert 0.6 < len(tr) / 2000 < 0.8
    one = {r.k for r in split(df.repartition(1), "k")[0].collect()}
    many = {r.k for r in split(df.repartition(8), "k")[0].collect()}
    assert one == many == tr
    u = union_tagged(train, test, "testTrain")
    assert u.count() == 2000 and u.filter("testTrain = 1").count() == len(tr)
    f = split_flag(df, "k")
    assert f.filter("is_train = 1").count() == len(tr)


def test_overlay_prediction(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (2, 0, 20.0), (3, 0, 30.0)],
                               "id int, is_train int, price double")
    preds = spark.createDataFrame([(2, 25.0)], "id int, prediction double")
    got = {r.id: r.price for r in overlay_prediction(df, preds, "id", "is_train", "price").collect()}
    assert got == {1: 10.0, 2: 25.0, 3: None}


def test_overlay_of_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (2, 0, 20.0), (2, 0, 21.0), (None, 0, 30.0), (None, 1, 31.0), (0, 0, 40.0)],
                               "id int, is_train int, price double").withColumn("row", F.monotonically_increasing_id())
    schema = "id int, prediction double"
    twice = spark.createDataFrame([(2, 25.0), (2, 27.0), (None, 5.0), (9, None), (9, 1.0)], schema)
    for rule, want in (("mean", 26.0), ("min", 25.0), ("max", 27.0)):
        got = overlay_prediction(df, twice, "id", "is_train", "price", repeated=rule).orderBy("row").collect()
        assert [r.price for r in got] == [10.0, want, want, 5.0, 31.0, None]
    with pytest.raises(Exception, match="predictions differ for id = 2"):
        overlay_prediction(df, twice.filter("id = 2"), "id", "is_train", "price").collect()
    with pytest.raises(Exception, match="predictions differ"):
        overlay_prediction(df, twice.filter("id = 9"), "id", "is_train", "price").collect()
    same = spark.createDataFrame([(2, 25.0), (2, 25.0), (None, 5.0), (None, 5.0)], schema)
    got = overlay_prediction(df, same, "id", "is_train", "price").orderBy("row").collect()
    assert [r.price for r in got] == [10.0, 25.0, 25.0, 5.0, 31.0, None]
    with pytest.raises(ValueError):
        overlay_prediction(df, same, "id", "is_train", "price", repeated="last")


def test_metrics_zero_prediction_and_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    p = spark.createDataFrame([(10.0, 8.0), (5.0, 0.0), (3.0, 4.0)], "label double, prediction double")
    m = ev.error_metrics(p).first()
    assert m.n == 3
    assert m.mape == pytest.approx((2 / 8 + 1 / 4) / 2)         # zero prediction left out
    assert m.rmse == pytest.approx(math.sqrt((4 + 25 + 1) / 3))  # but kept in RMSE
    assert m.rmse == pytest.approx(RegressionEvaluator(metricName="rmse").evaluate(p))
    tb = ev.error_metrics(p, mape_denominator="label").first()
    assert tb.mape == pytest.approx((2 / 10 + 5 / 5 + 1 / 3) / 3)


def test_best_group_and_summary(spark):
    m = spark.createDataFrame([(0, 10, 0.2, 5.0), (1, 30, 0.1, 9.0), (2, 60, 0.1, 7.0)],
                              "g int, n long, mape double, rmse double")
    b = ev.best_group(m, "g").first()
    assert (b.g, b.rmse) == (1, 9.0)          # lowest MAPE, its own RMSE, ties by id
    s = ev.metric_summary(m).first()
    assert s.best_rmse == 5.0 and s.mean_rmse == pytest.approx(7.0)
    assert s.best_mape == pytest.approx(0.1) and s.total_size == 100
    assert s.weighted_mape == pytest.approx((10 * 0.2 + 30 * 0.1 + 60 * 0.1) / 100)


def test_trainable_groups_skip_half_empty(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 0), (3, "b", 1), (4, "c", 0)],
                               "id int, g string, f int")
    assert {r.g for r in flt.trainable_groups(df, "g", "f").collect()} == {"a"}
    assert {r.id for r in flt.drop_empty_groups(df, "g", "f").collect()} == {1, 2}


def test_distance_anchor_antipode_and_brute_force(spark):
    pts = [(0, 40.76903722, -73.92942684), (1, 40.76633963, -73.92002632),
           (2, -40.76903722, 106.07057316), (3, 0.0, 0.0)]
    df = spark.createDataFrame(pts, "k int, latitude double, longitude double")
    got = {r.k: r.distance_km for r in distance_from_anchor(df, "k", 0).collect()}
    assert got[0] == 0.0
    assert got[2] == pytest.approx(6371 * math.pi, rel=1e-9)
    for k, la, lo in pts:
        assert got[k] == pytest.approx(haversine_km_py(pts[0][1], pts[0][2], la, lo), abs=1e-9)
    # two listings 0.846585907 km apart (golden value, R = 6371 km)
    d = df.select(haversine_km(F.lit(40.76903722), F.lit(-73.92942684),
                               F.lit(40.76633963), F.lit(-73.92002632)).alias("d")).first().d
    assert d == pytest.approx(0.846585907, abs=1e-6)


def test_rank_and_spread(spark):
    df = spark.createDataFrame([(1, 50), (2, 150), (3, 95), (4, 95)], "k int, price int")
    assert [r.k for r in rank_by(df, "price", "k").collect()] == [2, 3, 4, 1]
    s = agg.spread_summary(df, "price").first()
    vals = [50, 150, 95, 95]
    m = sum(vals) / 4
    assert s.std_samp == pytest.approx(math.sqrt(sum((v - m) ** 2 for v in vals) / 3))
    assert s.range == 100 and s.n == 4


def test_in_set_and_select_group(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, g string")
    assert flt.in_set(df, "g", ["a", "c"]).count() == 2
    assert flt.select_group(df, "g", "b").first().id == 2
    assert flt.comparables(df, {"g": "a"}, {"id": 0}).count() == 1


def test_odd_column_names_survive_joins(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "a", 4.0), (3, "b", 5.0)],
                               "id int, `room type` string, `price/night (usd)` double")
    kept = flt.zscore_filter_by(df, "room type", "price/night (usd)", 2.0, keep_constant=True)
    assert kept.columns == df.columns and kept.count() == 3
    ann = agg.annotate_count(df, "room type")
    assert ann.columns == df.columns + ["count"]
    semi = semi_join_keys(df, df.select("id").filter("id < 3"), "id")
    assert semi.columns == df.columns and semi.count() == 2


def test_lenient_long_cast_is_exact_for_big_ids(spark):
    df = spark.createDataFrame([("9007199254740993",), ("1.9",), (" 42 ",), ("x",)], "t string")
    got = [r.t for r in cols.bulk_cast(df, {"bigint": ["t"]}).collect()]
    assert got == [9007199254740993, 1, 42, None]


def test_vocabularies_one_pass_and_bound(spark):
    from roomrate.operators.encode import vocabularies

    df = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("a", None, 3)],
                               "p string, q string, n int")
    assert vocabularies(df, ["p", "q", "n"]) == {"p": ["a", "b"], "q": ["x"], "n": [1, 2, 3]}
    wide = spark.range(30).select(F.col("id").cast("string").alias("p"), F.lit("x").alias("q"))
    with pytest.raises(ValueError):
        vocabularies(wide, ["p", "q"], max_levels=10)


def test_bulk_cast_strict_mode(spark):
    df = spark.createDataFrame([("1",), ("x",)], "t string")
    with pytest.raises(Exception):
        cols.bulk_cast(df, {"int": ["t"]}, on_bad="error").collect()
    ok = spark.createDataFrame([("1",), ("2.0",), (None,)], "t string")
    assert [r.t for r in cols.bulk_cast(ok, {"int": ["t"]}, on_bad="error").collect()] == \
        [1, 2, None]
    with pytest.raises(ValueError):
        cols.bulk_cast(df, {"int": ["t"]}, on_bad="drop")


def test_zscore_nan_is_missing_in_omit_mode(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, float("nan")), (4, 3.0)],
                               "id int, x double")
    assert {r.id for r in flt.zscore_filter(df, "x", 2.5).collect()} == {1, 2, 4}
    assert flt.zscore_filter(df, "x", 2.5, nan_policy="propagate").count() == 0
    g = df.withColumn("g", F.lit("a"))
    assert {r.id for r in flt.zscore_filter_by(g, "g", "x", 2.5).collect()} == {1, 2, 4}
