"""Named queries over the driver tables, each paired (where SQL can state
the result exactly) with an equivalent DuckDB query used as the oracle.

Every query reads whole tables of ``sf_dir``; nothing is sampled or capped
except where the limit is the feature (``preview_predictions``). Doubles
produced by aggregates are rounded to 6 places on both sides, because two
engines sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomrate.operators import aggregates as agg
from roomrate.operators import columns as cols
from roomrate.operators import comparables as comp
from roomrate.operators import evaluate as ev
from roomrate.operators import filters as flt
from roomrate.operators.cluster import (assign_nearest, collect_centres, kmeans_assign,
                                        kmeans_fit, label_centres)
from roomrate.operators.encode import (assemble, index_categorical, missing_counts, one_hot,
                                       one_hot_vector)
from roomrate.operators.joins import attach, null_safe_join, semi_join_keys
from roomrate.operators.overlay import overlay_prediction, overlay_scored
from roomrate.operators.regress import fit_group_mean, fit_per_group, predict_group_mean
from roomrate.operators.split import split, split_flag, union_tagged
from roomrate.plans.clustered import clustered_price_model, leak_free_cluster_model
from roomrate.plans.global_model import global_price_model
from roomrate.plans.prepare import prepare_listings
from roomrate.plans.tables import (ORDER_PRIORITIES, PRICED_ORDER_FEATURES, load,
                                   located_customers, priced_orders)
from roomrate.session import scratch_path
from roomrate.sources.delimited import corrupt_rows, read_delimited, read_inferred, write_delimited
from roomrate.sources.staging import stage

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the reference: seed 123, 70/30 split, z bound 2.5
# (3 for comparables), rare-category share 1/200, K = 7 (final) and 10
# (leak-free variant), GBT maxIter 20 (global) and 10 (per cluster),
# maxCategories 5.
SEED = 123
TRAIN_PCT = 70
Z_K = 2.5
Z_K_COMPARABLES = 3.0
RARE_SHARE = 1 / 200
K_FINAL = 7
K_LEAK_FREE = 10
ITER_GLOBAL = 20
ITER_GROUP = 10
MAX_CATEGORIES = 5

EVENT_COLS = ["event_id", "user_id", "event_type", "value"]
SEGMENT = "HOUSEHOLD"
ANCHOR_CUSTKEY = 0
# Error that every row of the planted price stays below (its range is 216).
MODEL_BOUND = 60.0


def _r6(c, name: str):
    return F.round(c if not isinstance(c, str) else F.col(c), 6).alias(name)


def _events(spark, d):
    return load(spark, d, "events")


def _orders(spark, d):
    return load(spark, d, "orders")


def _flagged_orders(spark, d):
    return split_flag(_orders(spark, d), "o_orderkey", TRAIN_PCT, SEED, "is_train")


def _group_mean_predictions(spark, d):
    """Test rows of orders scored by a group-mean model (mean total price
    per priority over the training rows): a deterministic predictor, so
    the metric operators can be checked exactly."""
    train, test = split(_orders(spark, d), "o_orderkey", TRAIN_PCT, SEED)
    means = fit_group_mean(train, "o_orderpriority", "o_totalprice")
    return predict_group_mean(test, means, "o_orderpriority") \
        .select("o_orderkey", "o_orderstatus",
                F.col("o_totalprice").alias("label"), "prediction")


# ---------------------------------------------------------------- filters
def q_zscore_filter_k25(spark, d):
    return flt.zscore_filter(_events(spark, d), "value", Z_K).select(*EVENT_COLS)


def q_zscore_filter_k3(spark, d):
    return flt.zscore_filter(_events(spark, d), "value", 3.0).select(*EVENT_COLS)


def q_zscore_filter_by_group(spark, d):
    return flt.zscore_filter_by(_events(spark, d), "event_type", "value", Z_K).select(*EVENT_COLS)


def q_frequency_filter(spark, d):
    return flt.frequency_filter(_events(spark, d), "user_id", RARE_SHARE).select(*EVENT_COLS)


def q_frequency_filter_mean(spark, d):
    e = _events(spark, d)
    return flt.frequency_filter(e, "user_id", mean_share(e, "user_id")).select(*EVENT_COLS)


def q_filter_in_set(spark, d):
    return flt.in_set(_orders(spark, d), "o_orderpriority", ["1-URGENT", "2-HIGH"]) \
        .select("o_orderkey", "o_orderpriority", "o_totalprice")


def q_select_group(spark, d):
    return flt.select_group(_orders(spark, d), "o_orderstatus", "F") \
        .select("o_orderkey", "o_orderstatus", "o_totalprice")


def q_drop_empty_groups(spark, d):
    """Orders of customers that have both training and test orders."""
    o = _flagged_orders(spark, d).select("o_orderkey", "o_custkey", "is_train")
    return flt.drop_empty_groups(o, "o_custkey", "is_train")


def q_trainable_groups(spark, d):
    return flt.trainable_groups(_flagged_orders(spark, d), "o_orderpriority", "is_train")


# ---------------------------------------------------------- aggregations
def q_price_moments(spark, d):
    m = agg.moments(_events(spark, d), "value", by="event_type")
    return m.select("event_type", "n", _r6("mean", "mean"), _r6("std_pop", "std_pop"))


def q_count_by(spark, d):
    return agg.count_by(_events(spark, d), "user_id", "n")


def q_annotate_count(spark, d):
    e = _events(spark, d).select("event_id", "user_id")
    return agg.annotate_count(e, "user_id", "n")


def q_row_count(spark, d):
    return agg.row_count(_events(spark, d), "n_rows")


def q_group_sizes(spark, d):
    return agg.group_sizes(_orders(spark, d), "o_orderstatus", "size")


def q_distinct_values(spark, d):
    return agg.distinct_values(_orders(spark, d), "o_orderpriority")


# ----------------------------------------------------------------- joins
def q_semi_join_keys(spark, d):
    li = load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    keys = (_orders(spark, d).filter(F.col("o_orderstatus") == "F")
            .select(F.col("o_orderkey").alias("l_orderkey")))
    return semi_join_keys(li, keys, "l_orderkey")


def q_join_attach_flag(spark, d):
    flags = _flagged_orders(spark, d).select(
        F.col("o_orderkey").cast("string").alias("listId"), "is_train")
    return attach(_orders(spark, d).select("o_orderkey", "o_totalprice"), flags,
                  "o_orderkey", "listId")


def _embedding_centres(spark, d):
    return collect_centres(label_centres(load(spark, d, "embeddings"), "embedding", "label"),
                           "label")


def q_assign_nearest(spark, d):
    e = load(spark, d, "embeddings")
    return assign_nearest(e, "embedding", _embedding_centres(spark, d)).select("vec_id", "cluster")


def q_join_attach_cluster(spark, d):
    e = load(spark, d, "embeddings")
    members = assign_nearest(e, "embedding", _embedding_centres(spark, d)).select(
        F.col("vec_id").alias("member_id"), "cluster")
    return attach(e.select("vec_id", "label"), members, "vec_id", "member_id")


# ------------------------------------------------------ columns and types
def q_project_subset(spark, d):
    return cols.select_columns(_orders(spark, d), ["o_orderkey", "o_custkey", "o_totalprice"])


def q_rename_columns(spark, d):
    o = _orders(spark, d).select("o_orderkey", "o_orderstatus", "o_totalprice")
    return cols.rename_columns(o, {"o_orderkey": "order_id", "o_totalprice": "price"})


def q_drop_columns(spark, d):
    return cols.drop_columns(_orders(spark, d), ["o_orderdate", "o_orderpriority"])


def q_move_last(spark, d):
    o = _orders(spark, d).drop("o_orderdate")
    return cols.move_last(o, "o_totalprice", "price")


def q_flag_when(spark, d):
    o = _orders(spark, d).select("o_orderkey", "o_orderpriority")
    return cols.flag_when(o, F.col("o_orderpriority") == "1-URGENT", "is_urgent") \
        .select("o_orderkey", "is_urgent")


def _damaged_text(spark, d):
    """Text versions of numbers, damaged by a fixed rule on the key:
    clean, padded with blanks, a decimal where an int is expected, a
    currency sign, empty."""
    e = _events(spark, d)
    u, v = F.col("user_id").cast("string"), F.col("value").cast("string")
    r = F.col("event_id") % 5
    t_int = (F.when(r == 0, u).when(r == 1, F.concat(F.lit(" "), u, F.lit(" ")))
             .when(r == 2, v).when(r == 3, F.concat(F.lit("$"), u)).otherwise(F.lit("")))
    t_dbl = (F.when(r == 0, v).when(r == 1, F.concat(F.lit(" "), v, F.lit(" ")))
             .when(r == 2, u).when(r == 3, F.concat(F.lit("$"), v)).otherwise(F.lit("n/a")))
    return e.select("event_id", t_int.alias("a_int"), t_dbl.alias("b_dbl"))


def q_bulk_cast(spark, d):
    return cols.bulk_cast(_damaged_text(spark, d), {"int": ["a_int"], "double": ["b_dbl"]})


# ----------------------------------------------------- encode and vectors
def q_one_hot_single(spark, d):
    o = _orders(spark, d).select("o_orderkey", "o_orderpriority")
    return one_hot(o, ["o_orderpriority"])


def q_one_hot_multi(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber",
                                           "l_returnflag", "l_linestatus")
    return one_hot(li, ["l_returnflag", "l_linestatus"])


def q_index_categorical(spark, d):
    li = load(spark, d, "lineitem").select("l_linenumber", "l_quantity", "l_discount",
                                           "l_tax", "l_returnflag", "l_linestatus")
    wide = one_hot(li, ["l_returnflag", "l_linestatus"])
    return index_categorical(wide, wide.columns, MAX_CATEGORIES)


def q_one_hot_vector(spark, d):
    """E1, feature path: StringIndexer (alphabetical) + OneHotEncoder with
    no dropped level, shown as one column per vector slot."""
    o = _orders(spark, d).select("o_orderkey", "o_orderpriority")
    enc = Pipeline(stages=one_hot_vector(["o_orderpriority"])).fit(o).transform(o)
    arr = vector_to_array(F.col("o_orderpriority_vec"))
    return enc.select("o_orderkey", *[arr[i].alias(f"o_orderpriority_vec_{i}")
                                      for i in range(len(ORDER_PRIORITIES))])


def q_assemble_features(spark, d):
    o = _orders(spark, d).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    o = one_hot(o, ["o_orderpriority"], vocab={"o_orderpriority": ORDER_PRIORITIES})
    a = assemble(o, ["o_custkey", "o_totalprice", "o_orderpriority_1_URGENT"],
                 keep=["o_orderkey"])
    arr = vector_to_array(F.col("features"))
    return a.select("o_orderkey", *[arr[i].alias(f"f{i}") for i in range(3)])


# -------------------------------------------------------- split and union
def q_split_train(spark, d):
    train, _ = split(_orders(spark, d), "o_orderkey", TRAIN_PCT, SEED)
    return train.select("o_orderkey", "o_totalprice")


def q_split_test(spark, d):
    _, test = split(_orders(spark, d), "o_orderkey", TRAIN_PCT, SEED)
    return test.select("o_orderkey", "o_totalprice")


def q_split_counts(spark, d):
    return agg.count_by(_flagged_orders(spark, d), "is_train", "n")


def q_split_union(spark, d):
    train, test = split(_orders(spark, d).select("o_orderkey"), "o_orderkey", TRAIN_PCT, SEED)
    return union_tagged(train, test, "is_train")


def q_overlay_prediction(spark, d):
    o = _flagged_orders(spark, d).select("o_orderkey", "o_orderpriority", "o_totalprice",
                                         "is_train")
    means = fit_group_mean(o.filter(F.col("is_train") == 1), "o_orderpriority", "o_totalprice")
    preds = predict_group_mean(o.filter(F.col("is_train") == 0), means, "o_orderpriority") \
        .select("o_orderkey", "prediction")
    out = overlay_prediction(o, preds, "o_orderkey", "is_train", "o_totalprice")
    return out.select("o_orderkey", "is_train", _r6("o_totalprice", "price"))


def q_overlay_prediction_nulls(spark, d):
    """J4 with a null key and keys of several predictions: rows of five orders
    in seven keep their key, the rest share the null key; the predictions of a
    key (two for every third order, one of them null for every ninth) count by
    their mean."""
    o = _flagged_orders(spark, d).withColumn(
        "k", F.when(F.col("o_orderkey") % 7 < 5, F.col("o_orderkey") % 1000))
    own = o.filter(F.col("is_train") == 0).select("k", "o_orderkey", F.col("o_totalprice").alias("prediction"))
    again = own.filter(F.col("o_orderkey") % 3 == 0).withColumn(
        "prediction", F.when(F.col("o_orderkey") % 9 != 0, F.col("prediction") + 100))
    out = overlay_prediction(o.select("o_orderkey", "k", "is_train", "o_totalprice"),
                             own.unionByName(again), "k", "is_train", "o_totalprice", repeated="mean")
    return out.select("o_orderkey", "k", "is_train", F.round("o_totalprice", 4).alias("price"))


# ------------------------------------------------------------- evaluation
def q_mape(spark, d):
    m = ev.mape(_group_mean_predictions(spark, d))
    return m.select("n", _r6("mape", "mape"))


def q_rmse(spark, d):
    m = ev.rmse(_group_mean_predictions(spark, d))
    return m.select("n", _r6("rmse", "rmse"))


def q_mape_by_group(spark, d):
    m = ev.mape(_group_mean_predictions(spark, d), by="o_orderstatus")
    return m.select("o_orderstatus", "n", _r6("mape", "mape"))


def q_rmse_by_group(spark, d):
    m = ev.rmse(_group_mean_predictions(spark, d), by="o_orderstatus")
    return m.select("o_orderstatus", "n", _r6("rmse", "rmse"))


def _group_metrics(spark, d):
    return ev.error_metrics(_group_mean_predictions(spark, d), by="o_orderstatus")


def q_best_group(spark, d):
    b = ev.best_group(_group_metrics(spark, d), "o_orderstatus", "mape")
    return b.select("o_orderstatus", "n", _r6("mape", "mape"), _r6("rmse", "rmse"))


def q_metric_summary(spark, d):
    s = ev.metric_summary(_group_metrics(spark, d), "n")
    return s.select("n_groups", "total_size",
                    *[_r6(c, c) for c in ("best_rmse", "mean_rmse", "best_mape", "mean_mape",
                                          "pooled_rmse", "weighted_mape")])


def q_preview_predictions(spark, d):
    p = ev.preview(_group_mean_predictions(spark, d), ["o_orderkey", "label", "prediction"],
                   "o_orderkey", 20)
    return p.select("o_orderkey", "label", _r6("prediction", "prediction"))


# ------------------------------------------------------------ comparables
def _comparables(spark, d):
    c = located_customers(spark, d)
    kept = flt.zscore_filter(c, "price", Z_K_COMPARABLES)
    return c, flt.comparables(kept, {"c_mktsegment": SEGMENT}, {"price": 0})


def q_comparables_filter(spark, d):
    _, rows = _comparables(spark, d)
    return rows.select("c_custkey", "c_nationkey", "price")


def q_distance_from_anchor(spark, d):
    c = located_customers(spark, d)
    out = comp.distance_from_anchor(c, "c_custkey", ANCHOR_CUSTKEY)
    return out.select("c_custkey", _r6("distance_km", "distance_km"))


def q_comparables_ranked(spark, d):
    c, rows = _comparables(spark, d)
    rows = comp.distance_from_anchor(rows, "c_custkey", ANCHOR_CUSTKEY, anchors=c)
    return comp.rank_by(rows, "price", "c_custkey").select(
        "c_custkey", "price", _r6("distance_km", "distance_km"))


def q_comparables_summary(spark, d):
    _, rows = _comparables(spark, d)
    s = agg.spread_summary(rows, "price")
    return s.select("n", _r6("std_samp", "std_samp"), _r6("range", "range"))


def q_comparables_report(spark, d):
    c = located_customers(spark, d)
    ranked, summary = comp.comparables_report(c, "c_custkey", ANCHOR_CUSTKEY,
                                              {"c_mktsegment": SEGMENT}, {"price": 0},
                                              "price", Z_K_COMPARABLES)
    footer = [summary.select(x).scalar() for x in ("n", "std_samp", "range")]
    return ranked.select("c_custkey", "price", _r6("distance_km", "distance_km"),
                         footer[0].alias("n_comparables"),
                         _r6(footer[1], "price_std"), _r6(footer[2], "price_range"))


# ------------------------------------------------------- composed plans
def mean_share(df: DataFrame, col: str) -> float:
    """The share of an average value of ``col``: a rarity bound under which
    some values stay and some go at every scale."""
    return 1 / max(2, df.select(F.count_distinct(col)).first()[0])


def q_prepare_listings(spark, d):
    """PL1 in full: rare users dropped, two categories encoded with the
    vocabulary of the data, text cast, price outliers dropped, staged. Null
    categories are kept."""
    e = _events(spark, d)
    dated = e.select("event_id", "user_id", "event_type", F.date_format("ts", "EEE").alias("day"),
                     F.col("user_id").cast("string").alias("user_text"),
                     F.concat(F.lit(" "), F.col("value").cast("string")).alias("value_text"),
                     "value")
    return prepare_listings(dated, "user_id", ["event_type", "day"], "value", mean_share(e, "user_id"),
                            Z_K, int_cols=["user_text"], double_cols=["value_text"],
                            out_path=scratch_path(spark, "prepared"))


# -------------------------------------- nulls by a fixed rule over the key
def _events_with_nulls(spark, d):
    return _events(spark, d).select(
        "event_id", F.when(F.col("event_id") % 4 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("event_type"), "value")


def q_annotate_count_nulls(spark, d):
    return agg.annotate_count(_events_with_nulls(spark, d).select("event_id", "user_id"), "user_id", "n")


def q_frequency_filter_nulls(spark, d):
    e = _events_with_nulls(spark, d)
    return flt.frequency_filter(e, "user_id", mean_share(e, "user_id")).select(*EVENT_COLS)


def q_zscore_by_group_nulls(spark, d):
    return flt.zscore_filter_by(_events_with_nulls(spark, d), "event_type", "value", Z_K).select(*EVENT_COLS)


def q_drop_empty_groups_nulls(spark, d):
    o = _flagged_orders(spark, d).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("o_custkey"), "is_train")
    return flt.drop_empty_groups(o, "o_custkey", "is_train")


def _is_nearest(km, assigned, features: str = "_features"):
    """Whether each row's cluster is the nearest of the model's centres,
    computed apart from the model."""
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(km.stages[-1].clusterCenters())]
    out = assigned
    for st in km.stages[:-1]:
        out = st.transform(out)
    again = assign_nearest(out.withColumn("_x", vector_to_array(features)), "_x", centres, "_nearest",
                           method="sql")
    return again.withColumn("is_nearest", F.col("_nearest") == F.col("cluster"))


def q_assign_all_rows(spark, d):
    """M2 on features with nulls: every row has a cluster, and the nearest one."""
    o = priced_orders(spark, d).withColumn(
        "cust_band", F.when(F.col("o_orderkey") % 5 != 0, F.col("cust_band")))
    km = kmeans_fit(o, ["cust_band", "price"], K_FINAL, SEED, key="o_orderkey")
    out = _is_nearest(km, kmeans_assign(km, o))
    return out.select("o_orderkey", F.col("cluster").between(0, K_FINAL - 1).alias("has_cluster"), "is_nearest")


def q_missing_counts(spark, d):
    o = priced_orders(spark, d).withColumn(
        "cust_band", F.when(F.col("o_orderkey") % 5 != 0, F.col("cust_band")))
    return missing_counts(o, ["cust_band", "o_totalprice"])


ORDERS_TEXT_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderpriority", T.StringType())])


def q_delimited_roundtrip(spark, d):
    """S3 then S1: the whole orders table written as CSV (in parallel, into
    the shared checkpoint folder) and read back with a declared schema."""
    path = scratch_path(spark, "orders-csv")
    write_delimited(_orders(spark, d).select(*ORDERS_TEXT_SCHEMA.fieldNames()), path)
    return read_delimited(spark, path, ORDERS_TEXT_SCHEMA)


def q_stage_roundtrip(spark, d):
    o = _orders(spark, d).select("o_orderkey", "o_orderstatus", "o_totalprice")
    return stage(o, "orders", partition_by="o_orderstatus")


def q_stage_values(spark, d):
    """S4 keeps the values of its partition column: leading zeros, empty
    strings and nulls, by a fixed rule over the key."""
    k = F.col("o_orderkey") % 4
    code = F.when(k == 0, "007").when(k == 1, "").when(k == 2, F.col("o_orderstatus"))
    return stage(_orders(spark, d).select("o_orderkey", code.alias("code")), "coded", partition_by="code")


def _damaged_file(spark, d):
    """Orders as CSV lines; each seventh has a field too many."""
    o = _orders(spark, d)
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority")
    line = F.when(F.col("o_orderkey") % 7 == 0, F.concat(line, F.lit(",x"))).otherwise(line)
    path = scratch_path(spark, "damaged-csv")
    o.select(line.alias("value")).write.text(path)
    return path


DAMAGED_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()),
                               T.StructField("o_orderstatus", T.StringType()),
                               T.StructField("o_orderpriority", T.StringType())])


def q_corrupt_rows(spark, d):
    return corrupt_rows(spark, _damaged_file(spark, d), DAMAGED_SCHEMA, header=False)


def q_read_without_corrupt(spark, d):
    return read_delimited(spark, _damaged_file(spark, d), DAMAGED_SCHEMA, header=False)


def q_read_inferred(spark, d):
    """Names and types found in the file."""
    path = scratch_path(spark, "inferred-csv")
    write_delimited(_orders(spark, d).select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    r = read_inferred(spark, path)
    return r.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderstatus", "o_totalprice")


def q_comparables_by_nation(spark, d):
    """Comparables with every kind of predicate, summarised per nation."""
    c = located_customers(spark, d)
    kept = flt.zscore_filter(c, "price", Z_K_COMPARABLES)
    rows = flt.comparables(kept, {"c_mktsegment": SEGMENT}, {"price": 0, "c_nationkey": 4})
    s = agg.spread_summary(rows, "price", by="c_nationkey")
    return s.select("c_nationkey", "n", _r6("std_samp", "std_samp"), _r6("range", "range"))


def q_comparables_place(spark, d):
    """One place and kind: segment and nation equal, price above 0; ranked."""
    c = located_customers(spark, d)
    kept = flt.zscore_filter(c, "price", Z_K_COMPARABLES)
    rows = flt.comparables(kept, {"c_mktsegment": SEGMENT, "c_nationkey": 3}, {"price": 0})
    return comp.rank_by(rows, "price", "c_custkey").select("c_custkey", "c_nationkey", "price")


def q_pipeline_overlay(spark, d):
    """PL4 with a predictor SQL can state: test rows take the training mean of
    their priority, rows go to the nearest status centre of the overlaid price,
    and per cluster a mean model is trained and scored on real prices."""
    o = _flagged_orders(spark, d).select("o_orderkey", "o_orderstatus", "o_orderpriority",
                                         F.col("o_totalprice").alias("seen"),
                                         F.col("o_totalprice").alias("price"), "is_train")
    train, test = (o.filter(F.col("is_train") == x) for x in (1, 0))
    first = fit_group_mean(train, "o_orderpriority", "price")
    overlaid = overlay_scored(train, predict_group_mean(test, first, "o_orderpriority"), "seen")
    overlaid = stage(overlaid.withColumn("vec", F.array(F.round("seen", 6))), "overlaid-orders")
    statuses = overlaid.withColumn("label", F.ascii("o_orderstatus"))
    centres = collect_centres(label_centres(statuses, "vec", "label"), "label")
    members = assign_nearest(overlaid, "vec", [(i, [round(x, 6) for x in c]) for i, c in centres],
                             "cluster", method="sql")
    by = ["cluster", "o_orderpriority"]
    means = (members.filter(F.col("is_train") == 1).groupBy(*by)
             .agg(F.avg("price").alias("prediction")))
    scored = null_safe_join(members.filter(F.col("is_train") == 0), means, by, "left")
    m = ev.error_metrics(scored, "price", "prediction", by="cluster")
    return m.select("cluster", "n", _r6("mape", "mape"), _r6("rmse", "rmse"))


# ------------------------------------------------------------ model plans
# A model's numbers have no SQL; these queries return, for every row, facts
# about it that hold for any right result and that SQL can state.
def q_kmeans_sizes(spark, d):
    e = load(spark, d, "embeddings").withColumn("emb", array_to_vector("embedding"))
    km = kmeans_fit(e, ["emb"], K_LEAK_FREE, SEED, key="vec_id")
    out = kmeans_assign(km, e)
    total = agg.group_sizes(out, "cluster", "size").select(F.sum("size")).scalar()
    return _is_nearest(km, out).select("vec_id", "is_nearest", total.alias("total_size"))


def _model_input(spark, d):
    """Priced orders with a missing feature in each ninth row."""
    return priced_orders(spark, d).withColumn(
        "cust_band", F.when(F.col("o_orderkey") % 9 != 0, F.col("cust_band")))


def q_gbt_predict(spark, d):
    """Every test row is scored, also with a missing feature; where nothing is
    missing the error is below two steps of the planted noise and rest
    (``MODEL_BOUND``)."""
    preds, _, _ = global_price_model(_model_input(spark, d), "o_orderkey",
                                     PRICED_ORDER_FEATURES, "price", ITER_GLOBAL,
                                     MAX_CATEGORIES, TRAIN_PCT, SEED)
    close = F.abs(F.col("price") - F.col("prediction")) < MODEL_BOUND
    return preds.select("o_orderkey", "price", F.col("prediction").isNotNull().alias("is_scored"),
                        (close | (F.col("o_orderkey") % 9 == 0)).alias("is_close"))


def _agrees(a: str, b: str):
    return F.abs(F.col(a) - F.col(b)) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(F.col(a)))


def _recomputed(preds, by: list[str]):
    """RMSE and MAPE in plain expressions, apart from ``error_metrics``."""
    e = F.col("price") - F.col("prediction")
    return preds.groupBy(*by).agg(F.sqrt(F.sum(e * e) / F.count(e)).alias("_rmse"),
                                  (F.sum(F.abs(e) / F.col("prediction")) / F.count(e)).alias("_mape"),
                                  F.stddev_pop("price").alias("_spread"))


def q_global_price_model(spark, d):
    preds, metrics, _ = global_price_model(priced_orders(spark, d), "o_orderkey",
                                           PRICED_ORDER_FEATURES, "price", ITER_GROUP,
                                           MAX_CATEGORIES, TRAIN_PCT, SEED)
    preds = stage(preds, "global-predictions")
    m = ev.error_metrics(preds, "price", "prediction").crossJoin(F.broadcast(_recomputed(preds, [])))
    return m.select("n", (_agrees("rmse", "_rmse") & _agrees("mape", "_mape")).alias("metrics_agree"),
                    (F.col("rmse") < 0.3 * F.col("_spread")).alias("explains_price"))


def q_per_group_metrics(spark, d):
    o = split_flag(priced_orders(spark, d), "o_orderkey", TRAIN_PCT, SEED, "is_train")
    staged = stage(o, "orders_by_status", partition_by="o_orderstatus")
    preds, _, _ = fit_per_group(staged, "o_orderstatus", PRICED_ORDER_FEATURES, "price",
                                "o_orderkey", "is_train", ITER_GROUP, MAX_CATEGORIES, SEED)
    preds = stage(preds, "group-predictions")
    m = null_safe_join(ev.error_metrics(preds, "price", "prediction", by="o_orderstatus"),
                       _recomputed(preds, ["o_orderstatus"]), "o_orderstatus")
    return m.select("o_orderstatus", "n",
                    (_agrees("rmse", "_rmse") & _agrees("mape", "_mape")).alias("metrics_agree"),
                    (F.col("rmse") < 0.5 * F.col("_spread")).alias("explains_price"))


def _every_row(res, flagged, price_in_z: bool, k: int):
    """Per row of ``flagged`` (all rows, with their clusters): is it clustered
    as the price test of its cluster says, and scored if and only if it is a
    test row of a trainable cluster?"""
    own = F.col("cluster")
    stats = flagged.groupBy("cluster").agg(F.avg("price").alias("_m"), F.stddev_pop("price").alias("_s"))
    halves = res.clustered.groupBy("cluster").agg(
        (F.min("is_train") != F.max("is_train")).alias("_both"))
    kept = res.clustered.select("o_orderkey", F.lit(True).alias("_kept"))
    preds = res.predictions.select("o_orderkey", F.col("price").alias("_label"), F.lit(True).alias("_scored"))
    j = (flagged.join(F.broadcast(stats), "cluster").join(F.broadcast(halves), "cluster", "left")
         .join(kept, "o_orderkey", "left").join(preds, "o_orderkey", "left").fillna(False, ["_kept", "_scored", "_both"]))
    inside = F.coalesce(F.abs((F.col("price") - F.col("_m")) / F.nullif("_s", F.lit(0.0))) < Z_K, F.lit(False)) \
        if price_in_z else F.lit(True)
    return j.select("o_orderkey", "is_train", own.between(0, k - 1).alias("has_cluster"),
                    (F.col("_kept") == inside).alias("kept_as_stated"),
                    (F.col("_scored") == (F.col("_kept") & F.col("_both") & (F.col("is_train") == 0)))
                    .alias("scored_as_stated"),
                    F.coalesce(F.col("_label") == F.col("price"), F.lit(True)).alias("real_label"))


def _clustered(spark, d):
    o = priced_orders(spark, d)
    return o, clustered_price_model(o, "o_orderkey", PRICED_ORDER_FEATURES, PRICED_ORDER_FEATURES,
                                    "price", K_FINAL, SEED, max_iter=ITER_GROUP, z_k=Z_K)


def q_clustered_price_model(spark, d):
    o, res = _clustered(spark, d)
    flagged = split_flag(kmeans_assign(res.kmeans, o), "o_orderkey", TRAIN_PCT, SEED, "is_train")
    return _every_row(res, flagged, price_in_z=True, k=K_FINAL)


def q_clustered_price_summary(spark, d):
    """Best cluster and summary of PL3, against the predictions themselves."""
    _, res = _clustered(spark, d)
    preds = res.predictions
    over_all, best = _recomputed(preds, []), _recomputed(preds, ["cluster"])
    first = best.orderBy("_mape", "cluster").limit(1).select(
        F.col("cluster").alias("_best"), F.col("_rmse").alias("_best_rmse"), F.col("_mape").alias("_best_mape"))
    one = (res.summary.crossJoin(F.broadcast(over_all)).crossJoin(F.broadcast(first))
           .crossJoin(F.broadcast(res.best.select("cluster", F.col("rmse").alias("_of_best")))))
    rows = res.clustered.select(F.count(F.lit(1))).scalar()
    return one.select(_agrees("pooled_rmse", "_rmse").alias("rmse_of_the_union"),
                      _agrees("weighted_mape", "_mape").alias("mape_of_the_union"),
                      ((F.col("cluster") == F.col("_best")) & _agrees("best_mape", "_best_mape")
                       & _agrees("_of_best", "_best_rmse")).alias("best_is_lowest"),
                      (F.col("total_size") == rows).alias("sizes_add_up"))


def q_leak_free_cluster_model(spark, d):
    o = priced_orders(spark, d)
    res = leak_free_cluster_model(o, "o_orderkey", PRICED_ORDER_FEATURES, "price", K_LEAK_FREE, SEED,
                                  max_iter=ITER_GROUP)
    flagged = res.clustered.select("o_orderkey", "is_train", "cluster").join(
        o.select("o_orderkey", "price"), "o_orderkey", "right")
    return _every_row(res, flagged, price_in_z=False, k=K_LEAK_FREE)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
