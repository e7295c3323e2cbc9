"""Regression (M4, M5, C4) plus a group-mean predictor.

GBT is MLlib's ``GBTRegressor`` (squared loss), preceded by a
``VectorIndexer`` fitted on the training rows only (the reference fitted it
on train + test). Per-group models: one MLlib fit per group, each a
distributed Spark job over that group's rows only - a hot group is spread
over the cluster like any other table, never collected into one task.
The fits are launched from a small driver thread pool so the cluster runs
several at once; their predictions are unioned and scored in one
aggregate.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.operators.encode import categorical_indexer, drop_feature_columns, feature_stages
from roomrate.operators.evaluate import error_metrics
from roomrate.operators.joins import join_small
from roomrate.operators.layout import lay_out
from roomrate.session import checkpoint_root

MAX_CONCURRENT_FITS = 16


def gbt_pipeline(df: DataFrame, inputs: list[str], label: str, max_iter: int = 20,
                 max_categories: int = 5, seed: int = 123,
                 missing: str = "impute", **gbt_params) -> Pipeline:
    return Pipeline(stages=[
        *feature_stages(df, inputs, "features", missing),
        categorical_indexer(max_categories, "features", "indexedFeatures"),
        GBTRegressor(featuresCol="indexedFeatures", labelCol=label, maxIter=max_iter,
                     seed=seed, **gbt_params),
    ])


def gbt_fit(train: DataFrame, inputs: list[str], label: str, max_iter: int = 20,
            max_categories: int = 5, seed: int = 123, key: str | None = None,
            partitions: int | None = None, missing: str = "impute",
            **gbt_params) -> PipelineModel:
    """M4. Rows without a label cannot train and are left out; missing
    inputs are treated as ``missing`` says (see ``encode.feature_stages``), in
    the fit and whenever the model scores. With ``key``, the training rows are
    first put in the layout of ``layout.lay_out``: MLlib's split-candidate
    sample is drawn per partition, so this makes the model independent of the
    input's file layout, and it spreads a training set that arrived in few
    partitions over all cores. The laid-out rows are persisted for the
    duration of the fit (the indexer pass and the boosting passes then share
    one shuffle) and released afterwards."""
    # MLlib checkpoints the boosting state every ``checkpointInterval``
    # trees into the SparkContext checkpoint folder: make sure it is the
    # shared one, so a lost executor does not cost the whole lineage
    checkpoint_root(train.sparkSession)
    # only what the fit reads is shuffled and cached
    t = train.filter(F.col(label).isNotNull()).select(
        *([key] if key is not None else []), *[c for c in inputs if c != key],
        F.col(label).cast("double").alias(label))
    pipe = gbt_pipeline(t, inputs, label, max_iter, max_categories, seed, missing, **gbt_params)
    if key is not None:
        t = lay_out(t, key, partitions)
    t = t.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipe.fit(t)
    finally:
        t.unpersist()


def predict(model: PipelineModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """M5: append ``prediction`` (and drop the intermediate vectors)."""
    out = drop_feature_columns(model.transform(df), "features", "indexedFeatures")
    return out.select(*keep, "prediction") if keep else out


def fit_per_group(df: DataFrame, group: str, inputs: list[str], label: str, key: str,
                  flag: str, max_iter: int = 10, max_categories: int = 5,
                  seed: int = 123, parallelism: int | None = None,
                  max_groups: int | None = None, missing: str = "impute"):
    """C4: one model per group, trained on its ``flag`` = 1 rows and scored
    on its ``flag`` = 0 rows. Groups lacking either half are skipped; the null
    group is one like any other. ``max_groups``, if given, makes more groups
    an error (each is a model that the driver keeps).

    ``df`` should be staged partitioned by ``group`` (see
    ``sources.stage``) so each fit reads only its own folder.
    Returns ``(predictions, metrics, models)``; ``predictions`` holds
    (key, group, label, prediction) for every scored test row and
    ``metrics`` one row per group (group, n, mape, rmse).
    """
    from roomrate.operators.filters import trainable_groups

    groups = [r[0] for r in trainable_groups(df, group, flag).select(group).orderBy(group).collect()]
    if max_groups is not None and len(groups) > max_groups:
        raise ValueError(f"more than {max_groups} groups to fit")
    # default: every group's fit at once (each is a small distributed job;
    # running them together keeps the cluster's slots busy)
    workers = max(1, min(parallelism or MAX_CONCURRENT_FITS, len(groups) or 1))

    def fit_one(g):
        part = df.filter(F.col(group).eqNullSafe(F.lit(g)))
        # each fit is laid out by its own bytes: a cluster holding a third of
        # the data gets a third-of-the-data's worth of tasks, small ones few
        train = part.filter(F.col(flag) == 1)
        model = gbt_fit(train, inputs, label, max_iter, max_categories, seed, key=key, missing=missing)
        scored = predict(model, part.filter(F.col(flag) == 0),
                         keep=[key, group, F.col(label).cast("double").alias(label)])
        return g, model, scored

    with ThreadPoolExecutor(max_workers=workers) as pool:
        results = list(pool.map(inheritable_thread_target(df.sparkSession)(fit_one), groups))
    models = {g: m for g, m, _ in results}
    if results:
        preds = results[0][2]
        for _, _, p in results[1:]:
            preds = preds.unionByName(p)
    else:
        spark = df.sparkSession
        preds = spark.createDataFrame([], f"{key} {dict(df.dtypes)[key]}, "
                                          f"{group} {dict(df.dtypes)[group]}, "
                                          f"{label} double, prediction double")
    metrics = error_metrics(preds, label, "prediction", by=group)
    return preds, metrics, models


def fit_group_mean(train: DataFrame, group: str, target: str,
                   name: str = "prediction") -> DataFrame:
    """A deterministic baseline model: mean ``target`` per group over the
    training rows (one row per group)."""
    return train.groupBy(group).agg(F.avg(F.col(target).cast("double")).alias(name))


def predict_group_mean(df: DataFrame, means: DataFrame, group: str,
                       max_groups: int | None = None) -> DataFrame:
    """Attach the group mean as ``prediction``; rows of a group unseen in
    training get null (the null group is a group like any other)."""
    return join_small(df, means, group, "left", bound=max_groups)
