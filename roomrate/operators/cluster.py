"""K-means and nearest-centre assignment (M2, M3).

K-means is MLlib's (k-means|| init, distributed Lloyd iterations, one
tree-aggregate per iteration). Its result depends on how rows are laid out
across partitions even with a fixed seed, so the input is first put in a
layout that depends only on the data (see ``layout``).

``assign_nearest`` is the predict half on its own: the centres (K rows, a
fitted model, size-checked) travel with the task, never as a cross join of
rows with centres. Two forms give the same ids: built-in array functions
(``method='sql'``) and a numpy pass per Arrow batch (``method='arrow'``,
the default, ~9x faster because the array lambdas of the built-in form
run outside whole-stage codegen).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomrate.operators.encode import drop_feature_columns, feature_stages
from roomrate.operators.layout import lay_out

MAX_CENTRES = 10_000


def kmeans_fit(df: DataFrame, inputs: list[str], k: int = 7, seed: int = 123,
               key: str | None = None, partitions: int | None = None,
               max_iter: int = 20, scale: bool = False,
               cluster_col: str = "cluster", missing: str = "impute") -> PipelineModel:
    """M2 fit: assemble ``inputs`` by name (missing values as ``missing``
    says, see ``encode.feature_stages``), optionally standardise (the reference clustered unscaled mixed units;
    ``scale=False`` keeps that), then K-means. With ``key`` the rows are
    first laid out by key (see the module docstring); either way only the
    key and inputs are kept, persisted for the fit and released after."""
    if key is not None:
        # shuffle only the key and the inputs (the layout is for the fit;
        # ``kmeans_assign`` then runs on the full rows where they are)
        df = lay_out(df.select(*dict.fromkeys([key, *inputs])), key, partitions)
    else:
        df = df.select(*inputs)
    # K-means makes ~20 passes: materialise its input once for the fit, so
    # no pass replays the lineage above it (upstream models, subqueries)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    stages = feature_stages(df, inputs, "_features", missing)
    feat = "_features"
    if scale:
        stages.append(StandardScaler(inputCol=feat, outputCol="_scaled", withMean=True, withStd=True))
        feat = "_scaled"
    stages.append(KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=feat,
                         predictionCol=cluster_col))
    try:
        return Pipeline(stages=stages).fit(df)
    finally:
        df.unpersist()


def kmeans_assign(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M2 transform: every input column plus the cluster id. Because the row
    key travels through ``transform`` there is nothing to join back."""
    out = model.transform(df)
    return drop_feature_columns(out, "_features", "_scaled")


def label_centres(df: DataFrame, vec_col: str, label: str) -> DataFrame:
    """Mean vector per label (partial-aggregated; one row per label)."""
    return (df.select(label, array_to_vector(F.col(vec_col)).alias("_v"))
            .groupBy(label).agg(Summarizer.mean(F.col("_v")).alias("centre")))


def collect_centres(centres: DataFrame, label: str, max_centres: int = MAX_CENTRES):
    rows = centres.orderBy(label).limit(max_centres + 1).collect()
    if len(rows) > max_centres:
        raise ValueError(f"more than {max_centres} centres")
    return [(r[label], [float(x) for x in r["centre"]]) for r in rows]


def nearest_centre(vec: Column, centres: list[tuple[int, list[float]]],
                   decimals: int = 9) -> Column:
    """Id of the nearest centre by squared Euclidean distance; ties go to
    the lowest id (distances rounded to ``decimals`` first, so engines that
    sum in a different order agree)."""
    x = vec.cast("array<double>")
    cands = []
    for cid, c in centres:
        carr = F.array(*[F.lit(float(v)) for v in c])
        dd = F.aggregate(F.zip_with(x, carr, lambda a, b: (a - b) * (a - b)),
                         F.lit(0.0), lambda acc, v: acc + v)
        cands.append(F.struct(F.round(dd, decimals).alias("d"), F.lit(cid).alias("id")))
    return F.array_min(F.array(*cands))["id"]


def nearest_centre_arrow(spark: SparkSession, vec: Column, centres: list[tuple[int, list[float]]],
                         decimals: int = 9) -> Column:
    """Same result as ``nearest_centre``, computed per Arrow batch with numpy.

    The built-in form evaluates its array lambdas row by row outside
    whole-stage codegen; here a batch of rows becomes one matrix and each
    centre costs one vectorised pass (memory: batch x dim, whatever K is).
    Measured on 400k rows x 64 dims, K = 10, local[8]: 0.9 s against 8.8 s.
    Centres are visited in id order and only a strictly smaller rounded
    distance wins, so ties go to the lowest id as in the built-in form.
    """
    ids = np.array([cid for cid, _ in centres])
    out_type = "int" if ids.size == 0 or np.abs(ids).max() < 2**31 else "bigint"
    # the centre matrix travels once per executor as a broadcast, not inside
    # every task's closure (K x dim doubles can be megabytes)
    centres_bc = spark.sparkContext.broadcast(
        np.array([c for _, c in centres], dtype=np.float64))

    @F.pandas_udf(out_type)
    def _nearest(batch: pd.Series) -> pd.Series:
        mat = centres_bc.value
        present = batch.notna().to_numpy()
        result = pd.Series(pd.NA, index=batch.index,
                           dtype="Int32" if out_type == "int" else "Int64")
        if present.any():
            x = np.stack(batch[present].to_numpy()).astype(np.float64)
            best_d = np.full(len(x), np.inf)
            best_j = np.zeros(len(x), dtype=np.int64)
            for j in range(len(mat)):
                d = np.round(((x - mat[j]) ** 2).sum(axis=1), decimals)
                closer = d < best_d
                best_d[closer] = d[closer]
                best_j[closer] = j
            result[present] = ids[best_j]
        return result

    return _nearest(vec)


def assign_nearest(df: DataFrame, vec_col: str, centres: list[tuple[int, list[float]]],
                   name: str = "cluster", method: str = "arrow") -> DataFrame:
    """M3: nearest centre for every row, as a column. ``method='arrow'``
    (numpy per Arrow batch, the fast path) or ``'sql'`` (built-in array
    functions only)."""
    centres = sorted(centres, key=lambda t: t[0])
    if method == "arrow":
        return df.withColumn(name, nearest_centre_arrow(df.sparkSession, F.col(vec_col), centres))
    if method == "sql":
        return df.withColumn(name, nearest_centre(F.col(vec_col), centres))
    raise ValueError("method must be 'arrow' or 'sql'")
