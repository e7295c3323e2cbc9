"""PL3 clustered_price_model and PL4 leak_free_cluster_model.

Shape of both plans at scale:

1. K-means fit (MLlib; the input is laid out by key first so the result
   does not depend on the file layout).
2. One pass assigns clusters (``transform`` keeps the key - no join back)
   and applies the per-cluster price filter (per-cluster moments: K rows,
   broadcast) and the keyed split flag.
3. That result is written once, partitioned by cluster, into the shared
   checkpoint folder: lineage is cut there (a lost executor re-reads files
   instead of re-running K-means) and each cluster's fit reads only its
   own folder.
4. One GBT per cluster, several at once from a small thread pool; each is
   a distributed MLlib job over that cluster's rows.
5. The unioned predictions are written once; metrics for all clusters are one
   aggregate over them, and whoever reads them does not score again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.operators.aggregates import group_sizes
from roomrate.operators.cluster import kmeans_assign, kmeans_fit
from roomrate.operators.evaluate import best_group, error_metrics, metric_summary
from roomrate.operators.filters import zscore_filter_by
from roomrate.operators.overlay import overlay_from_model
from roomrate.operators.regress import fit_per_group, gbt_fit
from roomrate.operators.split import split_flag
from roomrate.sources.staging import stage

CLUSTER = "cluster"
FLAG = "is_train"


@dataclass
class ClusteredResult:
    predictions: DataFrame
    metrics: DataFrame          # cluster, n (test rows), mape, rmse, n_mape, n_rmse, size
    best: DataFrame             # the lowest-MAPE cluster's row
    summary: DataFrame          # best/mean/pooled metrics over clusters
    kmeans: PipelineModel
    models: dict = field(default_factory=dict)
    clustered: DataFrame | None = None   # all clustered rows, flagged


def _score_clusters(staged: DataFrame, key: str, features: list[str], label: str, k: int,
                    kmeans: PipelineModel, max_iter: int, max_categories: int,
                    seed: int, parallelism: int, missing: str) -> ClusteredResult:
    preds, _, models = fit_per_group(staged, CLUSTER, features, label, key, FLAG,
                                     max_iter, max_categories, seed, parallelism,
                                     max_groups=k, missing=missing)
    preds = stage(preds, "cluster-predictions")
    metrics = error_metrics(preds, label, "prediction", by=CLUSTER)
    sizes = group_sizes(staged, CLUSTER, "size")
    # K rows, written once: metrics, best and summary do not score again
    metrics = stage(metrics.join(F.broadcast(sizes), CLUSTER, "inner"), "cluster-metrics")
    return ClusteredResult(preds, metrics, best_group(metrics, CLUSTER, "mape"),
                           metric_summary(metrics, "size"), kmeans, models, staged)


def clustered_price_model(df: DataFrame, key: str, cluster_features: list[str],
                          features: list[str], label: str, k: int = 7, seed: int = 123,
                          kmeans_iter: int = 20, max_iter: int = 10, z_k: float = 2.5,
                          max_categories: int = 5, train_pct: int = 70,
                          parallelism: int | None = None, partitions: int | None = None,
                          scale: bool = False, stage_input: bool = False,
                          missing: str = "impute") -> ClusteredResult:
    """PL3. ``cluster_features`` must not contain the label (clustering on
    the price would leak it into the cluster choice).

    The input is read four times (row count, K-means layout, per-cluster
    moments, the staged write). For a table already on storage that is four
    pruned scans; for a long lazy plan pass ``stage_input=True`` to write
    the needed columns once and read those instead."""
    if label in cluster_features:
        raise ValueError("the label must not be a clustering feature")
    if stage_input:
        needed = list(dict.fromkeys([key, *cluster_features, *features, label]))
        df = stage(df.select(*needed), "clustered-input")
    km = kmeans_fit(df, cluster_features, k, seed, key=key, partitions=partitions,
                    max_iter=kmeans_iter, scale=scale, cluster_col=CLUSTER, missing=missing)
    clustered = kmeans_assign(km, df)
    kept = zscore_filter_by(clustered, CLUSTER, label, z_k, max_groups=k)
    staged = stage(split_flag(kept, key, train_pct, seed, FLAG), "clustered",
                   partition_by=CLUSTER)
    return _score_clusters(staged, key, features, label, k, km, max_iter,
                           max_categories, seed, parallelism, missing)


def leak_free_cluster_model(df: DataFrame, key: str, features: list[str], label: str,
                            k: int = 10, seed: int = 123, kmeans_iter: int = 20,
                            max_iter: int = 10, max_categories: int = 5,
                            train_pct: int = 70, parallelism: int | None = None,
                            partitions: int | None = None,
                            seen_label: str = "price_seen", missing: str = "impute") -> ClusteredResult:
    """PL4: cluster on the features plus a price that is real for training
    rows and *predicted* for test rows (a first GBT fitted on the training
    rows), so test prices never steer the clustering; then one GBT per
    cluster trained on that cluster's training rows and scored on its test
    rows against their real prices."""
    flagged = split_flag(df, key, train_pct, seed, FLAG)
    first = gbt_fit(flagged.filter(F.col(FLAG) == 1), features, label, max_iter,
                    max_categories, seed, key=key, missing=missing)
    seen = flagged.withColumn(seen_label, F.col(label).cast("double"))
    # written once: K-means (count, layout) and the assignment read these
    # files instead of re-running the input's lineage and the first model
    overlaid = stage(overlay_from_model(seen, first, FLAG, seen_label), "overlaid-input")
    km = kmeans_fit(overlaid, features + [seen_label], k, seed, key=key,
                    partitions=partitions, max_iter=kmeans_iter, cluster_col=CLUSTER, missing=missing)
    staged = stage(kmeans_assign(km, overlaid), "overlaid", partition_by=CLUSTER)
    return _score_clusters(staged, key, features, label, k, km, max_iter,
                           max_categories, seed, parallelism, missing)
