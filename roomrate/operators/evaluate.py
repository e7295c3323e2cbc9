"""Model scoring.

MAPE and RMSE come out of one grouped aggregate over the prediction rows
instead of collecting the error column to the driver and summing it there.

MAPE divides by the *prediction* by default, as the reference did; pass
``mape_denominator='label'`` for the textbook form. A zero denominator gives
null for that row, which ``avg`` leaves out (the row still counts in RMSE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _metric_cols(label: str, prediction: str, mape_denominator: str):
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    denom = F.col(prediction if mape_denominator == "prediction" else label).cast("double")
    ape = F.abs(err / F.nullif(denom, F.lit(0.0)))
    return [F.count(F.lit(1)).alias("n"),
            F.avg(ape).alias("mape"),
            F.sqrt(F.avg(err * err)).alias("rmse"),
            F.count(ape).alias("n_mape"), F.count(err).alias("n_rmse")]


def error_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                  by: str | list[str] | None = None,
                  mape_denominator: str = "prediction") -> DataFrame:
    """(by..., n, mape, rmse, n_mape, n_rmse): rows, the two errors, and how
    many rows each is an average of; one row overall when ``by`` is None."""
    if mape_denominator not in ("prediction", "label"):
        raise ValueError("mape_denominator must be 'prediction' or 'label'")
    cols = _metric_cols(label, prediction, mape_denominator)
    return pred.groupBy(by).agg(*cols) if by else pred.agg(*cols)


def mape(pred: DataFrame, label: str = "label", prediction: str = "prediction",
         by=None, mape_denominator: str = "prediction") -> DataFrame:
    return error_metrics(pred, label, prediction, by, mape_denominator).drop("rmse", "n_mape", "n_rmse")


def rmse(pred: DataFrame, label: str = "label", prediction: str = "prediction",
         by=None) -> DataFrame:
    return error_metrics(pred, label, prediction, by).drop("mape", "n_mape", "n_rmse")


def best_group(metrics: DataFrame, group: str, metric: str = "mape") -> DataFrame:
    """The group with the lowest ``metric`` and *that* group's other
    metrics (ties broken by group id). The metrics table has one row per
    group, so the sort is tiny."""
    return metrics.orderBy(F.col(metric).asc_nulls_last(), F.col(group)).limit(1)


def metric_summary(metrics: DataFrame, size_col: str = "n", mape_rows: str | None = None,
                   rmse_rows: str | None = None) -> DataFrame:
    """Best and unweighted mean over groups of RMSE and MAPE (the
    reference's report), the total of ``size_col``, and the errors over all
    scored rows: each group's error weighs by the rows it is an average of,
    whatever the group's size (RMSE pooled, MAPE weighted). The weights are the
    columns of ``error_metrics`` (``n`` in a table without them)."""
    mape_rows = mape_rows or ("n_mape" if "n_mape" in metrics.columns else "n")
    rmse_rows = rmse_rows or ("n_rmse" if "n_rmse" in metrics.columns else "n")
    by_rmse, by_mape = (F.when(F.col(m).isNotNull(), F.col(n).cast("double"))
                        for m, n in (("rmse", rmse_rows), ("mape", mape_rows)))
    return metrics.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.min("rmse").alias("best_rmse"),
        F.avg("rmse").alias("mean_rmse"),
        F.min("mape").alias("best_mape"),
        F.avg("mape").alias("mean_mape"),
        F.sum(size_col).alias("total_size"),
        F.sqrt(F.sum(by_rmse * F.col("rmse") * F.col("rmse"))
               / F.nullif(F.sum(by_rmse), F.lit(0.0))).alias("pooled_rmse"),
        (F.sum(by_mape * F.col("mape"))
         / F.nullif(F.sum(by_mape), F.lit(0.0))).alias("weighted_mape"))


def preview(df: DataFrame, cols: list[str], key: str, n: int = 20) -> DataFrame:
    """O3: the first ``n`` rows by key (a top-n, so ``limit`` is the
    feature; ordered so it is deterministic)."""
    return df.select(*cols).orderBy(key).limit(n)
