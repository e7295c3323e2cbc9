"""PL2 global_price_model: keyed split -> VectorIndexer + GBT on the
training rows -> score the test rows -> MAPE and RMSE in one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.operators.evaluate import error_metrics
from roomrate.operators.regress import gbt_fit, predict
from roomrate.operators.split import split


def global_price_model(df: DataFrame, key: str, features: list[str], label: str,
                       max_iter: int = 20, max_categories: int = 5,
                       train_pct: int = 70, seed: int = 123, missing: str = "impute"):
    """Every test row is scored (missing features as ``missing`` says). Returns ``(predictions, metrics, model)``; predictions are
    (key, label, prediction) over the test rows."""
    train, test = split(df, key, train_pct, seed)
    model = gbt_fit(train, features, label, max_iter, max_categories, seed, key=key, missing=missing)
    preds = predict(model, test, keep=[key, F.col(label).cast("double").alias(label)])
    return preds, error_metrics(preds, label, "prediction"), model
