"""Overlay predicted values on held-out rows (J4 + P8).

Used to cluster without leaking the target: test rows carry the model's
prediction instead of their true value, training rows keep theirs.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.operators.columns import replace_when
from roomrate.operators.joins import null_safe_join
from roomrate.operators.regress import predict
from roomrate.operators.split import TEST


#: What stands for the predictions of one key that differ.
REPEATED = {"mean": F.avg, "min": F.min, "max": F.max}


def one_prediction(predictions: DataFrame, key: str, prediction: str, repeated: str = "error") -> DataFrame:
    """(key, _pred): one row a key, the null key included."""
    if repeated not in ("error", *REPEATED):
        raise ValueError(f"repeated must be error, {', '.join(REPEATED)}")
    k, p = F.col(f"`{key}`"), F.col(f"`{prediction}`")
    told = REPEATED["min" if repeated == "error" else repeated](p)
    if repeated == "error":
        some = F.count(p)
        differ = (F.min(p) != F.max(p)) | ((some > 0) & (some < F.count(F.lit(1))))
        name = F.coalesce(F.max(k.cast("string")), F.lit("null"))
        told = F.when(differ, F.raise_error(F.concat(F.lit(f"predictions differ for {key} = "), name))
                      .cast(predictions.schema[prediction].dataType)).otherwise(told)
    return predictions.groupBy(k.alias(key)).agg(told.alias("_pred"))


def overlay_prediction(df: DataFrame, predictions: DataFrame, key: str, flag: str,
                       target: str, prediction: str = "prediction",
                       repeated: str = "error") -> DataFrame:
    """J4 + P8 in the reference's form: left outer join of (key,
    prediction) onto all rows, then replace ``target`` on test rows.

    Every row of ``df`` comes out once. A null key is a key like any other and
    takes the null key's prediction. A key with several predictions that differ
    is an error, or ``repeated`` says which stands for them (mean, min, max;
    nulls do not count); equal ones are one. A test row whose key has no
    prediction gets null. The test for repeats is an aggregate of one row a
    key; dealing that out again for the join keeps both sides plain shuffles,
    which the adaptive optimiser may broadcast or, for a hot key (or the null
    key) of ``df``, split."""
    joined = null_safe_join(df, one_prediction(predictions, key, prediction, repeated), key, "left")
    out = replace_when(joined, F.col(flag) == F.lit(TEST), target, F.col("_pred"))
    return out.drop("_pred")


def overlay_from_model(df: DataFrame, model: PipelineModel, flag: str,
                       target: str) -> DataFrame:
    """Same result without the join: test rows are scored where they are and
    take the prediction; all other rows stay as they were, unscored."""
    is_test = F.col(flag).eqNullSafe(F.lit(TEST))
    return overlay_scored(df.filter(~is_test), predict(model, df.filter(is_test)), target)


def overlay_scored(untouched: DataFrame, scored: DataFrame, target: str,
                   prediction: str = "prediction") -> DataFrame:
    """Join-free overlay: the rows of ``scored`` with ``prediction`` in the
    place of ``target``, and the rows of ``untouched``."""
    kind = dict(untouched.dtypes)[target]
    cols = [F.col(prediction).cast(kind).alias(c) if c == target else F.col(f"`{c}`")
            for c in untouched.columns]
    return untouched.unionByName(scored.select(*cols))
