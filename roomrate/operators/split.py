"""Reproducible train/test split and tagged union.

``randomSplit(seed)`` draws per partition, so the same seed splits
differently when the input is partitioned differently (a cluster of
another size, a different file layout). The split here is a pure function
of (seed, key): an md5 bucket in [0, 100) below ``train_pct`` is training.
No shuffle, no sampling state, identical on any cluster and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.functions.hashing import hash_bucket

TRAIN, TEST = 1, 0


def split_flag(df: DataFrame, key: str, train_pct: int = 70, seed: int = 123,
               flag: str = "is_train") -> DataFrame:
    """Add ``flag`` = 1 for training rows, 0 for test rows."""
    return df.withColumn(flag, (hash_bucket(key, seed) < F.lit(train_pct)).cast("int"))


def split(df: DataFrame, key: str, train_pct: int = 70, seed: int = 123):
    """(train, test): two filters over the same expression."""
    b = hash_bucket(key, seed)
    return df.filter(b < F.lit(train_pct)), df.filter(b >= F.lit(train_pct))


def union_tagged(train: DataFrame, test: DataFrame, flag: str = "is_train") -> DataFrame:
    """Tag train rows 1 and test rows 0, then union by name (the
    reference's positional union silently paired columns by position)."""
    return (train.withColumn(flag, F.lit(TRAIN))
            .unionByName(test.withColumn(flag, F.lit(TEST))))
