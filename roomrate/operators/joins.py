"""Equi-joins.

Keys compare null-safely: a null key is a value like any other, so a join
never loses the rows of the null group.

Broadcast rule: a side carries a broadcast hint only when its row count is
bounded by construction (one row of moments, K cluster centres, at most
1/share frequent keys) and that bound is small. Every other join is left to
the adaptive optimiser, which sees the bytes each side really shuffled:
it broadcasts a small one, and splits hot keys of a large one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a structurally bounded side up to which the hint is given.
HINT_ROWS = 10_000


def _renamed_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    rest = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    return df.select(*[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)], *rest)


def null_safe_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner",
                   bound: int | None = None) -> DataFrame:
    """Join on columns of the same names, null equal to null; the key columns
    appear once, as the left side has them. ``bound``: rows that ``right``
    has at most, by construction."""
    keys = [on] if isinstance(on, str) else list(on)
    right = _renamed_keys(right, keys)
    if bound is not None and bound <= HINT_ROWS:
        right = F.broadcast(right)
    cond = reduce(lambda a, b: a & b,
                  [left[f"`{k}`"].eqNullSafe(right[f"_key_{i}"]) for i, k in enumerate(keys)])
    out = left.join(right, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_key_{i}" for i in range(len(keys))])


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               bound: int | None = None) -> DataFrame:
    """Join ``big`` with a side of one row per key (see ``null_safe_join``)."""
    return null_safe_join(big, small, on, how, bound)


def semi_join_keys(df: DataFrame, keys: DataFrame, on, bound: int | None = None) -> DataFrame:
    """Keep rows of ``df`` whose key appears in ``keys``; each row at
    most once even if ``keys`` repeats (the reference's inner join on a
    non-unique id would have multiplied rows)."""
    return null_safe_join(df, keys, on, "left_semi", bound)


def attach(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
           how: str = "inner", bound: int | None = None) -> DataFrame:
    """Join on differently named keys; the right key is cast to the
    left key's type first (the reference compared an int to a string). Text
    that does not parse matches nothing; nulls do not match each other here,
    as a failed cast is null too."""
    ltype = dict(left.dtypes)[left_key]
    r = right.withColumn(right_key, F.col(right_key).try_cast(ltype))
    if right_key != left_key:
        r = r.withColumnRenamed(right_key, left_key)
    if bound is not None and bound <= HINT_ROWS:
        r = F.broadcast(r)
    return left.join(r, left_key, how)
