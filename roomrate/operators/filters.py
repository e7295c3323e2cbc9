"""Row filters.

Moments for the z-score filter are never brought to the driver as a table:
the global form uses scalar subqueries (executed once, merged into one
aggregate by Catalyst, injected as literals), the grouped form a small
per-group aggregate joined back under the broadcast rule of ``joins``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomrate.operators.joins import join_small, semi_join_keys


def frequency_filter(df: DataFrame, by: str, min_share: float = 1 / 200) -> DataFrame:
    """drop rows whose ``by`` value holds at most ``min_share`` of all
    rows (strict: a category survives when count > total * share).

    Counts are partial-aggregated map-side. At most floor(1/share) values
    can pass, so the surviving key list has a proven bound and is broadcast
    when that bound is small; the big side is then never shuffled, even if
    one value owns a third of the rows.
    """
    if not 0 < min_share < 1:
        raise ValueError("min_share must be in (0, 1)")
    total = df.select(F.count(F.lit(1))).scalar()
    n = F.col("_n")
    inv = 1 / min_share
    if abs(inv - round(inv)) < 1e-9:
        # share = 1/d: compare n * d > total in exact integer arithmetic
        frequent_cond = n * F.lit(int(round(inv))) > total
    else:
        frequent_cond = n.cast("double") > total * F.lit(float(min_share))
    frequent = (df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
                .filter(frequent_cond).select(by))
    return join_small(df, frequent, by, "left_semi", bound=math.floor(inv))


def zscore_filter(df: DataFrame, col: str, k: float = 2.5,
                  nan_policy: str = "omit", keep_constant: bool = False) -> DataFrame:
    """keep rows with |x - mean| / population std < k (strict).

    ``nan_policy='omit'``: null and NaN values are ignored in the moments and
    their rows dropped; ``'propagate'`` mirrors scipy's default, where one
    missing value makes every comparison fail and the result is empty. A constant column
    (std 0) drops every row unless ``keep_constant``.
    """
    if nan_policy not in ("omit", "propagate"):
        raise ValueError(f"nan_policy must be 'omit' or 'propagate', not {nan_policy!r}")
    x = _missing_as_null(df, col) if nan_policy == "omit" else F.col(col)
    m = df.select(F.avg(x)).scalar()
    sd = df.select(F.stddev_pop(x)).scalar()
    cond = _z_condition(x, m, sd, k, keep_constant)
    if nan_policy == "propagate":
        n_null = df.select(F.count(F.lit(1)) - F.count(col)).scalar()
        cond = cond & (n_null == 0)
    return df.filter(cond)


def _missing_as_null(df: DataFrame, col: str) -> Column:
    """NaN (pandas' missing marker) counts as missing, like null."""
    if dict(df.dtypes)[col] in ("double", "float"):
        return F.nanvl(F.col(col), F.lit(None).cast("double"))
    return F.col(col)


def _z_condition(x: Column, m: Column, sd: Column, k: float, keep_constant: bool) -> Column:
    z_ok = F.abs((x - m) / F.nullif(sd, F.lit(0.0))) < F.lit(float(k))
    if keep_constant:
        z_ok = z_ok | ((sd == 0) & x.isNotNull())
    return F.coalesce(z_ok, F.lit(False))


def group_moments(df: DataFrame, group: str, col: str) -> DataFrame:
    x = _missing_as_null(df, col)
    return df.groupBy(group).agg(F.avg(x).alias("_mean"), F.stddev_pop(x).alias("_std"))


def zscore_filter_by(df: DataFrame, group: str, col: str, k: float = 2.5,
                     keep_constant: bool = False, max_groups: int | None = None) -> DataFrame:
    """the z-score test inside each group.

    Per-group moments are one partial+final aggregate; the moments table has
    one row per group (the null group included) and carries a broadcast hint
    only when ``max_groups`` bounds it (K clusters). The window form
    (``avg OVER (PARTITION BY g)``) would shuffle every row and put a hot
    group in one task, so it is not used.
    """
    stats = group_moments(df, group, col)
    joined = join_small(df, stats, group, "inner", bound=max_groups)
    cond = _z_condition(_missing_as_null(df, col), F.col("_mean"), F.col("_std"), k,
                        keep_constant)
    return joined.filter(cond).select(*[F.col(f"`{c}`") for c in df.columns])


def all_of(predicates: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def comparables(df: DataFrame, equals: dict[str, object],
                greater_than: dict[str, object] | None = None) -> DataFrame:
    """AND of equality tests plus strict lower bounds (e.g.
    availability > 0). Plain column predicates, so Parquet scans receive
    them as pushed filters."""
    preds = [F.col(c) == F.lit(v) for c, v in equals.items()]
    preds += [F.col(c) > F.lit(v) for c, v in (greater_than or {}).items()]
    return df.filter(all_of(preds))


def in_set(df: DataFrame, col: str, values: list) -> DataFrame:
    """membership test (pushed to the scan as an In filter)."""
    return df.filter(F.col(col).isin(list(values)))


def select_group(df: DataFrame, group_col: str, value) -> DataFrame:
    """rows of one group, addressed by name, ``None`` being the null
    group (skips the files of other groups when the table was staged
    partitioned by ``group_col``)."""
    return df.filter(F.col(group_col).eqNullSafe(F.lit(value)))


def group_flag_counts(df: DataFrame, group: str, flag: str) -> DataFrame:
    """Per group: rows, training rows (flag = 1), test rows (flag = 0)."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(flag) == 1).alias("n_train"),
        F.count_if(F.col(flag) == 0).alias("n_test"))


def trainable_groups(df: DataFrame, group: str, flag: str) -> DataFrame:
    """groups that have both training and test rows (a group with no
    test rows cannot be scored, one with no training rows cannot be fit);
    the null group counts as one."""
    return group_flag_counts(df, group, flag).filter(
        (F.col("n_train") > 0) & (F.col("n_test") > 0))


def drop_empty_groups(df: DataFrame, group: str, flag: str,
                      max_groups: int | None = None) -> DataFrame:
    keys = trainable_groups(df, group, flag).select(group)
    return semi_join_keys(df, keys, group, bound=max_groups)
