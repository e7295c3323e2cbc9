"""Aggregations (A1-A5, A10-A11). All are hash aggregates with map-side
partial aggregation, so a value that owns a third of the rows costs one
partial row per task, not a third of the data in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.operators.joins import join_small


def count_by(df: DataFrame, by: str | list[str], name: str = "count") -> DataFrame:
    """A1: rows per value."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def annotate_count(df: DataFrame, by: str, name: str = "count",
                   max_groups: int | None = None) -> DataFrame:
    """A2: write each row's group size on the row.

    Aggregate-then-join rather than ``count(*) OVER (PARTITION BY by)``: the
    window moves every row into its key's partition, the aggregate moves
    only partial counts; how the counts (one row per value, null included)
    are joined back is decided at run time by their real size.
    """
    counts = count_by(df, by, name)
    out = join_small(df, counts, by, "inner", bound=max_groups)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], name)


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """A3 as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def group_sizes(df: DataFrame, group: str, name: str = "size") -> DataFrame:
    return count_by(df, group, name)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A4: the vocabulary of ``col``, sorted (the reference used whatever
    order ``distinct()`` returned, which made column order unstable)."""
    return df.select(col).distinct().orderBy(col)


def moments(df: DataFrame, col: str, by: str | list[str] | None = None) -> DataFrame:
    """A5: count, mean and population std (the z-score filter's inputs)."""
    aggs = [F.count(col).alias("n"), F.avg(col).alias("mean"),
            F.stddev_pop(col).alias("std_pop")]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def spread_summary(df: DataFrame, col: str, by: str | list[str] | None = None) -> DataFrame:
    """Row count, *sample* std and range (max - min) of ``col``; the
    footer of the reference's comparables sheets (note: the filters use the
    population std, this summary the sample std)."""
    aggs = [F.count(F.lit(1)).alias("n"),
            F.stddev_samp(col).alias("std_samp"),
            (F.max(col) - F.min(col)).alias("range")]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)
