"""PL1 prepare_listings: rare-category filter -> one-hot -> casts ->
price outlier filter -> (optionally) staged Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roomrate.operators.columns import bulk_cast
from roomrate.operators.encode import one_hot
from roomrate.operators.filters import frequency_filter, zscore_filter
from roomrate.sources.staging import stage_table


def prepare_listings(df: DataFrame, rare_col: str, categories: list[str], price: str,
                     min_share: float = 1 / 200, k: float = 2.5,
                     int_cols: list[str] | None = None, double_cols: list[str] | None = None,
                     vocab: dict | None = None, drop: list[str] | None = None,
                     out_path: str | None = None) -> DataFrame:
    """The reference's preparation, as one lazy plan with three small
    jobs (the row total, the vocabularies, the price moments - the last
    two as merged scalar subqueries / a bounded collect)."""
    d = frequency_filter(df, rare_col, min_share)
    d = one_hot(d, categories, vocab=vocab, drop_source=True)
    if int_cols or double_cols:
        d = bulk_cast(d, {"int": int_cols or [], "double": double_cols or []})
    if drop:
        d = d.drop(*drop)
    d = zscore_filter(d, price, k)
    return stage_table(d, out_path) if out_path else d
