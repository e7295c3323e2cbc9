"""Comparable listings (F4, X5, O1, A11): listings like a given one, their
great-circle distance from an anchor listing, ranked by price, and the
spread of their prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.functions.geo import haversine_km
from roomrate.operators.aggregates import spread_summary
from roomrate.operators.filters import comparables, zscore_filter


def distance_from_anchor(df: DataFrame, key: str, anchor, lat: str = "latitude",
                         lon: str = "longitude", name: str = "distance_km",
                         anchors: DataFrame | None = None) -> DataFrame:
    """Km from the anchor row (``key == anchor``) to every row.

    The anchor's coordinates are scalar subqueries (run once, merged into
    one scan with a pushed-down key filter), not a join; a key that is not
    unique makes the subquery fail loudly instead of multiplying rows.
    ``anchors`` lets the anchor come from a wider table than ``df``.
    """
    src = (anchors if anchors is not None else df).filter(F.col(key) == F.lit(anchor))
    lat0 = src.select(lat).scalar()
    lon0 = src.select(lon).scalar()
    return df.withColumn(name, haversine_km(F.col(lat), F.col(lon), lat0, lon0))


def rank_by(df: DataFrame, col: str, key: str, descending: bool = True) -> DataFrame:
    """O1: sort by ``col`` (highest first), ties by key so the order is
    total. A report-sized result, range-partitioned by Spark's sort."""
    c = F.col(col).desc() if descending else F.col(col).asc()
    return df.orderBy(c, F.col(key))


def comparables_report(df: DataFrame, key: str, anchor, equals: dict,
                       greater_than: dict | None = None, price: str = "price",
                       k: float = 3.0, lat: str = "latitude", lon: str = "longitude"):
    """PL5 building block: z-score filter on price over the whole table,
    then the comparables predicates, distance from the anchor listing and
    the price ranking. Returns ``(ranked_rows, summary)``."""
    kept = zscore_filter(df, price, k)
    rows = comparables(kept, equals, greater_than)
    rows = distance_from_anchor(rows, key, anchor, lat, lon, anchors=df)
    return rank_by(rows, price, key), spread_summary(rows, price)
