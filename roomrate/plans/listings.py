"""The listing workflow on real listing files: schema, preparation, models
and comparables with the listing column names.

This is what a user of the original scripts runs: a reduced listings CSV in,
a prepared (encoded, cleaned) Parquet table out, then the global model, the
clustered model, the leak-free variant, or a comparables report. All steps
are the generic operators and plans of this package with the listing
columns filled in; the ``id`` column is the row key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from roomrate.operators.comparables import comparables_report
from roomrate.plans.clustered import ClusteredResult, clustered_price_model, leak_free_cluster_model
from roomrate.plans.global_model import global_price_model
from roomrate.plans.prepare import prepare_listings
from roomrate.sources.delimited import read_delimited
from roomrate.sources.staging import stage

# The reduced listings file, column by column (name, type).
LISTING_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("neighbourhoodGroup", T.StringType()),
    T.StructField("neighbourhood", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("propertyType", T.StringType()),
    T.StructField("roomType", T.StringType()),
    T.StructField("accommodates", T.IntegerType()),
    T.StructField("bathrooms", T.DoubleType()),
    T.StructField("bedrooms", T.IntegerType()),
    T.StructField("beds", T.IntegerType()),
    T.StructField("bedType", T.StringType()),
    T.StructField("price", T.IntegerType()),
    T.StructField("availability", T.IntegerType()),
    T.StructField("rating", T.IntegerType()),
])

KEY = "id"
PRICE = "price"
RARE = "neighbourhood"
CATEGORIES = ["neighbourhoodGroup", "neighbourhood", "propertyType", "roomType", "bedType"]

# Fixed values of the workflow: rare-neighbourhood share 1/200, price
# z-bound 2.5 (3 for comparables), K = 7 (10 leak-free), GBT maxIter 20
# global and 10 per cluster, maxCategories 5, seed 123, 70/30 split.
MIN_SHARE = 1 / 200
Z_K = 2.5
Z_K_COMPARABLES = 3.0
K = 7
K_LEAK_FREE = 10


def read_listings(spark: SparkSession, path: str, drop_repeated_header: bool = True) -> DataFrame:
    return read_delimited(spark, path, LISTING_SCHEMA, drop_repeated_header=drop_repeated_header,
                          by_position=True)  # the file's own header has other names


def prepare(spark: SparkSession, path: str, out_path: str | None = None,
            min_share: float = MIN_SHARE, k: float = Z_K,
            stage_raw: bool = True) -> DataFrame:
    """Listings CSV -> rare neighbourhoods dropped -> 0/1 columns for the
    five categories -> price outliers dropped -> (staged to ``out_path``).

    The preparation reads its input several times (row total, neighbourhood
    counts, vocabularies, price moments, the final pass). With
    ``stage_raw`` the CSV is parsed once into Parquet in the shared
    checkpoint folder and those passes read only the columns they need from
    it, instead of re-parsing the full text each time.
    """
    raw = read_listings(spark, path)
    if stage_raw:
        raw = stage(raw, "listings-raw")
    return prepare_listings(raw, RARE, CATEGORIES, PRICE, min_share, k, out_path=out_path)


def features(prepared: DataFrame) -> list[str]:
    """Every column of a prepared table except the key and the price."""
    return [c for c in prepared.columns if c not in (KEY, PRICE)]


def global_model(prepared: DataFrame, max_iter: int = 20):
    return global_price_model(prepared, KEY, features(prepared), PRICE, max_iter)


def clustered_model(prepared: DataFrame, k: int = K, max_iter: int = 10,
                    stage_input: bool = False) -> ClusteredResult:
    f = features(prepared)
    return clustered_price_model(prepared, KEY, f, f, PRICE, k, max_iter=max_iter,
                                 stage_input=stage_input)


def leak_free_model(prepared: DataFrame, k: int = K_LEAK_FREE,
                    max_iter: int = 10) -> ClusteredResult:
    return leak_free_cluster_model(prepared, KEY, features(prepared), PRICE, k,
                                   max_iter=max_iter)


def comparables(listings: DataFrame, anchor: int, borough: str, neighbourhood: str,
                room_type: str = "Private room", property_type: str = "Apartment",
                bed_type: str = "Real Bed", accommodates: int = 1, bathrooms: float = 1.0,
                bedrooms: int = 1, k: float = Z_K_COMPARABLES):
    """Listings like the anchor: same place and kind, one guest, one bath,
    one bedroom, available at least one day; ranked by price with their
    distance to the anchor listing and the price spread."""
    equals = {"neighbourhoodGroup": borough, "neighbourhood": neighbourhood,
              "roomType": room_type, "propertyType": property_type, "bedType": bed_type,
              "accommodates": accommodates, "bathrooms": bathrooms, "bedrooms": bedrooms}
    return comparables_report(listings, KEY, anchor, equals, {"availability": 0}, PRICE, k)
