"""Driver tables in the roles of the listing data.

The listing data itself is not available, so each role is played by a
column of the given tables (see FIXTURES.md section 3): ``events`` for the
table with a rare category, a small category and an outlier-heavy price;
``orders`` for keyed rows to split, encode and model, with a price that
Spark derives from its columns (the raw price columns carry no signal);
``customer`` with coordinates derived from its key for the comparables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomrate.operators.encode import dummy_name, one_hot

# Fixed vocabularies of the stand-in category columns (values of the
# given tables, listed so the wide tables have a stable schema).
ORDER_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
ORDER_STATUSES = ["F", "O", "P"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def priced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as listings: key ``o_orderkey``; features ``cust_band``
    (0-49, like a capacity), ``o_totalprice`` (no signal) and 0/1 columns
    of priority and status; ``price`` = 100 + 3*cust_band + 20*[urgent] +
    40*[status F] + (o_orderkey mod 7), the last term being noise the
    features cannot explain."""
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    o = o.withColumn("cust_band", (F.col("o_custkey") % 50).cast("int")).withColumn(
        "price",
        (F.lit(100) + 3 * F.col("cust_band")
         + F.when(F.col("o_orderpriority") == "1-URGENT", 20).otherwise(0)
         + F.when(F.col("o_orderstatus") == "F", 40).otherwise(0)
         + (F.col("o_orderkey") % 7)).cast("int"))
    return one_hot(o, ["o_orderpriority", "o_orderstatus"],
                   vocab={"o_orderpriority": ORDER_PRIORITIES, "o_orderstatus": ORDER_STATUSES},
                   drop_source=False)


PRICED_ORDER_FEATURES = (["cust_band", "o_totalprice"]
                         + [dummy_name("o_orderpriority", v) for v in ORDER_PRIORITIES]
                         + [dummy_name("o_orderstatus", v) for v in ORDER_STATUSES])


def located_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as listings with coordinates derived from the key
    (a grid around 40.5 N, 74.1 W) and ``c_acctbal`` as the price."""
    c = load(spark, sf_dir, "customer")
    return c.select(
        "c_custkey", "c_nationkey", "c_mktsegment",
        F.col("c_acctbal").alias("price"),
        (F.lit(40.5) + (F.col("c_custkey") % 997) * F.lit(0.0004)).alias("latitude"),
        (F.lit(-74.1) + (F.col("c_custkey") % 499) * F.lit(0.0008)).alias("longitude"))
