"""Command line for the listing workflow.

    python -m roomrate prepare LISTINGS.csv PREPARED_DIR
    python -m roomrate global PREPARED_DIR
    python -m roomrate clustered PREPARED_DIR [--k 7]
    python -m roomrate leakfree PREPARED_DIR [--k 10]
    python -m roomrate comparables LISTINGS.csv --anchor ID --borough B --neighbourhood N

Uses the active Spark configuration (``spark-submit`` or defaults); prints
only metric rows and reports, never the data.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from roomrate.plans import listings
from roomrate.sources.staging import release_staged


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="roomrate")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("prepare")
    p.add_argument("listings")
    p.add_argument("out")
    p.add_argument("--min-share", type=float, default=listings.MIN_SHARE)
    p.add_argument("--z", type=float, default=listings.Z_K)
    for name, k in (("global", None), ("clustered", listings.K),
                    ("leakfree", listings.K_LEAK_FREE)):
        q = sub.add_parser(name)
        q.add_argument("prepared")
        if k is not None:
            q.add_argument("--k", type=int, default=k)
    c = sub.add_parser("comparables")
    c.add_argument("listings")
    c.add_argument("--anchor", type=int, required=True)
    c.add_argument("--borough", required=True)
    c.add_argument("--neighbourhood", required=True)
    c.add_argument("--room-type", default="Private room")
    c.add_argument("--property-type", default="Apartment")
    c.add_argument("--bed-type", default="Real Bed")
    c.add_argument("--out")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"roomrate-{a.cmd}").getOrCreate()
    if a.cmd == "prepare":
        df = listings.prepare(spark, a.listings, a.out, a.min_share, a.z)
        print(f"prepared {df.count()} rows x {len(df.columns)} columns -> {a.out}")
    elif a.cmd == "global":
        _, metrics, _ = listings.global_model(spark.read.parquet(a.prepared))
        metrics.show(truncate=False)
    elif a.cmd in ("clustered", "leakfree"):
        prepared = spark.read.parquet(a.prepared)
        fit = listings.clustered_model if a.cmd == "clustered" else listings.leak_free_model
        res = fit(prepared, a.k)
        res.metrics.orderBy("cluster").show(truncate=False)
        res.best.show(truncate=False)
        res.summary.show(truncate=False)
    else:
        rows, summary = listings.comparables(listings.read_listings(spark, a.listings),
                                             a.anchor, a.borough, a.neighbourhood,
                                             room_type=a.room_type,
                                             property_type=a.property_type,
                                             bed_type=a.bed_type)
        if a.out:
            rows.write.mode("overwrite").option("header", True).csv(a.out)
        else:
            rows.show(50, truncate=False)
        summary.show(truncate=False)
    release_staged(spark)


if __name__ == "__main__":
    main()
