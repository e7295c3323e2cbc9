"""Keyed hash buckets for reproducible splits.

``randomSplit`` depends on how rows are partitioned, so the same seed gives
a different split on a different cluster. A bucket computed from the row key
alone does not: ``md5("<seed>-<key>")``, first 32 bits, modulo ``buckets``.
It is a pure per-row expression (no shuffle, no state) and the same
formula is expressible in DuckDB for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(key, seed: int = 123, buckets: int = 100) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}-"), k.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)
