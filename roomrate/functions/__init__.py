"""Column expressions (JVM-side built-ins only, no Python UDFs)."""

from roomrate.functions.casts import to_double, to_int, to_long
from roomrate.functions.geo import haversine_km
from roomrate.functions.hashing import hash_bucket

__all__ = ["to_double", "to_int", "to_long", "haversine_km", "hash_bucket"]
