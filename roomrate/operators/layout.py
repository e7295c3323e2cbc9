"""Two-level key layout of the rows that an iterative fit reads.

A fit's result depends on which rows share a partition, and in what order, so
both follow from the data alone. One aggregate gives a histogram: rows and
bytes of each of ``BUCKETS`` hash buckets of the key (that many rows at most,
however large the table). The buckets lie end to end on a line as long as the
table's bytes; the partitions cut the line into equal pieces. A row stands
where its bucket begins, plus a share of the bucket given by a second hash, of
the key and all values. A small bucket lands in one partition; a heavy one (the
null key, a key that repeats) spreads over as many as its bytes ask for.

Number of partitions: bytes / target, the target being 1 MiB for small tables
(so that a fit uses the cores), growing to 64 MiB, and never more than
``MAX_PARTITIONS``, so a pass over any table is a bounded number of tasks.

Rows that repeat the key and every value stand in one place and share a
partition.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1024
MAX_PARTITIONS = 8192
SMALL, LARGE = 1 << 20, 64 << 20
#: Pieces that a table is cut into before the target grows beyond ``SMALL``.
PIECES = 64
_PLACE = "_place"


def partition_count(size: int, max_partitions: int = MAX_PARTITIONS) -> int:
    """Partitions for ``size`` bytes."""
    target = min(LARGE, max(SMALL, size / PIECES))
    return int(max(1, min(max_partitions, -(-size // target))))


@dataclass(frozen=True)
class Layout:
    """Where each bucket begins and how long it is, in bytes."""

    partitions: int
    begin: list[int]
    size: list[int]


def _bytes(df: DataFrame) -> Column:
    """Bytes of a row: eight a value, and what variable-length values hold."""
    size = F.lit(8 * len(df.columns)).cast("long")
    more = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            more.append(F.octet_length(c))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            more.append(8 * F.when(c.isNotNull(), F.size(c)))
    return reduce(lambda a, b: a + F.coalesce(b, F.lit(0)).cast("long"), more, size)


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(BUCKETS)).cast("int")


def plan_layout(df: DataFrame, key: str, partitions: int | None = None,
                max_partitions: int = MAX_PARTITIONS) -> Layout:
    """Layout of the rows of ``df`` (only what the fit reads)."""
    hist = df.select(_bucket(key).alias("b"), _bytes(df).alias("n")).groupBy("b").agg(F.sum("n").alias("n"))
    size = [0] * BUCKETS
    for r in hist.collect():  # BUCKETS rows at most
        size[r.b] = r.n
    begin, total = [], 0
    for n in size:
        begin.append(total)
        total += n
    return Layout(partitions or partition_count(total, max_partitions), begin, size)


def place_of(df: DataFrame, key: str, plan: Layout) -> Column:
    """Partition of each row."""
    total = max(plan.begin[-1] + plan.size[-1], 1)
    values = [F.col(f"`{c}`") for c in sorted(df.columns) if not isinstance(df.schema[c].dataType, T.MapType)]
    share = F.pmod(F.xxhash64(F.lit(2), F.col(f"`{key}`"), *values), F.lit(1 << 30)) / float(1 << 30)
    where = lambda x: F.get(F.lit([float(v) for v in x]), _bucket(key))
    at = (where(plan.begin) + share * where(plan.size)) * (plan.partitions / total)
    return F.least(F.floor(at).cast("int"), F.lit(plan.partitions - 1))


def lay_out(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """``df`` in its layout: one shuffle, rows sorted by key and then by all
    other values inside each partition."""
    plan = plan_layout(df, key, partitions)
    rest = [F.col(f"`{c}`") for c in df.columns if c != key and not isinstance(df.schema[c].dataType, T.MapType)]
    return (df.withColumn(_PLACE, place_of(df, key, plan)).repartitionById(plan.partitions, F.col(_PLACE))
            .drop(_PLACE).sortWithinPartitions(F.col(f"`{key}`"), *rest))
