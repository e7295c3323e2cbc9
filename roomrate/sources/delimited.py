"""Delimited text in and out.

The reference read CSV as raw lines, split on every comma and pasted names
on by position; a quoted value holding a comma shifted all later columns.
Here the Spark CSV reader parses quotes, a declared schema names the
columns and a header is checked against it, and rows whose field count is wrong
are dropped (``corrupt_rows`` returns them, to count or to repair) or kept
aside in a corrupt record column, instead of being silently shifted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomrate.operators.columns import bulk_cast

CORRUPT_COL = "_corrupt_record"


def read_delimited(spark: SparkSession, path: str, schema: T.StructType,
                   header: bool = True, sep: str = ",",
                   drop_repeated_header: bool = False,
                   keep_corrupt: bool = False, by_position: bool = False) -> DataFrame:
    """Read delimited text with a declared schema.

    A header must name the schema's columns in their order; a file whose
    header differs fails rather than being read with its columns exchanged.
    ``by_position`` skips that test for files whose header has other names.

    Fields are read as text and converted with lenient casts (bad values
    become null rather than failing the job, the behaviour the reference
    relied on); empty fields are null. Rows with too few or too many
    fields are dropped, or kept with their raw text in ``_corrupt_record``
    when ``keep_corrupt``. ``drop_repeated_header`` also removes data lines
    equal to the header (concatenated exports repeat it).

    Spark flags such rows only while it parses every field of the line; with
    CSV column pruning (a query needing a few columns, or a bare
    ``count()``) they would pass unnoticed. The row test therefore refers
    to every declared field through an always-true term, which keeps the
    whole line parsed whatever the downstream projection.
    """
    names = [f.name for f in schema.fields]
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    raw = (spark.read.schema(T.StructType(fields + [T.StructField(CORRUPT_COL, T.StringType())]))
           .option("header", header).option("sep", sep)
           .option("enforceSchema", not header or by_position)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL)
           .csv(path))
    every_field = F.length(F.concat_ws("", *[F.col(f"`{n}`") for n in names])) >= 0
    if keep_corrupt:
        extra = [F.when(every_field, F.col(CORRUPT_COL)).alias(CORRUPT_COL)]
    else:
        raw = raw.filter(F.col(CORRUPT_COL).isNull() & every_field)
        extra = []
    if drop_repeated_header:
        is_header = reduce(lambda a, b: a & b,
                           [F.coalesce(F.col(f"`{n}`") == F.lit(n), F.lit(False)) for n in names])
        raw = raw.filter(~is_header)
    raw = raw.select(*[F.nullif(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names], *extra)
    by_type: dict[str, list[str]] = {}
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            by_type.setdefault(f.dataType.simpleString(), []).append(f.name)
    return bulk_cast(raw, by_type)


def corrupt_rows(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                 sep: str = ",", by_position: bool = False) -> DataFrame:
    """The lines that ``read_delimited`` leaves out, as they stand in the file
    (column ``line``); ``.count()`` them to know what a read lost."""
    rows = read_delimited(spark, path, schema, header, sep, keep_corrupt=True, by_position=by_position)
    return rows.filter(F.col(CORRUPT_COL).isNotNull()).select(F.col(CORRUPT_COL).alias("line"))


def read_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Header names and inferred types (one extra pass over the file).
    Convenient for exploration; prefer ``read_delimited`` in production."""
    return (spark.read.option("header", True).option("inferSchema", True)
            .option("sep", sep).csv(path))


def write_delimited(df: DataFrame, path: str, header: bool = True,
                    mode: str = "overwrite") -> None:
    """Write CSV from the executors in parallel (one file per partition);
    no row index column and nothing collected to the driver."""
    df.write.mode(mode).option("header", header).csv(path)
