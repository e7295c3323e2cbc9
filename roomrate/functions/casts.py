"""Lenient casts.

The reference ran on a Spark whose ``cast`` turned bad text into null and
truncated ``'1.0'`` to 1. Spark 4 runs with ANSI mode on, where the same
cast raises, so we go through ``try_cast``: text -> double -> int. Going via
double keeps ``'1.0'`` -> 1 and ``'1.9'`` -> 1 (truncation), while ``''`` and
``'$100'`` become null. Surrounding blanks are ignored by Spark's parser.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    return _col(c).try_cast("double")


def to_int(c) -> Column:
    return _col(c).try_cast("double").try_cast("int")


def to_long(c) -> Column:
    """Exact text -> bigint first (ids above 2**53 must not pass through a
    double); only text that is not an integer ('1.0', '1.9') goes via
    double and is truncated."""
    x = _col(c)
    return F.coalesce(x.try_cast("bigint"), x.try_cast("double").try_cast("bigint"))
