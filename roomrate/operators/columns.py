"""Projection and typing (P1-P8). Each builds one ``select``/``withColumn``
so Catalyst sees a single Project instead of a stack of ~100."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomrate.functions.casts import to_double, to_int, to_long


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def select_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[_q(n) for n in names])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


_CASTERS = {
    "int": to_int,
    "integer": to_int,
    "bigint": to_long,
    "long": to_long,
    "double": to_double,
}


def bulk_cast(df: DataFrame, by_type: dict[str, list[str]], on_bad: str = "null") -> DataFrame:
    """Cast lists of columns in one projection, with the lenient parsing
    rules above. ``on_bad='null'``: a value that does not parse becomes
    null; ``on_bad='error'``: it fails the job, naming the column (whatever
    the session's ANSI setting)."""
    if on_bad not in ("null", "error"):
        raise ValueError("on_bad must be 'null' or 'error'")
    target: dict[str, Column] = {}
    for typ, names in by_type.items():
        caster = _CASTERS.get(typ.lower())
        for n in names:
            parsed = caster(_q(n)) if caster else _q(n).try_cast(typ)
            if on_bad == "error":
                parsed = F.when(_q(n).isNotNull() & parsed.isNull(),
                                F.raise_error(F.concat(F.lit(f"bad {typ} value in {n}: "),
                                                       _q(n).cast("string")))
                                ).otherwise(parsed)
            target[n] = parsed
    return df.select(*[target[c].alias(c) if c in target else _q(c) for c in df.columns])


def move_last(df: DataFrame, name: str, as_name: str | None = None) -> DataFrame:
    """Copy ``name`` to the end (optionally renamed) and drop the original."""
    rest = [_q(c) for c in df.columns if c != name]
    return df.select(*rest, _q(name).alias(as_name or name))


def tag(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def flag_when(df: DataFrame, cond: Column, name: str) -> DataFrame:
    return df.withColumn(name, F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def replace_when(df: DataFrame, cond: Column, target: str, source: str | Column) -> DataFrame:
    src = F.col(source) if isinstance(source, str) else source
    return df.withColumn(target, F.when(cond, src).otherwise(_q(target)))
