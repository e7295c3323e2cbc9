"""Every full-oracle query against its DuckDB SQL at sf0.01 (row count,
column names and types, order-insensitive values rounded to 6 places)."""

import hashlib
import math

import pytest

from conftest import SF001

from __spark_entry__ import oracle_sql, queries

_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN", "float": "FLOAT"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return repr(v)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(hashlib.md5("|".join(_norm(r[i]) for i in order).encode()).hexdigest()
                  for r in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    sql = oracle_sql()[name]
    cur = duck.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    otypes = {r[0]: r[1] for r in duck.execute(f"describe {sql}").fetchall()}
    stypes = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
    assert stypes == otypes
    assert len(srows) == len(orows)
    assert _bag(df.columns, srows) == _bag(ocols, orows)


def test_every_query_is_registered_with_a_callable():
    q = queries()
    assert set(oracle_sql()) <= set(q)
    assert all(callable(f) for f in q.values())


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert "event_id" in df.columns
