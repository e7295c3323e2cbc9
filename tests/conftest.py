import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from roomrate.session import build_session

    s = build_session(master="local[*]", app="roomrate-tests", shuffle_partitions=8,
                      driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split():
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con
