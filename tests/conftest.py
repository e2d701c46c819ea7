import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="kasir-test-")


@pytest.fixture(scope="session")
def spark(scratch):
    from kasir.session import local_session
    s = local_session("*", 8, app="kasir-tests",
                      extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    yield s
    s.stop()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows_of(df):
    return [tuple(r) for r in df.collect()]


_FRAMES: dict = {}


def query_frame(spark, name):
    """A registered query's result over the small tables, built once: some
    queries load or publish tables while they are built."""
    if name not in _FRAMES:
        from kasir.queries import QUERIES
        _FRAMES[name] = QUERIES[name](spark, SF_SMALL)
    return _FRAMES[name]
