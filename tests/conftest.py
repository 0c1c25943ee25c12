import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from lexmill.session import build_session

    session = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def duck():
    import glob

    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def same_rows(df, con, sql):
    """Whether a DataFrame has the rows and column names of a query."""
    from collections import Counter

    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    ours = Counter(repr(tuple(r[c] for c in order)) for r in df.collect())
    theirs = Counter(repr(tuple(r[names.index(c)] for c in order)) for r in cursor.fetchall())
    assert ours == theirs, (list((ours - theirs))[:3], list((theirs - ours))[:3])
