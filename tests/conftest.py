import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

import pytest  # noqa: E402

from roadlens.session import get_spark  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(cpus=4, partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir("file://" + str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def same_rows(df, relation) -> None:
    """Columns by name and rows in any order are equal."""
    cols = sorted(df.columns)
    assert cols == sorted(relation.columns)
    at = [relation.columns.index(c) for c in cols]
    got = sorted(repr([v for v in r]) for r in df.select(*cols).collect())
    want = sorted(repr([r[i] for i in at]) for r in relation.fetchall())
    assert got == want
