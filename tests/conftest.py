import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lineara.session import local_session, ship

    return ship(local_session("tests", **{"spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4"}))


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck(sf):
    import glob

    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")

    def run(sql):
        got = c.sql(sql)
        order = sorted(range(len(got.columns)), key=lambda k: got.columns[k])
        return sorted(got.columns), sorted(repr(tuple(r[k] for k in order)) for r in got.fetchall())

    return run
