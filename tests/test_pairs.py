"""Reports of two modes that arrive one by one."""

import datetime as dt

import pytest
from helpers import rows

from lineara.streaming import pairs

SCHEMA = "record string, mode string, at timestamp, path string, content string"
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(key)


def test_pairs_with_restarts(rocks, tmp_path):
    spark = rocks
    (tmp_path / "in").mkdir()

    def arrive(n, *reports):
        """One file, one run of the query: each call starts it anew from its checkpoint."""
        spark.createDataFrame([(r, m, T0 + dt.timedelta(minutes=t), p, f"text {p}") for r, m, t, p in reports], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        out = pairs.paired(stream, late="10 minutes", wait=60 * 60_000, forget=600 * 60_000)
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        return {r["record"]: (r["genome_path"], r["protein_path"], r["complete"]) for r in spark.read.schema(pairs.JOINED).parquet(str(tmp_path / "out")).collect()}

    assert arrive(1, ("a", "genome", 0, "a1"), ("b", "genome", 1, "b1"), ("b", "protein", 2, "b2"), (None, "genome", 1, "x"), ("c", "other", 1, "c0")) == {"b": ("b1", "b2", True)}
    got = arrive(2, ("a", "genome", 5, "a3"), ("b", "genome", 6, "late for b"), ("d", "protein", 7, "d1"))
    assert got == {"b": ("b1", "b2", True)}, "a newer report of one mode replaces the older, and a record that is done stays so"
    got = arrive(3, ("a", "protein", 20, "a4"), ("e", "genome", 21, "e1"))
    assert got["a"] == ("a3", "a4", True)
    arrive(4, ("z", "genome", 200, "z1"))
    got = arrive(5, ("z", "genome", 201, "z2"), ("d", "genome", 201, "after the time"))
    assert got["d"] == (None, "d1", False) and got["e"] == ("e1", None, False) and "z" not in got and "c" not in got
    assert len(rows(spark.read.schema(pairs.JOINED).parquet(str(tmp_path / "out")))) == len(got) == 4
