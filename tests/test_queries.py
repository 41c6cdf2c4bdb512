"""Every registered query of the metadata engine against its SQL."""

import pytest
from helpers import rows

from lineara.queries import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(spark, sf, duck, name):
    got = catalog.QUERIES[name](spark, sf)
    columns, want = duck(catalog.ORACLE_SQL[name])
    assert sorted(got.columns) == columns
    assert rows(got) == want


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(catalog.ORACLE_SQL) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() > 100


def test_broadcasts_are_left_to_the_planner(spark, sf):
    plan = catalog.QUERIES["insert_ignore_merge"](spark, sf)._jdf.queryExecution().logical().toString()
    assert "Hint" not in plan


def test_lineage_queries_take_whole_tables(spark, sf, tmp_path):
    """Every nation has its dataset, whatever its name; a customer of no known nation is the one without any."""
    import duckdb

    c = duckdb.connect()
    for t in ("nation", "region", "customer"):
        c.execute(f"CREATE TABLE {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    c.execute("UPDATE customer SET c_nationkey = CASE c_custkey WHEN 3 THEN 99 ELSE NULL END WHERE c_custkey IN (3, 5)")
    for t in ("nation", "region", "customer"):
        c.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet'")
    got = {}
    for name in ("lineage_exact_lookup", "lineage_nearest_ancestor", "lineage_unmatched", "dataset_override"):
        df = catalog.QUERIES[name](spark, str(tmp_path))
        got[name] = rows(df)
        assert got[name] == sorted(map(repr, c.sql(f"SELECT {', '.join(sorted(df.columns))} FROM ({catalog.ORACLE_SQL[name]})").fetchall())), name
    assert len(got["lineage_exact_lookup"]) == 25
    assert got["lineage_unmatched"] == ["(3,)", "(5,)"]
    assert len(got["lineage_nearest_ancestor"]) == 148 == len(got["dataset_override"])
