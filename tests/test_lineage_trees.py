"""Nearest ancestors from links: pointers that double, and intervals."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lineara.operators import intervals, lineage
from lineara.queries import catalog


def random_tree(n, seed, deep=False):
    """child to parent; with deep most hang below the one before, else a third below one node."""
    r = random.Random(seed)
    up = {}
    for k in range(1, n):
        up[k] = k - 1 if deep and r.random() < 0.95 else 0 if r.random() < 0.3 else r.randrange(k) if r.random() < 0.9 else None
    return up


def nearest(up, map_, node, include_self=False):
    at, d = (node, 0) if include_self else (up.get(node), 1)
    while at is not None and at not in map_:
        at, d = up.get(at), d + 1
    return (node, map_[at], d) if at is not None else (node, None, None)


def frames(spark, up, map_):
    edges = spark.createDataFrame([*up.items(), *list(up.items())[:5], (None, 3)], "child long, parent long")
    return edges, spark.createDataFrame([(str(k), v) for k, v in map_.items()] + [("987654", "absent")], "taxon_id string, dataset string")


@pytest.mark.parametrize("deep", [False, True])
@pytest.mark.parametrize("include_self", [False, True])
def test_nearest_on_edges_and_in_intervals(spark, deep, include_self):
    up = random_tree(400, 5, deep)
    map_ = {k: f"set{k}" for k in random.Random(2).sample(range(1, 400), 25)}
    edges, datasets = frames(spark, up, map_)
    nodes = set(up) | {p for p in up.values() if p is not None}
    want = sorted(repr((*nearest(up, map_, k, include_self),)) for k in nodes)
    got = lineage.nearest_on_edges(edges, datasets, "child", "parent", include_self)
    assert sorted(repr((r.child, r.dataset, r.distance)) for r in got.collect()) == want
    lookups = spark.createDataFrame([(k,) for k in [*nodes, *[7] * 500, 10**9, None]], "taxon long")
    found = intervals.nearest(lookups, intervals.numbered(edges, "child", "parent"), datasets, "taxon", include_self)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and "ancestor" not in plan, "only mapped intervals have a row for each range"
    assert rows(found) == rows(got.where("dataset IS NOT NULL").select(F.col("child").alias("taxon"), "dataset"))


def test_chain_of_300_and_one_row_for_each_node(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lineage, "checkpointed", lambda df, f=lineage.checkpointed: seen.append(f(df)) or seen[-1])
    chain = spark.range(1, 300).selectExpr("id AS child", "id - 1 AS parent")
    datasets = spark.createDataFrame([("0", "root")], "taxon_id string, dataset string")
    got = {r.child: (r.dataset, r.distance) for r in lineage.nearest_on_edges(chain, datasets, "child", "parent").collect()}
    assert got == {0: (None, None)} | {k: ("root", k) for k in range(1, 300)}
    assert len(seen) <= 12 and all(df.count() <= 300 for df in seen)


def test_numbers_are_nested(spark):
    up = random_tree(300, 8)
    edges, _ = frames(spark, up, {})
    got = {r["node"]: (r["first"], r["last"]) for r in intervals.numbered(edges, "child", "parent").collect()}
    assert sorted(f for f, _ in got.values()) == list(range(1, len(got) + 1))

    def above(a, b):
        while b is not None and b != a:
            b = up.get(b)
        return b == a

    for a in random.Random(1).sample(sorted(got), 40):
        for b in got:
            assert (got[a][0] <= got[b][0] <= got[a][1]) == above(a, b)


def test_totals_of_subtrees(spark):
    up = random_tree(120, 3)
    edges, _ = frames(spark, up, {})
    values = spark.createDataFrame([(k, k * k) for k in range(0, 120, 2)], "id long, v long")
    want = {}
    for k in range(120):
        at = k
        while at is not None:
            n, v = want.get(at, (0, 0))
            want[at] = (n + 1, v + (k * k if k % 2 == 0 else 0))
            at = up.get(at)
    got = intervals.totals(intervals.numbered(edges, "child", "parent"), values, "id", "v")
    assert {r["node"]: (r["n_below"], r["v"]) for r in got.collect()} == want


@pytest.mark.parametrize("links", [[(1, 2), (2, 3), (3, 1), (4, 1)], [(1, 1)], [(1, 2), (2, 1), (5, 6)]])
def test_cycles_raise(spark, links):
    edges = spark.createDataFrame(links, "child long, parent long")
    datasets = spark.createDataFrame([("1", "a")], "taxon_id string, dataset string")
    with pytest.raises(ValueError, match="cycle"):
        lineage.nearest_on_edges(edges, datasets, "child", "parent")
    with pytest.raises(ValueError, match="cycle"):
        intervals.numbered(edges, "child", "parent")


def test_two_parents_and_no_rows(spark):
    edges = spark.createDataFrame([(1, 2), (1, 3)], "child long, parent long")
    datasets = spark.createDataFrame([("1", "a")], "taxon_id string, dataset string")
    with pytest.raises(ValueError, match="several"):
        lineage.nearest_on_edges(edges, datasets, "child", "parent")
    none = edges.where("child > 5")
    assert lineage.nearest_on_edges(none, datasets, "child", "parent").count() == 0
    assert intervals.nearest(none, intervals.numbered(none, "child", "parent"), datasets, "child").count() == 0


def test_lineage_queries_see_every_case(spark, sf):
    """Nearest, farther and no ancestors all occur in the registered queries."""
    near = catalog.lineage_nearest_ancestor(spark, sf).groupBy(F.left("dataset", F.lit(3)).alias("k")).count().collect()
    assert len(near) > 1 and catalog.lineage_unmatched(spark, sf).count() > 0
    edges = catalog.lineage_on_edges(spark, sf)
    assert edges.where("dataset IS NULL").count() > 0 and edges.where("distance = 1").count() > 0 and edges.where("distance > 2").count() > 0
