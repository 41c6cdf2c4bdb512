"""Trees as intervals: a node's descendants are a run of numbers, so questions on ancestors are range searches."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from . import lineage


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sizes(nodes: DataFrame, what: str = "nodes") -> DataFrame:
    """nodes (node, up) with size, the number of a node's descendants and itself, by pointers that double.

    After k rounds size counts what is less than 2^k steps below; a round adds the sizes of those exactly 2^k below.
    Sums are made before the shuffle, so a node with very many children does no harm.
    """
    parents = nodes.select("node", F.col("up").alias("parent"))

    def step(open_, state, distance):
        far = state.select(F.col("node").alias("up"), F.col("up").alias("_up"))
        below = open_.groupBy("up").agg(F.sum("size").alias("_gain")).withColumnRenamed("up", "node")
        moved = open_.join(far, "up").select("node", F.col("_up").alias("up"), "size")
        ends.append(checkpointed(state.where("up IS NULL").join(below, "node").select("node", "_gain")))
        return moved.join(below, "node", "left").select("node", "up", (F.col("size") + F.coalesce("_gain", F.lit(0))).alias("size"))

    ends: list = []
    state = lineage.climb(checkpointed(nodes.withColumn("size", F.lit(1).cast("long"))), step, what)
    for more in ends:  # what nodes gained after their pointers had passed the root
        state = state.unionByName(more.select("node", F.lit(None).cast(state.schema["up"].dataType).alias("up"), F.col("_gain").alias("size")))
    total = state.groupBy("node").agg(F.sum("size").alias("size"))
    return total.join(parents, "node").withColumnRenamed("parent", "up")


def before(rows: DataFrame, by: str, order: str, value: str, name: str) -> DataFrame:
    """rows with the sum of value over those of the same ``by`` that come earlier in the order; no group is ever in one task.

    Rows are sorted into ranges; each range sums up its own part of a group, and what earlier ranges have of it (a row
    for each range) is added.
    """
    n = _partitions(rows.sparkSession)
    dealt = checkpointed(rows.repartitionByRange(n, by, order).withColumn("_range", F.spark_partition_id()))
    inside = F.sum(value).over(Window.partitionBy("_range", by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    earlier = F.sum("_sum").over(Window.partitionBy(by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    sums = dealt.groupBy("_range", by).agg(F.sum(value).alias("_sum")).select("_range", by, F.coalesce(earlier, F.lit(0)).alias("_earlier"))
    found = dealt.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(sums, ["_range", by])
    return found.select(*rows.columns, (F.col("_inside") + F.col("_earlier")).cast("long").alias(name))


def numbered(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """node, first, last: numbers from 1 in which each node comes before its descendants, which end at last. Stored."""
    nodes = lineage.tree(edges, child, parent)
    sized = checkpointed(sizes(nodes, f"{child} and {parent}")).withColumn("_of", F.coalesce(F.col("up").cast("string"), F.lit("")))
    placed = before(sized, "_of", "node", "size", "_before").select("node", "up", "size", (F.col("_before") + 1).alias("first"))

    def step(open_, state, distance):
        far = state.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("first").alias("_first"))
        return open_.join(far, "up").select("node", F.col("_up").alias("up"), "size", (F.col("first") + F.col("_first")).alias("first"))

    state = lineage.climb(checkpointed(placed), step, f"{child} and {parent}")
    return state.select("node", "first", (F.col("first") + F.col("size") - 1).alias("last"))


def totals(tree: DataFrame, values: DataFrame, on: str, value: str) -> DataFrame:
    """node, n_below, value: for each node the number of nodes below it and itself, and the sum of their values.

    A subtree is a run of numbers, so its sum is the difference of two running sums, whatever its size.
    """
    nodes = tree.join(values.select(F.col(on).alias("node"), F.col(value).cast("long").alias("_v")), "node", "left")
    nodes = nodes.select("node", "first", "last", F.coalesce("_v", F.lit(0).cast("long")).alias("_v")).withColumn("_all", F.lit(0))
    running = checkpointed(before(nodes, "_all", "first", "_v", "_before"))
    ends = running.select(F.col("first").alias("last"), (F.col("_before") + F.col("_v")).alias("_through"))
    found = running.join(ends, "last")
    return found.select("node", (F.col("last") - F.col("first") + 1).alias("n_below"), (F.col("_through") - F.col("_before")).alias(value))


def nearest(lookups: DataFrame, tree: DataFrame, datasets: DataFrame, on: str, include_self: bool = False) -> DataFrame:
    """on, dataset: for each node asked for (once, however often it comes) the dataset of its nearest ancestor in the map.

    tree: see numbered(). The numbers are cut into ranges; a task sweeps its range with the mapped intervals that begin
    in it or reach into it, in order, and a stack of those that are open, whose top is the nearest. An interval that
    spans many ranges has a row in each, which is bounded by their number; no row stands for a pair of a node and an
    ancestor. Nodes that the tree lacks, or without a mapped ancestor, give no row.
    """
    n = _partitions(tree.sparkSession)
    most = max(1, tree.agg(F.max("last")).first()[0] or 1)
    kind = tree.schema["node"].dataType
    marks = lineage.once(datasets).select(F.col("taxon_id").cast(kind).alias("node"), "dataset").join(tree, "node")
    part = lambda at: F.expr(f"CAST(({at} - 1) * {n} div {most} AS INT)")
    marks = marks.select(F.explode(F.sequence(part("first"), part("last"))).alias("part"), "first", F.lit(0 if include_self else 2).alias("turn"), "last", "dataset", F.lit(None).cast(kind).alias("node"))
    points = lookups.select(F.col(on).cast(kind).alias("node")).distinct().join(tree, "node")
    points = points.select(part("first").alias("part"), "first", F.lit(1).alias("turn"), F.lit(None).cast("long").alias("last"), F.lit(None).cast("string").alias("dataset"), "node")

    def sweep(batches):
        import pyarrow as pa

        now, stack = None, []
        for batch in batches:
            nodes, found = [], []
            columns = [c.to_pylist() for c in batch.columns[:5]]
            for k, (part, first, turn, last, dataset) in enumerate(zip(*columns)):
                if part != now:
                    now, stack = part, []
                while stack and stack[-1][0] < first:
                    stack.pop()
                if turn != 1:
                    stack.append((last, dataset))
                elif stack:
                    nodes.append(k)
                    found.append(stack[-1][1])
            yield pa.RecordBatch.from_arrays([batch.column(5).take(pa.array(nodes, pa.int64())), pa.array(found, pa.string())], names=[on, "dataset"])

    both = marks.unionByName(points).repartitionById(n, "part").sortWithinPartitions("part", "first", "turn")
    return both.mapInArrow(sweep, f"`{on}` {kind.simpleString()}, dataset string")
