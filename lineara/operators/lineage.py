"""The nearest dataset up a taxon's ancestors."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import naming
from ..session import checkpointed


def parents_of(reports: DataFrame, content: str = "content") -> DataFrame:
    """parents of each taxonomy report in JSON: null where the report has none."""
    parsed = F.from_json(F.col(content), schemas.TAXONOMY_REPORT)
    return reports.withColumn("parents", F.get(parsed["reports"], F.lit(0))["taxonomy"]["parents"])


def ancestors(taxa: DataFrame, id_col: str, parents: str = "parents", include_self: bool = False) -> DataFrame:
    """A row for each ancestor: id, pos, ancestor, the nearest with the greatest pos. Parents come root first."""
    chain = F.col(parents).cast("array<string>")
    chain = F.array_append(chain, F.col(id_col).cast("string")) if include_self else chain
    return taxa.select(id_col, F.posexplode(chain).alias("pos", "ancestor"))


def nearest_dataset(taxa: DataFrame, lineage: DataFrame, id_col: str, parents: str = "parents", include_self: bool = False) -> DataFrame:
    """id and dataset of the nearest ancestor that the lineage map has; taxa without one are left out."""
    found = ancestors(taxa, id_col, parents, include_self).join(lineage.withColumnRenamed("taxon_id", "ancestor"), "ancestor")
    return found.groupBy(id_col).agg(F.max_by("dataset", "pos").alias("dataset"))


def unmatched(taxa: DataFrame, lineage: DataFrame, id_col: str, parents: str = "parents", include_self: bool = False) -> DataFrame:
    """Taxa no ancestor of which the map has."""
    hits = ancestors(taxa, id_col, parents, include_self).join(lineage.withColumnRenamed("taxon_id", "ancestor"), "ancestor").select(id_col).distinct()
    return taxa.join(hits, id_col, "left_anti")


def assigned(records: DataFrame, taxa: DataFrame, lineage: DataFrame, dataset: str | None = None) -> DataFrame:
    """Records with busco_dataset: the run's dataset if it has one, else the nearest ancestor's."""
    near = nearest_dataset(taxa, lineage, "taxon_id")
    return records.join(near, "taxon_id", "left").withColumn("busco_dataset", naming.override(dataset, F.col("dataset"))).drop("dataset")


def walk_up(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """child, ancestor, distance over a table of child and parent ids, however deep.

    Paths double in each round: those of exactly d steps are continued by all known ones, so a chain of n nodes takes
    log2(n) joins; each round ends in a checkpoint. A cycle raises ValueError. Rows with a null on either side are no
    links; a child with several parents has a row for each path.
    """
    steps = edges.where(F.col(child).isNotNull() & F.col(parent).isNotNull())
    known, d = checkpointed(steps.select(F.col(child).alias("child"), F.col(parent).alias("ancestor"), F.lit(1).cast("long").alias("distance"))), 1
    while True:
        if known.where("child = ancestor").head(1):
            raise ValueError(f"{child} and {parent} have a cycle")
        far = known.where(F.col("distance") == d).select("child", F.col("ancestor").alias("via"))
        if not far.head(1):
            return known
        more = far.join(known.withColumnsRenamed({"child": "via", "distance": "rest"}), "via")
        known, d = checkpointed(known.union(more.select("child", "ancestor", F.col("rest") + d))), 2 * d


def tree(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """node, up: each node once, those that are only parents too; roots have a null up. Stored, since what uses it goes over it often.

    A row with a null parent names a root, one with a null child is no link, equal rows count once. A node with two
    parents raises ValueError.
    """
    links = edges.where(F.col(child).isNotNull()).select(F.col(child).alias("node"), F.col(parent).alias("up"))
    both = links.unionByName(links.where("up IS NOT NULL").select(F.col("up").alias("node"), F.lit(None).cast(links.schema["up"].dataType).alias("up")))
    nodes = checkpointed(both.groupBy("node").agg(F.max("up").alias("up"), F.min("up").alias("_least")))
    if nodes.where("up <> _least").head(1):
        raise ValueError(f"a {child} has several of {parent}")
    return nodes.drop("_least")


def climb(state: DataFrame, step, what: str) -> DataFrame:
    """state (node, up and more) after its pointers have doubled until all have passed their root.

    Each round joins the open rows, those whose pointer still leads to a node, with all rows once and calls
    step(open, state, distance), which gives the open rows anew; the others stay. So the state never has more rows than
    there are nodes, and a chain of n nodes takes log2(n) rounds, each ending in a checkpoint. A cycle never passes a
    root: it raises ValueError when pointers are longer than there are nodes.
    """
    distance, nodes = 1, None
    while True:
        open_ = state.where("up IS NOT NULL")
        if not open_.head(1):
            return state
        nodes = state.count() if nodes is None else nodes
        if distance > nodes:
            raise ValueError(f"{what} have a cycle")
        state, distance = checkpointed(state.where("up IS NULL").unionByName(step(open_, state, distance))), 2 * distance


def once(datasets: DataFrame) -> DataFrame:
    """The map with one dataset for each taxon, the least."""
    return datasets.groupBy("taxon_id").agg(F.min("dataset").alias("dataset"))


def nearest_on_edges(edges: DataFrame, datasets: DataFrame, child: str, parent: str, include_self: bool = False) -> DataFrame:
    """child, dataset, distance for every node of a tree given by its links; nulls where no ancestor is in the map.

    Pointers double and carry a label: after k rounds a node knows the nearest mapped ancestor within 2^k steps. So no
    row stands for a pair of a node and an ancestor.
    """
    nodes = tree(edges, child, parent)
    labels = once(datasets).select(F.col("taxon_id").cast(nodes.schema["node"].dataType).alias("_at"), F.col("dataset"))
    of = F.col("node") if include_self else F.col("up")
    state = nodes.join(labels, of == F.col("_at"), "left").select("node", "up", "dataset", F.when(F.col("_at").isNotNull(), F.lit(0 if include_self else 1).cast("long")).alias("distance"))

    def step(open_, state, distance):
        far = state.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("dataset").alias("_dataset"), (F.col("distance") + distance).alias("_distance"))
        return open_.join(far, "up").select("node", F.col("_up").alias("up"), F.coalesce("dataset", "_dataset").alias("dataset"), F.coalesce("distance", "_distance").alias("distance"))

    return climb(checkpointed(state), step, f"{child} and {parent}").select(F.col("node").alias(child), "dataset", "distance")
