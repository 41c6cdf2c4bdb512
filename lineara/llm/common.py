"""Shared folder, column checks and partition counts for the operators of this subpackage."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir


def saved(df: DataFrame, what: str) -> DataFrame:
    """Write df to the shared folder and read it back: its lineage ends there, and lost executors cost nothing twice."""
    spark = df.sparkSession
    path = shared_dir(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, *more: str, text: str = "text") -> DataFrame:
    """doc_id as long, text as string with null read as empty, and the columns named; all others go."""
    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")]
    return docs.select(*cols, *[F.col(c) for c in more])


def partitions(df: DataFrame) -> int:
    """As many as the session's shuffles have, or as the tables that df reads have splits if those are more.

    Only sizes that the planner knows are asked for; nothing is run.
    """
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    split = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    known = sum(n for n in sizes if n < 1 << 60)  # rows given by a program have no size
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-known // split))


KEPT: dict = {}


def kept(what, make):
    """make(), kept in this Python worker for its next tasks; what other operators kept there goes."""
    if what not in KEPT:
        KEPT.clear()
        KEPT[what] = make()
    return KEPT[what]


def arrow_schema(ddl: str):
    """The pyarrow schema of a DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(ddl))
