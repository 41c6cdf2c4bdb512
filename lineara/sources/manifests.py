"""Manifests of databases and of assemblies."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import naming


def read_core_manifest(spark: SparkSession, path: str) -> DataFrame:
    """core: each line after the header, trimmed; blank lines are dropped.

    A file's header is the line that begins its first block; other blocks begin behind it, so large files are read by
    many tasks.
    """
    lines = spark.read.option("header", True).option("enforceSchema", True).option("sep", "\x00").option("quote", "").schema("line string").csv(path)
    return lines.select(naming.trimmed(F.col("line")).alias("core")).where("core <> ''")


def read_assembly_manifest(spark: SparkSession, path: str) -> DataFrame:
    """gca and taxon_id by the names in the header."""
    return spark.read.schema(schemas.ASSEMBLY_MANIFEST).option("header", True).option("enforceSchema", False).csv(path)


def records(spark: SparkSession, rows: list, schema: str = schemas.RECORD) -> DataFrame:
    """Records given in the program."""
    return spark.createDataFrame(rows, schema)
