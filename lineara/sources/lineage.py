"""The map from taxa to lineage datasets, and the list of the datasets' names."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    """taxon_id, dataset of a JSON object with a dataset for each taxon id."""
    pairs = F.explode(F.from_json("value", "map<string,string>"))
    return spark.read.text(path, wholetext=True).select(pairs.alias("taxon_id", "dataset"))


def read_lineage_names(spark: SparkSession, path: str) -> DataFrame:
    """dataset: one name on each line, without a header."""
    return spark.read.text(path).select(F.trim("value").alias("dataset")).where("dataset <> ''")
