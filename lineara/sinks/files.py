"""Results as files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def publish(df: DataFrame, path: str, parts: list[str]) -> None:
    """Rows in folders by the parts of their paths; a rerun overwrites what it gives anew."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def write_json(documents: DataFrame, path: str) -> None:
    """JSON documents, one on each line."""
    documents.select("document").withColumnRenamed("document", "value").write.mode("overwrite").text(path)


def write_scripts(scripts: DataFrame, path: str, db: str = "db") -> None:
    """SQL patches in a folder for each database; a rerun overwrites them, so statements are never doubled."""
    rows = scripts.select(F.col(db).alias("db"), F.col("script").alias("value"))
    rows.write.mode("overwrite").partitionBy("db").option("lineSep", "\n\n").text(path)
