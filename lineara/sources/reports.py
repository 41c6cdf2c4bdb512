"""Whole report files, found by pattern, and paths of files that are never read."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """path, name, content of each file below path whose name fits the pattern."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("content"))


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """The summaries below path."""
    return read_files(spark, path, "*_short_summary.txt")


def list_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path, length of files such as sequences; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length")


def read_scripts(spark: SparkSession, path: str) -> DataFrame:
    """db (the file's name), path and script of all .sql files below path."""
    files = read_files(spark, path, "*.sql")
    return files.select(F.regexp_extract("name", r"^(.*)\.sql$", 1).alias("db"), "path", F.col("content").alias("script"))
