"""Sequences in FASTA files and texts."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fields(record: Column) -> list[Column]:
    """id, description, residues and length of a record without its leading sign: a header line, then lines of residues."""
    header, body = F.substring_index(record, "\n", 1), F.regexp_replace(record, r"^[^\n]*+\n?", "")
    header = F.trim(F.regexp_replace(F.regexp_replace(header, r"\r$", ""), r"\s", " "))
    residues = F.regexp_replace(body, r"\s++", "")
    description = F.nullif(F.trim(F.regexp_replace(header, r"^\S*+", "")), F.lit(""))
    return [F.substring_index(header, " ", 1).alias("id"), description.alias("description"), residues.alias("residues"), F.length(residues).cast("long").alias("length")]


def records(df: DataFrame, ids: list[str], text: str) -> DataFrame:
    """ids, ordinal, id, description, residues, length of each record in a column of FASTA texts; what comes before the first one is left out."""
    parts = F.filter(F.split(F.concat(F.lit("\n"), F.col(text)), "\n>"), lambda x, i: i > 0)
    return df.select(*ids, F.posexplode(parts).alias("ordinal", "_record")).select(*ids, "ordinal", *_fields(F.col("_record")))


def read_sequences(spark: SparkSession, path: str, pattern: str = "*.fa*") -> DataFrame:
    """path, id, description, residues, length of each record of the files below path whose names fit the pattern.

    A record ends where a line begins with the sign of the next, and that is where Spark's reader cuts: a large file is
    read by many tasks, each of which takes the records that begin in its split. Files begin with a record; compressed
    ones are read by one task each. A record is a row, so it has to fit in a task.
    """
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("lineSep", "\n>").text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", r"^\s*+>", "").alias("_record"))
    return rows.where(F.trim(F.translate("_record", "\r\n\t", "   ")) != "").select("path", *_fields(F.col("_record")))


def counts(sequences: DataFrame) -> DataFrame:
    """path, records, residues, shortest, longest of each file."""
    n = F.col("length")
    return sequences.groupBy("path").agg(F.count(F.lit(1)).alias("records"), F.sum(n).alias("residues"), F.min(n).alias("shortest"), F.max(n).alias("longest"))
