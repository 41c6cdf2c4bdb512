"""Metadata rows to columns, and records enriched by them in one join."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants


def to_rows(df: DataFrame, ids: list[str], columns: list[str], key: str = "meta_key", value: str = "meta_value") -> DataFrame:
    """Wide columns as key and value rows; nulls stay."""
    return df.unpivot(ids, columns, key, value)


def lookup(meta: DataFrame, key: str) -> DataFrame:
    """The rows of one key; the predicate reaches the source."""
    return meta.where(F.col("meta_key") == key)


def to_columns(meta: DataFrame, by: str | list[str], keys: dict[str, str]) -> DataFrame:
    """One row for each ``by`` with a column for each key (name of the column by key).

    Of several values of a key the least is taken, where an unordered source would give any. Sums are made before the
    shuffle, so a key that holds most rows does no harm.
    """
    by = [by] if isinstance(by, str) else by
    rows = meta.where(F.col("meta_key").isin(list(keys)))
    return rows.groupBy(*by).agg(*[F.min(F.when(F.col("meta_key") == k, F.col("meta_value"))).alias(name) for k, name in keys.items()])


def enrich(records: DataFrame, wide: DataFrame, on: str) -> DataFrame:
    """Every record with its metadata; nulls where there is none. Catalyst broadcasts wide if it is small."""
    return records.join(wide, on, "left")


def first_by(df: DataFrame, by: str, value: Column, order: Column, name: str) -> DataFrame:
    """For each ``by`` the value of the least order."""
    return df.groupBy(by).agg(F.min_by(value, order).alias(name))


def last_by(df: DataFrame, by: str, value: Column, order: Column, name: str) -> DataFrame:
    """For each ``by`` the value written last."""
    return df.groupBy(by).agg(F.max_by(value, order).alias(name))


def core_records(manifest: DataFrame, meta: DataFrame) -> DataFrame:
    """Records gca, taxon_id, core of a manifest of databases, from one pass over their metadata."""
    wide = to_columns(meta, "db", {constants.ACCESSION: "gca", constants.TAXONOMY_ID: "taxon_id"})
    return manifest.join(wide.withColumnRenamed("db", "core"), "core", "left").select("gca", "taxon_id", "core")


def assembly_records(manifest: DataFrame) -> DataFrame:
    """Records of a manifest of assemblies, which have no database."""
    return manifest.select("gca", "taxon_id", F.lit(constants.NO_DATABASE).alias("core"))


def fan_out(records: DataFrame, modes: list[str], name: str = "mode") -> DataFrame:
    """Each record once for each mode."""
    return records.withColumn(name, F.explode(F.array(*[F.lit(m) for m in modes])))
