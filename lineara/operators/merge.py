"""Rows into a table that has some of them already, and cached results."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_rows(target: DataFrame, patch: DataFrame, key: list[str], value: list[str]) -> DataFrame:
    """Patch rows whose key the target lacks, one for each key (the least values): what an insert that ignores
    duplicates would add. An existing key is never updated."""
    least = F.min(F.struct(*value)).alias("v")
    once = patch.groupBy(*key).agg(least).select(*key, *[F.col(f"v.{c}").alias(c) for c in value])
    return once.join(target.select(*key), key, "left_anti")


def insert_ignore(target: DataFrame, patch: DataFrame, key: list[str], value: list[str]) -> DataFrame:
    """The target after the patch; doing it twice changes nothing."""
    return target.select(*key, *value).unionByName(new_rows(target, patch, key, value))


def probe(requests: DataFrame, cache: DataFrame, key: list[str]) -> DataFrame:
    """requests with cached: whether the cache has their key."""
    known = cache.select(*key).distinct().withColumn("cached", F.lit(True))
    return requests.join(known, key, "left").withColumn("cached", F.coalesce("cached", F.lit(False)))


def missing(requests: DataFrame, cache: DataFrame, key: list[str]) -> DataFrame:
    """What has to be computed, since the cache lacks it."""
    return requests.join(cache.select(*key), key, "left_anti")
