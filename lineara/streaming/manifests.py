"""Manifests that keep arriving: each batch is enriched and merged once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import enrich, merge


def manifest_stream(spark: SparkSession, folder: str, schema: str = schemas.ASSEMBLY_MANIFEST) -> DataFrame:
    """CSV manifests with a header as they appear in a folder."""
    return spark.readStream.schema(schema).option("header", True).csv(folder)


def merge_into(stream: DataFrame, target: str, checkpoint: str, key: list[str], value: list[str], buckets: int = 64):
    """Start a query that appends to the parquet table at target the rows whose key it lacks.

    The target lies in ``buckets`` folders by a hash of the key (column bucket); a batch reads the keys of the buckets
    that it has rows for. A batch that is repeated after a failure finds its rows there and adds none.
    """
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        rows = df.select(*key, *value).withColumn("bucket", bucket)
        touched = [r[0] for r in rows.select("bucket").distinct().limit(buckets).collect()]
        if not touched:
            return
        if _exists(spark, target):
            have = spark.read.schema(rows.schema).parquet(target).where(F.col("bucket").isin(touched))
        else:
            have = spark.createDataFrame([], rows.schema)
        merge.new_rows(have, rows, ["bucket", *key], value).write.mode("append").partitionBy("bucket").parquet(target)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def assembly_records(stream: DataFrame) -> DataFrame:
    """Records of a stream of assemblies; rows without an accession are left out."""
    return enrich.assembly_records(stream).where(F.col("gca").isNotNull())
