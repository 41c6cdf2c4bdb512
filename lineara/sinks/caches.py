"""Results of earlier runs in buckets of their key's hash, with a Bloom filter for each bucket, so a probe opens few files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists, stored

#: Bits of one block of a filter, which is what Spark's bitmaps have; a key sets HASHES of them in its block.
BLOCK, HASHES = 32768, 4


def _place(key: list[str], buckets: int, blocks: int) -> tuple[Column, Column, Column]:
    """bucket, block and bits of a key. Null parts are parts like any other."""
    parts = [F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in key]), {"ignoreNullFields": "false"})]
    bit = lambda n: F.pmod(F.xxhash64(*parts, F.lit(n)), F.lit(BLOCK)).cast("int")
    bucket = F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")
    return bucket, F.pmod(F.xxhash64(*parts, F.lit(-1)), F.lit(blocks)).cast("int"), F.array(*[bit(n) for n in range(HASHES)])


class Cache:
    """Rows by key in path/rows (partitioned by bucket) and their filters in path/filters.

    blocks is the number of filter blocks a bucket has: one holds about 4,000 keys at a rate of one false hit in forty.
    Filters are bitwise sums, made before the shuffle by Spark's own functions, and those of several appends are put
    together when they are read. buckets, blocks and key have to be the same in all uses of a cache.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], schema: str, buckets: int = 64, blocks: int = 4):
        self.spark, self.path, self.key, self.schema, self.buckets, self.blocks = spark, path.rstrip("/"), key, schema, buckets, blocks

    def append(self, rows: DataFrame) -> None:
        """New results. The filters are written first: one that is too full does no harm, a missing one would hide rows."""
        bucket, block, bits = _place(self.key, self.buckets, self.blocks)
        rows = stored(rows, "cache-rows")
        marks = rows.select(bucket.alias("bucket"), block.alias("block"), F.explode(bits).alias("bit"))
        filters = marks.groupBy("bucket", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
        filters.write.mode("append").parquet(f"{self.path}/filters")
        rows.withColumn("bucket", bucket).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/rows")

    def rows(self) -> DataFrame:
        """All rows."""
        if not exists(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema + ", bucket int").parquet(f"{self.path}/rows").drop("bucket")

    def hopeful(self, requests: DataFrame) -> DataFrame:
        """Requests whose key may be there, by the filters alone, with its bucket."""
        bucket, block, bits = _place(self.key, self.buckets, self.blocks)
        asked = requests.withColumns({"bucket": bucket, "_block": block, "_bits": bits})
        filters = self.spark.read.schema("bucket int, block int, bits binary").parquet(f"{self.path}/filters").groupBy("bucket", F.col("block").alias("_block")).agg(F.bitmap_or_agg("bits").alias("_set"))
        byte = lambda b: F.conv(F.hex(F.substring("_set", F.floor(b / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.forall("_bits", lambda b: F.floor(byte(b) / F.pow(F.lit(2), b % 8)) % 2 == 1)
        return asked.join(filters, ["bucket", "_block"]).where(is_set).select(*requests.columns, "bucket")

    def lookup(self, requests: DataFrame) -> DataFrame:
        """Rows of the keys asked for. Only the buckets in which a filter has hope for one of them are opened."""
        if not exists(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], self.schema)
        keys = requests.select(*self.key).distinct()
        found = stored(self.hopeful(keys), "cache-hopes")
        buckets = [r[0] for r in found.select("bucket").distinct().collect()]  # at most as many as there are buckets
        rows = self.spark.read.schema(self.schema + ", bucket int").parquet(f"{self.path}/rows").where(F.col("bucket").isin(buckets))
        same = F.lit(True)
        for k in self.key:
            same = same & rows[k].eqNullSafe(found[k])
        return rows.join(found, same & (rows["bucket"] == found["bucket"]), "left_semi").drop("bucket")

    def probe(self, requests: DataFrame) -> DataFrame:
        """requests with cached: whether the cache has their key."""
        known = self.lookup(requests).select(*self.key).distinct().withColumn("cached", F.lit(True))
        same = F.lit(True)
        for k in self.key:
            same = same & requests[k].eqNullSafe(known[k])
        return requests.join(known, same, "left").select(*[requests[c] for c in requests.columns], F.coalesce("cached", F.lit(False)).alias("cached"))
