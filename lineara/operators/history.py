"""The history of patches: a log in segments, views of it by first or last write, and compaction."""

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists

KEY = ["db", "species_id", "meta_key"]
ROW = "db string, species_id int, meta_key string, meta_value string, run string, seq long, ordinal long"


def last_write(rows: DataFrame, key: list[str], value: list[str], order: list[Column]) -> DataFrame:
    """key and value of each key's last row by the order (of equal rows the greatest value): what replacing writes leave."""
    return rows.groupBy(*key).agg(F.max(F.struct(*[o.alias(f"_{k}") for k, o in enumerate(order)], *value)).alias("_v")).select(*key, *[F.col(f"_v.{c}").alias(c) for c in value])


def first_write(rows: DataFrame, key: list[str], value: list[str], order: list[Column]) -> DataFrame:
    """key and value of each key's first row by the order: what inserts that ignore known keys leave."""
    return rows.groupBy(*key).agg(F.min(F.struct(*[o.alias(f"_{k}") for k, o in enumerate(order)], *value)).alias("_v")).select(*key, *[F.col(f"_v.{c}").alias(c) for c in value])


class PatchLog:
    """Patches (db, species_id, meta_key, meta_value and an ordinal) of runs, in the folder path, written once each.

    A run appends a segment, path/segments/SEQ-HASH, in files by the key's hash, sorted by key; HASH is the run's, so a run that is
    in the log already adds nothing, and a segment that fails is written anew. compact() writes the first and the last row of each key of all segments into one, path/compacted/SEQ, and
    then path/compacted/SEQ/_SUCCESS makes readers take it in place of those segments, so both views stay as they were.
    One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _list(self, folder: str) -> list[str]:
        if not exists(self.spark, f"{self.path}/{folder}"):
            return []
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
        return sorted(n for n in names if exists(self.spark, f"{self.path}/{folder}/{n}/_SUCCESS"))

    def segments(self) -> list[str]:
        """The folders that make up the log now."""
        whole = self._list("compacted")[-1:]
        covered = int(whole[0]) if whole else -1
        return [f"compacted/{n}" for n in whole] + [f"segments/{n}" for n in self._list("segments") if int(n.split("-")[0]) > covered]

    def rows(self) -> DataFrame:
        parts = [f"{self.path}/{n}" for n in self.segments()]
        return self.spark.read.schema(ROW).parquet(*parts) if parts else self.spark.createDataFrame([], ROW)

    def append(self, patch: DataFrame, run: str) -> int:
        """The run's patch as a new segment; its number, or that of the segment that has the run already."""
        mark, names = hashlib.sha1(run.encode()).hexdigest(), self._list("segments")
        for name in names:
            if name.split("-")[1] == mark:
                return int(name.split("-")[0])
        seq = max([int(n.split("-")[0]) for n in names], default=-1) + 1
        ordinal = F.col("ordinal").cast("long") if "ordinal" in patch.columns else F.lit(0).cast("long")
        rows = patch.select(*KEY, "meta_value", F.lit(run).alias("run"), F.lit(seq).cast("long").alias("seq"), ordinal.alias("ordinal"))
        self._write(rows, f"segments/{seq:012d}-{mark}")
        return seq

    def _write(self, rows: DataFrame, to: str) -> None:
        rows.repartition(self.buckets, *KEY).sortWithinPartitions(*KEY).write.mode("overwrite").parquet(f"{self.path}/{to}")

    def view(self, kind: str) -> DataFrame:
        """KEY and meta_value by the "last" or the "first" write."""
        take = {"last": last_write, "first": first_write}[kind]
        return take(self.rows(), KEY, ["meta_value"], [F.col("seq"), F.col("ordinal")])

    def compact(self) -> int:
        """Rows of the log afterwards: two for each key at most."""
        names = self.segments()
        if not names:
            return 0
        rows = self.rows()
        fields = ["seq", "ordinal", "meta_value", "run"]
        ends = rows.groupBy(*KEY).agg(F.min(F.struct(*fields)).alias("a"), F.max(F.struct(*fields)).alias("b"))
        kept = ends.select(*KEY, F.explode(F.array_distinct(F.array("a", "b"))).alias("v")).select(*KEY, *[F.col(f"v.{f}").alias(f) for f in fields])
        seq = max(int(n.split("/")[1].split("-")[0]) for n in names)
        self._write(kept, f"compacted/{seq:012d}")
        return self.rows().count()
