"""Named files published in two phases, so a tree is never seen, or left, half written.

Below the root stand, besides the files: _published (a Parquet table of each file's path and digest), and while a
publication goes on _attempt-ID, with the new files under their names and the table that will replace the old one.

1. Tasks write the files whose digest is new into the attempt. If anything fails, the tree is as it was.
2. The driver writes _attempt-ID/_ready. From here on the publication counts as done; what is left can be repeated.
3. Tasks move the files to their places, the table is replaced, and the attempt goes.

A run that finds an attempt with _ready finishes it first; one without is a failed run's, and goes.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists, stored

PUBLISHED = "path string, digest string"
TABLE, ATTEMPT, READY = "_published", "_attempt-", "_ready"


def _files(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _writer(root: str, attempt: str):
    def write(batches):
        import posixpath

        import pyarrow as pa

        system, base = _files(root)
        for batch in batches:
            for path, text in zip(*(c.to_pylist() for c in batch.columns)):
                to = posixpath.join(base, attempt, "files", path)
                system.create_dir(posixpath.dirname(to), recursive=True)
                part = f"{to}.{uuid.uuid4().hex}.part"
                with system.open_output_stream(part) as f:
                    f.write(text.encode("utf-8"))
                system.move(part, to)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return write


def _mover(root: str, attempt: str):
    def move(batches):
        import posixpath

        import pyarrow as pa
        from pyarrow import fs

        system, base = _files(root)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source, to = posixpath.join(base, attempt, "files", path), posixpath.join(base, path)
                if system.get_file_info(source).type == fs.FileType.File:  # else an earlier try has moved it
                    system.create_dir(posixpath.dirname(to), recursive=True)
                    system.move(source, to)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return move


def published(spark: SparkSession, root: str) -> DataFrame:
    """path and digest of the files of a root."""
    return spark.read.schema(PUBLISHED).parquet(f"{root}/{TABLE}") if exists(spark, f"{root}/{TABLE}") else spark.createDataFrame([], PUBLISHED)


def _promote(spark: SparkSession, root: str, attempt: str) -> None:
    at = f"{root}/{attempt}"
    spark.read.schema(PUBLISHED).parquet(f"{at}/changed").select("path").mapInArrow(_mover(root, attempt), "n long").agg(F.sum("n")).collect()
    system, new = _hadoop(spark, f"{at}/table")
    if system.exists(new):
        _, old = _hadoop(spark, f"{root}/{TABLE}")
        system.delete(old, True)
        system.rename(new, old)
    system.delete(_hadoop(spark, at)[1], True)


def recover(spark: SparkSession, root: str) -> None:
    """Finish a publication that was interrupted after it was decided, and clear away one that wasn't."""
    if not exists(spark, root):
        return
    system, path = _hadoop(spark, root)
    for status in system.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(ATTEMPT):
            if exists(spark, f"{root}/{name}/{READY}"):
                _promote(spark, root, name)
            else:
                system.delete(status.getPath(), True)


def publish(df: DataFrame, root: str, folder: Column, name: Column, content: Column) -> dict:
    """A file root/folder/name for each row: {"files": how many there are, "written": how many of them were new or changed}.

    Rows without a folder, name or content give no file; of rows with one path the greatest content is written. Files
    of earlier publications that this one doesn't name stay. One publication of a root goes on at a time.
    """
    spark = df.sparkSession
    if ":" not in root:
        import os

        root = "file://" + os.path.abspath(root)
    recover(spark, root)
    rows = df.select(F.concat(folder, F.lit("/"), name).alias("path"), content.cast("string").alias("text")).where("path IS NOT NULL AND text IS NOT NULL")
    rows = stored(rows.groupBy("path").agg(F.max("text").alias("text")).withColumn("digest", F.sha2("text", 256)), "published")
    known = published(spark, root)
    changed = rows.join(known, ["path", "digest"], "left_anti")
    n, written = rows.count(), 0
    attempt = ATTEMPT + uuid.uuid4().hex
    changed.select("path", "digest").write.parquet(f"{root}/{attempt}/changed")
    changed = rows.join(spark.read.schema(PUBLISHED).parquet(f"{root}/{attempt}/changed").select("path"), "path", "left_semi")
    written = changed.select("path", "text").mapInArrow(_writer(root, attempt), "n long").agg(F.sum("n")).first()[0] or 0
    if written:
        known.join(rows, "path", "left_anti").unionByName(rows.select("path", "digest")).write.parquet(f"{root}/{attempt}/table")
        system, ready = _hadoop(spark, f"{root}/{attempt}/{READY}")
        system.create(ready).close()
        _promote(spark, root, attempt)
    else:
        system, at = _hadoop(spark, f"{root}/{attempt}")
        system.delete(at, True)
    return {"files": n, "written": written}
