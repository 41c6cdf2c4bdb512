"""Taxonomy reports: from files, or from a web service for the ids of a frame."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lineage
from ..session import exists, stored

ANSWER = "taxon_id string, content string, error string"


def read_taxa(spark: SparkSession, path: str) -> DataFrame:
    """taxon_id (the file's name) and parents of reports in JSON files; null where a report has none."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    files = files.select(F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1).alias("taxon_id"), F.col("value").alias("content"))
    return lineage.parents_of(files).select("taxon_id", "parents")


def asked(ids: DataFrame, url: str, timeout: float = 10, partitions: int = 4, rate: float = 3, retries: int = 3, wait: float = 1) -> DataFrame:
    """ANSWER for each distinct taxon_id of ids, from url/ID/dataset_report.

    partitions tasks ask at most ``rate`` times a second each. What the service may answer later (no connection, 429,
    5xx) is asked again up to ``retries`` times, after wait, 2 * wait, 4 * wait seconds; any other refusal is final. An
    id without an answer has its error, and the others go on. Ids go from the frame to the tasks, not by the driver.
    """

    def ask(batches):
        import time
        from urllib.error import HTTPError
        from urllib.parse import quote
        from urllib.request import urlopen

        import pyarrow as pa

        due = time.monotonic()

        def answer(taxon):
            nonlocal due
            error = None
            for attempt in range(retries + 1):
                time.sleep(max(0.0, due - time.monotonic()) + (wait * 2 ** (attempt - 1) if attempt else 0))
                due = time.monotonic() + 1 / rate
                try:
                    with urlopen(f"{url.rstrip('/')}/{quote(taxon, safe='')}/dataset_report", timeout=timeout) as got:
                        return taxon, got.read().decode("utf-8"), None
                except HTTPError as e:
                    error = str(e)
                    if e.code != 429 and e.code < 500:
                        break
                except (OSError, ValueError) as e:
                    error = str(e)
            return taxon, None, error

        for batch in batches:
            rows = [answer(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], names=["taxon_id", "content", "error"])

    wanted = ids.select(F.col("taxon_id").cast("string").alias("taxon_id")).where("taxon_id IS NOT NULL").distinct()
    return wanted.repartition(partitions, "taxon_id").mapInArrow(ask, ANSWER)


def lookup(ids: DataFrame, url: str, answers: str, **how) -> DataFrame:
    """taxon_id, parents, error for each distinct taxon_id of ids; answers is a table that keeps what the service said.

    Only ids that the table lacks are asked for (see asked() for how), at once, and once: their answers are stored
    before anything reads them, and those without an error join the table.
    """
    spark = ids.sparkSession
    wanted = stored(ids.select(F.col("taxon_id").cast("string").alias("taxon_id")).where("taxon_id IS NOT NULL").distinct(), "taxon-ids")
    known = spark.read.schema("taxon_id string, content string").parquet(answers) if exists(spark, answers) else spark.createDataFrame([], "taxon_id string, content string")
    fresh = stored(asked(wanted.join(known.select("taxon_id"), "taxon_id", "left_anti"), url, **how), "taxon-answers")
    fresh.where("error IS NULL").select("taxon_id", "content").write.mode("append").parquet(answers)
    kept = spark.read.schema("taxon_id string, content string").parquet(answers).groupBy("taxon_id").agg(F.max("content").alias("content"))
    told = wanted.join(kept, "taxon_id").select("taxon_id", "content", F.lit(None).cast("string").alias("error"))
    return lineage.parents_of(told.unionByName(fresh.where("error IS NOT NULL"))).select("taxon_id", "parents", "error")
