"""A training corpus from documents: five stages, each over all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a frame; its rows are written as Parquet and read again as the next
stage's docs. All but the last keep the columns of documents.

In every stage nulls, empty and very long texts, equal rows and further columns are treated as the operator's module says; a
stage over an empty table gives an empty table with its columns. A row without doc_id is a document that nothing else
can be compared with: it passes line dedup and near duplicates unchanged.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineara.llm import fm_index, language, line_dedup, packing, simhash
from lineara.llm.common import saved
from lineara.session import MADE, discard, ship

#: A document's language is rejected where fewer of its n-grams are known.
LEAST_SCORE = 0.3
HAS_WORD = r"[^\x20\x09-\x0D]"
#: The columns of documents; further ones, whatever their names, go in the first stage.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(*COLUMNS)


def _counted(docs: DataFrame) -> DataFrame:
    """Documents that still have a word, with n_chars for their present text."""
    return docs.where(F.col("text").rlike(HAS_WORD)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels teach. Those without a letter go, null texts too; null labels are predicted like others."""
    docs = _documents(docs)
    said = language.identify(docs, language.learn(docs))
    return said.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that recur are cut from all but their first document; documents without a word left go, blank and null texts too.

    Rows equal in doc_id and text are one document and are cut alike."""
    return _counted(line_dedup.dedup_lines(_documents(docs)))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near-duplicates, and all rows without doc_id.

    Of rows equal in doc_id and text one stays, the first by its other columns; rows with one doc_id and different texts are
    judged by their doc_id. Texts aren't shuffled to find equal rows: only those of doc_ids that come more than once are.
    """
    docs = _documents(docs)
    gone = simhash.similar_documents(docs).where("doc_id <> component_id").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    twice = saved(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    if not twice.head(1):
        return left
    ties = left.join(twice, "doc_id").groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("v"))
    return left.join(twice, "doc_id", "left_anti").select(*COLUMNS).unionByName(ties.select("doc_id", "text", "v.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents without a word left go. Equal rows are cut alike, and an empty benchmark cuts nothing."""
    docs = _documents(docs)
    return _counted(fm_index.cleaned(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences whose sources keep the corpus's proportions. A null source is a source; equal rows are packed each."""
    return packing.pack(_documents(docs))


STAGES = [
    ("language", identify_language),
    ("line_dedup", dedup_lines),
    ("near_duplicates", dedup_near),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Fingerprints, n-gram filters and tokenizers have no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus of sf_dir. A stage's working files are deleted when the next stage's documents are written."""
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    since = len(MADE)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
        discard(spark, since, (MADE[-1],))
    return STAGES[-1][1](spark, docs, sf_dir)
