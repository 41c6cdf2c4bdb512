"""Parsed reports as metadata rows, JSON documents and SQL patches."""

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants


def prefix(mode: Column) -> Column:
    """assembly. for genomes, genebuild. for all else."""
    return F.when(mode.isin(constants.GENOME_MODES), "assembly.").otherwise("genebuild.")


def to_eav(parsed: DataFrame, ids: list[str], compat: bool = False) -> DataFrame:
    """A row for each metakey of a usable report: ids, ordinal, meta_key, meta_value.

    Missing fields give no row, or with compat the text None. The erroneous share is a key of one mode only.
    """
    pairs = []
    for n, (column, key) in enumerate(constants.METAKEYS.items()):
        value = F.col(column).cast("string")
        value = F.coalesce(value, F.lit("None")) if compat and column != "erroneous" else value
        pairs.append(F.struct(F.lit(n).alias("ordinal"), F.concat(prefix(F.col("run_mode")), F.lit(key)).alias("meta_key"), value.alias("meta_value")))
    return parsed.where("reason IS NULL").select(*ids, F.inline(F.array(*pairs))).where("meta_value IS NOT NULL")


def to_json(parsed: DataFrame, db: str = "db") -> DataFrame:
    """db, name and document of each usable report: the metakeys in order and then the database; the total is a number."""
    def document(head: str) -> Column:
        fields = [(F.col(c) if c == "total" else F.col(c).cast("string")).alias(head + k) for c, k in constants.METAKEYS.items()]
        return F.to_json(F.struct(*fields, F.col(db).alias("core_db")))

    doc = F.when(F.col("run_mode").isin(constants.GENOME_MODES), document("assembly.")).otherwise(document("genebuild."))
    name = F.concat(F.col(db), F.lit("_busco_"), F.col("busco_mode"), F.lit("_metakey.json"))
    return parsed.where("reason IS NULL").select(F.col(db), name.alias("name"), doc.alias("document"))


def indented(document: str) -> Column:
    """A column of documents in the layout of their files, four spaces in; batches go to Python by Arrow."""

    @F.pandas_udf("string")
    def laid_out(documents):
        return documents.map(lambda d: json.dumps(json.loads(d), indent=4))

    return laid_out(document)


def quoted(value: Column) -> Column:
    return F.replace(value, F.lit("'"), F.lit("''"))


def statement(key: Column, value: Column, table: str = "meta", species_id: int = 1) -> Column:
    """The statement that inserts a metakey unless it is there."""
    head = f"INSERT IGNORE INTO {table} (species_id, meta_key, meta_value) VALUES ({species_id}, '"
    return F.concat(F.lit(head), key, F.lit("', '"), quoted(value), F.lit("');"))


def scripts(eav: DataFrame, db: str, order: str = "ordinal", table: str = "meta", species_id: int = 1) -> DataFrame:
    """db and script: the statements of each database in order, after the one that chooses it."""
    line = F.struct(F.col(order).alias("o"), statement(F.col("meta_key"), F.col("meta_value"), table, species_id).alias("s"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(line)), lambda x: x["s"]), "\n")
    return eav.groupBy(db).agg(body.alias("body")).select(db, F.concat(F.lit("USE "), F.col(db), F.lit(";\n\n"), F.col("body")).alias("script"))


def split_script(df: DataFrame, ids: list[str], script: str) -> DataFrame:
    """The pieces of a script between semicolons at line ends, numbered, as an executor of statements takes them."""
    pieces = F.split(F.regexp_replace(F.col(script), r"^\s+|\s+$", ""), ";\n")
    return df.select(*ids, F.posexplode(pieces).alias("ordinal", "statement"))
