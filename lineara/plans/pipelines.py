"""Whole runs over all records at once. Scores come from programs outside; here they are a frame of reports."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants
from ..config import Parameters
from ..functions import naming
from ..operators import enrich, lineage, merge, metakeys, reports
from ..session import stored
from ..sources import sequences

PATH_KEYS = {constants.ACCESSION: "gca", constants.TAXONOMY_ID: "taxon_id", constants.SCIENTIFIC_NAME: "scientific_name", constants.PRODUCTION_NAME: "production_name", constants.ANNOTATION_SOURCE: "annotation_source"}
#: What a scorer's result depends on.
CACHE_KEY = ["gca", "busco_dataset", "mode"]


def described(records: DataFrame, meta: DataFrame, default_source: str | None = None) -> DataFrame:
    """Records (core and maybe gca, taxon_id) with all that names and paths need, by one join."""
    wide = enrich.to_columns(meta, "db", PATH_KEYS).withColumnRenamed("db", "core")
    own = [c for c in ("gca", "taxon_id") if c in records.columns]
    joined = records.join(wide.withColumnsRenamed({c: f"meta_{c}" for c in own}), "core", "left")
    for c in own:
        joined = joined.withColumn(c, F.coalesce(c, f"meta_{c}")).drop(f"meta_{c}")
    db, name = F.col("core"), F.col("scientific_name")
    joined = joined.withColumn("publish_dir", naming.record_path(db, F.col("gca"), name, F.col("annotation_source"), default_source))
    joined = joined.withColumn("species", naming.species(db, name))
    return joined.withColumn("production_name", naming.or_missing(naming.trimmed(F.col("production_name")), db))


def quarantined(records: DataFrame) -> DataFrame:
    """Records with a database but no scientific name, no accession or no place to publish: db, gca, stage, reason."""
    with_db = F.col("core") != constants.NO_DATABASE
    why = F.when(F.col("gca").isNull(), "no_accession").when(with_db & F.col("scientific_name").isNull(), "no_scientific_name").when(F.col("publish_dir").isNull(), "no_annotation_source")
    return records.select(F.col("core").alias("db"), "gca", F.lit("enrich").alias("stage"), why.alias("reason")).where("reason IS NOT NULL")


def tasks(records: DataFrame, taxa: DataFrame, datasets: DataFrame, params: Parameters, cache: DataFrame | None = None) -> DataFrame:
    """What the scorer has to do: each record with its dataset, once for each mode, less what the cache has."""
    wanted = enrich.fan_out(lineage.assigned(records, taxa, datasets, params.busco_dataset), params.modes())
    return wanted if cache is None else merge.missing(wanted, cache.select(*CACHE_KEY).distinct(), CACHE_KEY)


def of_record(db: Column, gca: Column) -> list[Column]:
    """What tells a record: its database, or its accession where it has none. All of those share the name of no database."""
    return [db, F.when(db == constants.NO_DATABASE, gca).otherwise(F.lit(""))]


def with_records(found: DataFrame, records: DataFrame) -> DataFrame:
    """Rows of found (db, gca) with the columns of their own record; the gca is the row's."""
    mine, theirs = of_record(found["db"], found["gca"]), of_record(records["core"], records["gca"])
    joined = found.withColumn("_n", mine[0]).withColumn("_a", mine[1]).join(records.select("*", theirs[0].alias("_n"), theirs[1].alias("_a")).drop("gca"), ["_n", "_a"])
    return joined.drop("_n", "_a")


def with_record(found: DataFrame, records: DataFrame) -> DataFrame:
    """found (db, gca and more) with recorded: whether the run has a record of theirs."""
    mine, theirs = of_record(found["db"], found["gca"]), of_record(records["core"], records["gca"])
    known = records.select(theirs[0].alias("_n"), theirs[1].alias("_a")).distinct().withColumn("recorded", F.lit(True))
    joined = found.withColumn("_n", mine[0]).withColumn("_a", mine[1]).join(known, ["_n", "_a"], "left")
    return joined.withColumn("recorded", F.coalesce("recorded", F.lit(False))).drop("_n", "_a")


def in_folder(rows: DataFrame, records: DataFrame) -> DataFrame:
    """rows of databases (db and more) with the publish_dir of their record."""
    folders = records.where(F.col("core") != constants.NO_DATABASE).groupBy(F.col("core").alias("db")).agg(F.min("publish_dir").alias("publish_dir"))
    return rows.join(folders, "db", "left")


def summaries(records: DataFrame, found: DataFrame, project: str, short_name_projects: tuple = ()) -> DataFrame:
    """Filtered report texts with the names and folders they are published under. found: gca, db, mode, path, content."""
    name = naming.summary_name(F.lit(project), F.col("species"), F.col("gca"), F.col("mode"), short_name_projects)
    return with_records(found, records).select("db", "gca", "mode", "publish_dir", name.alias("summary_name"), "path", reports.without_lines(F.col("content")).alias("content"))


def report_metakeys(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metakey rows of the usable reports, and the others with their reason. Records without a database have none."""
    parsed = usable(found)
    bad = parsed.where("reason IS NOT NULL").select("db", "gca", F.lit("report").alias("stage"), "reason")
    return metakeys.to_eav(parsed, ["db"]), bad


def usable(found: DataFrame) -> DataFrame:
    """Parsed reports of records with a database, with the reason why one can't be used."""
    return reports.classified(reports.parse(found.where(F.col("db") != constants.NO_DATABASE)))


def patch_of(eav: DataFrame) -> DataFrame:
    """Metakey rows as rows of the meta table."""
    return eav.select("db", F.lit(1).alias("species_id"), "meta_key", "meta_value")


def busco(manifest: DataFrame, meta: DataFrame, taxa: DataFrame, datasets: DataFrame, found: DataFrame, params: Parameters, cache: DataFrame | Callable | None = None) -> dict[str, DataFrame]:
    """A run over databases or assemblies: tasks, reports, summaries, metakeys, documents, meta after the patch, scripts, quarantine.

    cache: earlier reports with what they depend on (CACHE_KEY, path, content), or a function that gives those of a
    frame's keys. Tasks are what it lacks, and its reports
    of the other tasks join those found. A report without a record in the manifest is set aside (no_record): it gives
    no summary, no metakey and no patch. Documents and scripts carry the publish_dir of their record.
    """
    params = params.checked()
    records = enrich.assembly_records(manifest) if params.from_assemblies() else manifest
    records = described(records, meta, params.default_source)
    wanted = tasks(records, taxa, datasets, params)
    if cache is not None:
        cache = stored(cache(wanted), "cached-reports") if callable(cache) else cache
        once = cache.groupBy(*CACHE_KEY).agg(F.max(F.struct("path", "content")).alias("v"))
        known = wanted.join(once, CACHE_KEY).select("gca", F.col("core").alias("db"), "mode", F.col("v.path").alias("path"), F.col("v.content").alias("content"))
        found = found.select(*known.columns).unionByName(known)
    judged = with_record(found, records)
    known = judged.where("recorded").drop("recorded")
    strays = judged.where("NOT recorded").select("db", "gca", F.lit("report").alias("stage"), F.lit("no_record").alias("reason"))
    eav, bad = report_metakeys(known)
    key, value = ["db", "species_id", "meta_key"], ["meta_value"]
    out = {
        "records": records, "tasks": tasks(records, taxa, datasets, params, cache), "reports": found, "summaries": summaries(records, known, params.project, params.short_name_projects),
        "metakeys": eav, "documents": in_folder(metakeys.to_json(usable(known)), records), "quarantine": quarantined(records).unionByName(strays).unionByName(bad),
    }
    if params.apply_busco_metakeys:
        out |= {"meta": merge.insert_ignore(meta, patch_of(eav), key, value), "scripts": in_folder(metakeys.scripts(eav, "db"), records)}
    return out


def omark(manifest: DataFrame, meta: DataFrame, found: DataFrame, default_source: str | None = None) -> DataFrame:
    """Detailed summaries of proteins: files of a record joined in order of path, with name and folder."""
    records = described(manifest, meta, default_source)
    joined = reports.concatenated(found, "db", F.col("content"), F.col("path"))
    rows = joined.join(records, joined["db"] == records["core"])
    return rows.select("db", "gca", "publish_dir", naming.omark_name(F.col("species"), F.col("gca")).alias("summary_name"), "content")


def protein_inputs(manifest: DataFrame, meta: DataFrame, dumped: DataFrame | None = None) -> DataFrame:
    """gca, dbname, path of each database's dumped proteins, and an empty dataset where none was assigned.

    dumped: the sequences themselves (see sources.sequences), found by the names of their files; then proteins and
    residues are their numbers, null where there is no file or no sequence in it.
    """
    records = described(manifest, meta)
    rows = records.select("gca", F.col("core").alias("dbname"), naming.translations_name(F.col("production_name")).alias("path"), F.lit(None).cast("string").alias("busco_dataset"))
    if dumped is None:
        return rows
    counted = sequences.counts(dumped).select(F.element_at(F.split("path", "/"), -1).alias("path"), F.col("records").alias("proteins"), "residues")
    return rows.join(counted.groupBy("path").agg(F.sum("proteins").alias("proteins"), F.sum("residues").alias("residues")), "path", "left").select(*rows.columns, "proteins", "residues")


def statistics(manifest: DataFrame, meta: DataFrame, statements: DataFrame, target: DataFrame, apply: bool, default_source: str | None = None) -> dict[str, DataFrame]:
    """Statistics or beta metakeys that a program outside gives (db, meta_key, meta_value): where they are published,
    as rows and as scripts, and, if they are to be applied, the meta table after them."""
    records = described(manifest, meta, default_source)
    out = {"published": statements.join(records, statements["db"] == records["core"]).select("db", "gca", "publish_dir", "meta_key", "meta_value")}
    out["scripts"] = metakeys.scripts(statements.withColumn("ordinal", F.struct("meta_key", "meta_value")), "db").join(records.select(F.col("core").alias("db"), "publish_dir"), "db")
    if apply:
        out["meta"] = merge.insert_ignore(target, patch_of(statements), ["db", "species_id", "meta_key"], ["meta_value"])
    return out
