"""A whole run: from the manifest and what outside programs gave to published files and patched databases."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants, schemas
from ..config import Parameters
from ..operators import enrich, metakeys, scripts
from ..session import stored
from ..sinks import caches, databases, publication
from ..sources import lineage as lineage_source
from ..sources import manifests, taxonomy
from ..sources import meta as meta_source
from ..sources import reports as report_source
from . import pipelines


def _published(rows: DataFrame, out_dir: str) -> int:
    """Summaries under their own names, in the statistics folder of their record."""
    folder = F.concat("publish_dir", F.lit("/" + constants.STATISTICS_FOLDER))
    return publication.publish(rows, out_dir, folder, F.col("summary_name"), F.col("content"))["files"]


def _cache(spark: SparkSession, params: Parameters) -> caches.Cache | None:
    return caches.Cache(spark, params.cache_dir, pipelines.CACHE_KEY, schemas.CACHE) if params.cache_dir else None


def inputs(spark: SparkSession, params: Parameters, meta: DataFrame | None, taxa: DataFrame | None, datasets: DataFrame | None) -> tuple:
    """The run's records (gca, taxon_id, core), metadata, taxa and lineage map; what isn't given comes from where the parameters say.

    Metadata is read once and stored: every later step reads the stored rows, so no database is opened twice. Taxa are
    asked for once each, as the service's answers are kept.
    """
    if params.from_assemblies():
        manifest = manifests.read_assembly_manifest(spark, params.csv_file)
        meta = spark.createDataFrame([], schemas.META) if meta is None else meta
    else:
        names = manifests.read_core_manifest(spark, params.csv_file)
        if meta is None and params.driver:
            meta = meta_source.read_meta_databases(names.withColumnRenamed("core", "db"), params.database.reader(params.driver), constants.RUN_KEYS, mark=params.mark)
        if meta is None:
            raise ValueError("a run over databases needs their metadata or a driver to read it with")
        meta = stored(meta, "meta")
        manifest = enrich.core_records(names, meta)
    if datasets is None and params.datasets_file:
        datasets = lineage_source.read_lineage(spark, params.datasets_file)
    if taxa is None and params.taxonomy_url:
        taxa = taxonomy.lookup(manifest, params.taxonomy_url, params.taxonomy_dir).select("taxon_id", "parents")
    return manifest, meta, spark.createDataFrame([], schemas.TAXA) if taxa is None else taxa, spark.createDataFrame([], schemas.LINEAGE) if datasets is None else datasets


def run(
    spark: SparkSession, params: Parameters, meta: DataFrame | None = None, taxa: DataFrame | None = None, datasets: DataFrame | None = None, reports: DataFrame | None = None,
    omark_reports: DataFrame | None = None, statistics: DataFrame | None = None, beta_metakeys: DataFrame | None = None, connect: Callable | None = None, mark: str | None = None, name: str | None = None,
) -> dict:
    """Go through the branches that the parameters choose; gives the frames of each and the numbers of files written.

    meta, taxa and datasets: see inputs(). reports (gca, db, mode, path, content), omark_reports (the same), statistics
    and beta_metakeys (db, meta_key, meta_value) are what programs outside gave; a branch without its input only gives
    its tasks. connect(db) opens a database for the patches that are to be applied (else the parameters' driver does);
    without either they are published as scripts alone. name marks the patches of this run in the databases, so that a
    second run of that name leaves them as they are.
    """
    params, out = params.checked(), {}
    none = spark.createDataFrame([], schemas.REPORT)
    if connect is None and params.driver:
        connect = params.database.writer(params.driver)
    manifest, meta, taxa, datasets = inputs(spark, params, meta, taxa, datasets)

    def applied(rows, what):
        return databases.insert_meta(pipelines.patch_of(rows), connect, mark=mark or params.mark, run=name and f"{name}/{what}").collect()

    if params.run_busco_core or params.run_busco_ncbi:
        cache = _cache(spark, params)
        found = none if reports is None else reports
        frames = pipelines.busco(manifest, meta, taxa, datasets, found, params, cache and cache.lookup)
        out |= {"busco": frames, "busco_files": _published(frames["summaries"], params.out_dir)}
        if cache is not None:
            new = frames["tasks"].withColumnRenamed("core", "db").join(found, ["gca", "db", "mode"]).select("gca", "busco_dataset", "mode", "path", "content")
            cache.append(new)
        if params.apply_busco_metakeys:
            out["busco_documents"] = publication.publish(frames["documents"], params.out_dir, F.col("publish_dir"), F.col("name"), metakeys.indented("document"))["files"]
            out["busco_scripts"] = publication.publish(frames["scripts"], params.out_dir, F.col("publish_dir"), F.concat("db", F.lit(".sql")), F.col("script"))["files"]
            if connect is not None:
                out["busco_applied"] = applied(frames["metakeys"], "busco")
    if params.run_omark:
        rows = pipelines.omark(manifest, meta, none if omark_reports is None else omark_reports, params.default_source)
        out |= {"omark": rows, "omark_files": _published(rows, params.out_dir)}
    for kind, wanted, apply, rows in (("stats", params.run_stats, params.apply_stats, statistics), ("beta_metakeys", params.run_beta_metakeys, params.apply_beta_metakeys, beta_metakeys)):
        if wanted and rows is not None:
            frames = pipelines.statistics(manifest, meta, rows, meta, apply, params.default_source)
            folder = F.concat("publish_dir", F.lit("/" + constants.STATISTICS_FOLDER))
            out |= {kind: frames, f"{kind}_files": publication.publish(frames["scripts"], params.out_dir, folder, F.concat("db", F.lit(f"_{kind}.sql")), F.col("script"))["files"]}
            if apply and connect is not None:
                out[f"{kind}_applied"] = applied(rows, kind)
    if params.sql_dir:
        texts = scripts.statements(report_source.read_scripts(spark, params.sql_dir), ["db"], "script")
        out["sql_applied"] = databases.execute_scripts(texts, connect).collect()
    return out
