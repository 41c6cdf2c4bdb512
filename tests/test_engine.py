"""Decisions on missing, empty and malformed values, file sources and sinks, runs and streams."""

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lineara import config, constants, schemas
from lineara.functions import naming
from lineara.operators import enrich, lineage, merge, metakeys, reports
from lineara.operators import scripts as script_operators
from lineara.plans import pipelines
from lineara.plans import run as plan_run
from lineara.queries import fixtures as fx
from lineara.sinks import databases, files
from lineara.sources import lineage as lineage_source
from lineara.sources import manifests, meta, sequences, taxonomy
from lineara.sources import reports as report_source
from lineara.streaming import manifests as streams


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_names(spark):
    assert one(spark, naming.slug_name(F.lit("Homo  sapiens"))) == "Homo__sapiens"
    assert one(spark, naming.slug_accession(F.lit("GCA_963576655.1"))) == "gca963576655v1"
    assert one(spark, naming.scientific_name(F.lit(""), F.lit("db"))) == "db"
    assert one(spark, naming.record_path(F.lit("core"), F.lit("GCA_1.1"), F.lit(None), F.lit(None))) == "GCA_1.1"
    assert one(spark, naming.record_path(F.lit("db"), F.lit("GCA_1.1"), F.lit("A b"), F.lit(None), "given")) == "A_b/GCA_1.1/given"
    assert one(spark, naming.record_path(F.lit("db"), F.lit("GCA_1.1"), F.lit("A b"), F.lit(None))) is None
    assert one(spark, naming.publish_path(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) is None
    assert one(spark, naming.trimmed(F.lit(" x\n"))) == "x"
    assert one(spark, naming.override("", F.lit(" y\n"))) == "y"
    assert one(spark, naming.override("z", F.lit("y"))) == "z"
    assert one(spark, naming.species(F.lit("core"), F.lit(None).cast("string"))) == "species"
    assert one(spark, naming.translations_name(F.lit("Apis"))) == "apis_translations.fa"


def test_nearest_ancestor(spark):
    taxa, map_ = fx.frame(spark, fx.TAXA, schemas.TAXA), fx.frame(spark, fx.LINEAGE, schemas.LINEAGE)
    near = {r.taxon_id: r.dataset for r in lineage.nearest_dataset(taxa, map_, "taxon_id").collect()}
    assert near == {"100": "aves_odb10", "101": "insecta_odb10", "102": "fungi_odb10", "105": "eukaryota_odb10"}
    with_self = {r.taxon_id: r.dataset for r in lineage.nearest_dataset(taxa, map_, "taxon_id", include_self=True).collect()}
    assert with_self["105"] == "self_odb10"
    assert {r.taxon_id for r in lineage.unmatched(taxa, map_, "taxon_id").collect()} == {"103", "104"}
    more = taxa.withColumn("parents", F.concat("parents", F.array(F.lit(999999).cast("long"))))
    assert rows(lineage.nearest_dataset(more, map_, "taxon_id")) == rows(lineage.nearest_dataset(taxa, map_, "taxon_id"))


def test_each_pattern_reads_a_text_once(spark):
    """No filter on the fields is pushed below the patterns, which then ran again for each of its terms on texts made anew."""
    texts = fx.reports(spark).withColumn("content", F.concat("content", F.lit(" ")))
    plan = metakeys.to_eav(reports.classified(reports.parse(texts)), ["db"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat(content") == 1
    for pattern in (constants.MODE, constants.SCORE + ", 0", constants.SCORE_ERRONEOUS + ", 0", *constants.COUNTS.values()):
        assert plan.count(pattern) == 1, pattern


def test_taxonomy_without_reports(spark):
    got = lineage.parents_of(spark.createDataFrame([('{"reports":[]}',), ("{}",), ("no json",), (None,), ('{"reports":[{"taxonomy":{"parents":[1,2]}}]}',)], "content string")).collect()
    assert [r.parents for r in got] == [None, None, None, None, [1, 2]]


def test_reports(spark):
    got = {r.db: r for r in reports.classified(reports.parse(fx.reports(spark))).collect()}
    assert (got["db_protein"].total, got["db_protein"].busco_mode, got["db_protein"].version, got["db_protein"].reason) == (8338, "protein", "5.7.1", None)
    assert (got["db_min"].score[-7:], got["db_min"].erroneous) == (",E:3.5%", "3.5")
    assert (got["db_no_e"].reason, got["db_unknown"].reason) == ("no_score", "unknown_mode")
    assert got["db_missing"].complete is None and got["db_missing"].reason is None
    whole = spark.createDataFrame([("d", "BUSCO was run in mode: proteins\nC:100%[S:96.5%,D:0.5%],F:0.6%,M:2.4%,n:10")], "db string, content string")
    assert reports.classified(reports.parse(whole)).first().reason == "no_score"
    with pytest.raises(Exception, match="unusable report"):
        reports.strict(reports.classified(reports.parse(fx.reports(spark)))).collect()


def test_metakeys(spark):
    parsed = reports.classified(reports.parse(fx.reports(spark)))
    plain = metakeys.to_eav(parsed, ["db"]).where("db = 'db_missing'")
    legacy = metakeys.to_eav(parsed, ["db"], compat=True).where("db = 'db_missing'")
    assert plain.count() == 5
    assert {r.meta_value for r in legacy.collect()} >= {"None"} and legacy.count() == 10
    docs = {r.db: json.loads(r.document) for r in metakeys.to_json(parsed).collect()}
    assert list(docs["db_min"])[-1] == "core_db" and docs["db_min"]["assembly.busco_total"] == 1367
    assert docs["db_min"]["assembly.busco_erroneus"] == "3.5" and docs["db_min"]["assembly.busco_completeness"] == "1352"
    assert one(spark, metakeys.indented(F.lit('{"a":"b","n":1}'))) == '{\n    "a": "b",\n    "n": 1\n}'
    assert one(spark, metakeys.statement(F.lit("k"), F.lit("O'Brien"))).endswith("'O''Brien');")
    pieces = metakeys.split_script(spark.createDataFrame([("USE d;\n\nINSERT 1;\nINSERT 2;",)], "s string"), [], "s").orderBy("ordinal").collect()
    assert [p.statement for p in pieces] == ["USE d", "\nINSERT 1", "INSERT 2;"]


def test_merge_twice_is_merge_once(spark):
    target = spark.createDataFrame([("a", "1")], "k string, v string")
    patch = spark.createDataFrame([("a", "9"), ("b", "3"), ("b", "2")], "k string, v string")
    once = merge.insert_ignore(target, patch, ["k"], ["v"])
    assert rows(once) == ["('a', '1')", "('b', '2')"]
    assert rows(merge.insert_ignore(once, patch, ["k"], ["v"])) == rows(once)
    assert rows(merge.missing(patch.select("k").distinct(), target, ["k"])) == ["('b',)"]


def test_enrichment_states(spark):
    meta_rows = fx.frame(spark, fx.META, schemas.META)
    records = pipelines.described(enrich.core_records(meta_rows.select(F.col("db").alias("core")).distinct(), meta_rows), meta_rows, "given")
    bad = {r.db: r.reason for r in pipelines.quarantined(records).collect()}
    assert bad == {"db_unknown": "no_scientific_name"}
    paths = {r.core: r.publish_dir for r in records.collect()}
    assert paths["db_met"] == "db_met/GCA_000003.1/given" and paths["db_protein"] == "Gallus__gallus/GCA_963576655.1/braker"


def test_parameters(tmp_path):
    there = tmp_path / "m.csv"
    there.write_text("core\n")
    good = config.Parameters(csv_file=str(there), out_dir="/o", project="beta", projects=("alpha", "beta"), busco_mode="genome")
    assert good.checked().modes() == ["genome"]
    assert config.Parameters(run_busco_ncbi=True).modes() == ["genome"]
    assert config.Parameters(run_busco_ncbi=True, run_busco_core=True).modes() == ["genome", "protein"]
    assert good.merged({"busco_dataset": "a"}, {"busco_dataset": "b"}).busco_dataset == "b"
    with pytest.raises(ValueError, match="project must be"):
        good.merged({"project": "x"}).checked()
    with pytest.raises(ValueError, match="team"):
        good.merged({"run_beta_metakeys": True}).checked()
    assert config.Database("h", 1, "w", "r", "p").reader("m").args == ("m", {"host": "h", "port": 1, "user": "r"})
    assert config.Database("h", 1, "w", "r", "p").writer("m").args[1]["password"] == "p"


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "cores.csv").write_text("header\ndb_a\n\n db_b \n")
    assert [r.core for r in manifests.read_core_manifest(spark, str(tmp_path / "cores.csv")).collect()] == ["db_a", "db_b"]
    (tmp_path / "gca.csv").write_text("gca,taxon_id\nGCA_1.1,0042\n")
    assert manifests.read_assembly_manifest(spark, str(tmp_path / "gca.csv")).first().taxon_id == "0042"
    (tmp_path / "map.json").write_text('{"1": "a_odb10", "2": "b_odb10"}')
    (tmp_path / "names.csv").write_text("a_odb10\nb_odb10")
    pairs, names = lineage_source.read_lineage(spark, str(tmp_path / "map.json")), lineage_source.read_lineage_names(spark, str(tmp_path / "names.csv"))
    assert pairs.select("dataset").exceptAll(names).count() == 0 == names.exceptAll(pairs.select("dataset")).count()
    (tmp_path / "taxa/x").mkdir(parents=True)
    (tmp_path / "taxa/x/42.json").write_text('{"reports":[{"taxonomy":{"parents":[1,7]}}]}')
    assert taxonomy.read_taxa(spark, str(tmp_path / "taxa")).first().asDict() == {"taxon_id": "42", "parents": [1, 7]}
    (tmp_path / "out/y").mkdir(parents=True)
    (tmp_path / "out/y/a_short_summary.txt").write_text("text\nmore")
    (tmp_path / "out/y/other.txt").write_text("no")
    assert [r.content for r in report_source.read_summaries(spark, str(tmp_path / "out")).collect()] == ["text\nmore"]
    assert report_source.list_files(spark, str(tmp_path / "out"), "*.txt").count() == 2
    fx.frame(spark, fx.META, schemas.META).write.parquet(str(tmp_path / "meta"))
    assert meta.read_meta(spark, str(tmp_path / "meta"), [constants.ACCESSION]).count() == 6
    eav = metakeys.to_eav(reports.classified(reports.parse(fx.reports(spark))), ["db"])
    for _ in range(2):
        files.write_scripts(metakeys.scripts(eav, "db"), str(tmp_path / "sql"))
    text = spark.read.text(str(tmp_path / "sql"), wholetext=True).where("db = 'db_min'").collect()
    assert len(text) == 1 and text[0].value.startswith("USE db_min;\n\nINSERT IGNORE INTO meta") and text[0].value.count("INSERT") == 11


def test_runs(spark, tmp_path):
    there = tmp_path / "m.csv"
    there.write_text("x\n")
    meta_rows, taxa = fx.frame(spark, fx.META, schemas.META), fx.frame(spark, fx.TAXA, schemas.TAXA)
    map_ = fx.frame(spark, fx.LINEAGE, schemas.LINEAGE)
    params = config.Parameters(csv_file=str(there), out_dir="/o", project="alpha", default_source="given", apply_busco_metakeys=True)
    manifest = enrich.core_records(meta_rows.select(F.col("db").alias("core")).distinct(), meta_rows)
    out = pipelines.busco(manifest, meta_rows, taxa, map_, fx.reports(spark), params)
    assert out["tasks"].count() == 12
    assert out["summaries"].where(F.col("content").contains(constants.DROPPED_LINE)).count() == 0
    assert {(r.db, r.reason) for r in out["quarantine"].collect()} == {("db_unknown", "no_scientific_name"), ("db_unknown", "unknown_mode"), ("db_no_e", "no_score")}
    merged = out["meta"].where("db = 'db_met' AND meta_key = 'assembly.busco'").collect()
    assert [r.meta_value for r in merged] == ["kept as it was"]
    ncbi = config.Parameters(csv_file=str(there), out_dir="/o", project="beta", short_name_projects=("beta",), run_busco_ncbi=True)
    accessions = ["GCA_9.1", "GCA_8.1", "GCA_7.2"]
    found = fx.frame(spark, [(a, "core", "genome", f"/{a}", f"of {a}") for a in accessions], schemas.REPORT)
    rest = pipelines.busco(fx.frame(spark, [(a, "100") for a in accessions], schemas.ASSEMBLY_MANIFEST), meta_rows, taxa, map_, found, ncbi)
    assert sorted((r.gca, r.publish_dir, r.content) for r in rest["summaries"].collect()) == sorted((a, a, f"of {a}") for a in accessions)
    assert {r.summary_name for r in rest["summaries"].collect()} == {"genome_busco_short_summary.txt"}
    assert rest["metakeys"].count() == 0
    cache = fx.frame(spark, [("GCA_9.1", "aves_odb10", "genome", "/old", "cached")], schemas.CACHE)
    again = pipelines.busco(fx.frame(spark, [(a, "100") for a in accessions], schemas.ASSEMBLY_MANIFEST), meta_rows, taxa, map_, found.where("gca <> 'GCA_9.1'"), ncbi, cache)
    assert {r.gca for r in again["tasks"].collect()} == set(accessions[1:])
    assert {(r.gca, r.content) for r in again["summaries"].collect()} == {("GCA_9.1", "cached"), ("GCA_8.1", "of GCA_8.1"), ("GCA_7.2", "of GCA_7.2")}
    files_ = fx.frame(spark, [("g", "db_min", "p", "/b", "two"), ("g", "db_min", "p", "/a", "one")], schemas.REPORT)
    joined = pipelines.omark(manifest, meta_rows, files_).first()
    assert (joined.content, joined.summary_name) == ("onetwo", "apis_mellifera_gca0000022_omark_proteins_detailed_summary.txt".replace("gca0000022", "gca000002v2"))
    inputs = {r.dbname: r.path for r in pipelines.protein_inputs(manifest, meta_rows).collect()}
    assert inputs["db_min"] == "apis_mellifera_translations.fa" and inputs["db_met"] == "db_met_translations.fa"
    (tmp_path / "dump").mkdir()
    (tmp_path / "dump/apis_mellifera_translations.fa").write_text(">a\nMK\nL\n>b x\nM\n")
    counted = {r.dbname: (r.proteins, r.residues) for r in pipelines.protein_inputs(manifest, meta_rows, sequences.read_sequences(spark, str(tmp_path / "dump"))).collect()}
    assert counted["db_min"] == (2, 4) and counted["db_met"] == (None, None) and len(counted) == len(inputs)
    stats = spark.createDataFrame([("db_min", "s.k", "1"), ("db_met", "assembly.busco", "new")], "db string, meta_key string, meta_value string")
    applied = pipelines.statistics(manifest, meta_rows, stats, meta_rows, True)
    assert applied["published"].count() == 2 == applied["scripts"].count() and applied["meta"].count() == meta_rows.count() + 1


def opener(folder):
    def connect(name):
        import sqlite3

        return sqlite3.connect(f"{folder}/{name}.db")

    return connect


def test_databases(spark, tmp_path):
    connect = opener(tmp_path)
    for name in ("db_a", "db_b"):
        with connect(name) as c:
            c.execute("CREATE TABLE meta (species_id INT, meta_key TEXT, meta_value TEXT)")
            c.execute("INSERT INTO meta VALUES (1, 'assembly.accession', ?), (1, 'other', 'x')", (f"GCA of {name}",))
    names = spark.createDataFrame([("db_a",), ("db_b",), ("db_a",), (None,)], "db string")
    assert rows(meta.read_meta_databases(names, connect).select("db", "meta_value")) == ["('db_a', 'GCA of db_a')", "('db_b', 'GCA of db_b')"]
    assert meta.read_meta_databases(names.where("db IS NULL"), connect).count() == 0
    patch = spark.createDataFrame([("db_a", 1, "k", "it's"), ("db_a", 1, "other", "new"), ("db_none", 1, "k", "v")], schemas.META)
    for _ in range(2):
        got = {r.db: (r.statements, r.error) for r in databases.insert_meta(patch, connect).collect()}
        assert got["db_a"] == (1 - _, None) and got["db_none"][0] == 0 and "meta" in got["db_none"][1]
    assert sorted(connect("db_a").execute("SELECT meta_key, meta_value FROM meta").fetchall()) == [("assembly.accession", "GCA of db_a"), ("k", "it's"), ("other", "x")]
    scripts = spark.createDataFrame([("db_b", "USE db_b;\n\nINSERT INTO meta VALUES (1, 'a', 'b');\nUPDATE meta SET meta_value = 'c' WHERE meta_key = 'a';"), ("db_a", "USE db_a;\n\nDELETE FROM meta;\nNO SQL;")], "db string, script string")
    got = {r.db: (r.statements, r.error is None) for r in databases.execute_scripts(script_operators.statements(scripts, ["db"], "script"), connect).collect()}
    assert got == {"db_b": (2, True), "db_a": (0, False)}
    assert connect("db_b").execute("SELECT meta_value FROM meta WHERE meta_key = 'a'").fetchall() == [("c",)]
    assert connect("db_a").execute("SELECT count(*) FROM meta").fetchone() == (3,), "a script that fails changes nothing"


def test_whole_runs(spark, tmp_path):
    (tmp_path / "m.csv").write_text("core\ndb_min\ndb_protein\n")
    meta_rows, taxa, map_ = fx.frame(spark, fx.META, schemas.META), fx.frame(spark, fx.TAXA, schemas.TAXA), fx.frame(spark, fx.LINEAGE, schemas.LINEAGE)
    connect = opener(tmp_path)
    for name in ("db_min", "db_protein"):
        with connect(name) as c:
            c.execute("CREATE TABLE meta (species_id INT, meta_key TEXT, meta_value TEXT)")
    params = config.Parameters(
        csv_file=str(tmp_path / "m.csv"), out_dir=str(tmp_path / "out"), project="alpha", default_source="given", run_busco_core=True, run_omark=True, run_stats=True, apply_busco_metakeys=True, apply_stats=True,
        cache_dir=str(tmp_path / "cache"),
    )
    found = fx.reports(spark).where("db IN ('db_min', 'db_protein')")
    stats = spark.createDataFrame([("db_min", "s.k", "1")], "db string, meta_key string, meta_value string")
    inputs = {"meta": meta_rows, "taxa": taxa, "datasets": map_, "omark_reports": found, "statistics": stats, "connect": connect}
    out = plan_run.run(spark, params, reports=found, **inputs)
    assert (out["busco_files"], out["omark_files"], out["stats_files"], out["busco_documents"], out["busco_scripts"]) == (2, 2, 1, 2, 2)
    summary = tmp_path / "out/Apis_mellifera/GCA_000002.2/given/statistics/apis_mellifera_gca000002v2_genome_busco_short_summary.txt"
    assert "lineage dataset" in summary.read_text() and constants.DROPPED_LINE not in summary.read_text()
    document = (tmp_path / "out/Apis_mellifera/GCA_000002.2/given/db_min_busco_genome_metakey.json").read_text()
    assert document.startswith('{\n    "assembly.busco_version": "5.7.1",') and json.loads(document)["core_db"] == "db_min"
    assert not list((tmp_path / "out").rglob("*.part"))
    assert connect("db_min").execute("SELECT count(*) FROM meta").fetchone() == (12,)
    again = plan_run.run(spark, params, **inputs)
    assert again["busco_files"] == 2 and again["busco"]["tasks"].count() == 2, "the cache has the reports; each database lacks its other mode"
    assert connect("db_min").execute("SELECT count(*) FROM meta").fetchone() == (12,)
    (tmp_path / "a.csv").write_text("gca,taxon_id\nGCA_1.1,100\nGCA_2.1,101\n")
    ncbi = config.Parameters(csv_file=str(tmp_path / "a.csv"), out_dir=str(tmp_path / "out2"), project="alpha", run_busco_ncbi=True)
    alone = plan_run.run(spark, ncbi, meta_rows, taxa, map_, fx.frame(spark, [(f"GCA_{k}.1", "core", "genome", "/p", f"text {k}") for k in (1, 2)], schemas.REPORT))
    assert alone["busco_files"] == 2
    assert (tmp_path / "out2/GCA_2.1/statistics/species_gca2v1_genome_busco_short_summary.txt").read_text() == "text 2"


def test_walk_up(spark):
    chain = spark.range(1, 300).selectExpr("id AS child", "id - 1 AS parent")
    got = lineage.walk_up(chain, "child", "parent")
    assert got.count() == 300 * 299 // 2
    assert got.where("child - ancestor <> distance").count() == 0
    assert rows(lineage.walk_up(spark.createDataFrame([(2, 1), (3, None), (None, 3)], "child int, parent int"), "child", "parent")) == ["(1, 2, 1)"]
    assert lineage.walk_up(chain.where("child < 0"), "child", "parent").count() == 0
    with pytest.raises(ValueError, match="cycle"):
        lineage.walk_up(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "child int, parent int"), "child", "parent")


def test_stream_merges_once(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for n in range(2):
        (inbox / f"m{n}.csv").write_text("gca,taxon_id\nGCA_1.1,7\nGCA_2.1,8\n")
        records = streams.assembly_records(streams.manifest_stream(spark, str(inbox)))
        streams.merge_into(records, str(tmp_path / "out"), str(tmp_path / "cp"), ["gca"], ["taxon_id", "core"]).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("gca", "taxon_id", "core")) == ["('core', 'GCA_1.1', '7')", "('core', 'GCA_2.1', '8')"]
