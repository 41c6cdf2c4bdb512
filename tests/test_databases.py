"""Databases as sources and sinks, SQL scripts, the taxonomy service, and a whole run over them."""

import http.server
import json
import sqlite3
import sys
import threading
from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lineara import config, constants, schemas
from lineara.operators import scripts
from lineara.plans import run as plan_run
from lineara.queries import fixtures as fx
from lineara.sinks import databases
from lineara.sources import meta, reports, taxonomy

TABLE = "CREATE TABLE meta (species_id INT, meta_key TEXT, meta_value TEXT)"


def counting(folder):
    """connect(name) of SQLite files, which notes each opening and each statement with its parameters."""

    def connect(name):
        import os
        import sqlite3

        class Noted(sqlite3.Connection):
            def cursor(self):
                outer = self

                class Cursor(sqlite3.Cursor):
                    def execute(self, sql, parameters=()):
                        with open(f"{folder}/log", "a") as f:
                            f.write(f"{name}\t{' '.join(sql.split())}\t{','.join(map(str, parameters))}\n")
                        return super().execute(sql, parameters)

                return super().cursor(Cursor) if outer else None

        with open(f"{folder}/opened", "a") as f:
            f.write(name + "\n")
        if not os.path.exists(f"{folder}/{name}.db"):
            raise OSError(f"no database {name}")
        return sqlite3.connect(f"{folder}/{name}.db", factory=Noted)

    return connect


def make(folder, name, rows_):
    with sqlite3.connect(f"{folder}/{name}.db") as c:
        c.execute(TABLE)
        c.executemany("INSERT INTO meta VALUES (?, ?, ?)", rows_)


def opened(folder):
    return Counter((folder / "opened").read_text().split()) if (folder / "opened").exists() else Counter()


def test_filters_reach_the_servers(spark, tmp_path):
    for k in range(12):
        make(tmp_path, f"db{k}", [(1, "assembly.accession", f"G{k}"), (1, "assembly.busco", "x"), (2, "unwanted", "y"), (1, None, "z")])
    names = spark.createDataFrame([(f"db{k}",) for k in range(12)] + [("db1",), (None,)], "db string")
    frame = meta.read_meta_databases(names, counting(tmp_path))
    assert frame.schema.simpleString() == "struct<db:string,species_id:int,meta_key:string,meta_value:string>"
    assert frame.count() == 12 and opened(tmp_path) == {f"db{k}": 1 for k in range(12)}, "each database once"
    log = (tmp_path / "log").read_text()
    assert log.count("WHERE meta_key IN (?, ?, ?, ?, ?)") == 12 and constants.ACCESSION in log
    (tmp_path / "opened").unlink(), (tmp_path / "log").unlink()
    got = frame.where(F.col("db").isin("db3", "db4") & (F.col("meta_key") == constants.ACCESSION)).select("db", "meta_value")
    assert rows(got) == ["('db3', 'G3')", "('db4', 'G4')"]
    assert opened(tmp_path) == {"db3": 1, "db4": 1} and (tmp_path / "log").read_text().count("WHERE meta_key IN (?)\tassembly.accession") == 2
    assert meta.read_meta_databases(names, counting(tmp_path), keys=None).count() == 48
    assert meta.read_meta_databases(names, counting(tmp_path), keys=None).where("db = 'none'").count() == 0
    assert meta.read_meta_databases(names.where("db IS NULL"), counting(tmp_path)).count() == 0


def test_patches_add_once_and_count_what_they_add(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(databases, "CHUNK", 3)
    for name in ("a", "b"):
        make(tmp_path, name, [(1, "there", "old"), (None, "none", "old")])
    patch = [("a", 1, f"k{k}", f"v{k}") for k in range(10)] + [("a", 1, "there", "new"), ("a", 1, "k1", "u"), ("a", None, "none", "new"), ("b", 2, "there", "it's"), ("gone", 1, "k", "v"), (None, 1, "k", "v")]
    df = spark.createDataFrame(patch, schemas.META).repartition(4)
    first = {r.db: (r.statements, r.error is None) for r in databases.insert_meta(df, counting(tmp_path)).collect()}
    assert first == {"a": (10, True), "b": (1, True), "gone": (0, False)}
    assert {r.db: r.statements for r in databases.insert_meta(df, counting(tmp_path)).collect()} == {"a": 0, "b": 0, "gone": 0}
    have = sqlite3.connect(tmp_path / "a.db").execute("SELECT meta_key, meta_value FROM meta ORDER BY 1").fetchall()
    assert have == sorted([("none", "old"), ("there", "old"), ("k1", "u"), *[(f"k{k}", f"v{k}") for k in range(10) if k != 1]])
    log = [x for x in (tmp_path / "log").read_text().split("\n") if x.startswith("a\tINSERT INTO meta ")]
    assert len(log) == 2, "one set-based statement a database and run"


def test_marked_patches_are_done_once(spark, tmp_path):
    make(tmp_path, "a", [])
    df = spark.createDataFrame([("a", 1, "k", "v"), ("a", 1, "l", "w")], schemas.META)
    got = [databases.insert_meta(df, counting(tmp_path), run="r1").first().statements]
    with sqlite3.connect(tmp_path / "a.db") as c:
        c.execute("DELETE FROM meta WHERE meta_key = 'k'")
    got += [databases.insert_meta(df, counting(tmp_path), run=name).first().statements for name in ("r1", "r2")]
    assert got == [2, 2, 1], "the mark keeps the count; another run adds what is absent"


def test_a_patch_that_fails_leaves_nothing(spark, tmp_path):
    make(tmp_path, "a", [])
    with sqlite3.connect(tmp_path / "a.db") as c:
        c.execute("CREATE TRIGGER t BEFORE INSERT ON meta WHEN NEW.meta_key = 'bad' BEGIN SELECT RAISE(ABORT, 'refused'); END")
    df = spark.createDataFrame([("a", 1, "good", "v"), ("a", 1, "bad", "v")], schemas.META)
    got = databases.insert_meta(df, counting(tmp_path), run="r").first()
    assert got.statements == 0 and "refused" in got.error
    assert sqlite3.connect(tmp_path / "a.db").execute("SELECT count(*) FROM meta").fetchone() == (0,)
    assert databases.insert_meta(df.where("meta_key = 'good'"), counting(tmp_path), run="r").first().statements == 1


SCRIPTS = [
    ("VALUES (1,'k','a;\nb')", ["VALUES (1,'k','a;\nb')"]),
    ("a;b;\n\nc", ["a", "b", "c"]),
    ("USE d;\n\nINSERT 'it''s; x';-- gone; not here\nB;", ["USE d", "INSERT 'it''s; x'", "-- gone; not here\nB"]),
    (r"x 'a\';b'; y", [r"x 'a\';b'", "y"]),
    (r'x "a;\";b"; y "";z', [r'x "a;\";b"', 'y ""', "z"]),
    ("x `a\\`; y `;`", ["x `a\\`", "y `;`"]),
    ("/* one; two */ a; /* three; */", ["/* one; two */ a"]),
    ("# c; d\n;\n;; e -- f", ["e -- f"]),
    ("a --b; c", ["a --b", "c"]),
    ("a /* \\*/; b", ["a /* \\*/", "b"]),
    ("a - b / c * d; e", ["a - b / c * d", "e"]),
    ("a 'never closed; b", ["a 'never closed; b"]),
    ("'\";' ; \"';\"", ["'\";'", "\"';\""]),
    ("é 'ü;' ; ñ", ["é 'ü;'", "ñ"]),
    ("", []),
    (" ;\n; ", []),
    ("-- only; this", []),
    (None, []),
]


def test_statements(spark):
    df = spark.createDataFrame([(k, s) for k, (s, _) in enumerate(SCRIPTS)], "k int, s string")
    got = {}
    for r in scripts.statements(df, ["k"], "s").orderBy("k", "ordinal").collect():
        assert r.ordinal == len(got.setdefault(r.k, []))
        got[r.k].append(r.statement)
    assert [got.get(k, []) for k in range(len(SCRIPTS))] == [want for _, want in SCRIPTS]


def test_long_scripts(spark):
    """Tens of thousands of escapes in one literal, and thousands of statements, without recursion."""
    literal = "x '" + "\\'; " * 50_000 + "'"
    many = ";".join(f"insert '{k};'" for k in range(3_000))
    df = spark.createDataFrame([(f"{literal};{many}",)], "s string")
    got = [r.statement for r in scripts.statements(df, [], "s").orderBy("ordinal").collect()]
    assert got[0] == literal and got[1:] == many.split(";insert") [:1] + ["insert" + x for x in many.split(";insert")[1:]]


def test_statements_by_one_pattern(spark):
    """A block comment ends at the first */ after its opening, a star before one is code; and the plan has no fold over tokens, whose cost was 300 us a script."""
    texts = ["/*/ a; */ b; c", "/* a /*/; b", "2*/* ; */3; d", "--;x", "-- ;\nx", "a\\;b", "a 'b;\\", ";;' ;"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, s string")
    got = scripts.statements(df, ["k"], "s")
    found = {k: [r.statement for r in got.where(f"k = {k}").orderBy("ordinal").collect()] for k in range(len(texts))}
    assert list(found.values()) == [["/*/ a; */ b", "c"], ["b"], ["2*/* ; */3", "d"], ["--", "x"], ["-- ;\nx"], ["a\\;b"], ["a 'b;\\"], ["' ;"]]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "lambdafunction" not in plan


def test_files_of_statements_are_run(spark, tmp_path):
    make(tmp_path, "a", []), make(tmp_path, "b", [])
    (tmp_path / "sql/x").mkdir(parents=True)
    (tmp_path / "sql/a.sql").write_text("USE a;\n\nINSERT INTO meta VALUES (1, 'k', 'one;\ntwo'); -- and;\nUPDATE meta SET species_id = 7;\n")
    (tmp_path / "sql/x/b.sql").write_text("INSERT INTO meta VALUES (1, 'k', 'v');\nNO SQL;")
    (tmp_path / "sql/notes.txt").write_text("no")
    texts = scripts.statements(reports.read_scripts(spark, str(tmp_path / "sql")), ["db"], "script")
    got = {r.db: (r.statements, r.error is None) for r in databases.execute_scripts(texts, counting(tmp_path)).collect()}
    assert got == {"a": (2, True), "b": (0, False)}
    assert sqlite3.connect(tmp_path / "a.db").execute("SELECT * FROM meta").fetchall() == [(7, "k", "one;\ntwo")]
    assert sqlite3.connect(tmp_path / "b.db").execute("SELECT * FROM meta").fetchall() == []


@pytest.fixture
def service():
    """A taxonomy service that counts requests: 404 for ids ending in 4, once 503 for ids ending in 5."""
    asked = Counter()

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            taxon = self.path.split("/")[1]
            asked[taxon] += 1
            code = 404 if taxon.endswith("4") else 503 if taxon.endswith("5") and asked[taxon] == 1 else 200
            body = json.dumps({"reports": [{"taxonomy": {"parents": [1, int(taxon) + 1]}}]}).encode()
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body if code == 200 else b"")

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked
    server.shutdown()


def test_taxa_are_asked_for_once(spark, tmp_path, service):
    url, asked = service
    how = {"rate": 1e6, "wait": 0.01, "partitions": 4}
    ids = spark.range(100, 400).selectExpr("CAST(id AS STRING) AS taxon_id").union(spark.createDataFrame([("100",), (None,), ("101",)], "taxon_id string"))
    got = {r.taxon_id: (r.parents, r.error) for r in taxonomy.lookup(ids, url, str(tmp_path / "answers"), **how).collect()}
    assert len(got) == 300 and got["101"] == ([1, 102], None)
    assert all((parents is None and "404" in error) == t.endswith("4") for t, (parents, error) in got.items())
    assert all(n == (2 if t.endswith("5") else 1) for t, n in asked.items()), "busy answers are asked for again, refusals are not"
    asked.clear()
    more = taxonomy.lookup(ids.union(spark.createDataFrame([("7001",)], "taxon_id string")), url, str(tmp_path / "answers"), **how)
    more.collect(), more.count()
    assert set(asked) == {t for t in got if t.endswith("4")} | {"7001"} and max(asked.values()) == 1, "only what the table lacks, and once whatever is done with the frame"


def test_ids_stay_out_of_the_plan(spark, tmp_path, service):
    url, _ = service
    ids = spark.range(10_000).selectExpr("CAST(1000000 + id AS STRING) AS taxon_id")
    plan = taxonomy.asked(ids, url)._jdf.queryExecution().toString()
    assert "1000123" not in plan and "Range" in plan


def test_rate_and_errors(spark):
    import time

    t = time.monotonic()
    got = taxonomy.asked(spark.createDataFrame([("1",), ("2",), ("3",)], "taxon_id string"), "http://127.0.0.1:9", timeout=1, partitions=1, rate=4, retries=1, wait=0.1).collect()
    assert len(got) == 3 and all(r.content is None and r.error for r in got)
    assert time.monotonic() - t > 5 * 0.25, "six requests at four a second"


STUB = """
import sqlite3

def connect(database, host=None, port=None, user=None, password=None):
    with open("{folder}/opened", "a") as f:
        f.write(f"{{database}} {{user}}\\n")
    return sqlite3.connect(f"{folder}/{{database}}.db")
"""


def test_a_run_from_its_parameters(spark, tmp_path, service):
    """Databases, map, taxa, patches and SQL files all from parameters; each database is read once."""
    url, asked = service
    (tmp_path / "lineara_test_driver.py").write_text(STUB.format(folder=tmp_path))
    sys.path.insert(0, str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "lineara_test_driver.py"))
    by = {}
    for db, species, key, value in fx.META:
        by.setdefault(db, []).append((species, key, value))
    for db, rows_ in by.items():
        make(tmp_path, db, [*rows_, (1, "much.else", "never read")])
    (tmp_path / "m.csv").write_text("core\n" + "\n".join(d for d in by if d != "db_missing") + "\n")
    (tmp_path / "map.json").write_text(json.dumps({"101": "from_service"}))
    (tmp_path / "sql").mkdir()
    (tmp_path / "sql/db_met.sql").write_text("INSERT INTO meta VALUES (1, 'loaded', 'yes;no');")
    params = config.Parameters(
        csv_file=str(tmp_path / "m.csv"), out_dir=str(tmp_path / "out"), project="alpha", default_source="given", run_busco_core=True, apply_busco_metakeys=True, datasets_file=str(tmp_path / "map.json"),
        taxonomy_url=url, taxonomy_dir=str(tmp_path / "taxa"), sql_dir=str(tmp_path / "sql"), driver="lineara_test_driver", database=config.Database("h", 1, "writer", "reader", "p"),
    )
    out = plan_run.run(spark, params, reports=fx.reports(spark), name="first")
    reads = Counter(x.split()[0] for x in (tmp_path / "opened").read_text().split("\n") if x.endswith(" reader"))
    assert reads == {db: 1 for db in by if db != "db_missing"}, "one read a database in a run"
    assert {r.taxon_id: r.busco_dataset for r in out["busco"]["tasks"].collect()}["100"] == "from_service"
    assert {(r.db, r.reason) for r in out["busco"]["quarantine"].collect()} == {("db_unknown", "no_scientific_name"), ("db_unknown", "unknown_mode"), ("db_no_e", "no_score"), ("db_missing", "no_record")}
    assert out["busco"]["metakeys"].where("db = 'db_missing'").count() == 0 and out["busco"]["summaries"].where("db = 'db_missing'").count() == 0
    assert {r.db: (r.statements, r.error) for r in out["busco_applied"]} == {"db_protein": (10, None), "db_min": (11, None), "db_met": (9, None)}
    assert sqlite3.connect(tmp_path / "db_missing.db").execute("SELECT count(*) FROM meta WHERE meta_key LIKE '%busco%'").fetchone() == (0,)
    assert [tuple(r) for r in out["sql_applied"]] == [("db_met", 1, None)]
    assert sqlite3.connect(tmp_path / "db_met.db").execute("SELECT meta_value FROM meta WHERE meta_key IN ('assembly.busco', 'loaded') ORDER BY meta_key").fetchall() == [("kept as it was",), ("yes;no",)]
    where = tmp_path / "out/Apis_mellifera/GCA_000002.2/given"
    assert sorted(p.name for p in where.iterdir()) == ["db_min.sql", "db_min_busco_genome_metakey.json", "statistics"]
    assert (where / "db_min.sql").read_text().startswith("USE db_min;")
    asked.clear()
    again = plan_run.run(spark, params, reports=fx.reports(spark), name="first")
    assert {r.db: r.statements for r in again["busco_applied"]} == {"db_protein": 10, "db_min": 11, "db_met": 9}, "a run of the same name finds its marks"
    assert set(asked) == {"104"}, "the service is asked only for what it refused"


def test_parameters_that_lack_something(tmp_path):
    there = tmp_path / "m.csv"
    there.write_text("core\n")
    good = config.Parameters(csv_file=str(there), out_dir="/o", project="beta")
    with pytest.raises(ValueError, match="driver"):
        good.merged({"sql_dir": "/s"}).checked()
    with pytest.raises(ValueError, match="taxonomy_dir"):
        good.merged({"taxonomy_url": "http://x"}).checked()


def test_manifests_are_split(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m/a.csv").write_text("core\n" + "\n".join(f' db_"{k},x ' for k in range(5000)) + "\n\n")
    (tmp_path / "m/b.csv").write_text("core\r\nlast\r\n")
    from lineara.sources import manifests

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        frame = manifests.read_core_manifest(spark, str(tmp_path / "m"))
        assert frame.rdd.getNumPartitions() > 3
        assert sorted(r.core for r in frame.collect()) == sorted([f'db_"{k},x' for k in range(5000)] + ["last"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
