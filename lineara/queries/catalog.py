"""The registered queries of the metadata engine, and the SQL that each must agree with.

The driver's tables hold no annotation data, so each operator runs on a whole table of the same shape, or on the
fixtures where only the format matters.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config, constants, schemas
from ..functions import naming
from ..operators import enrich, history, intervals, lineage, merge, metakeys, reports, scripts
from ..plans import pipelines
from ..session import ship
from ..sources import sequences
from . import fixtures as fx

#: The source of records that name none, in these queries.
SOURCE = "submitted"
QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None):
    """Register a function as the query of its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt over as many tasks as a shuffle has: a small file is one split, but the texts made of its rows are much work."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


EAV_COLUMNS = ["c_name", "c_mktsegment", "c_nation"]


def eav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as key and value rows."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").cast("string").alias("c_nation"))
    return enrich.to_rows(rows, ["c_custkey"], EAV_COLUMNS)


EAV = """eav AS (SELECT c_custkey, meta_key, meta_value FROM (
    UNPIVOT (SELECT c_custkey, c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nation FROM customer)
    ON c_name, c_mktsegment, c_nation INTO NAME meta_key VALUE meta_value))"""


@query("SELECT c_name AS gca, CAST(c_custkey AS VARCHAR) AS taxon_id, 'core' AS core FROM customer")
def manifest_project(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_name").alias("gca"), F.col("c_custkey").cast("string").alias("taxon_id"))
    return enrich.assembly_records(rows)


@query("""SELECT doc_id, line_no, line FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents) WHERE line_no > 0""")
def manifest_lines_skip_header(spark, sf_dir):
    return reports.lines_after_header(table(spark, sf_dir, "documents"), ["doc_id"], "text")


@query(f"WITH {EAV} SELECT * FROM eav")
def eav_unpivot(spark, sf_dir):
    return eav(spark, sf_dir)


@query(f"WITH {EAV} SELECT * FROM eav WHERE meta_key = 'c_name'")
def eav_point_lookup(spark, sf_dir):
    return enrich.lookup(eav(spark, sf_dir), "c_name")


@query(f"""WITH {EAV}, wide AS (SELECT c_custkey, min(meta_value) FILTER (meta_key = 'c_name') AS name, min(meta_value) FILTER (meta_key = 'c_mktsegment') AS segment FROM eav GROUP BY 1)
    SELECT o_orderkey, o_custkey, name, segment FROM orders LEFT JOIN wide ON o_custkey = c_custkey""")
def eav_pivot_enrich_full(spark, sf_dir):
    wide = enrich.to_columns(eav(spark, sf_dir), "c_custkey", {"c_name": "name", "c_mktsegment": "segment"}).withColumnRenamed("c_custkey", "o_custkey")
    return enrich.enrich(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), wide, "o_custkey")


@query(f"WITH {EAV} SELECT o_orderkey, o_custkey, meta_value AS name FROM orders LEFT JOIN (SELECT * FROM eav WHERE meta_key = 'c_name') ON o_custkey = c_custkey")
def eav_pivot_enrich_minimal(spark, sf_dir):
    wide = enrich.to_columns(eav(spark, sf_dir), "c_custkey", {"c_name": "name"}).withColumnRenamed("c_custkey", "o_custkey")
    return enrich.enrich(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), wide, "o_custkey")


@query("SELECT n_nationkey, n_name, coalesce(r_name, 'submitted') AS source FROM nation LEFT JOIN (SELECT * FROM region WHERE r_name LIKE 'A%') ON n_regionkey = r_regionkey")
def default_missing_row(spark, sf_dir):
    known = table(spark, sf_dir, "region").where("r_name LIKE 'A%'").withColumnRenamed("r_regionkey", "n_regionkey")
    rows = enrich.enrich(table(spark, sf_dir, "nation"), known, "n_regionkey")
    return rows.select("n_nationkey", "n_name", naming.or_missing(F.col("r_name"), F.lit(SOURCE)).alias("source"))


#: A record of each customer, in expressions that mean the same to Spark and to SQL: some have no database, some no name or an empty one.
CUSTOMER_NAMES = [
    "CASE WHEN c_nationkey % 5 = 0 THEN 'core' ELSE concat('db_', CAST(c_custkey AS STRING)) END AS db",
    "CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL ELSE concat('Genus  ', lower(c_mktsegment)) END AS scientific_name",
    "CASE WHEN c_nationkey > 12 THEN 'braker' END AS source", "concat('GCA_', CAST(c_custkey AS STRING), '.', CAST(c_nationkey AS STRING)) AS gca",
    "CASE WHEN c_nationkey < 8 THEN 'beta' ELSE 'alpha' END AS project", "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'protein' WHEN 'FURNITURE' THEN 'other' ELSE 'genome' END AS datatype",
]
NAMES = f"SELECT {', '.join(CUSTOMER_NAMES)} FROM customer"


@query(f"SELECT db, gca, coalesce(nullif(scientific_name, ''), db) AS name FROM ({NAMES})")
def default_empty_value(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(*CUSTOMER_NAMES)
    return rows.select("db", "gca", naming.or_empty(F.col("scientific_name"), F.col("db")).alias("name"))


@query("SELECT user_id, arg_min(value, event_id) AS first_value FROM events GROUP BY user_id")
def first_row_deterministic(spark, sf_dir):
    return enrich.first_by(table(spark, sf_dir, "events"), "user_id", F.col("value"), F.col("event_id"), "first_value")


@query("SELECT p_partkey, lower(regexp_replace(p_name, '\\s', '_', 'g')) AS slug FROM part")
def slug_name(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.lower(naming.slug_name(F.col("p_name"))).alias("slug"))


@query("SELECT s_suppkey, replace(replace(lower(s_name || '_1.2'), '.', 'v'), '_', '') AS slug FROM supplier")
def slug_accession(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", naming.slug_accession(F.concat("s_name", F.lit("_1.2"))).alias("slug"))


@query("""SELECT c_custkey, regexp_replace(n_name, '\\s', '_', 'g') || '/' || c_name || '/' || r_name AS path
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def publish_path(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("c_custkey", naming.publish_path(naming.slug_name(F.col("n_name")), F.col("c_name"), F.col("r_name")).alias("path"))


NAMED = f"""named AS (
    SELECT *, CASE WHEN db = 'core' THEN 'species' ELSE lower(regexp_replace(coalesce(nullif(scientific_name, ''), db), '\\s', '_', 'g')) END AS species,
           CASE WHEN db = 'core' THEN gca ELSE regexp_replace(coalesce(nullif(scientific_name, ''), db), '\\s', '_', 'g') || '/' || gca || '/' || coalesce(source, 'submitted') END AS publish_dir,
           CASE datatype WHEN 'genome' THEN 'genome_busco' WHEN 'protein' THEN 'protein_busco' ELSE '' END AS label,
           replace(replace(lower(gca), '.', 'v'), '_', '') AS slug
    FROM ({NAMES}))"""


@query(f"""WITH {NAMED} SELECT gca, publish_dir,
    CASE WHEN project = 'beta' THEN label || '_short_summary.txt' ELSE species || '_' || slug || '_' || label || '_short_summary.txt' END AS summary_name,
    species || '_' || slug || '_omark_proteins_detailed_summary.txt' AS omark_name,
    CASE WHEN project = 'alpha' THEN '/out/' || db ELSE '/out' END AS project_dir FROM named""")
def summary_name_by_project(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(*CUSTOMER_NAMES)
    species = naming.species(F.col("db"), F.col("scientific_name"))
    return rows.select(
        "gca", naming.record_path(F.col("db"), F.col("gca"), F.col("scientific_name"), F.col("source"), SOURCE).alias("publish_dir"),
        naming.summary_name(F.col("project"), species, F.col("gca"), F.col("datatype"), ("beta",)).alias("summary_name"), naming.omark_name(species, F.col("gca")).alias("omark_name"),
        naming.publish_dir(F.lit("/out"), F.col("project"), F.col("db"), ("alpha",)).alias("project_dir"),
    )


#: A sparse map as lineage datasets are, for the runs below: nations whose names end in 7, and regions whose names begin
#: with A (numbered from 1000). So some records have their nation's dataset, some fall back to their region's, and some have none.
def nation_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").where("n_name LIKE '%7'").select(F.col("n_nationkey").cast("string").alias("taxon_id"), F.col("n_name").alias("dataset"))
    regions = table(spark, sf_dir, "region").where("r_name LIKE 'A%'").select((F.col("r_regionkey") + 1000).cast("string").alias("taxon_id"), F.col("r_name").alias("dataset"))
    return nations.unionByName(regions)


def whole_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation and every region (numbered from 1000) with its dataset."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("taxon_id"), F.col("n_name").alias("dataset"))
    regions = table(spark, sf_dir, "region").select((F.col("r_regionkey") + 1000).cast("string").alias("taxon_id"), F.col("r_name").alias("dataset"))
    return nations.unionByName(regions)


def customer_taxa(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    """customers as taxa below their nation and region; how="left" keeps those of no known nation, which have null ancestors."""
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), how)
    return rows.select("c_custkey", F.array((F.col("n_regionkey") + 1000).cast("long"), F.col("n_nationkey").cast("long")).alias("parents"))


MAP = """lineage AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS dataset FROM nation WHERE n_name LIKE '%7'
    UNION ALL SELECT r_regionkey + 1000, r_name FROM region WHERE r_name LIKE 'A%'),
    taxa AS (SELECT c_custkey, [n_regionkey + 1000, n_nationkey] AS parents FROM customer JOIN nation ON c_nationkey = n_nationkey),
    up AS (SELECT c_custkey, unnest(parents) AS id, generate_subscripts(parents, 1) AS pos FROM taxa),
    near AS (SELECT c_custkey, arg_max(dataset, pos) AS dataset FROM up JOIN lineage USING (id) GROUP BY c_custkey)"""
WHOLE_MAP = """lineage AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS dataset FROM nation UNION ALL SELECT r_regionkey + 1000, r_name FROM region),
    taxa AS (SELECT c_custkey, [n_regionkey + 1000, n_nationkey] AS parents FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
    up AS (SELECT c_custkey, unnest(parents) AS id, generate_subscripts(parents, 1) AS pos FROM taxa),
    near AS (SELECT c_custkey, arg_max(dataset, pos) AS dataset FROM up JOIN lineage USING (id) GROUP BY c_custkey)"""


@query(f"WITH {WHOLE_MAP} SELECT n_nationkey, dataset FROM nation JOIN lineage ON n_nationkey = id")
def lineage_exact_lookup(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_nationkey").cast("string").alias("taxon_id"))
    return rows.join(whole_map(spark, sf_dir), "taxon_id").select("n_nationkey", "dataset")


@query(f"WITH {WHOLE_MAP} SELECT * FROM near")
def lineage_nearest_ancestor(spark, sf_dir):
    return lineage.nearest_dataset(customer_taxa(spark, sf_dir, "left"), whole_map(spark, sf_dir), "c_custkey")


@query(f"WITH {WHOLE_MAP} SELECT c_custkey FROM taxa WHERE c_custkey NOT IN (SELECT c_custkey FROM near)")
def lineage_unmatched(spark, sf_dir):
    return lineage.unmatched(customer_taxa(spark, sf_dir, "left"), whole_map(spark, sf_dir), "c_custkey").select("c_custkey")


@query(f"WITH {WHOLE_MAP} SELECT c_custkey, 'given_odb10' AS forced, dataset AS blank FROM near")
def dataset_override(spark, sf_dir):
    near = lineage.nearest_dataset(customer_taxa(spark, sf_dir, "left"), whole_map(spark, sf_dir), "c_custkey")
    return near.select("c_custkey", naming.override(" given_odb10\n", F.col("dataset")).alias("forced"), naming.override("  ", F.col("dataset")).alias("blank"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS parents FROM events")
def taxonomy_json_parents(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))
    content = F.concat(F.lit('{"reports":[{"taxonomy":{"parents":['), F.col("k").cast("string"), F.lit("]}}]}"))
    return lineage.parents_of(rows.withColumn("content", content)).select("event_id", "k", F.array_join(F.col("parents").cast("array<string>"), ",").alias("parents"))


@query("""WITH RECURSIVE t AS (SELECT p_partkey AS child, nullif(p_partkey // 2, 0) AS parent FROM part),
    up(child, ancestor, distance) AS (SELECT child, parent, CAST(1 AS BIGINT) FROM t WHERE parent IS NOT NULL
        UNION ALL SELECT up.child, t.parent, up.distance + 1 FROM up JOIN t ON t.child = up.ancestor WHERE t.parent IS NOT NULL)
    SELECT * FROM up""")
def taxonomy_walk_recursive(spark, sf_dir):
    """Parts as a tree in which each hangs below the one of half its number."""
    tree = table(spark, sf_dir, "part").selectExpr("p_partkey AS child", "nullif(p_partkey div 2, 0) AS parent")
    return lineage.walk_up(tree, "child", "parent")


def part_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tree: nodes of half the number are parents."""
    return table(spark, sf_dir, "part").selectExpr("p_partkey", "nullif(p_partkey div 2, 0) AS parent")


def part_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset for the smallest parts, about one in seventeen."""
    return table(spark, sf_dir, "part").where("p_size <= 3").selectExpr("CAST(p_partkey AS STRING) AS taxon_id", "p_brand AS dataset")


PART_MAP = """RECURSIVE t AS (SELECT p_partkey AS node, nullif(p_partkey // 2, 0) AS up FROM part),
    m AS (SELECT p_partkey AS node, p_brand AS dataset FROM part WHERE p_size <= 3),
    climb(node, here, distance) AS (SELECT node, up, CAST(1 AS BIGINT) FROM t UNION ALL
        SELECT climb.node, t.up, distance + 1 FROM climb JOIN t ON t.node = climb.here WHERE climb.here NOT IN (SELECT node FROM m)),
    near AS (SELECT climb.node, m.dataset, distance FROM climb JOIN m ON m.node = climb.here)"""


@query(f"WITH {PART_MAP} SELECT t.node AS p_partkey, dataset, distance FROM t LEFT JOIN near USING (node)")
def lineage_on_edges(spark, sf_dir):
    """Every part with its nearest ancestor's dataset and how far that is, or nulls, from links alone."""
    return lineage.nearest_on_edges(part_edges(spark, sf_dir), part_map(spark, sf_dir), "p_partkey", "parent")


@query(f"WITH {PART_MAP} SELECT l_orderkey, l_linenumber, dataset FROM lineitem LEFT JOIN near ON node = l_partkey")
def lineage_interval_lookup(spark, sf_dir):
    """Very many lookups: each line item's part, by a range search in the tree's numbers."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    near = intervals.nearest(items, intervals.numbered(part_edges(spark, sf_dir), "p_partkey", "parent"), part_map(spark, sf_dir), "l_partkey")
    return items.join(near, "l_partkey", "left").select("l_orderkey", "l_linenumber", "dataset")


@query("""WITH RECURSIVE t AS (SELECT p_partkey AS node, nullif(p_partkey // 2, 0) AS up FROM part),
    above(node, anc) AS (SELECT node, node FROM t UNION ALL SELECT above.node, t.up FROM above JOIN t ON t.node = above.anc WHERE t.up IS NOT NULL)
    SELECT anc AS p_partkey, count(*) AS n_below, CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS BIGINT) AS cents_below FROM above JOIN part ON node = p_partkey GROUP BY anc""")
def lineage_subtree_totals(spark, sf_dir):
    """Of each part the number and price of all parts below it and itself: sums over its run of numbers, as differences of running sums."""
    tree = intervals.numbered(part_edges(spark, sf_dir), "p_partkey", "parent")
    cents = table(spark, sf_dir, "part").selectExpr("p_partkey AS node", "CAST(round(p_retailprice * 100) AS BIGINT) AS cents")
    return intervals.totals(tree, cents, "node", "cents").selectExpr("node AS p_partkey", "n_below", "cents AS cents_below")


@query("""SELECT doc_id, md5(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT contains(x, 'the')), chr(10))) AS text_md5 FROM documents""")
def report_line_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(reports.without_lines(F.col("text"), "the")).alias("text_md5"))


@query("SELECT conv_id, md5(string_agg(text, '' ORDER BY turn)) AS text_md5, CAST(length(string_agg(text, '' ORDER BY turn)) AS BIGINT) AS n_chars FROM conversations GROUP BY conv_id")
def report_concat(spark, sf_dir):
    rows = reports.concatenated(table(spark, sf_dir, "conversations"), "conv_id", F.col("text"), F.col("turn"))
    return rows.select("conv_id", F.md5("content").alias("text_md5"), F.length("content").cast("long").alias("n_chars"))


#: A report of each customer, in expressions that mean the same to Spark and to SQL: gca, db, mode, path, content.
CUSTOMER_REPORTS = [
    "c_name AS gca", "concat('db_', CAST(c_custkey AS STRING)) AS db", "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'protein' ELSE 'genome' END AS mode", "concat('/r/', c_name) AS path",
    """concat('# BUSCO version is: 5.', CAST(c_nationkey AS STRING), '.1 ', chr(10), '# The lineage dataset is: ', lower(c_mktsegment), '_odb10 (Creation date: 2024-01-08)', chr(10),
        '# Summarized benchmarking in BUSCO notation for file /x/in.fa', chr(10),
        '# BUSCO was run in mode: ', CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'proteins' WHEN 'BUILDING' THEN 'euk_genome_min' WHEN 'FURNITURE' THEN 'euk_genome_met' WHEN 'MACHINERY' THEN 'transcriptome' ELSE 'genome' END, chr(10), chr(10),
        chr(9), 'C:', CAST(c_custkey % 100 AS STRING), '.', CAST(c_nationkey % 10 AS STRING), '%[S:9', CAST(c_nationkey % 10 AS STRING), '.5%,D:0.5%],F:0.6%,M:', CAST(c_nationkey AS STRING), '.4%,n:', CAST(c_custkey AS STRING),
        CASE WHEN c_nationkey > 12 THEN concat(',E:', CAST(c_nationkey AS STRING), '.5%') ELSE '' END, chr(9), chr(10),
        chr(9), CAST(c_custkey + 7 AS STRING), chr(9), 'Complete BUSCOs (C)', chr(10), chr(9), CAST(c_custkey AS STRING), chr(9), 'Complete and single-copy BUSCOs (S)', chr(10),
        CASE WHEN c_nationkey > 3 THEN concat(chr(9), '7', chr(9), 'Complete and duplicated BUSCOs (D)', chr(10), chr(9), CAST(c_nationkey AS STRING), chr(9), 'Fragmented BUSCOs (F)', chr(10)) ELSE '' END,
        chr(9), '12', chr(9), 'Missing BUSCOs (M)', chr(10)) AS content""",
]


def _found(pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract(content, '{pattern}', {group}), '')"


#: The patterns as the formats have them, written apart from those that the operators use.
_SCORE = r"C:(\d+\.\d+)%\[S:(\d+\.\d+)%.*,D:(\d+\.\d+)%\],F:(\d+\.\d+)%.*,M:(\d+\.\d+)%,n:(\d+)"
_COUNTED = {"complete": r"(\d+)\s+Complete BUSCOs \(C\)", "single_copy": r"(\d+)\s+Complete and single-copy BUSCOs \(S\)", "duplicated": r"(\d+)\s+Complete and duplicated BUSCOs \(D\)", "fragmented": r"(\d+)\s+Fragmented BUSCOs \(F\)", "missing": r"(\d+)\s+Missing BUSCOs \(M\)"}
_KEYS = [
    ("version", "busco_version"), ("dataset", "busco_dataset"), ("score", "busco"), ("busco_mode", "busco_mode"), ("complete", "busco_completeness"), ("single_copy", "busco_single_copy"), ("duplicated", "busco_duplicated"),
    ("fragmented", "busco_fragmented"), ("missing", "busco_missing"), ("total", "busco_total"), ("erroneous", "busco_erroneus"),
]


def _picked(group: int) -> str:
    return f"CASE WHEN run_mode = 'euk_genome_min' THEN {_found(_SCORE + r',E:(\d+\.\d+)%', group)} ELSE {_found(_SCORE, group)} END"


PARSED = rf"""found AS (SELECT * FROM ({fx.values(fx.REPORTS)}) t(gca, db, mode, path, content) UNION ALL SELECT {', '.join(CUSTOMER_REPORTS)} FROM customer),
    r AS (SELECT *, {_found(r'BUSCO was run in mode: ([\w_]+)')} AS run_mode FROM found),
    parsed AS (SELECT gca, db, run_mode, {_found(r'BUSCO version is: ((\d+\.\d+.\d+))')} AS version, {_found(r'The lineage dataset is: ([\w_]+)')} AS dataset,
        CASE WHEN run_mode IN ('genome', 'euk_genome_met', 'euk_genome_min') THEN 'genome' WHEN run_mode = 'proteins' THEN 'protein' END AS busco_mode,
        {', '.join(f"TRY_CAST({_found(p)} AS INT) AS {n}" for n, p in _COUNTED.items())},
        {_picked(0)} AS score, TRY_CAST({_picked(6)} AS INT) AS total,
        CASE WHEN run_mode = 'euk_genome_min' THEN {_found(_SCORE + r',E:(\d+\.\d+)%', 7)} END AS erroneous FROM r),
    judged AS (SELECT *, CASE WHEN run_mode IS NULL THEN 'no_mode' WHEN busco_mode IS NULL THEN 'unknown_mode' WHEN score IS NULL THEN 'no_score' END AS reason FROM parsed)"""


def found_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The odd reports of the fixtures, and one of each customer."""
    return fx.reports(ship(spark)).unionByName(spread(table(spark, sf_dir, "customer")).selectExpr(*CUSTOMER_REPORTS))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.classified(reports.parse(found_reports(spark, sf_dir)))


@query(f"WITH {PARSED} SELECT db, version, dataset, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _COUNTED)} FROM parsed")
def report_parse_counts(spark, sf_dir):
    return judged(spark, sf_dir).select("db", "version", "dataset", *[F.col(c).cast("string").alias(c) for c in constants.COUNTS])


@query(f"WITH {PARSED} SELECT db, score, CAST(total AS VARCHAR) AS total, erroneous FROM parsed")
def report_parse_score(spark, sf_dir):
    return judged(spark, sf_dir).select("db", "score", F.col("total").cast("string").alias("total"), "erroneous")


@query(f"WITH {PARSED} SELECT db, run_mode, busco_mode, CASE WHEN run_mode IN ('genome', 'euk_genome_met', 'euk_genome_min') THEN 'assembly.' ELSE 'genebuild.' END AS prefix FROM parsed")
def report_mode_dispatch(spark, sf_dir):
    return judged(spark, sf_dir).select("db", "run_mode", "busco_mode", metakeys.prefix(F.col("run_mode")).alias("prefix"))


@query(f"WITH {PARSED} SELECT db, gca, reason FROM judged WHERE reason IS NOT NULL")
def report_quarantine(spark, sf_dir):
    return judged(spark, sf_dir).select("db", "gca", "reason").where("reason IS NOT NULL")


KEYED = f"""{PARSED}, keyed AS (
    SELECT db, ordinal, CASE WHEN run_mode LIKE '%genome%' THEN 'assembly.' ELSE 'genebuild.' END || k AS meta_key, v AS meta_value FROM (
        {' UNION ALL '.join(f"SELECT db, run_mode, {n} AS ordinal, '{k}' AS k, CAST({c} AS VARCHAR) AS v FROM judged WHERE reason IS NULL" for n, (c, k) in enumerate(_KEYS))})
    WHERE v IS NOT NULL)"""


@query(f"WITH {KEYED} SELECT * FROM keyed")
def metakeys_unpivot(spark, sf_dir):
    return metakeys.to_eav(judged(spark, sf_dir), ["db"])


def _document(head: str) -> str:
    parts = [f"'{head}{k}', {c if c == 'total' else f'CAST({c} AS VARCHAR)'}" for c, k in _KEYS if (c != "erroneous" or head == "assembly.")]
    return f"json_object({', '.join(parts)}, 'core_db', db)"


@query(f"""WITH {PARSED} SELECT db, db || '_busco_' || busco_mode || '_metakey.json' AS name,
    regexp_replace(CAST(CASE WHEN busco_mode = 'genome' THEN {_document('assembly.')} ELSE {_document('genebuild.')} END AS VARCHAR), '"[a-z_.]+":null,', '', 'g') AS document
    FROM judged WHERE reason IS NULL""")
def metakeys_json(spark, sf_dir):
    return metakeys.to_json(judged(spark, sf_dir))


@query(f"""WITH {EAV} SELECT c_custkey, meta_key, 'INSERT IGNORE INTO meta (species_id, meta_key, meta_value) VALUES (1, ''' || meta_key || ''', ''' || replace(meta_value, '''', '''''') || ''');' AS statement FROM eav""")
def sql_patch_statements(spark, sf_dir):
    return eav(spark, sf_dir).select("c_custkey", "meta_key", metakeys.statement(F.col("meta_key"), F.col("meta_value")).alias("statement"))


@query(f"""WITH {KEYED}, s AS (SELECT db, 'USE ' || db || ';' || chr(10) || chr(10) || string_agg('INSERT IGNORE INTO meta (species_id, meta_key, meta_value) VALUES (1, ''' || meta_key || ''', ''' || replace(meta_value, '''', '''''') || ''');', chr(10) ORDER BY ordinal) AS script FROM keyed GROUP BY db)
    SELECT db, generate_subscripts(string_split(script, ';' || chr(10)), 1) - 1 AS ordinal, unnest(string_split(script, ';' || chr(10))) AS statement FROM s""")
def sql_patch_split(spark, sf_dir):
    scripts = metakeys.scripts(metakeys.to_eav(judged(spark, sf_dir), ["db"]), "db")
    return metakeys.split_script(scripts, ["db"], "script").withColumn("ordinal", F.col("ordinal").cast("long"))


@query("""WITH t AS (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F'),
    p AS (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey)
    SELECT * FROM t UNION ALL SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_custkey = p.o_custkey)""")
def insert_ignore_merge(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return merge.insert_ignore(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'O'"), ["o_custkey"], ["o_orderkey"])


@query(f"""WITH found AS (SELECT {', '.join(CUSTOMER_REPORTS)} FROM customer)
    SELECT 'core' AS db, gca, gca AS publish_dir, 'species_' || replace(replace(lower(gca), '.', 'v'), '_', '') || '_genome_busco_short_summary.txt' AS summary_name,
        md5(regexp_replace(content, '[^\n]*Summarized benchmarking in BUSCO notation for file[^\n]*\n', '')) AS content_md5 FROM found""")
def assembly_run_summaries(spark, sf_dir):
    """A run over assemblies, of which no one has a database: each report is published under its own assembly."""
    customers = table(spark, sf_dir, "customer")
    found = customers.selectExpr(*CUSTOMER_REPORTS).withColumns({"db": F.lit("core"), "mode": F.lit("genome")})
    records = enrich.assembly_records(customers.select(F.col("c_name").alias("gca"), F.col("c_custkey").cast("string").alias("taxon_id")))
    rows = pipelines.summaries(pipelines.described(records, fx.frame(spark, fx.META, schemas.META), SOURCE), found, "alpha")
    return rows.select("db", "gca", "publish_dir", "summary_name", F.md5("content").alias("content_md5"))


@query("""SELECT o_custkey AS db, o_orderpriority AS meta_key, arg_max(o_orderstatus, o_orderkey) AS meta_value FROM orders GROUP BY ALL""")
def patch_history_last_write(spark, sf_dir):
    """Orders as a history of patches, one after another: what the last write of each key leaves."""
    rows = table(spark, sf_dir, "orders").selectExpr("o_custkey AS db", "o_orderpriority AS meta_key", "o_orderstatus AS meta_value", "o_orderkey")
    return history.last_write(rows, ["db", "meta_key"], ["meta_value"], [F.col("o_orderkey")])


@query("""SELECT o_custkey AS db, o_orderpriority AS meta_key, arg_min(o_orderstatus, o_orderkey) AS meta_value FROM orders GROUP BY ALL""")
def patch_history_insert_ignore(spark, sf_dir):
    """The same history where known keys are never updated."""
    rows = table(spark, sf_dir, "orders").selectExpr("o_custkey AS db", "o_orderpriority AS meta_key", "o_orderstatus AS meta_value", "o_orderkey")
    return history.first_write(rows, ["db", "meta_key"], ["meta_value"], [F.col("o_orderkey")])


@query("""SELECT conv_id, CAST(unnest(range(n)) AS INT) AS ordinal, unnest(ids) AS id, unnest(roles) AS description, md5(unnest(said)) AS residues_md5, unnest(sizes) AS length FROM (
    SELECT conv_id, count(*) AS n, list('t' || turn ORDER BY turn) AS ids, list(role ORDER BY turn) AS roles, list(regexp_replace(text, '\s+', '', 'g') ORDER BY turn) AS said,
           list(length(regexp_replace(text, '\s+', '', 'g')) ORDER BY turn) AS sizes FROM conversations WHERE NOT contains(text, '>') GROUP BY conv_id)""")
def sequence_records(spark, sf_dir):
    """A text in the format of sequence files for each conversation, with its turns as records, read back into records."""
    turns = table(spark, sf_dir, "conversations").where("NOT contains(text, '>')")
    line = F.concat(F.lit(">t"), F.col("turn").cast("string"), F.lit(" "), "role", F.lit("\n"), "text", F.lit("\n"))
    texts = reports.concatenated(turns, "conv_id", line, F.col("turn"))
    return sequences.records(texts, ["conv_id"], "content").select("conv_id", "ordinal", "id", "description", F.md5("residues").alias("residues_md5"), "length")


@query("SELECT c_custkey, mode FROM customer CROSS JOIN (VALUES ('genome'), ('protein')) m(mode)")
def fanout_modes(spark, sf_dir):
    return enrich.fan_out(table(spark, sf_dir, "customer").select("c_custkey"), config.Parameters().modes())


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS cached FROM customer")
def cache_probe(spark, sf_dir):
    cache = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return merge.probe(table(spark, sf_dir, "customer").select("c_custkey"), cache, ["c_custkey"])


@query("""SELECT o_custkey, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS complete, count(*) FILTER (o_orderstatus = 'O') AS fragmented,
    count(*) FILTER (o_orderstatus = 'F') * 1000 // count(*) AS complete_per_mille, count(*) FILTER (o_orderstatus = 'O') * 1000 // count(*) AS fragmented_per_mille FROM orders GROUP BY o_custkey""")
def completeness_counts(spark, sf_dir):
    return reports.completeness(table(spark, sf_dir, "orders"), ["o_custkey"], F.col("o_orderstatus"), {"F": "complete", "O": "fragmented"})


#: Metadata of each customer's database, in expressions that mean the same to Spark and to SQL; a null value is no row.
CUSTOMER_META = {
    "assembly.accession": "c_name", "species.taxonomy_id": "CAST(c_custkey AS STRING)", "species.scientific_name": "CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL ELSE concat('Genus ', lower(c_mktsegment)) END",
    "species.annotation_source": "CASE WHEN c_nationkey > 12 THEN 'braker' END", "assembly.busco": "CASE WHEN c_nationkey = 7 THEN 'kept as it was' END",
}
_DB = "concat('db_', CAST(c_custkey AS STRING))"
_META = f"""meta AS (SELECT * FROM ({' UNION ALL '.join(f"SELECT {_DB} AS db, '{k}' AS meta_key, {v} AS meta_value FROM customer" for k, v in CUSTOMER_META.items())}) WHERE meta_value IS NOT NULL)"""


def customer_run(spark: SparkSession, sf_dir: str) -> tuple[dict, DataFrame]:
    """A run over the databases of all customers but those of one segment, whose reports come all the same; and the metadata before it."""
    customers = table(spark, sf_dir, "customer")
    names = customers.selectExpr(f"{_DB} AS db", "c_custkey", "c_mktsegment")
    rows = customers.select(F.expr(_DB).alias("db"), F.inline(F.array(*[F.struct(F.lit(k).alias("meta_key"), F.expr(v).alias("meta_value")) for k, v in CUSTOMER_META.items()])))
    meta = rows.where("meta_value IS NOT NULL").select("db", F.lit(1).alias("species_id"), "meta_key", "meta_value")
    manifest = enrich.core_records(names.where("c_mktsegment <> 'HOUSEHOLD'").select(F.col("db").alias("core")), meta)
    taxa = customer_taxa(spark, sf_dir).select(F.col("c_custkey").cast("string").alias("taxon_id"), "parents")
    params = config.Parameters(csv_file="s3://manifest", out_dir="/out", project="alpha", default_source=SOURCE, run_busco_core=True, apply_busco_metakeys=True)
    return pipelines.busco(manifest, meta, taxa, nation_map(spark, sf_dir), spread(customers).selectExpr(*CUSTOMER_REPORTS), params), meta


CUSTOMER_RUN = f"""{PARSED.replace(f"SELECT * FROM ({fx.values(fx.REPORTS)}) t(gca, db, mode, path, content) UNION ALL ", "")}, {MAP}, {_META},
    wide AS (SELECT db, min(meta_value) FILTER (meta_key = 'assembly.accession') AS gca, min(meta_value) FILTER (meta_key = 'species.taxonomy_id') AS taxon_id,
        min(meta_value) FILTER (meta_key = 'species.scientific_name') AS name, min(meta_value) FILTER (meta_key = 'species.annotation_source') AS source FROM meta GROUP BY db),
    mine AS (SELECT wide.* FROM wide JOIN customer ON db = {_DB} WHERE c_mktsegment <> 'HOUSEHOLD'),
    keyed AS (
    SELECT db, ordinal, CASE WHEN run_mode LIKE '%genome%' THEN 'assembly.' ELSE 'genebuild.' END || k AS meta_key, v AS meta_value FROM (
        {' UNION ALL '.join(f"SELECT db, run_mode, {n} AS ordinal, '{k}' AS k, CAST({c} AS VARCHAR) AS v FROM judged WHERE reason IS NULL" for n, (c, k) in enumerate(_KEYS))})
    WHERE v IS NOT NULL AND db IN (SELECT db FROM mine)),
    fresh AS (SELECT db, count(*) AS new_keys FROM keyed k WHERE NOT EXISTS (SELECT 1 FROM meta m WHERE m.db = k.db AND m.meta_key = k.meta_key) GROUP BY db)"""


@query(f"""WITH {CUSTOMER_RUN},
    named AS (SELECT *, regexp_replace(coalesce(nullif(name, ''), db), '\\s', '_', 'g') AS folder FROM mine)
    SELECT w.db, w.gca, near.dataset AS busco_dataset, folder || '/' || w.gca || '/' || coalesce(source, 'submitted') AS publish_dir,
        lower(folder) || '_' || replace(replace(lower(w.gca), '.', 'v'), '_', '') || '_' || r.mode || '_busco_short_summary.txt' AS summary_name,
        score, CASE WHEN name IS NULL THEN 'no_scientific_name' ELSE reason END AS reason, coalesce(new_keys, 0) AS new_keys
    FROM named w LEFT JOIN near ON c_custkey = CAST(taxon_id AS BIGINT) LEFT JOIN judged j ON j.db = w.db LEFT JOIN r ON r.db = w.db LEFT JOIN fresh ON fresh.db = w.db
    UNION ALL SELECT db, gca, NULL, NULL, NULL, NULL, 'no_record', 0 FROM r WHERE db NOT IN (SELECT db FROM mine)""")
def pipeline_end_to_end(spark, sf_dir):
    """A run over databases: for each its dataset, where its summary goes, its score, why it was set aside if it was, and its new metakeys; and reports without a record."""
    out, meta = customer_run(spark, sf_dir)
    named, scores = out["summaries"].select("db", "summary_name"), reports.parse(out["reports"]).select("db", "score")
    fresh = merge.new_rows(meta, out["metakeys"], ["db", "meta_key"], ["meta_value"]).groupBy("db").agg(F.count("*").alias("new_keys"))
    why = out["quarantine"].groupBy("db").agg(F.min_by("reason", "stage").alias("reason"))
    records = out["tasks"].groupBy(F.col("core").alias("db"), "gca", "busco_dataset", "publish_dir").agg(F.count("*").alias("modes")).drop("modes")
    rows = records.join(named, "db", "left").join(scores, "db", "left").join(why, "db", "left").join(fresh, "db", "left").withColumn("new_keys", F.coalesce("new_keys", F.lit(0).cast("long")))
    none = F.lit(None).cast("string")
    strays = out["quarantine"].where("reason = 'no_record'").select("db", "gca", none.alias("busco_dataset"), none.alias("publish_dir"), none.alias("summary_name"), none.alias("score"), "reason", F.lit(0).cast("long").alias("new_keys"))
    return rows.unionByName(strays)


@query(f"""WITH {CUSTOMER_RUN} SELECT db, 1 AS species_id, meta_key, meta_value FROM meta
    UNION ALL SELECT db, 1, meta_key, meta_value FROM keyed k WHERE NOT EXISTS (SELECT 1 FROM meta m WHERE m.db = k.db AND m.meta_key = k.meta_key)""")
def run_meta_after_patch(spark, sf_dir):
    """The metadata of all databases after a run's patch: nothing is overwritten, and databases that are in no manifest stay as they are."""
    return customer_run(spark, sf_dir)[0]["meta"]


#: Statements of each customer with what a cut at semicolons would break, in expressions that mean the same to Spark and
#: to SQL: chr(39) and chr(34) are quotes.
CUSTOMER_STATEMENTS = [
    f"concat('USE ', {_DB})",
    "concat('INSERT INTO meta VALUES (1, ', chr(39), 'k;', c_name, chr(39), ', ', chr(39), 'a;', chr(10), lower(c_mktsegment), chr(39), chr(39), ';', chr(39), chr(39), 'b', chr(39), ')')",
    "concat('-- note; of ', c_name, chr(10), 'UPDATE meta SET meta_value = ', chr(34), c_mktsegment, ';', chr(34), ' WHERE species_id = ', CAST(c_nationkey AS STRING), ' /* ', c_name, '; */')",
]


@query(f"SELECT db, CAST(unnest([0, 1, 2]) AS INT) AS ordinal, unnest([{', '.join(CUSTOMER_STATEMENTS)}]) AS statement FROM (SELECT *, {_DB} AS db FROM customer)")
def sql_statements(spark, sf_dir):
    """A script of each customer cut into its statements, at the semicolons outside quotes and comments."""
    script = f"concat({CUSTOMER_STATEMENTS[0]}, ';', chr(10), chr(10), {CUSTOMER_STATEMENTS[1]}, '; ', {CUSTOMER_STATEMENTS[2]}, ';', chr(10), '-- the end;')"
    texts = spread(table(spark, sf_dir, "customer")).selectExpr(f"{_DB} AS db", f"{script} AS script")
    return scripts.statements(texts, ["db"], "script")


@query("SELECT page_id, url, regexp_matches(url, '\\.example\\.com/') AS in_host, url LIKE '%#top' AS at_top FROM pages WHERE url LIKE '%/en/%'")
def glob_filter(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").where(url.contains("/en/")).select("page_id", "url", url.rlike(r"\.example\.com/").alias("in_host"), url.endswith("#top").alias("at_top"))


@query("SELECT conv_id, md5(arg_max(text, turn)) AS text_md5 FROM conversations GROUP BY conv_id")
def last_write_wins(spark, sf_dir):
    return enrich.last_by(table(spark, sf_dir, "conversations"), "conv_id", F.col("text"), F.col("turn"), "last_text").select("conv_id", F.md5("last_text").alias("text_md5"))


_MODES = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'genome' WHEN 'BUILDING' THEN 'genome,protein' WHEN 'FURNITURE' THEN 'euk_genome_min' ELSE 'protein' END"


@query(f"SELECT c_custkey, list_contains(string_split(s, ','), 'genome') AS is_member, contains(s, 'genome') AS is_substring FROM (SELECT c_custkey, {_MODES} AS s FROM customer)")
def string_membership_vs_substring(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{_MODES} AS s")
    return rows.select("c_custkey", naming.has_member(F.split("s", ","), "genome").alias("is_member"), naming.has_substring(F.col("s"), "genome").alias("is_substring"))
