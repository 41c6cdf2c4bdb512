"""Small inputs of our own for queries on formats that the driver's tables don't have."""

from pyspark.sql import DataFrame, SparkSession

from .. import schemas


def report_text(mode: str, dataset: str, counts: tuple | None, total: int, score: str) -> str:
    """A report as a scorer writes it; without counts it ends at the score."""
    head = [
        "# BUSCO version is: 5.7.1 ",
        f"# The lineage dataset is: {dataset} (Creation date: 2024-01-08, number of genomes: 62, number of BUSCOs: {total})",
        "# Summarized benchmarking in BUSCO notation for file /x/in.fa",
        f"# BUSCO was run in mode: {mode}",
        "",
        "\t***** Results: *****",
        "",
        f"\t{score}\t   ",
    ]
    if counts is None:
        return "\n".join(head) + "\n"
    c, s, d, f, m = counts
    return "\n".join([
        *head,
        f"\t{c}\tComplete BUSCOs (C)\t\t\t   ",
        f"\t{s}\tComplete and single-copy BUSCOs (S)\t   ",
        f"\t{d}\tComplete and duplicated BUSCOs (D)\t   ",
        f"\t{f}\tFragmented BUSCOs (F)\t\t\t   ",
        f"\t{m}\tMissing BUSCOs (M)\t\t\t   ",
        f"\t{total}\tTotal BUSCO groups searched\t\t   ",
    ]) + "\n"


#: (gca, db, mode, path, content)
REPORTS = [
    ("GCA_963576655.1", "db_protein", "protein", "/r/r1.txt", report_text("proteins", "aves_odb10", (8085, 8046, 39, 50, 203), 8338, "C:97.0%[S:96.5%,D:0.5%],F:0.6%,M:2.4%,n:8338")),
    ("GCA_000002.2", "db_min", "genome", "/r/r2.txt", report_text("euk_genome_min", "insecta_odb10", (1352, 1336, 16, 6, 9), 1367, "C:98.9%[S:97.7%,D:1.2%],F:0.4%,M:0.7%,n:1367,E:3.5%")),
    ("GCA_000003.1", "db_met", "genome", "/r/r3.txt", report_text("euk_genome_met", "fungi_odb10", (683, 681, 2, 18, 57), 758, "C:90.1%[S:89.8%,D:0.3%],F:2.4%,M:7.5%,n:758")),
    ("GCA_000004.1", "db_no_e", "genome", "/r/r4.txt", report_text("euk_genome_min", "insecta_odb10", (1352, 1336, 16, 6, 9), 1367, "C:98.9%[S:97.7%,D:1.2%],F:0.4%,M:0.7%,n:1367")),
    ("GCA_000005.1", "db_unknown", "genome", "/r/r5.txt", report_text("transcriptome", "bacteria_odb10", (99, 98, 1, 6, 19), 124, "C:80.0%[S:79.0%,D:1.0%],F:5.0%,M:15.0%,n:124")),
    ("GCA_000006.1", "db_missing", "protein", "/r/r6.txt", report_text("proteins", "eukaryota_odb10", None, 255, "C:99.6%[S:99.2%,D:0.4%],F:0.0%,M:0.4%,n:255")),
]
#: (db, species_id, meta_key, meta_value)
META = [
    *[(r[1], 1, "assembly.accession", r[0]) for r in REPORTS],
    *[(r[1], 1, "species.taxonomy_id", str(n)) for n, r in enumerate(REPORTS, 100)],
    ("db_protein", 1, "species.scientific_name", "Gallus  gallus"), ("db_min", 1, "species.scientific_name", "Apis mellifera"), ("db_met", 1, "species.scientific_name", ""),
    ("db_no_e", 1, "species.scientific_name", "O'Brien fly"), ("db_missing", 1, "species.scientific_name", "Homo sapiens"),
    ("db_protein", 1, "species.annotation_source", "braker"), ("db_min", 1, "species.production_name", "apis_mellifera"), ("db_met", 1, "assembly.busco", "kept as it was"),
]
#: (taxon_id, parents root first)
TAXA = [("100", [1, 131567, 2759, 33208, 7742, 8782]), ("101", [1, 131567, 2759, 33208, 50557]), ("102", [1, 131567, 2759, 4751]), ("103", [1, 131567]), ("104", []), ("105", [1, 131567, 2759])]
#: (taxon_id, dataset)
LINEAGE = [("2759", "eukaryota_odb10"), ("33208", "metazoa_odb10"), ("7742", "vertebrata_odb10"), ("8782", "aves_odb10"), ("50557", "insecta_odb10"), ("4751", "fungi_odb10"), ("105", "self_odb10")]
#: (db, scientific_name, production_name, source, gca, project, datatype)
NAMES = [
    ("db_a", "Homo  sapiens", "homo_sapiens", "braker", "GCA_963576655.1", "alpha", "genome"),
    ("db_b", "", None, None, "GCA_000001405.29", "alpha", "protein"),
    ("db_c", None, None, "refseq", "GCF_1.1", "beta", "genome"),
    ("core", None, None, None, "GCA_2.1", "alpha", "genome"),
    ("core", None, None, None, "GCA_3.1", "beta", "other"),
]


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, list):
        return "CAST([" + ", ".join(map(literal, value)) + "] AS BIGINT[])"
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def values(rows: list) -> str:
    """Rows as an SQL VALUES list."""
    return "VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)


def frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def reports(spark: SparkSession) -> DataFrame:
    return frame(spark, REPORTS, schemas.REPORT)


NAMES_SCHEMA = "db string, scientific_name string, production_name string, source string, gca string, project string, datatype string"
