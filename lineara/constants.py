"""Names, keys, labels and report patterns that inputs and outputs must carry exactly."""

#: Metadata keys.
ACCESSION = "assembly.accession"
TAXONOMY_ID = "species.taxonomy_id"
SCIENTIFIC_NAME = "species.scientific_name"
PRODUCTION_NAME = "species.production_name"
ANNOTATION_SOURCE = "species.annotation_source"
ENRICHMENT_KEYS = [ACCESSION, TAXONOMY_ID, SCIENTIFIC_NAME, PRODUCTION_NAME, ANNOTATION_SOURCE]

#: What stands for a record without a database.
NO_DATABASE = "core"
NO_DATABASE_SPECIES = "species"

#: Labels and endings of file names.
LABELS = {"genome": "genome_busco", "protein": "protein_busco"}
SUMMARY_ENDING = "short_summary.txt"
OMARK_LABEL = "omark"
OMARK_ENDING = "proteins_detailed_summary.txt"
STATISTICS_FOLDER = "statistics"
DROPPED_LINE = "Summarized benchmarking in BUSCO notation for file"

#: Modes of reports.
GENOME_MODES = ["genome", "euk_genome_met", "euk_genome_min"]
PROTEIN_MODE = "proteins"
MODE_WITH_ERRONEOUS = "euk_genome_min"

#: Patterns of the report, group 1 unless said otherwise.
VERSION = r"BUSCO version is: ((\d+\.\d+.\d+))"
DATASET = r"The lineage dataset is: ([\w_]+)"
MODE = r"BUSCO was run in mode: ([\w_]+)"
#: A number is tried from its first digit only, and without giving digits back.
COUNTS = {
    "complete": r"(?<!\d)(\d++)\s++Complete BUSCOs \(C\)",
    "single_copy": r"(?<!\d)(\d++)\s++Complete and single-copy BUSCOs \(S\)",
    "duplicated": r"(?<!\d)(\d++)\s++Complete and duplicated BUSCOs \(D\)",
    "fragmented": r"(?<!\d)(\d++)\s++Fragmented BUSCOs \(F\)",
    "missing": r"(?<!\d)(\d++)\s++Missing BUSCOs \(M\)",
}
#: Group 0 is the score, group 6 the total.
SCORE = r"C:(\d+\.\d+)%\[S:(\d+\.\d+)%.*,D:(\d+\.\d+)%\],F:(\d+\.\d+)%.*,M:(\d+\.\d+)%,n:(\d+)"
#: Group 7 is the share of erroneous ones.
SCORE_ERRONEOUS = SCORE + r",E:(\d+\.\d+)%"

#: Metadata keys of a parsed report, after "assembly." or "genebuild.", by column.
METAKEYS = {
    "version": "busco_version", "dataset": "busco_dataset", "score": "busco", "busco_mode": "busco_mode", "complete": "busco_completeness", "single_copy": "busco_single_copy",
    "duplicated": "busco_duplicated", "fragmented": "busco_fragmented", "missing": "busco_missing", "total": "busco_total", "erroneous": "busco_erroneus",
}
#: What a run reads of a database: its description, and the metakeys that a patch leaves as they are.
RUN_KEYS = ENRICHMENT_KEYS + [head + key for head in ("assembly.", "genebuild.") for key in METAKEYS.values()]
