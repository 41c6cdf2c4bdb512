"""The schema of every stage; sources never infer one."""

CORE_MANIFEST = "core string"
ASSEMBLY_MANIFEST = "gca string, taxon_id string"
RECORD = "gca string, taxon_id string, core string"
MINIMAL_RECORD = "gca string, core string"
META = "db string, species_id int, meta_key string, meta_value string"
LINEAGE = "taxon_id string, dataset string"
TAXONOMY_REPORT = "struct<reports:array<struct<taxonomy:struct<parents:array<bigint>>>>>"
TAXA = "taxon_id string, parents array<bigint>"
REPORT = "gca string, db string, mode string, path string, content string"
CACHE = "gca string, busco_dataset string, mode string, path string, content string"
PATCH = "db string, ordinal int, statement string"
QUARANTINE = "db string, gca string, stage string, reason string"
