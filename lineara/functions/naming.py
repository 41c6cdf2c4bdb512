"""Names and paths as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants


def slug_name(name: Column) -> Column:
    """Each white-space character becomes one underscore."""
    return F.regexp_replace(name, r"\s", "_")


def slug_accession(accession: Column) -> Column:
    """Lower case, dots as v, without underscores."""
    return F.replace(F.replace(F.lower(accession), F.lit("."), F.lit("v")), F.lit("_"), F.lit(""))


def trimmed(text: Column) -> Column:
    """Without white space at both ends, newlines included."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def or_missing(value: Column, default: Column) -> Column:
    """The default where there is no row, that is null."""
    return F.coalesce(value, default)


def or_empty(value: Column, default: Column) -> Column:
    """The default where the value is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), default)


def override(parameter: str | None, value: Column) -> Column:
    """A run's parameter, unless it is null or blank, else the record's value; both trimmed."""
    return F.coalesce(F.nullif(trimmed(F.lit(parameter).cast("string")), F.lit("")), trimmed(value))


def scientific_name(value: Column, db: Column) -> Column:
    return slug_name(or_empty(value, db))


def publish_path(name: Column, accession: Column, source: Column) -> Column:
    """name/accession/source; null if a part is null, so that no folder is ever skipped."""
    return F.concat(name, F.lit("/"), accession, F.lit("/"), source)


def publish_dir(folder: Column, project: Column, name: Column, named: tuple = ()) -> Column:
    """The folder, and under it the name for the projects that want it."""
    return F.concat_ws("/", folder, F.when(project.isin(*named) & (name != ""), name))


def record_path(db: Column, accession: Column, name: Column, source: Column, default_source: str | None = None) -> Column:
    """Where a record's results go: its accession alone if it has no database. Null if it has no source and there is no default."""
    with_db = publish_path(scientific_name(name, db), accession, or_missing(source, F.lit(default_source).cast("string")))
    return F.when(db == constants.NO_DATABASE, accession).otherwise(with_db)


def species(db: Column, name: Column) -> Column:
    return F.when(db == constants.NO_DATABASE, constants.NO_DATABASE_SPECIES).otherwise(F.lower(scientific_name(name, db)))


def label(datatype: Column) -> Column:
    out = F.lit("")
    for kind, name in constants.LABELS.items():
        out = F.when(datatype == kind, name).otherwise(out)
    return out


def summary_name(project: Column, species: Column, accession: Column, datatype: Column, short: tuple = ()) -> Column:
    """The file name of a filtered summary; the projects in ``short`` have names without species and accession."""
    brief = F.concat_ws("_", label(datatype), F.lit(constants.SUMMARY_ENDING))
    full = F.concat_ws("_", species, slug_accession(accession), label(datatype), F.lit(constants.SUMMARY_ENDING))
    return F.when(project.isin(*short), brief).otherwise(full)


def omark_name(species: Column, accession: Column) -> Column:
    return F.concat_ws("_", species, slug_accession(accession), F.lit(constants.OMARK_LABEL), F.lit(constants.OMARK_ENDING))


def translations_name(production_name: Column) -> Column:
    return F.concat(F.lower(production_name), F.lit("_translations.fa"))


def has_member(modes: Column, mode: str) -> Column:
    """A list has the mode as a member."""
    return F.array_contains(modes, mode)


def has_substring(modes: Column, mode: str) -> Column:
    """A text has the mode somewhere in it, which is another question than membership."""
    return F.contains(modes, F.lit(mode))
