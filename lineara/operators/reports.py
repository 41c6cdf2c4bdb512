"""Report texts to typed columns; malformed reports are set aside with a reason."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants


def without_lines(content: Column, part: str = constants.DROPPED_LINE) -> Column:
    """The text without the lines that contain part."""
    return F.array_join(F.filter(F.split(content, "\n"), lambda x: ~F.contains(x, F.lit(part))), "\n")


def concatenated(files: DataFrame, by: str, text: Column, order: Column, name: str = "content") -> DataFrame:
    """The texts of each ``by`` one after another, in order, with nothing between them."""
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order.alias("o"), text.alias("t")))), lambda x: x["t"]), "")
    return files.groupBy(by).agg(joined.alias(name))


def lines_after_header(files: DataFrame, ids: list[str], content: str) -> DataFrame:
    """Every line of a text but the first, whole, with its number."""
    lines = files.select(*ids, F.posexplode(F.split(content, "\n")).alias("line_no", "line"))
    return lines.where("line_no > 0").withColumn("line_no", F.col("line_no").cast("long"))


def found(content: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group; null where there is none."""
    return F.nullif(F.regexp_extract(content, pattern, group), F.lit(""))


def parse(reports: DataFrame, content: str = "content") -> DataFrame:
    """reports with the fields of their texts; a field is null where the text lacks it.

    The patterns run in a generator of one row, which no filter on the fields is pushed below: each pattern reads each text once,
    and the parts of a score come from its own match.
    """
    text, field = F.col(content), lambda name: F.nullif(F.col(f"_{name}"), F.lit(""))
    patterns = {"version": constants.VERSION, "dataset": constants.DATASET, "run_mode": constants.MODE} | constants.COUNTS
    read = [F.regexp_extract(text, pattern, 1).alias(f"_{name}") for name, pattern in patterns.items()]
    read.append(F.regexp_extract(text, constants.SCORE, 0).alias("_score"))
    read.append(F.when(F.contains(text, F.lit(constants.MODE_WITH_ERRONEOUS)), F.regexp_extract(text, constants.SCORE_ERRONEOUS, 0)).alias("_with_erroneous"))
    rows = reports.select("*", F.inline(F.array(F.struct(*read))))
    for name in ("version", "dataset", "run_mode"):
        rows = rows.withColumn(name, field(name))
    rows = rows.withColumn("busco_mode", normal_mode(F.col("run_mode")))
    rows = rows.withColumns({name: field(name).try_cast("int") for name in constants.COUNTS})
    erroneous = F.col("run_mode") == constants.MODE_WITH_ERRONEOUS
    rows = rows.withColumn("score", F.when(erroneous, field("with_erroneous")).otherwise(field("score")))
    rows = rows.withColumn("total", found(F.col("score"), constants.SCORE, 6).try_cast("int"))
    rows = rows.withColumn("erroneous", F.when(erroneous, found(F.col("score"), constants.SCORE_ERRONEOUS, 7)))
    return rows.drop(*[f"_{name}" for name in (*patterns, "score", "with_erroneous")])


def normal_mode(mode: Column) -> Column:
    """genome or protein; null for any other mode."""
    return F.when(mode.isin(constants.GENOME_MODES), "genome").when(mode == constants.PROTEIN_MODE, "protein")


def reason(mode: Column, score: Column) -> Column:
    """Why a parsed report can't be used; null if it can."""
    return F.when(normal_mode(mode).isNull(), F.when(mode.isNull(), "no_mode").otherwise("unknown_mode")).when(score.isNull(), "no_score")


def classified(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("reason", reason(F.col("run_mode"), F.col("score")))


def strict(parsed: DataFrame) -> DataFrame:
    """The parsed reports, raising an error at the first that can't be used."""
    bad = F.raise_error(F.concat(F.lit("unusable report: "), reason(F.col("run_mode"), F.col("score"))))
    return parsed.where(F.coalesce(F.when(F.col("reason").isNotNull(), bad).cast("boolean"), F.lit(True)))


def completeness(rows: DataFrame, by: list[str], status: Column, names: dict[str, str]) -> DataFrame:
    """Counts of each status and per mille of all, for status rows of a scorer (names: column by status value)."""
    counts = [F.count_if(status == v).alias(n) for v, n in names.items()]
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *counts)
    return out.select(*by, "total", *names.values(), *[F.expr(f"{n} * 1000 div total").alias(f"{n}_per_mille") for n in names.values()])
