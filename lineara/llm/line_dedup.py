"""Operator 7: removal of repeated passages by content-defined chunks of lines, in Spark's own functions only.

A text is split at newlines and each line is hashed. A rolling hash runs over the line hashes of a text (a running
exclusive-or of hashes turned by their place), so the hash of any stretch of lines follows from two of its values.
Chunks are chosen by content alone: one begins at each line and ends where its words reach ``min_words``, and one ends at
each line and begins as late as it can with that many words. Neither rule looks at where a line stands in its text or
at lines outside the chunk, so lines put in or taken out elsewhere move no border. Chunks overlap: every run of lines
with ``min_words`` words or more is a union of chunks inside it, so whatever recurs is found, from its first line to its last,
whatever stands around it. A line with that many words is a chunk alone, or else passages of one paragraph would stay.

Of equal chunks the first stays (least doc_id, then its text's hash, then first line) and the others go. Chunks of one
document that follow the same first document at the same distance are joined to one run, and a run goes only if its
bytes equal those of the lines that it follows: where hashes collide, text stays. The first occurrence of a line is never
removed, so no line disappears from the corpus as a whole.

Only numbers are shuffled to find the runs; the texts of documents that lose lines move to compare them, and all once
to be cut. Joins on chunk hashes read both sides from files, so adaptive execution can split a hash that a large part
of all chunks share. A text's chunks are found in one sorted pass over its lines and cut in one; time and memory follow
its number of lines, and a very long text is one group of a sort that can spill.

Null texts are empty; rows without doc_id pass unchanged and count for nothing; rows equal in doc_id and text are one
document, of which all rows are cut alike; a text of which all lines go becomes empty; an empty table gives an empty
table. Other columns pass through, but for ones named n_lines or n_removed_lines, which are replaced.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved

WORD = r"[^\x20\x09-\x0D]+"
KEY = ["_id", "_th"]
FIRST = ["_id0", "_th0"]
#: Both sides of every join here grow with the corpus and have no bound, so none is broadcast, whatever its size is today.
MERGED = "merge"


def _keyed(docs: DataFrame) -> DataFrame:
    """_row with all columns of docs, and apart from it text, _id and _th, so that no column's name can clash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), text.alias("text"), F.col("doc_id").cast("long").alias("_id"))
    return rows.withColumn("_th", F.xxhash64("text"))


def _turned(x: str, n: str) -> str:
    """SQL: the bits of x turned left by n places."""
    return f"(shiftleft({x}, {n}) | shiftrightunsigned({x}, 64 - {n}))"


def lines(docs: DataFrame) -> DataFrame:
    """A row for each line: place i, hash turned by its place, words w; each line of a document once."""
    rows = docs.where("_id is not null").select(*KEY, F.transform(F.split("text", "\n"), lambda x: F.struct(F.xxhash64(x).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w"))).alias("_l"))
    rows = rows.select(*KEY, F.posexplode("_l").alias("i", "_l")).select(*KEY, "i", F.col("_l.h").alias("h"), F.col("_l.w").cast("long").alias("w"))
    rows = rows.repartition(*KEY).dropDuplicates([*KEY, "i"])
    return rows.select(*KEY, "i", "w", F.expr(_turned("h", "(i % 64)")).alias("h"))


def chunks(rows: DataFrame, min_words: int) -> DataFrame:
    """The chunks of all lines: document, first and last line, hash. No chunk comes twice."""
    so_far = Window.partitionBy(*KEY).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"end": F.sum("w").over(so_far), "rolled": F.bit_xor("h").over(so_far)})
    rows = rows.withColumns({"begin": F.col("end") - F.col("w"), "before": F.col("rolled").bitwiseXOR(F.col("h"))})
    # words before (or up to) a line and its place in one number, so that a range of words ends at a single line
    span = (int(min_words) << 32) - 1
    rows = rows.withColumns({"_b": F.expr("shiftleft(begin, 32) + i"), "_e": F.expr("shiftleft(end, 32) + i")})
    ahead = Window.partitionBy(*KEY).orderBy("_b").rangeBetween(0, span)
    behind = Window.partitionBy(*KEY).orderBy("_e").rangeBetween(-span, 0)
    rows = rows.withColumns({"to": F.last("i").over(ahead), "to_end": F.last("end").over(ahead), "to_rolled": F.last("rolled").over(ahead)})
    rows = rows.withColumns({"of": F.first("i").over(behind), "of_begin": F.first("begin").over(behind), "of_before": F.first("before").over(behind)})
    chunk = lambda first, last, rolled, before, words: F.struct(
        F.expr(f"{first}").alias("first"), F.expr(f"{last}").alias("last"), F.expr(f"xxhash64({_turned(f'({rolled} ^ {before})', f'(64 - {first} % 64)')}, {last} - {first}, {words})").alias("hash")
    )
    forward = F.when(F.expr(f"to_end - begin >= {int(min_words)}"), chunk("i", "to", "to_rolled", "before", "to_end - begin"))
    # the same chunk as the one that begins there, if the words are reached at this line only
    backward = F.when(F.expr(f"end - of_begin >= {int(min_words)} AND begin - of_begin >= {int(min_words)}"), chunk("of", "i", "rolled", "of_before", "end - of_begin"))
    found = F.filter(F.array(forward, backward), lambda c: c.isNotNull())
    return rows.select(*KEY, F.inline(found))


def followers(found: DataFrame) -> DataFrame:
    """Runs of lines that recur: document, first and last line, and the document and first line of what they follow."""
    again = saved(found.groupBy("hash").count().where("count > 1").select("hash"), "recurring")
    found = saved(found.join(again.hint(MERGED), "hash"), "recurring-chunks")
    place = F.struct(*KEY, "first")
    least = saved(found.groupBy("hash").agg(F.min(place).alias("least")), "first-chunks")
    later = found.join(least.hint(MERGED), "hash").where(place != F.col("least"))
    later = later.select(*KEY, "first", "last", F.col("least._id").alias("_id0"), F.col("least._th").alias("_th0"), (F.col("least.first") - F.col("first")).alias("shift"))
    return _joined(later, [*KEY, *FIRST, "shift"])


def _joined(spans: DataFrame, by: list[str]) -> DataFrame:
    """Spans (first, last) that touch or overlap as one."""
    line = Window.partitionBy(*by).orderBy("first", "last")
    reached = F.max("last").over(line.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("apart", F.when(F.col("first") <= reached + 1, 0).otherwise(1))
    spans = spans.withColumn("run", F.sum("apart").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return spans.groupBy(*by, "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def _with_lines(make) -> Column:
    """make(lines) over the text's lines, which are split once."""
    return F.get(F.transform(F.array(F.split("text", "\n")), make), F.lit(0))


def pieces(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """spans (KEY, first, last) of documents with their text, piece."""
    listed = spans.groupBy(*KEY).agg(F.collect_set(F.struct("first", "last")).alias("_s"))
    texts = docs.select(*KEY, "text").join(listed.hint(MERGED), KEY).dropDuplicates(KEY)
    cut = lambda x: F.transform("_s", lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), F.array_join(F.slice(x, s["first"] + 1, s["last"] - s["first"] + 1), "\n").alias("piece")))
    return texts.select(*KEY, F.inline(_with_lines(cut)))


def removals(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """For each document that loses lines, _id and _th with the spans (first, last) that go, apart and in order."""
    runs = saved(followers(saved(chunks(lines(docs), min_words), "chunks")), "runs").withColumns({"first0": F.col("first") + F.col("shift"), "last0": F.col("last") + F.col("shift")})
    followed = runs.select(*[F.col(a).alias(b) for a, b in zip(FIRST, KEY)], F.col("first0").alias("first"), F.col("last0").alias("last"))
    texts = saved(pieces(docs, runs.select(*KEY, "first", "last").unionByName(followed)), "pieces")
    first = texts.select(F.col("_id").alias("_id0"), F.col("_th").alias("_th0"), F.col("first").alias("first0"), F.col("last").alias("last0"), F.col("piece").alias("piece0"))
    same = runs.join(texts.hint(MERGED), [*KEY, "first", "last"]).join(first.hint(MERGED), [*FIRST, "first0", "last0"]).where("piece = piece0")
    gone = _joined(same.select(*KEY, "first", "last"), KEY)
    return gone.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("_gone"))


def dedup_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """docs with repeated passages of ``min_words`` words or more removed from text, and with n_lines and n_removed_lines."""
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed_lines")]
    rows = _keyed(docs.select(*own))
    rows = rows.join(saved(removals(rows, min_words), "removals").hint(MERGED), KEY, "left")
    begins = F.concat(F.array(F.lit(0)), F.transform("_gone", lambda g: g["last"] + 1))
    kept = lambda x: F.flatten(F.zip_with(begins, F.concat(F.transform("_gone", lambda g: g["first"]), F.array(F.size(x))), lambda a, b: F.slice(x, a + 1, b - a)))
    n = F.size(F.split("text", "\n"))
    gone = F.coalesce(F.aggregate("_gone", F.lit(0), lambda a, g: a + g["last"] - g["first"] + 1), F.lit(0))
    rest = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(_with_lines(kept), "\n"))
    columns = [rest.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in own]
    return rows.select(*columns, n.cast("long").alias("n_lines"), gone.cast("long").alias("n_removed_lines"))
