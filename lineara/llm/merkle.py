"""Operator 12: a Merkle manifest of documents, over a trie of ranks.

A row is a leaf, the hash of its five columns. Leaves of a source ascend by doc_id; every FAN consecutive nodes become
their hash until one is left, the source's subroot; subroots, by source, become the root in the same way. A leaf's proof
is what stands left and right of it and of its ancestors.

Ranks come without a global sort. doc_ids are read as four digits of 10 to 16 bits; for each level of digits a histogram
counts rows by prefix, and prefix sums among the children of one prefix (65,536 at most) add up to what is before a
bucket of 1,024 ids; a row's place inside its bucket is found there. If a bucket holds more than CROWDED rows, since a
doc_id has many texts, digits of the leaf hash follow. Rows equal in all columns are counted before anything is shuffled and spread out afterwards.

The digits of a rank in base FAN are a leaf's key in the trie. Nodes that share all but the last LEVELS digits, 729 at
most, are reduced in one row, then what is left by the next LEVELS, so ten million documents take three shuffles and
not fifteen. Paths come down the same blocks: each block's path is joined once for all its members. A source that holds
most documents has as many blocks as its share.

Null doc_ids come first, null values are hashed as "-", a null source is a source of its own; rows with one doc_id stand
in the order of their hashes and equal rows are leaves each; rows without doc_id aren't tampered with; texts may be of
any length (they are read once and never shuffled); an empty table gives no rows; further columns are ignored.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

FAN, LEVELS = 3, 6
BLOCK = FAN**LEVELS
CROWDED = 1 << 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def hashed(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf(docs: DataFrame, **other: Column) -> Column:
    """The hash of a row, with other columns in place of its own where given."""

    def item(name):
        value = other.get(name, docs[name]).cast("long" if name in ("doc_id", "n_chars") else "string").cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return hashed(F.concat(*[item(name) for name in FIELDS]))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, grp, leaf, told (the leaf after tampering, if there is any), copies, of distinct rows.

    grp stands for the source and sorts as it does: the empty text for null, else a dot and the name.
    """
    doc_id = docs["doc_id"].cast("long")
    lot = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    own = leaf(docs)
    told = F.when(lot & F.contains("text", F.lit("\n")), leaf(docs, text=F.replace(docs["text"], F.lit("\n"), F.lit("")))).otherwise(own)
    grp = F.coalesce(F.concat(F.lit("."), docs["source"].cast("string")), F.lit(""))
    rows = docs.select(doc_id.alias("doc_id"), grp.alias("grp"), own.alias("leaf"), told.alias("told"))
    return rows.groupBy("doc_id", "grp", "leaf", "told").agg(F.count(F.lit(1)).alias("copies"))


#: Where the digits of a doc_id begin, in bits from the right; the lowest ten bits are found inside a bucket.
SHIFTS = [48, 32, 20, 10]


def _digits(crowded: bool) -> list[Column]:
    """Digits of a row's place, the greatest first: of doc_id but the lowest bits, and if buckets are crowded those and the leaf's."""
    doc_id = F.col("doc_id")
    digits = [F.shiftright(doc_id, SHIFTS[0]) + 32769]  # a null's is 0, and comes first
    for above, shift in zip(SHIFTS, SHIFTS[1:] + [0] * crowded):
        digits.append(F.shiftright(doc_id, shift).bitwiseAND(F.lit((1 << above - shift) - 1)))
    digits = [F.coalesce(d, F.lit(0).cast("long")) for d in digits]
    return digits + [F.conv(F.substring("leaf", at, 4), 16, 10).cast("long") for at in (1, 5)] if crowded else digits


def ranked(rows: DataFrame) -> DataFrame:
    """rows with rank (the first of their copies', from 0) in their grp by (doc_id, leaf), and n, the size of the grp."""

    def with_digits(crowded):
        digits = _digits(crowded)
        names = [f"_d{k}" for k in range(len(digits))]
        return rows.withColumns(dict(zip(names, digits))), names

    placed, names = with_digits(False)
    histogram = placed.groupBy("grp", *names).agg(F.sum("copies").alias("c"), F.count(F.lit(1)).alias("rows"))
    if histogram.where(F.col("rows") > CROWDED).head(1):
        placed, names = with_digits(True)
        histogram = placed.groupBy("grp", *names).agg(F.sum("copies").alias("c"))
    histogram = saved(histogram.select("grp", *names, "c"), "digit-histogram")
    offsets = histogram.groupBy("grp").agg(F.sum("c").alias("n"), F.lit(0).cast("long").alias("before"))
    for k in range(len(names)):
        prefix = ["grp", *names[:k]]
        counts = histogram.groupBy(*prefix, names[k]).agg(F.sum("c").alias("c"))
        less = F.sum("c").over(Window.partitionBy(*prefix).orderBy(names[k]).rowsBetween(Window.unboundedPreceding, -1))
        counts = counts.withColumn("less", F.coalesce(less, F.lit(0).cast("long"))).join(offsets, prefix)
        offsets = counts.select(*prefix, names[k], "n", (F.col("before") + F.col("less")).alias("before"))
    inside = F.sum("copies").over(Window.partitionBy("grp", *names).orderBy("doc_id", "leaf").rowsBetween(Window.unboundedPreceding, -1))
    found = placed.withColumn("inside", F.coalesce(inside, F.lit(0).cast("long"))).join(offsets, ["grp", *names])
    return found.select(*rows.columns, (F.col("before") + F.col("inside")).alias("rank"), "n")


def ordered(groups: DataFrame) -> DataFrame:
    """groups with rank by grp: sorted by ranges and written, then numbered by the counts of the ranges (a row each)."""
    at = F.monotonically_increasing_id()
    rows = saved(groups.orderBy("grp").withColumn("_at", at), "sorted-groups").withColumn("_part", F.shiftright("_at", 33))
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_part", F.coalesce(before, F.lit(0).cast("long")).alias("before"))
    place = F.col("before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(counts, "_part").withColumn("rank", place).drop("_at", "_part", "before")


def depth(n: Column) -> Column:
    """The levels above n leaves."""
    return sum(((n > FAN**k).cast("int") for k in range(1, 40)), (n > 1).cast("int"))


def _above(nodes: Column) -> Column:
    """The next level of an array of nodes."""
    return F.transform(F.sequence(F.lit(1), F.size(nodes), F.lit(FAN)), lambda i: hashed(F.array_join(F.slice(nodes, i, FAN), "")))


def _with_levels(blocks: DataFrame, round_: int) -> DataFrame:
    """blocks with m, the levels that this round takes, and _l0.._l6, their nodes level by level."""
    left = depth(F.col("n")) - LEVELS * round_
    out = blocks.withColumn("m", F.greatest(F.lit(0), F.least(F.lit(LEVELS), left))).withColumn("_l0", F.transform("members", lambda x: x["node"]))
    for k in range(LEVELS):
        below = F.col(f"_l{k}")
        out = out.withColumn(f"_l{k + 1}", F.when(F.col("m") > k, _above(below)).otherwise(below))
    return out


def blocks_of(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round, stored, from nodes (grp, n, rank, node and more); and grp, n, node of each grp's top."""
    rounds, most = [], 1
    while True:
        more = [c for c in nodes.columns if c not in ("grp", "n", "rank")]
        keyed = nodes.withColumn("block", F.expr(f"rank div {BLOCK}"))
        blocks = keyed.groupBy("grp", "n", "block").agg(F.sort_array(F.collect_list(F.struct("rank", *more))).alias("members"))
        rounds.append(saved(_with_levels(blocks, len(rounds)).select("grp", "n", "block", "members", F.get(f"_l{LEVELS}", F.lit(0)).alias("node")), "merkle-blocks"))
        nodes = rounds[-1].select("grp", "n", F.col("block").alias("rank"), "node")
        most *= BLOCK
        if not rounds[-1].where(F.col("n") > most).head(1):
            return rounds, nodes.drop("rank")


def paths(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The nodes that the blocks came from with path, the siblings left and right of each level up to the top and then tops' own path; tops (grp, path and more)."""
    more = [c for c in tops.columns if c not in ("grp", "path")]
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for k in reversed(range(len(rounds))):

        def siblings(i):
            found = []
            for level in range(LEVELS):
                nodes, at = F.col(f"_l{level}"), F.floor(i / FAN**level).cast("int")
                place = at % FAN
                first = at - place
                left, right = F.slice(nodes, first + 1, place), F.slice(nodes, first + place + 2, FAN - 1 - place)
                found.append(F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right")))
            return F.slice(F.array(*found), F.lit(1), F.col("m"))

        blocks = _with_levels(rounds[k].join(above, ["grp", "block"]), k)
        fields = [f for f in blocks.schema["members"].dataType.elementType.names]
        member = lambda x, i: F.struct(*[x[f].alias(f) for f in fields], F.concat(siblings(i), F.col("path")).alias("path"))
        above = blocks.select("grp", *more, F.inline(F.transform("members", member)))
        if k:
            above = above.select("grp", *more, F.col("rank").alias("block"), "path")
    return above


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, node, lambda acc, p: hashed(F.concat(p["left"], acc, p["right"])))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, source, rank, leaf, told, subroot, root and path of every document."""
    rows = ranked(saved(leaves(docs), "merkle-leaves"))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    rows = rows.select("grp", "n", "rank", F.col("leaf").alias("node"), "told", "doc_id", copy.alias("_copy")).withColumn("rank", F.col("rank") + F.col("_copy")).drop("_copy")
    rounds, subroots = blocks_of(rows)
    sources = ordered(subroots.select("grp", "node")).withColumnRenamed("grp", "member")
    total = sources.agg(F.count(F.lit(1)).alias("n"))
    upper, root = blocks_of(sources.crossJoin(total).withColumn("grp", F.lit("")).select("grp", "n", "rank", "node", "member"))
    none = F.array().cast("array<struct<left:string,right:string>>")
    tops = paths(upper, root.select("grp", F.col("node").alias("root"), none.alias("path")))
    found = paths(rounds, tops.select(F.col("member").alias("grp"), F.col("node").alias("subroot"), "root", "path"))
    source = F.when(F.col("grp") != "", F.expr("substring(grp, 2)"))
    return found.select("doc_id", source.alias("source"), "rank", F.col("node").alias("leaf"), "told", "subroot", "root", "path")


def report(rows: DataFrame) -> DataFrame:
    """What the contract asks for of a manifest: the digest of each proof, and what the leaf after tampering folds to."""
    proof = hashed(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""))
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), fold(F.col("told"), F.col("path")).alias("folded_root"), "source", "rank")
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
