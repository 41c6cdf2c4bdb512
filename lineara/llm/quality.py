"""Operator 10: quality rules as a ledger of failure bits, in Spark's own functions only.

Each rule is evaluated once over the whole text: its measurements are kept as columns and its verdict as one bit of
``failed_bits``. A policy is a named, versioned set of rules, a mask over those bits, so policies are applied and
compared on the ledger without the texts. The ledger is stored; ablations count documents by their failure bits.

Words are runs of characters other than space and U+0009 to U+000D; lines are split at newlines. A null text is one
without words, which fails the rule on few words; a null doc_id is kept as such; equal rows are judged alike; an empty
table gives an empty ledger. A very long text is one row's arrays of words and windows, so memory follows the longest
text. All columns but doc_id and text are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, texts

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Name of each rule and when a document fails it; a rule's bit is its place here, so new rules go last.
RULES: dict[str, Column | str] = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "symbols": "n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
}
#: Rules of each policy version.
POLICIES: dict[str, list[str]] = {
    "base": ["few_words", "repeated_windows"],
    "v1": list(RULES),
}


def mask(policy: str) -> int:
    """The bits of a policy's rules."""
    names = list(RULES)
    return sum(1 << names.index(r) for r in POLICIES[policy])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of each whole text."""
    rows = texts(docs)
    rows = rows.withColumn("words", F.filter(F.split("text", SPACE), lambda w: w != ""))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    n = F.size("hashes")
    window = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]))
    rows = rows.withColumn("windows", F.when(n > WINDOW, window)).drop("hashes")
    # most texts repeat no window, which sorting plain numbers tells; only for the others places are kept
    rows = rows.withColumn("repeats", F.size("windows") > F.size(F.array_distinct("windows")))
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("placed", F.when(F.col("repeats"), placed)).drop("windows")
    twice = F.filter("placed", lambda x, k: (x["h"] == F.get("placed", k - 1)["h"]) | (x["h"] == F.get("placed", k + 1)["h"]))
    rows = rows.withColumn("at", F.array_sort(F.transform(twice, lambda x: x["i"]))).drop("placed")
    steps = F.transform("at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("at", k + 1) - p, F.lit(WINDOW))))
    return rows.withColumn("n_repeat_words", F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")).drop("at", "repeats")


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and failed_bits, one bit for each rule that the document fails."""
    bits = sum((F.when(F.expr(rule), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k, rule in enumerate(RULES.values())), F.lit(0).cast("long"))
    return measured(docs).withColumn("failed_bits", bits)


def stored(docs: DataFrame) -> DataFrame:
    """The ledger of documents, written once; policies and ablations read it and never the texts."""
    return saved(ledger(docs), "ledger")


def judged(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """A ledger with the verdicts: kept by the policy, policies (bit k: kept by the k-th policy) and decisive_bits, the one
    rule of the policy without which a document that fails would be kept (none or several: 0)."""
    failed = F.col("failed_bits").bitwiseAND(F.lit(mask(policy)))
    by_policy = sum((F.when(F.col("failed_bits").bitwiseAND(F.lit(mask(name))) == 0, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k, name in enumerate(POLICIES)), F.lit(0).cast("long"))
    alone = F.when(F.bit_count(failed) == 1, failed).otherwise(F.lit(0).cast("long"))
    return rows.withColumns({"kept": failed == 0, "policies": by_policy, "decisive_bits": alone})


def ablations(rows: DataFrame) -> DataFrame:
    """policy, rule, failing, only_this, kept, kept_without: for each rule of each policy how many documents of a ledger fail it,
    fail no other rule of the policy, are kept, and would be kept without it.

    Documents are counted by their failure bits, of which there are at most 2 ** len(RULES) values; all else is bitwise
    arithmetic on those few counts.
    """
    counts = rows.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    names = list(RULES)
    trials = [F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(mask(p)).cast("long").alias("mask"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for p, rules in POLICIES.items() for r in rules]
    tried = counts.select("failed_bits", "n", F.inline(F.array(*trials)))
    total = lambda condition: F.coalesce(F.sum(F.when(F.expr(condition), F.col("n"))), F.lit(0))
    return tried.groupBy("policy", "rule").agg(
        total("failed_bits & bit <> 0").alias("failing"), total("failed_bits & mask = bit").alias("only_this"), total("failed_bits & mask = 0").alias("kept"), total("failed_bits & mask & ~bit = 0").alias("kept_without"),
    )


def with_ablations(verdicts: DataFrame, policy: str = "v1") -> DataFrame:
    """Verdicts with n_regained: how many documents the policy would keep more without the rule that decides this one (none: 0).

    The ablations' rows, one for each rule, are all that is broadcast.
    """
    names = list(RULES)
    bit = F.element_at(F.create_map(*[F.lit(x) for k, r in enumerate(names) for x in (r, 1 << k)]), F.col("rule")).cast("long")
    more = ablations(verdicts).where(F.col("policy") == policy).select(bit.alias("decisive_bits"), (F.col("kept_without") - F.col("kept")).alias("n_regained"))
    return verdicts.join(F.broadcast(more), "decisive_bits", "left").withColumn("n_regained", F.coalesce("n_regained", F.lit(0).cast("long")))
