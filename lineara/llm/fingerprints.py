"""Operator 13: fingerprints of documents from their improbable features.

Every run of WINDOW bytes is a possible feature. Its entropy, in thousandths of the greatest possible, has a rank: the
rarer that entropy is among all runs of the corpus, the lower. A feature is popular as often as it is the lowest (the
first of equals) of NEIGHBOURS runs in a row; those that are POPULAR times or more are chosen, so the choice depends on
what is near and survives edits elsewhere. Runs below LEAST thousandths (one byte over and over) are never chosen. A
chosen run's hash sets five bits of a filter of 2048; a filter takes FULL features and then the next one in the chain
begins, so a fingerprint grows with its text.

Two filters are alike by the bits that they share, less what chance would give, of the most they could share. Two
fingerprints: each filter of the shorter one looks for the filter most like it, and the mean is weighted by features
(with equally many filters, the mean of both directions). 1 for equal fingerprints, 0 beside an empty one.

A text needs its successor by doc_id (then by hash of the text). Rows are dealt by ranges of that order; the first row
of each range, known from a pass over ids alone, goes to the range before it too, so a task streams its range with all
it needs and texts are shuffled once. One doc_id with many texts is split between ranges; only rows equal in doc_id and
text stay together.

Null texts are empty and have the fingerprint "0:"; texts shorter than WINDOW, or without a chosen run, have one feature,
the whole text; longer ones are read whole, in pieces of bounded memory; null doc_ids come first; equal rows follow each
other; a single document is its own successor; an empty table gives no rows; further columns are ignored.
"""

import base64
import bisect
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, partitions, texts

WINDOW, NEIGHBOURS, POPULAR = 32, 32, 8
BITS, FULL = 2048, 160
LEVELS, LEAST = 1000, 100
#: Positions of one piece of work; a rank and a position share 31 bits.
PIECE_BITS = 20
NEVER = 1023
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

#: c * log2(c), with the greatest possible sum at LEVELS << 17: sums are exact and fit 32 bits.
_WEIGHT = np.array([c * np.log2(max(c, 1)) for c in range(WINDOW + 1)]) / (WINDOW * np.log2(WINDOW))
_STEP = np.diff(np.rint(_WEIGHT * (LEVELS << 17))).astype(np.int32)


def entropies(data: np.ndarray) -> np.ndarray:
    """The entropy of each run of WINDOW bytes in thousandths; one run has to fit."""
    n = len(data)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):  # equal bytes among the WINDOW - 1 before and after each byte
        same = (data[d:] == data[:-d]).view(np.uint8)
        before[d:] += same
        after[: n - d] += same
    change = _STEP.take(before, mode="clip")
    change[WINDOW:] -= _STEP.take(after[: n - WINDOW], mode="clip")
    weight = np.cumsum(change, dtype=np.int32)[WINDOW - 1 :]  # of the run that ends here
    return ((LEVELS << 17) + (1 << 16) - weight) >> 17


def _pieces(encoded: list[bytes]):
    """Lists of (text, first, last, from, to): features first..last - 1 are to be read, of which from..to - 1 to be chosen; as much as fits one piece of work."""
    size, room, part = 0, 1 << PIECE_BITS, []
    span = room - 4 * WINDOW
    for k, data in enumerate(encoded):
        n = len(data) - WINDOW + 1
        for a in range(0, n, span):
            b = min(a + span, n)
            first, last = max(0, a - NEIGHBOURS + 1), min(n, b + NEIGHBOURS - 1)
            if part and size + last - first + WINDOW - 1 > room:
                yield part
                size, part = 0, []
            part.append((k, first, last, a, b))
            size += last - first + WINDOW - 1
    if part:
        yield part


def level_counts(encoded: list[bytes]) -> np.ndarray:
    """How often each entropy occurs among the runs of these texts."""
    total = np.zeros(LEVELS + 1, np.int64)
    for part in _pieces(encoded):
        data = np.frombuffer(b"".join(encoded[k][a : b + WINDOW - 1] for k, _, _, a, b in part), np.uint8)
        found, at = entropies(data), 0
        for _, _, _, a, b in part:
            total += np.bincount(found[at : at + b - a], minlength=LEVELS + 1)
            at += b - a + WINDOW - 1
    return total


def ranks_of(counts) -> np.ndarray:
    """The rank of each entropy, the rarest lowest; NEVER for those below LEAST."""
    counts = np.asarray(counts)
    order = sorted(range(LEAST, LEVELS + 1), key=lambda level: (counts[level], level))
    ranks = np.full(LEVELS + 1, NEVER, np.int32)
    ranks[order] = np.arange(len(order))
    return ranks


def hashes(runs: np.ndarray) -> np.ndarray:
    """64 bits for each row of WINDOW bytes, by multiplications and rotations of its 8-byte words (fixed odd factors)."""
    found = np.full(len(runs), WINDOW, np.uint64)
    for word in np.ascontiguousarray(runs).view("<u8").T:
        mixed = (found ^ word) * np.uint64(0x9E3779B185EBCA87)
        found = (mixed << np.uint64(31) | mixed >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
    found ^= found >> np.uint64(29)
    found *= np.uint64(0x165667B19E3779F9)
    return found ^ found >> np.uint64(32)


def chosen(encoded: list[bytes], ranks: np.ndarray):
    """Texts and hashes of the chosen runs of a piece, in order."""
    mask = (1 << PIECE_BITS) - 1
    for part in _pieces(encoded):
        data = np.frombuffer(b"".join(encoded[k][first : last + WINDOW - 1] for k, first, last, _, _ in part), np.uint8)
        ranked = ranks.take(entropies(data), mode="clip")
        n = len(ranked)
        lowest, starts, wanted = np.full(n + NEIGHBOURS, NEVER, np.int32), np.zeros(n, bool), np.full(n, 255, np.uint8)
        begins, at = [], 0
        for k, first, last, a, b in part:
            whole = len(encoded[k]) - WINDOW + 1
            lowest[at : at + last - first] = ranked[at : at + last - first]
            starts[at : at + max(1, last - first - NEIGHBOURS + 1)] = True
            wanted[at + a - first : at + b - first] = min(POPULAR, max(1, (whole - NEIGHBOURS + 1) // 2))
            begins.append(at)
            at += last - first + WINDOW - 1
        lowest <<= PIECE_BITS
        lowest[:n] |= np.arange(n, dtype=np.int32)
        reach = 1
        while reach < NEIGHBOURS:
            lowest = np.minimum(lowest[:-reach], lowest[reach:])
            reach *= 2
        lowest = lowest[:n][starts]
        popular = np.bincount(lowest[lowest < NEVER << PIECE_BITS] & mask, minlength=n)
        at = np.flatnonzero(popular >= wanted)
        owner = np.array([p[0] for p in part])[np.searchsorted(begins, at, side="right") - 1]
        yield owner, hashes(np.lib.stride_tricks.sliding_window_view(data, WINDOW)[at])


class Fingerprint:
    """A chain of filters (rows of BITS // 64 words) and the number of features in them."""

    __slots__ = ("features", "filters")

    def __init__(self, features: int, filters: np.ndarray):
        self.features, self.filters = features, filters

    def __str__(self) -> str:
        return f"{self.features}:{base64.b64encode(self.filters.tobytes()).decode()}"

    @classmethod
    def parse(cls, text: str) -> "Fingerprint":
        features, _, filters = text.partition(":")
        return cls(int(features), np.frombuffer(base64.b64decode(filters), np.uint64).reshape(-1, BITS // 64))

    def sizes(self) -> np.ndarray:
        return np.minimum(FULL, self.features - FULL * np.arange(len(self.filters)))


def fingerprints(encoded: list[bytes], ranks: np.ndarray) -> list[Fingerprint]:
    """The fingerprint of each text."""
    parts = list(chosen(encoded, ranks))
    owner = np.concatenate([np.zeros(0, np.int64), *[p[0] for p in parts]])
    found = np.concatenate([np.zeros(0, np.uint64), *[p[1] for p in parts]])
    _, once = np.unique(found + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True)
    once.sort()
    owner, found = owner[once], found[once]  # each feature of a text once, in order
    plain = [k for k, c in enumerate(np.bincount(owner, minlength=len(encoded))) if not c and encoded[k]]
    owner = np.concatenate([owner, np.array(plain, np.int64)])
    found = np.concatenate([found, np.array([int.from_bytes(hashlib.sha1(encoded[k]).digest()[:8], "little") for k in plain], np.uint64)])
    order = np.argsort(owner, kind="stable")
    owner, found = owner[order], found[order]
    counts = np.bincount(owner, minlength=len(encoded))
    first = np.concatenate([[0], np.cumsum(-(-counts // FULL))])
    bits = np.zeros((first[-1], BITS), bool)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    places = found[:, None] >> np.array([0, 11, 22, 33, 44], np.uint64) & np.uint64(BITS - 1)
    bits[(np.repeat(first[:-1], counts) + within // FULL)[:, None], places] = True
    packed = np.packbits(bits, axis=1).view(np.uint64)
    return [Fingerprint(int(c), packed[first[k] : first[k + 1]]) for k, c in enumerate(counts)]


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """0 to 1: see above."""
    if a.features == b.features and np.array_equal(a.filters, b.filters):
        return 1.0
    if not a.features or not b.features:
        return 0.0
    if len(a.filters) > len(b.filters):
        a, b = b, a
    ones_a, ones_b = (np.bitwise_count(x.filters).sum(axis=1, dtype=np.int64) for x in (a, b))
    best_a, best_b, rows = np.zeros(len(ones_a)), np.zeros(len(ones_b)), max(1, (1 << 16) // len(ones_b))
    for at in range(0, len(ones_a), rows):
        shared = np.bitwise_count(a.filters[at : at + rows, None] & b.filters[None]).sum(axis=2, dtype=np.uint16)
        chance = ones_a[at : at + rows, None] * (ones_b / BITS)
        alike = (shared - chance) / np.maximum(np.minimum(ones_a[at : at + rows, None], ones_b) - chance, 1e-9)
        best_a[at : at + rows] = alike.max(axis=1)
        np.maximum(best_b, alike.max(axis=0), out=best_b)
    found = (best_a.clip(0, 1) * a.sizes()).sum() / a.features
    if len(a.filters) == len(b.filters):
        found = (found + (best_b.clip(0, 1) * b.sizes()).sum() / b.features) / 2
    return float(found)


def learn(docs: DataFrame, text: str = "text") -> list[int]:
    """Ranks of entropies by their counts over all texts; the counts are added up by Spark, and 1,001 of them come to the driver."""
    schema = arrow_schema("level int, n long")

    def count(batches):
        import pyarrow as pa

        total = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            group, size = [], 0
            for t in batch.column(0):
                group.append(t.as_py().encode())
                size += len(group[-1])
                if size >= 1 << PIECE_BITS:
                    total += level_counts(group)
                    group, size = [], 0
            total += level_counts(group)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS + 1), pa.int32()), pa.array(total)], schema=schema)

    rows = texts(docs, text=text).select("text").mapInArrow(count, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    counts = [0] * (LEVELS + 1)
    for r in rows:
        counts[r["level"]] = r["n"]
    return ranks_of(counts).tolist()


def fingerprinted(docs: DataFrame, ranks: list[int]) -> DataFrame:
    """doc_id and fingerprint of each text."""
    schema = arrow_schema("doc_id long, fingerprint string")

    def work(batches):
        import pyarrow as pa

        table = np.array(ranks, np.int32)
        for batch in batches:
            encoded = [t.encode() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(str, fingerprints(encoded, table)), pa.string())], schema=schema)

    return texts(docs).mapInArrow(work, "doc_id long, fingerprint string")


def _dealt(docs: DataFrame) -> DataFrame:
    """doc_id, text, bucket, ahead: rows in ranges of (doc_id, hash), sorted; the first of the next range (after the last: of the first) follows as ahead."""
    rows = texts(docs).withColumn("_h", F.xxhash64("text"))
    n = partitions(docs)
    key = F.struct("doc_id", "_h")
    found = rows.select("doc_id", "_h").repartitionByRange(n, "doc_id", "_h").groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("k")).collect()
    known = lambda doc_id, h: (doc_id is not None, doc_id or 0, h)
    starts = sorted({known(*r["k"]) for r in found})

    @F.arrow_udf("long")
    def place(doc_id, h):
        import pyarrow as pa

        keys = [known(*k) for k in zip(doc_id.to_pylist(), h.to_pylist())]
        at = [max(0, bisect.bisect_right(starts, k) - 1) for k in keys]
        return pa.array([2 * b + (starts[b] == k) for b, k in zip(at, keys)], pa.int64())

    bucket = F.shiftright("_p", 1)
    here = F.struct(bucket.alias("bucket"), F.lit(False).alias("ahead"))
    back = F.struct(F.pmod(bucket - 1, F.lit(max(1, len(starts)))).alias("bucket"), F.lit(True).alias("ahead"))
    rows = rows.withColumn("_p", place("doc_id", "_h")) if starts else rows.withColumn("_p", F.lit(0).cast("long"))
    rows = rows.select("doc_id", "_h", "text", F.inline(F.when(F.col("_p") % 2 == 1, F.array(here, back)).otherwise(F.array(here))))
    rows = rows.repartitionById(max(1, len(starts)), F.col("bucket").cast("int"))
    return rows.sortWithinPartitions("bucket", "ahead", "doc_id", "_h", "text").select("doc_id", "text", "bucket", "ahead")


def successions(batches):
    """(doc_id, text, the next document's text) of rows as _dealt gives them."""
    held = None
    for batch in batches:
        for doc_id, text, bucket, ahead in zip(*(c.to_pylist() for c in batch.columns)):
            if held is not None:
                yield *held, text
            held = None if ahead else (doc_id, text)


def edited(text: str, after: str) -> str:
    """The text with its last half replaced by as much of the beginning of the other."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def compared(docs: DataFrame, ranks: list[int]) -> DataFrame:
    """RESULT: each document beside its edited text and the next document."""
    schema = arrow_schema(RESULT)

    def told(group, table):
        import pyarrow as pa

        changed = [edited(text, after) for _, text, after in group]
        mine = {id(t): t for _, text, after in group for t in (text, after)}  # a text and its predecessor's next one are one object
        prints = fingerprints([t.encode() for t in mine.values()] + [t.encode() for t in changed], table)
        own = dict(zip(mine, prints))
        rows = []
        for (doc_id, text, after), new, print_ in zip(group, changed, prints[len(mine) :]):
            a = own[id(text)]
            rows.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), str(a), str(print_), likeness(a, print_), likeness(a, own[id(after)])))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def work(batches):
        table = np.array(ranks, np.int32)
        group, size = [], 0
        for row in successions(batches):
            group.append(row)
            size += len(row[1])
            if size >= 1 << 19 or len(group) >= 1000:
                yield told(group, table)
                group, size = [], 0
        if group:
            yield told(group, table)

    return _dealt(docs).mapInArrow(work, RESULT)
