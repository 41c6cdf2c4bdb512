"""Operator 3: mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' ids in order of doc_id. In each round every source is credited its quantum,
its share of a window of ``window`` ids in units of 1/512 id, and sends whole granules of ``granule`` ids as long as
its credit lasts; what is left is its deficit and is carried to the next round. The stream of granules is cut into
windows. What a source has sent after r rounds is a closed form of r, so the deficits at any window follow from the
quanta alone: partitions need no state from each other, and each document finds its own places. After any number of
rounds a source is less than one granule behind its share (by default an eighth of a window): smaller granules
keep every window closer to the targets and cut documents into more pieces.

A source that runs dry sends nothing more; the others keep their proportions. Without targets the quanta follow the
sources' own ids, so all run dry together. The stream's last part, shorter than a window, becomes sequences whose
lengths are powers of two, so no sequence needs padding.

Null texts are empty; a null source is a queue of its own; rows with one doc_id are separate documents; null doc_ids come
first; rows of one doc_id, or of none, are dealt over shards by their texts' hashes; an empty table gives no pieces.
"""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_schema, kept, partitions, saved, texts
from .tokens import batches, encoder, vocabulary

UNIT = 512
ENCODED = "shard long, doc_id long, source string, queue_start long, n_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def encoded(docs: DataFrame, vocab: str, end_id: int, shards: int | None = None, control: bool = True) -> DataFrame:
    """Ids of every document by ranges of doc_id, with its place in its source's part of the shard."""
    schema = arrow_schema(ENCODED)
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(rows):
        from pyspark import TaskContext

        shard, sent, encode = TaskContext.get().partitionId(), {}, encoder(vocab, control).encode
        for b in rows:
            for k, e in batches(pc.binary_length(b.column(1)).to_pylist()):
                part = b.slice(k, e - k)
                doc_ids, sources = part.column(0), part.column(2).to_pylist()
                ids = [x + end for x in encode(part.column(1).to_pylist())]
                n, starts = [len(x) // 4 for x in ids], []
                for s, m in zip(sources, n):
                    starts.append(sent.get(s, 0))
                    sent[s] = sent.get(s, 0) + m
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(n), pa.int64()), doc_ids, pa.array(sources, pa.string()), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    schema=schema,
                )

    rows = texts(docs, "source").withColumn("source", F.col("source").cast("string"))
    rows = rows.repartitionByRange(shards or partitions(rows), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text", "source")
    return rows.mapInArrow(encode, ENCODED)


class RoundRobin:
    """Where the ids of each source's queue stand in the stream."""

    def __init__(self, totals: list[int], weights: list[float], window: int = 2048, granule: int = 256):
        self.totals = np.array(totals, dtype=np.int64)
        self.window, self.granule = window, granule
        whole, w = window * UNIT, np.array(weights, dtype=float)
        exact = w / w.sum() * whole
        units = np.maximum(1, np.floor(exact).astype(np.int64))
        order = np.argsort(-(exact - np.floor(exact)), kind="stable")
        spare = int(whole - units.sum())
        if spare > 0:
            units[order[:spare]] += 1
        self.units, self.step = units, UNIT * granule

    def sent(self, rounds: np.ndarray, source: int) -> np.ndarray:
        """The ids that a source has sent after so many rounds."""
        return np.minimum(self.totals[source], rounds * self.units[source] // self.step * self.granule)

    def places(self, source: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """The stretches that documents (n ids from ``start`` in the queue of ``source``) have in the stream: document,
        start in it, length, and place in the stream."""
        first, many = start // self.granule, (start + n - 1) // self.granule - start // self.granule + 1
        doc = np.repeat(np.arange(len(n)), many)
        g = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many) + first[doc]
        rounds = -(-(g + 1) * self.step // self.units[source[doc]])
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (rounds[1:] != rounds[:-1])
        doc, rounds = doc[new], rounds[new]
        own, base = source[doc], np.zeros(len(doc), dtype=np.int64)
        for s in range(len(self.totals)):
            base += self.sent(rounds - (own <= s), s)
        sent, until = (np.minimum(self.totals[own], r * self.units[own] // self.step * self.granule) for r in (rounds - 1, rounds))
        lo, hi = np.maximum(start[doc], sent), np.minimum((start + n)[doc], until)
        at = base + lo - sent
        new = np.ones(len(at), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + (hi - lo)[:-1])
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(at)) - 1
        doc, lo, hi, at = doc[begin], lo[begin], hi[last], at[begin]
        return doc, lo - start[doc], hi - lo, at

    def sequences(self, lo: np.ndarray, length: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Cut stretches at the borders of the sequences: stretch, start, length, sequence_id, offset."""
        total, w = int(self.totals.sum()), self.window
        whole = total // w * w
        borders, k = [whole], total - whole
        for bit in range(w.bit_length() - 1, -1, -1):
            if k >> bit & 1:
                borders.append(borders[-1] + (1 << bit))
        tail = np.array(borders, dtype=np.int64)
        n = np.where(at < whole, np.maximum(0, (np.minimum(at + length, whole) - 1) // w - np.minimum(at, whole) // w), 0)
        n = n + np.searchsorted(tail[:-1], at + length, "left") - np.searchsorted(tail[:-1], at, "right") + 1
        piece = np.repeat(np.arange(len(at)), n)
        k = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(at, n)
        full = np.clip(whole // w - start // w, 0, None)
        ids = np.where(k == 0, start, 0)
        late = k > 0
        early = late & (k <= full)
        ids[early] = (start[early] // w + k[early]) * w
        past = late & (k > full)
        if past.any():
            first = np.searchsorted(tail, start[past], "right") - 1
            ids[past] = tail[np.where(full[past] > 0, k[past] - full[past], np.maximum(first, 0) + k[past])]
        end = np.append(ids[1:], 0)
        lasts = np.cumsum(n) - 1
        end[lasts] = at + length
        part = np.searchsorted(tail, ids, "right") - 1
        sequence = np.where(ids < whole, ids // w, whole // w + np.maximum(part, 0))
        offset = np.where(ids < whole, ids % w, ids - tail[np.maximum(part, 0)])
        return piece, lo[piece] + ids - start, end - ids, sequence, offset


def pack(docs: DataFrame, vocab: str | None = None, end_id: int = 1, window: int = 2048, granule: int = 256, targets: dict | None = None, shards: int | None = None, max_sources: int = 10_000, control: bool = True) -> DataFrame:
    """One row for each piece of a document: where it starts in it, and its sequence and offset there.

    targets: the share of each source (null is None); without it, each source's share of all ids. The sources' totals
    come to the driver: one row for each source, at most max_sources, else ValueError. control: whether control strings
    in texts become their ids (see tokens).
    """
    spark = docs.sparkSession
    table = saved(encoded(docs, vocab or vocabulary("word_bpe_49k.json"), end_id, shards, control), "encoded")
    sums = table.groupBy("shard", "source").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    sums = saved(sums.select("shard", "source", "n", F.coalesce(before, F.lit(0)).alias("before")), "queues")
    totals = sums.groupBy("source").agg(F.sum("n").alias("n")).orderBy(F.col("source").asc_nulls_first()).limit(max_sources + 1).collect()
    if len(totals) > max_sources:
        raise ValueError(f"more than {max_sources} sources; merge them into fewer queues")
    if not totals:
        return spark.createDataFrame([], PIECES)
    names = [r["source"] for r in totals]
    weights = [r["n"] if targets is None else targets[r["source"]] for r in totals]
    robin, number = RoundRobin([r["n"] for r in totals], weights, window, granule), {s: k for k, s in enumerate(names)}
    schema = arrow_schema(PIECES)

    def pieces(rows):
        kept("queues", lambda: None)  # the encoder that this worker may hold isn't needed any more
        for b in rows:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                raw, sources = part.column("ids").to_pylist(), part.column("source").to_pylist()
                n = np.asarray(part.column("n_tokens"))
                doc, lo, length, at = robin.places(np.array([number[s] for s in sources]), np.asarray(part.column("at")), n)
                piece, lo, length, sequence, offset = robin.sequences(lo, length, at)
                doc = doc[piece]
                crc = [zlib.crc32(raw[d][4 * x : 4 * (x + m)]) for d, x, m in zip(doc.tolist(), lo.tolist(), length.tolist())]
                made = [part.column("doc_id").take(pa.array(doc)), *map(pa.array, (lo, length, crc, n[doc], sequence, offset)), part.column("source").take(pa.array(doc))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(made, schema)], schema=schema)

    same = table["shard"].eqNullSafe(sums["shard"]) & table["source"].eqNullSafe(sums["source"])
    placed = table.join(sums, same).select(table["doc_id"], table["source"], (F.col("before") + F.col("queue_start")).alias("at"), "n_tokens", "ids")
    return placed.mapInArrow(pieces, PIECES)
