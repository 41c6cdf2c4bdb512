"""Operator 1: token ids in files of independent zstandard frames with a seek table.

A shard file holds the documents of one range of doc_id in ascending order:

* one zstandard frame for each document (a document of more than FRAME_IDS ids has several), each with the library's
  content checksum; its content is the ids as little-endian unsigned 32-bit integers, the end id included;
* a skippable frame with the document index, an Arrow table (doc_id, frame, frames, n_tokens);
* a skippable frame with the seek table of the public seekable format: for each frame before it the compressed size,
  the size of its content and the low 32 bits of the content's XXH64, then the number of frames, a flag byte and a
  magic number.

A reader takes the footer, the seek table and the index, then only the frames of the documents it wants.

Null doc_ids come first and stay null; null texts count as empty; rows with the same doc_id are separate documents, which,
like those without one, are dealt over files by the hashes of their texts;
an empty table gives no documents. All columns but doc_id and text are ignored.
"""

import io
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, partitions, shared_dir, texts
from .tokens import batches, encoder, vocabulary

FRAME_IDS = 1 << 20
#: Fixed values of the public format.
INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC, WITH_CHECKSUM = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
INDEX = pa.schema([("doc_id", pa.int64()), ("frame", pa.int64()), ("frames", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "shard long, path string, documents long, tokens long, bytes long"


class BadFrame(ValueError):
    """A frame whose content isn't what the seek table's checksum says."""


def _at(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_shard(uri: str, attempt: str, documents: Iterable) -> tuple[int, int, int]:
    """Write (doc_id, ids as bytes) pairs to a shard file; returns the documents, ids and bytes written.

    The file appears under its name only when it is whole, so a task that is lost or runs twice leaves no half file.
    """
    import xxhash
    import zstandard

    filesystem, path = _at(uri)
    own = f"{path}.{attempt}"
    packer = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
    seek, index, frames, tokens, size = bytearray(), [], 0, 0, 0
    with filesystem.open_output_stream(own) as out:
        for doc_id, ids in documents:
            first = frames
            for k in range(0, max(len(ids), 1), 4 * FRAME_IDS):
                part = ids[k : k + 4 * FRAME_IDS]
                frame = packer.compress(part)
                out.write(frame)
                seek += struct.pack("<III", len(frame), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF)
                frames += 1
                size += len(frame)
            index.append((doc_id, first, frames - first, len(ids) // 4))
            tokens += len(ids) // 4
        sink = io.BytesIO()
        table = pa.Table.from_arrays([pa.array([x[k] for x in index], pa.int64()) for k in range(4)], schema=INDEX)
        with pa.ipc.new_stream(sink, INDEX, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(table)
        body = struct.pack("<II", INDEX_MAGIC, sink.tell()) + sink.getvalue()
        out.write(body)
        seek += struct.pack("<III", len(body), 0, 0)
        out.write(struct.pack("<II", SEEK_MAGIC, len(seek) + 9) + bytes(seek))
        out.write(struct.pack("<IBI", frames + 1, WITH_CHECKSUM, FOOTER_MAGIC))
    filesystem.move(own, path)
    return len(index), tokens, size


class ShardReader:
    """Documents of one shard file; reads the tables at once and frames when they are asked for."""

    def __init__(self, uri: str):
        import zstandard

        filesystem, path = _at(uri)
        self.file = filesystem.open_input_file(path)
        end = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != FOOTER_MAGIC or flags != WITH_CHECKSUM:
            raise BadFrame(f"{uri} has no seek table")
        table = np.frombuffer(self.file.read_at(12 * n, end - 9 - 12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.lengths, self.sums = table[:, 0], table[:, 1], table[:, 2]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        with pa.ipc.open_stream(self.file.read_at(int(self.sizes[-1]) - 8, int(self.starts[n - 1]) + 8)) as r:
            self.index = r.read_all()
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        import xxhash

        got = self.unpacker.decompress(self.file.read_at(int(self.sizes[k]), int(self.starts[k])), max_output_size=int(self.lengths[k]))
        if len(got) != self.lengths[k] or xxhash.xxh64_intdigest(got) & 0xFFFFFFFF != self.sums[k]:
            raise BadFrame(f"frame {k} is damaged")
        return got

    def documents(self, wanted: set | None = None) -> Iterator[tuple[int, int, Iterator[bytes]]]:
        """(doc_id, n_tokens, its frames' contents) of all documents, or only of those wanted."""
        for batch in self.index.to_batches(65536):
            for doc_id, first, n, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if wanted is None or doc_id in wanted:
                    yield doc_id, tokens, (self.frame(k) for k in range(first, first + n))


def write_tokens(docs: DataFrame, folder: str, vocab: str, end_id: int | None = 0, shards: int | None = None, control: bool = True) -> DataFrame:
    """Encode every text and write it to shard files in folder; returns the manifest, one row for each file.

    Documents are dealt by ranges of doc_id, so no shard depends on a hot source. One row for each shard comes back.
    control: whether control strings in texts become their ids (see tokens).
    """
    spark, rows = docs.sparkSession, texts(docs)
    n = shards or partitions(rows)
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
    schema = arrow_schema(MANIFEST)

    def write(rows):
        from pyspark import TaskContext

        task, encode = TaskContext.get(), encoder(vocab, control).encode

        def documents():
            for b in rows:
                ids, text = b.column(0), b.column(1)
                for k, e in batches(pc.binary_length(text).to_pylist()):
                    yield from zip(ids[k:e].to_pylist(), (x + end for x in encode(text[k:e].to_pylist())))

        path = f"{folder}/shard-{task.partitionId():06d}.zst"
        got = write_shard(path, f"{task.taskAttemptId()}.part", documents())
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (task.partitionId(), path, *got)], schema=schema)

    _make(spark, folder)
    return rows.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text").mapInArrow(write, MANIFEST)


def _make(spark: SparkSession, folder: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def read_tokens(spark: SparkSession, manifest: list) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, shard of every document in the shard files of a manifest, one task a shard.

    manifest: the collected rows, one for each file, which is what a file listing holds.
    """
    manifest, start, at = sorted(manifest, key=lambda r: r["shard"]), 0, []
    for r in manifest:
        at.append((r["path"], start, r["shard"]))
        start += r["tokens"]
    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long, shard long"
    schema = arrow_schema(ddl)

    def read(batches):
        for b in batches:
            for k in b.column(0).to_pylist():
                path, start, shard = at[k]
                rows = []
                for doc_id, n, frames in ShardReader(path).documents():
                    crc = 0
                    for part in frames:
                        crc = zlib.crc32(part, crc)
                    rows.append((doc_id, start, n, crc, shard))
                    start += n
                    if len(rows) == 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    return spark.range(0, len(at), 1, max(1, len(at))).mapInArrow(read, ddl)


def token_files(docs: DataFrame, vocab: str | None = None, end_id: int = 0, shards: int | None = None) -> tuple[str, DataFrame]:
    """Write the files to a new shared folder and read them back; returns the folder and the documents' digests."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "tokens")
    manifest = write_tokens(docs, folder, vocab or vocabulary("byte_bpe_50k.json"), end_id, shards).collect()
    return folder, read_tokens(spark, [r.asDict() for r in manifest])
