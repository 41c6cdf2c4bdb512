"""Operator 9: language identification by a bit-sliced Bloom filter of character n-grams.

Texts are read as letters in lower case, all else as single spaces. From labelled texts each language's n-grams are
counted in Spark; an n-gram belongs to every language in which it is frequent and not much rarer than where it is most
frequent. One Bloom filter holds them all: a slot is a bitmask of languages (of as many 64-bit words as they need), and
the AND of an n-gram's slots gives every language that contains it. A text's score for a language is the share of its n-grams (all of them, the whole text) with that
language's bit, corrected for the bit's false-positive rate; the largest decides.

The filter is fitted on about ``max_docs`` labelled texts of each language (all, where there are fewer), chosen by a hash of
doc_id, so a rare language learns as much from a large table as from a small one, and holds at most ``max_grams`` n-grams
of a language, the most frequent; both bound what the driver gathers. More than ``max_langs`` labels are refused, as
no column of languages has them. Texts are read in parts, so memory doesn't grow with their length.

A null text or one without letters is ``und`` with score 0; ties go to the language with more n-grams in training; if
nothing could be learned all texts are ``und``; null labels are not learned from; a null doc_id is predicted like any
other and not learned from; an empty table gives no rows. Other columns are never inputs of a prediction.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_schema, kept

ORDERS = (3, 4)
PROBES = 4
CHUNK = 1 << 16
COUNTED = 1 << 20
#: Odd multipliers of the n-gram hash; fixed values.
ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]


def _letters() -> np.ndarray:
    table = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = ord(chr(c).lower()[0])
    return table


def letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space; made once in a Python worker."""
    return kept("letters", _letters)


def grams(text: str):
    """Hashes of all n-grams of a text, in parts, a new array for each."""
    table, tail = letters(), np.zeros(0, dtype=np.uint32)
    for k in range(0, len(text), CHUNK):
        part = table[np.frombuffer(text[k : k + CHUNK].encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        if k == 0:
            part = np.concatenate([[32], part])
        if k + CHUNK >= len(text):
            part = np.concatenate([part, [32]])
        space = part == 32
        double = np.concatenate([[len(tail) > 0 and tail[-1] == 32], space[:-1]]) & space
        part = np.concatenate([tail, part[~double]]).astype(np.uint64)
        for n in ORDERS:
            skip = max(0, len(tail) - n + 1)  # n-grams that end in the tail have been given
            size = len(part) - n + 1 - skip
            if size > 0:
                h = np.full(size, n, dtype=np.uint64)
                for j in range(n):
                    h = (h ^ part[skip + j : skip + j + size]) * np.uint64(ODD[j])
                    h ^= h >> np.uint64(29)
                yield h
        tail = part[-(max(ORDERS) - 1) :].astype(np.uint32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Filter:
    """Slots of language bitmasks."""

    def __init__(self, langs: list, hashes: list):
        self.langs, self.k = langs, PROBES
        n = sum(map(len, hashes))
        self.size = 1 << max(10, int(12 * n).bit_length())
        self.planes, fill = [], []
        for first in range(0, max(1, len(langs)), 64):  # 64 languages in each plane of slots
            part = hashes[first : first + 64]
            kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if np.iinfo(k).bits >= max(1, len(part)))
            slots = np.zeros(self.size, dtype=kind)
            for bit, h in enumerate(part):
                for at in self._at(h):
                    np.bitwise_or.at(slots, at, kind(1 << bit))
            self.planes.append(slots)
            fill += [np.count_nonzero(slots & kind(1 << b)) / self.size for b in range(len(part))]
        self.false = np.array(fill) ** PROBES

    def _at(self, h: np.ndarray):
        step = (h >> np.uint64(32)) | np.uint64(1)
        for j in range(self.k):
            yield ((h + np.uint64(j) * step) & np.uint64(self.size - 1)).astype(np.int64)

    def masks(self, h: np.ndarray) -> list:
        """For each n-gram the languages that contain it, a mask in each plane."""
        out: list = [None] * len(self.planes)
        for at in self._at(h):
            for k, slots in enumerate(self.planes):
                got = slots[at]
                out[k] = got if out[k] is None else out[k] & got
        return out

    def predict(self, text: str) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        counts, n = np.zeros(len(self.langs), dtype=np.int64), 0
        for h in grams(text):
            n += len(h)
            for first, masks in enumerate(self.masks(h)):
                for b in range(min(64, len(self.langs) - 64 * first)):
                    counts[64 * first + b] += np.count_nonzero(masks & masks.dtype.type(1 << b))
        scores = np.clip((counts / max(1, n) - self.false) / (1 - self.false), 0, 1)
        best = int(np.argmax(scores))
        return self.langs[best], float(scores[best])


def learn(docs: DataFrame, where: Column | None = None, max_docs: int = 5_000, max_grams: int = 100_000, min_count: int = 3, share: float = 0.4, max_langs: int = 1_000) -> Filter:
    """Fit the filter on labelled documents (text, lang, doc_id) for which ``where`` holds."""
    rows = docs.where("doc_id is not null and text is not null and lang is not null")
    rows = rows if where is None else rows.where(where)
    labelled = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().limit(max_langs + 1).collect()}
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    many = {x: n for x, n in sizes.items() if n > max_docs}
    if many:
        of = F.coalesce(F.element_at(F.create_map(*[F.lit(y) for x in many.items() for y in x]), F.col("lang")), F.lit(1))
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), of) < max_docs)
    ddl = "gram long, lang string, n long"
    schema = arrow_schema(ddl)

    def count(batches):
        by: dict = {}
        held = 0

        def counts():
            for lang, found in by.items():
                g, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array([lang] * len(g), pa.string()), pa.array(n, pa.int64())], schema=schema)
            by.clear()

        for b in batches:
            for k in range(0, b.num_rows, 128):
                for text, lang in zip(*(c.to_pylist() for c in b.slice(k, 128).columns)):
                    for h in grams(text) if has_letter(text) else ():
                        by.setdefault(lang, []).append(h)
                        held += len(h)
                        if held > COUNTED:
                            yield from counts()
                            held = 0
        yield from counts()

    counted = labelled.select("text", "lang").mapInArrow(count, ddl).groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    counted = counted.persist()
    try:
        totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
        langs = [r["lang"] for r in totals.orderBy(F.desc("total"), "lang").collect()]
        rated = counted.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total"))
        rated = rated.withColumn("most", F.max("rate").over(Window.partitionBy("gram"))).where((F.col("n") >= min_count) & (F.col("rate") >= share * F.col("most")))
        kept = rated.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("place") <= max_grams)
        got = kept.select("lang", "gram").toPandas()
    finally:
        counted.unpersist()
    return Filter(langs, [got.gram[got.lang == x].to_numpy(dtype=np.int64).view(np.uint64) for x in langs])


def identify(docs: DataFrame, model: Filter) -> DataFrame:
    """docs with lang_pred and score, both read off the whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema if f.name not in ("lang_pred", "score")]
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    out = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    at = [f.name for f in kept].index("text")
    schema = to_arrow_schema(out)

    def run(batches):
        model = shared.value
        for b in batches:
            said = [model.predict(t) if t is not None else ("und", 0.0) for k in range(0, b.num_rows, 128) for t in b.column(at).slice(k, 128).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(b.columns, schema)), pa.array([x for x, _ in said], pa.string()), pa.array([x for _, x in said], pa.float64())], schema=schema)

    return docs.select(*[f.name for f in kept]).mapInArrow(run, out)


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 3."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))
