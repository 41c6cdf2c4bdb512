"""Operator 8: benchmark decontamination with an FM-index for each shard of the training texts.

A text's words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A shard is as many documents as
make about ``shard_words`` words (a longer document is a shard of its own); its words are numbered and its FM-index is
built over these numbers, with a zero after each document:

* the suffix array, sorted by doubling prefixes and only where suffixes still tie,
* the Burrows-Wheeler transform in a wavelet matrix of packed bits, which counts a word before a row,
* the text positions of every SAMPLE-th place, from which the others are reached by walking back.

All distinct windows of the benchmark (``window`` consecutive words of an item; a shorter item is one window) are searched
backwards at once, each once however many items have it; rows found are located in bounded parts, and the places are
merged into removal spans.

The benchmark's windows go to every task, so their size is checked: more than ``max_words`` words of items are refused
and have to be searched in parts. Null texts have no words; a null doc_id stays null; null or wordless items have no
windows; equal rows are separate documents; items with the same id count once, and null ids hit but aren't listed; ids are
listed in the order of strings, and one that holds a comma looks like two in report()'s joined list; empty
tables give no rows, or documents without hits. Other columns are ignored; cleaned() keeps
them, but for ones named as its results.
"""

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import common

SAMPLE = 16
#: Letters and digits and bytes beyond ASCII stay, A-Z become small, all else is a space.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
HITS = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def words_of(text: str) -> list:
    """The words of a text as lower-cased UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(WORDS).split()


class Numbers(dict):
    """Numbers words from 1 as they come."""

    def __missing__(self, word):
        n = self[word] = len(self) + 1
        return n


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes of a text of small numbers in their order; a suffix that ends first is smaller."""
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    bits = int(text.max() + 1).bit_length()
    h = max(1, min(n, 62 // bits))
    key = np.zeros(n, dtype=np.int64)
    for k in range(h):  # the first h numbers of each suffix in one key
        key <<= bits
        key[: n - k] |= text[k:] + 1
    order = np.argsort(key)
    new = np.ones(n, dtype=bool)
    new[1:] = key[order][1:] != key[order][:-1]
    at = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = at + 1
    while True:
        tied = np.zeros(n, dtype=bool)
        tied[:-1] = ~new[1:]
        tied |= ~new
        rows = np.flatnonzero(tied)
        if not len(rows):
            return order
        places = order[rows]
        after = places + h
        next_rank = np.where(after < n, rank[np.minimum(after, n - 1)], 0)
        key = rank[places] * (n + 2) + next_rank
        by = np.argsort(key)
        key, places = key[by], places[by]
        order[rows] = places
        first = np.ones(len(rows), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        new[rows] = first
        rank[places] = np.maximum.accumulate(np.where(first, rows, 0)) + 1
        h *= 2


class WaveletMatrix:
    """How often a number stands before a row, and which stands there; one packed bit vector for each bit."""

    def __init__(self, numbers: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for b in range(bits - 1, -1, -1):
            on = (numbers >> b) & 1 == 1
            padded = np.zeros((len(on) // 64 + 1) * 64, dtype=bool)
            padded[: len(on)] = on
            words = np.packbits(padded, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype(np.int32)
            zeros = len(on) - int(before[-1])
            self.levels.append((words, before, zeros))
            numbers = np.concatenate([numbers[~on], numbers[on]])

    @staticmethod
    def ones(level: tuple, rows: np.ndarray) -> np.ndarray:
        words, before, _ = level
        k = rows >> 6
        below = (np.uint64(1) << (rows & 63).astype(np.uint64)) - np.uint64(1)
        return before[k] + np.bitwise_count(words[k] & below)

    def rank(self, numbers: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """How often each number stands before its row."""
        start, end = np.zeros(len(rows), dtype=np.int64), rows
        for k, level in enumerate(self.levels):
            on = (numbers >> (self.bits - 1 - k)) & 1 == 1
            a, b = self.ones(level, start), self.ones(level, end)
            start = np.where(on, level[2] + a, start - a)
            end = np.where(on, level[2] + b, end - b)
        return end - start

    def access(self, rows: np.ndarray) -> np.ndarray:
        """The number in each row."""
        numbers = np.zeros(len(rows), dtype=np.int64)
        for words, before, zeros in self.levels:
            on = (words[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones = self.ones((words, before, zeros), rows)
            rows = np.where(on, zeros + ones, rows - ones)
            numbers = numbers * 2 + on
        return numbers


class FMIndex:
    """Backward search over a text of numbers that ends with a zero."""

    def __init__(self, text: np.ndarray):
        order = suffix_array(text)
        n = len(text)
        self.bits = max(1, int(text.max()).bit_length())
        before = text[order - 1]
        self.matrix = WaveletMatrix(before, self.bits)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << self.bits))])
        known = (order % SAMPLE == 0) | (before == 0)  # no walk leaves its document
        self.known, self.places = known, order[known]
        self.nth = np.cumsum(known) - 1
        self.n = n

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and row after the last of each phrase, a matrix with a phrase in each line."""
        lo, hi = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n, dtype=np.int64)
        alive = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[alive, k]
            lo[alive] = self.first[c] + self.matrix.rank(c, lo[alive])
            hi[alive] = self.first[c] + self.matrix.rank(c, hi[alive])
            alive = alive[lo[alive] < hi[alive]]
            if not len(alive):
                break
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text's place of each row, by walking back to a sampled one."""
        out, steps, left = np.zeros(len(rows), dtype=np.int64), 0, np.arange(len(rows))
        while len(left):
            here = self.known[rows]
            out[left[here]] = self.places[self.nth[rows[here]]] + steps
            left, rows = left[~here], rows[~here]
            c = self.matrix.access(rows)
            rows = self.first[c] + self.matrix.rank(c, rows)
            steps += 1
        return out


def distinct(ids: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of ids stand for equal ones, and for each window the number of the one that stands for it.

    Hashes group them and words decide: windows of one hash that differ from the first of it stand for themselves.
    """
    hashes = np.zeros(len(begins), dtype=np.uint64)
    for k in range(size):
        hashes = (hashes ^ ids[begins + k].astype(np.uint64)) * np.uint64(0x9E3779B185EBCA87)
        hashes ^= hashes >> np.uint64(29)
    _, first, of = np.unique(hashes, return_index=True, return_inverse=True)
    same = np.ones(len(begins), dtype=bool)
    for k in range(size):
        same &= ids[begins + k] == ids[begins[first[of]] + k]
    own = np.flatnonzero(~same)
    of[own] = len(first) + np.arange(len(own))
    return np.concatenate([first, own]), of


class Phrases:
    """The distinct windows of some benchmark items: their words as numbers one after another, where windows of each
    length begin, and the items that have each window."""

    def __init__(self, items: list, window: int):
        numbers, ids, begins, at = Numbers(), [], {}, 0
        self.names = [item_id for item_id, _ in items]
        for k, (_, text) in enumerate(items):
            words = words_of(text or "")
            size = min(window, len(words))
            if size:
                ids.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words)) - 1)
                n = len(words) - size + 1
                begins.setdefault(size, []).append((np.arange(at, at + n), np.full(n, k, dtype=np.int64)))
                at += len(words)
        self.vocabulary = list(numbers)
        self.ids = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
        self.groups = []  # size, begins of distinct windows, where the items of each begin, items
        for size, parts in sorted(begins.items()):
            places, owners = map(np.concatenate, zip(*parts))
            first, of = distinct(self.ids, places, size)
            pairs = np.unique(of * len(items) + owners)
            self.groups.append((size, places[first], np.searchsorted(pairs, np.arange(len(first) + 1) * len(items)), pairs % len(items)))

    def among(self, numbers: dict, at_once: int = 1 << 16):
        """Yields (windows in the numbers of a shard, their length, the items of each as a function) of the windows whose words the shard all has."""
        own = np.fromiter((numbers.get(w, 0) for w in self.vocabulary), dtype=np.int64, count=len(self.vocabulary))
        text = own[self.ids]
        absent = np.concatenate([[0], np.cumsum(text == 0)])
        for size, begins, starts, items in self.groups:
            there = np.flatnonzero(absent[begins + size] == absent[begins])
            for k in range(0, len(there), at_once):
                part = there[k : k + at_once]
                yield text[begins[part, None] + np.arange(size)], size, lambda w, part=part, starts=starts, items=items: items[starts[part[w]] : starts[part[w] + 1]].tolist()


def occurrences(lo: np.ndarray, hi: np.ndarray, at_once: int = 1 << 18):
    """Yields (number of the window, row) for all rows of all windows, ``at_once`` at a time, however many one window has."""
    ends = np.cumsum(hi - lo)
    for k in range(0, int(ends[-1]) if len(ends) else 0, at_once):
        at = np.arange(k, min(k + at_once, int(ends[-1])))
        w = np.searchsorted(ends, at, "right")
        yield w, hi[w] - (ends[w] - at)


def scan(documents: list, phrases: Phrases) -> list:
    """For each text: n_words, hit words as merged [start, end) word spans, and ids of items found.

    Each distinct window is searched once and its places are found in bounded parts; what it says of a document goes to
    the window's items once for each part.
    """
    numbers, parts, starts, at = Numbers(), [], [], 0
    for document in documents:
        got = words_of(document)
        starts.append(at)
        parts.append(np.fromiter(itertools.chain(map(numbers.__getitem__, got), [0]), dtype=np.int64, count=len(got) + 1))
        at += len(got) + 1
    text = np.concatenate(parts)
    index = FMIndex(text)
    begin = np.array([*starts, at])
    cover, found = np.zeros(at + 1, dtype=np.int64), [set() for _ in documents]
    for windows, size, items in phrases.among(numbers):
        for w, rows in occurrences(*index.search(windows)):
            places = index.locate(rows)
            np.add.at(cover, places, 1)
            np.add.at(cover, places + size, -1)
            pairs = np.unique((np.searchsorted(begin, places, "right") - 1) * len(windows) + w)
            for d, k in zip((pairs // len(windows)).tolist(), (pairs % len(windows)).tolist()):
                found[d].update(phrases.names[p] for p in items(k))
    hit = np.cumsum(cover)[:-1] > 0
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    spans: list = [[] for _ in documents]
    for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
        d = int(np.searchsorted(begin, s, "right")) - 1
        spans[d].append((s - starts[d], e - starts[d]))
    return [(len(p) - 1, x, f) for p, x, f in zip(parts, spans, found)]


def phrases_of(benchmark: DataFrame, window: int, max_words: int) -> Phrases:
    """The benchmark's windows; ValueError if it has more than max_words words."""
    items, n = [], 0
    for item_id, text in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where("text is not null").toLocalIterator():
        items.append((item_id, text))
        n += len(words_of(text))
        if n > max_words:
            raise ValueError(f"the benchmark has more than {max_words} words; search it in parts")
    return Phrases(items, window)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_words: int = 1 << 19, max_words: int = 5_000_000, keep: list | None = None) -> DataFrame:
    """doc_id, n_words, n_hit, items and spans (removal spans in code points) of every document, after the columns to keep."""
    phrases = phrases_of(benchmark, window, max_words)
    kept = [f for f in docs.schema if f.name in (keep or ["doc_id"])]
    rows = docs.select(*[f.name for f in kept], F.coalesce(F.col("text").cast("string"), F.lit("")))
    out = T.StructType([*kept, *(f for f in T._parse_datatype_string(HITS))])
    schema = to_arrow_schema(out)

    def run(batches):
        common.kept("phrases", lambda: phrases)
        held, size = [], 0
        for b in batches:
            for k in range(0, b.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in b.slice(k, 256).columns)):
                    held.append(row)
                    size += len(row[-1]) // 5 + 1
                    if size >= shard_words:
                        yield shard(held)
                        held, size = [], 0
        if held:
            yield shard(held)

    def shard(documents):
        rows = []
        for row, (n, spans, found) in zip(documents, scan([d[-1] for d in documents], phrases)):
            marks = []
            if spans:
                at = [m.span() for m in WORD.finditer(row[-1])]
                marks = [{"start": at[s][0], "end": at[e - 1][1]} for s, e in spans]
            rows.append((*row[:-1], n, sum(e - s for s, e in spans), sorted(x for x in found if x is not None), marks))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return rows.mapInArrow(run, out)


def report(hits: DataFrame) -> DataFrame:
    """What the contract asks for of each document."""
    joined = F.array_join("items", ",")
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(joined, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def cleaned(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """docs with the removal spans cut out of text and with n_hit, the words cut."""
    own = [c for c in docs.columns if c not in ("n_words", "n_hit", "items", "spans")]
    hits = contamination(docs, benchmark, keep=own, **how)
    begin = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(a, s):
        part = F.substring("text", a["at"], s["start"].cast("int") + 1 - a["at"])
        return F.struct((s["end"].cast("int") + 1).alias("at"), F.concat(a["parts"], F.array(part)).alias("parts"))

    rest = F.aggregate("spans", begin, add, lambda a: F.array_join(F.concat(a["parts"], F.array(F.substring("text", a["at"], F.length("text")))), ""))
    return hits.withColumn("text", F.when(F.size("spans") == 0, F.col("text")).otherwise(rest)).select(*own, "n_hit")
