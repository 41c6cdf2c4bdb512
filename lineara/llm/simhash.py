"""Operator 2: near-duplicates by SimHash fingerprints, found in BK-trees.

Every whole text is lower-cased (A-Z), cut into words at ASCII white space and into word shingles; bit i of its
fingerprint is 1 if it is set in over half of the shingles' hashes. Fingerprints link when they differ in at most
``radius`` bits, and a document's component is what its links reach.

One BK-tree of the whole corpus has no size bound and so can't be broadcast. Instead each fingerprint gets block keys
such that fingerprints within the radius always share one: of ``blocks`` blocks of bits, at most ``radius`` can differ,
so some ``agree`` = blocks - radius blocks are the same, and every choice of that many blocks is a key. The distinct
fingerprints of a key are a shard: a BK-tree (children keyed by their distance to the parent) of at most ``tree_size``
nodes, which all fingerprints of the key query, following only the edges within the radius of their own distance. The
fingerprints of a key with more are keyed again by radius + 1 blocks of their other bits, of which those within the
radius share one; a key that is still too large gets several trees, and its fingerprints query each. A tree gives not its pairs but a
spanning forest of them, so its output never exceeds its input. Components come from alternating star contraction.

Null texts are empty; texts without words have fingerprint zero and link like any other; a null doc_id has the
fingerprint of its text and the component of equal fingerprints, but makes no links of its own; equal rows are equal
documents; an empty table gives no rows. All columns but doc_id and text are ignored. A text's shingles are hashed in
parts, so memory beyond the text itself follows its number of words.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import arrow_schema, partitions, saved, texts

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
CHUNK = 1 << 16
M64 = (1 << 64) - 1
SKETCH = "doc_id long, digest binary, fps array<long>, keys array<long>"
#: Odd multipliers of the further tables; fixed values.
MIX = [1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit numbers have each bit set, the highest bit first."""
    if len(h) <= 256:
        return np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    counts, weight = np.zeros(64, dtype=np.int64), 1
    while len(h):
        carries = []
        while len(h) >= 3:  # a full adder on three numbers at a time
            n = len(h) // 3
            a, b, c, rest = h[:n], h[n : 2 * n], h[2 * n : 3 * n], h[3 * n :]
            x = a ^ b
            carries.append((a & b) | (x & c))
            h = np.concatenate([x ^ c, rest])
        counts += weight * np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        h, weight = np.concatenate(carries) if carries else h[:0], 2 * weight
    return counts


def hashed(text: str, shingle: int):
    """Yields the hashes of a text's shingles, repeats too: XXH64 with seed 42."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last, digest = ends[min(shingle, len(words)) - 1 :], xxhash.xxh64_intdigest
    for k in range(0, n, CHUNK):
        yield np.array([digest(joined[a:b], 42) for a, b in zip(starts[k : min(n, k + CHUNK)].tolist(), last[k : k + CHUNK].tolist())], dtype=np.uint64)


def majority(hashes, tables: int = 1) -> list[int]:
    """The fingerprints of arrays of hashes as unsigned numbers; table 0 takes them as they are, the others mix them."""
    counts, n = np.zeros((tables, 64), dtype=np.int64), 0
    for h in hashes:
        n += len(h)
        for t in range(tables):
            mixed = h
            if t:
                mixed = h * np.uint64(MIX[t])
                mixed = mixed ^ (mixed >> np.uint64(32))
            counts[t] += bit_counts(mixed)
    bits = np.packbits(2 * counts > n, axis=1)
    return [int.from_bytes(row.tobytes(), "big") for row in bits]


def simhash(text: str, shingle: int = 3, tables: int = 1) -> list[int]:
    """The fingerprints of a text, in which a shingle counts as often as it occurs."""
    return majority(hashed(text, shingle), tables)


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """The hashes of a text's distinct shingles, sorted."""
    parts = list(hashed(text, shingle))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.uint64)


def fingerprints(docs: DataFrame, shingle: int = 3, tables: int = 1) -> DataFrame:
    """doc_id and fps, the fingerprints as an array of longs (signed)."""
    ddl = "doc_id long, fps array<long>"
    schema = arrow_schema(ddl)

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                fps = np.array([simhash(t, shingle, tables) for t in part.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(fps), pa.list_(pa.int64()))], schema=schema)

    return texts(docs).mapInArrow(run, ddl)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, each a row of 64-bit words."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


class BKTree:
    """A BK-tree over distinct fingerprints, built and searched level by level."""

    def __init__(self, points: np.ndarray):
        self.points = points
        waiting, at = np.arange(1, len(points)), np.zeros(max(0, len(points) - 1), dtype=np.int64)
        edges = []
        while len(waiting):
            d = distance(points[waiting], points[at])
            key = (at << 16) | d
            order = np.argsort(key, kind="stable")
            first = np.ones(len(key), dtype=bool)
            first[1:] = key[order][1:] != key[order][:-1]
            child = waiting[order][first]  # the first to come along an edge is the child; the others go down to it
            edges.append((key[order][first], child))
            stay = ~first
            at = np.repeat(child, np.diff(np.append(np.flatnonzero(first), len(key))))[stay]
            waiting = waiting[order][stay]
        keys = np.concatenate([e[0] for e in edges]) if edges else np.zeros(0, dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.children = keys[order], (np.concatenate([e[1] for e in edges]) if edges else keys)[order]

    def search(self, queries: np.ndarray, radius: int):
        """Yields arrays (query, node) of the pairs within the radius, a level at a time."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64)
        while len(q):
            d = distance(queries[q], self.points[node])
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit]
            lo = np.searchsorted(self.keys, (node << 16) | np.maximum(0, d - radius))
            n = np.searchsorted(self.keys, (node << 16) | (d + radius), "right") - lo
            q = np.repeat(q, n)
            node = self.children[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(len(q))]


class Forest:
    """Disjoint sets over 0..n-1; the smallest member stands for its set."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        up = self.up
        while True:
            x, y = up[a], up[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
            while (up[up] != up).any():
                up = up[up]
            self.up = up


def _small(points: list, radius: int) -> list:
    """Pairs (later, earlier) of a few fingerprints (as Python ints), by a BK-tree of dictionaries; one for each tie."""
    root, out = (points[0], 0, {}), []
    for k in range(1, len(points)):
        p, todo = points[k], [root]
        while todo:
            x, i, children = todo.pop()
            d = (x ^ p).bit_count()
            if d <= radius:
                out.append((k, i))
            todo += [c for e, c in children.items() if d - radius <= e <= d + radius]
        node = root
        while True:
            d = (node[0] ^ p).bit_count()
            if d not in node[2]:
                node[2][d] = (p, k, {})
                break
            node = node[2][d]
    return out


def _shards(radius: int, queries_at_once: int):
    """For mapInArrow over rows (key, shard, tree, rep, fps) sorted by shard. tree: 0 a query, 1 a node and a query, 2 a node only."""
    schema = arrow_schema("a long, b long")

    def edges_of(reps: np.ndarray, points: np.ndarray, tree: np.ndarray):
        if len(reps) <= 24 and (tree == 1).all():
            ints = [int.from_bytes(p.tobytes(), "little") for p in points]
            order = np.argsort(reps).tolist()
            up = list(range(len(order)))

            def find(x):
                while up[x] != x:
                    x = up[x]
                return x

            for a, b in _small([ints[i] for i in order], radius):
                a, b = find(a), find(b)
                up[max(a, b)] = min(a, b)
            return [(int(reps[order[k]]), int(reps[order[find(k)]])) for k in range(len(order)) if up[k] != k]
        nodes, asking = np.flatnonzero(tree > 0), np.flatnonzero(tree < 2)
        if not len(nodes):
            return []
        nodes = nodes[np.argsort(reps[nodes])]
        bk, forest, out = BKTree(points[nodes]), Forest(len(nodes)), []
        for k in range(0, len(asking), queries_at_once):
            part = asking[k : k + queries_at_once]
            hit = np.full(len(part), -1)
            for q, n in bk.search(points[part], radius):
                new = hit[q] < 0
                hit[q[new]] = n[new]
                forest.union(hit[q], n)
            linked = (hit >= 0) & (tree[part] == 0)
            out.append((reps[part][linked], hit[linked]))
        edges = [(int(reps[nodes[k]]), int(reps[nodes[u]])) for k, u in enumerate(forest.up.tolist()) if u != k]
        for r, n in out:
            edges += zip(r.tolist(), reps[nodes[n]].tolist())
        return edges

    def run(batches):
        held: list = []

        def done(last: bool, table: pa.Table):
            key, shard = (np.asarray(table.column(c)) for c in ("key", "shard"))
            new = np.flatnonzero((key[1:] != key[:-1]) | (shard[1:] != shard[:-1])) + 1
            starts = np.concatenate([[0], new])
            ends = np.append(new, len(key))
            if not last:
                starts, ends = starts[:-1], ends[:-1]
            many = ends - starts > 1
            edges: list = []
            if many.any():
                reps, tree = np.asarray(table.column("rep")), np.asarray(table.column("tree"))
                points = np.asarray(table.column("fps").combine_chunks().flatten()).view(np.uint64).reshape(len(key), -1)
                for s, e in zip(starts[many].tolist(), ends[many].tolist()):
                    edges += edges_of(reps[s:e], points[s:e], tree[s:e])
            return edges, table.slice(int(ends[-1])) if len(ends) and not last else table.slice(len(key) if last else 0)

        for b in itertools.chain(batches, [None]):
            if b is not None and b.num_rows == 0:
                continue
            if b is None and not held:
                return
            if b is not None:
                held.append(b)
                same = held[0].column(0)[0] == b.column(0)[-1] and held[0].column(1)[0] == b.column(1)[-1]
                if same:
                    continue
            table = pa.Table.from_batches(held)
            edges, rest = done(b is None, table)
            held = rest.combine_chunks().to_batches() if rest.num_rows else []
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges)], schema=schema)

    return run


def _blocks(size: int, blocks: int) -> list[tuple[int, int]]:
    """Place and width of blocks that part ``size`` bits."""
    width, over = divmod(size, blocks)
    widths = [width + (k < over) for k in range(blocks)]
    return list(zip(np.concatenate([[0], np.cumsum(widths)[:-1]]).tolist(), widths))


def _bits(places: list[int]) -> "F.Column":
    """The bits of fp at these places, all others zero."""
    mask = sum(1 << k for k in places)
    return F.col("fp").bitwiseAND(F.lit(mask - (mask >> 63 << 64)).cast("long"))


def block_keys(radius: int, blocks: int) -> tuple["F.Column", "F.Column"]:
    """An array of keys, of which fingerprints (column fp, 64 bits) within the radius share at least one, and the same for those of one key.

    The second array is of the keys that refine the key numbered ``pos`` (column): its bits outside the key are parted into
    radius + 1 blocks, and two fingerprints within the radius agree in one of them.
    """
    parts, keys, finer = _blocks(64, blocks), [], F.lit(None)
    for n, chosen in enumerate(itertools.combinations(range(blocks), blocks - radius)):
        inside = [k for c in chosen for k in range(parts[c][0], sum(parts[c]))]
        outside = [k for k in range(64) if k not in set(inside)]
        keys.append(F.xxhash64(F.lit(n), _bits(inside)))
        finer = F.when(F.col("pos") == n, F.array(*[F.xxhash64(F.col("key"), F.lit(m), _bits(outside[at : at + width])) for m, (at, width) in enumerate(_blocks(len(outside), radius + 1))])).otherwise(finer)
    return F.array(*keys), finer


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of groups cut into ``trees`` trees and ``slices`` slices of queries (null: one of each), with shard and tree as _shards wants."""
    own, part = F.pmod(F.xxhash64("rep"), "trees").cast("int"), F.pmod(F.xxhash64("rep", F.lit(1)), "slices").cast("int")
    asks = F.transform(F.sequence(F.lit(0), F.col("trees") - 1), lambda t: F.struct((t * F.col("slices") + part).alias("shard"), F.when(t == own, 1).otherwise(0).alias("tree")))
    stands = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda p: F.struct((own * F.col("slices") + p).alias("shard"), F.lit(2).alias("tree")))
    stands = F.filter(stands, lambda x: x["shard"] != own * F.col("slices") + part)
    alone = F.array(F.struct(F.lit(0).alias("shard"), F.lit(1).alias("tree")))
    return rows.select("*", F.inline(F.when(F.col("trees").isNull() | (F.col("trees") == 1), alone).otherwise(F.concat(asks, stands))))


def tree_edges(points: DataFrame, keys: "F.Column", radius: int, tree_size: int, queries_at_once: int = 2048, finer: "F.Column | None" = None) -> DataFrame:
    """Links (a, b) that connect all points (rep, fps, and what keys needs) within the radius that share a key.

    The points of a key with more than ``tree_size`` of them are parted by finer keys, if there are any; what is larger
    still is cut into trees, which all of its points query.
    """
    own = [c for c in points.columns if c != "keys"]
    rows = points.select(*own, F.posexplode(keys).alias("pos", "key"))
    sizes = lambda keyed: saved(keyed.groupBy("key").count().where(F.col("count") > tree_size), "large-keys")
    parts = lambda size: F.ceil(F.col("count") / F.lit(size)).cast("int")
    # keys alone, without what they were made from
    large = sizes(points.select(F.explode(keys).alias("key")))
    if finer is not None and large.head(1):
        marked = saved(rows.join(large, "key", "left"), "keyed")
        parted = marked.where("count is not null").select(*own, F.explode(finer).alias("key"))
        rows = marked.where("count is null").select(*own, "key").unionByName(parted)
        large = sizes(parted)
    large = large.select("key", parts(tree_size).alias("trees"), parts(16 * tree_size).alias("slices"))
    rows = rows.join(large, "key", "left")
    rows = dealt(rows).select("key", "shard", "tree", "rep", "fps")
    n = partitions(points)
    sorted_rows = rows.repartition(n, "key", "shard").sortWithinPartitions("key", "shard", F.desc("tree"))
    return sorted_rows.mapInArrow(_shards(radius, queries_at_once), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node that each node of the links (a, b) reaches.

    Alternating large and small stars: each round links every neighbour to the least one, first the larger neighbours
    and then the smaller, until nothing changes. Each round is joins and sums, cut off by a checkpoint; the least
    neighbours are checkpointed too, so both sides of a join come from files and adaptive execution can split the rows of
    a node that very many links share.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = checkpointed(edges), None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = checkpointed(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        stars = checkpointed(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = checkpointed(stars.groupBy("a").agg(F.min("b").alias("m")))
        small = stars.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        edges = checkpointed(small.union(low.select("a", F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, blocks: int = 5, tree_size: int = 8192) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document; links within at most ``radius`` bits, all of them."""
    fps = saved(fingerprints(docs, shingle).select("doc_id", F.get("fps", F.lit(0)).alias("fp")), "fingerprints")
    points = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")).where("rep is not null"), "points")
    keys, finer = block_keys(radius, blocks)
    edges = tree_edges(points.withColumn("fps", F.array("fp")), keys, radius, tree_size, finer=finer)
    found = components(edges)
    reps = points.join(found, points["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(reps, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def min_keys(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """For each band a key of the least values of ``rows`` random orders; sets of Jaccard similarity s share it with s ** rows."""
    factors = np.random.default_rng(11).integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(bands * rows, np.uint64(M64))
    mixed = hashes ^ (hashes >> np.uint64(32))
    for k in range(0, len(mixed), 1 << 12):
        least = np.minimum(least, (mixed[k : k + (1 << 12)] * factors[:, None]).min(axis=1))
    keys = np.arange(bands, dtype=np.uint64)
    for x in least.reshape(bands, rows).T:
        keys = (keys ^ x) * np.uint64(MIX[1])
        keys = keys ^ (keys >> np.uint64(29))
    return keys


def _sketches(shingle: int, words: int, bands: int, rows: int):
    """For mapInArrow over (doc_id, text): doc_id, a digest of the set of shingles, its fingerprints and its keys."""
    import xxhash

    schema = arrow_schema(SKETCH)

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                sets = [shingle_set(t, shingle) for t in part.column(1).to_pylist()]
                digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                fps = np.array([majority([s], words) for s in sets], dtype=np.uint64).view(np.int64)
                keys = np.array([min_keys(s, bands, rows) for s in sets], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(digests, pa.binary()), pa.array(list(fps), pa.list_(pa.int64())), pa.array(list(keys), pa.list_(pa.int64()))], schema=schema)

    return run


class Prefixes:
    """The sets of one shard with their shingles numbered from the rarest, and lists of the nodes by the shingles of their prefixes.

    Two sets whose similarity is high enough share a shingle among the rarest few of each (the prefix), and the first one
    they share stands so early in both that enough can follow it.
    """

    def __init__(self, sets: list, nodes: np.ndarray, similarity: float):
        self.similarity, self.sizes = similarity, np.array([len(s) for s in sets], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        _, number, count = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
        rank = np.empty(len(count), dtype=np.int64)
        rank[np.argsort(count, kind="stable")] = np.arange(len(count))
        ranks = rank[number]
        self.ranks = ranks[np.lexsort((ranks, owner))]  # of each set, the rarest first
        self.present = np.zeros(len(count), dtype=bool)
        self.lengths = self.sizes - np.ceil(similarity * self.sizes - 1e-9).astype(np.int64) + 1
        place = np.arange(len(owner)) - self.starts[owner]
        is_node = np.zeros(len(sets), dtype=bool)
        is_node[nodes] = True
        listed = np.flatnonzero(is_node[owner] & (place < self.lengths[owner]))
        listed = listed[np.argsort(self.ranks[listed], kind="stable")]
        self.tokens, self.nodes, self.places = self.ranks[listed], owner[listed], place[listed]

    def prefix(self, k: int) -> np.ndarray:
        return self.ranks[self.starts[k] : self.starts[k] + self.lengths[k]]

    def needed(self, a, b):
        """The shared shingles that sets of these sizes need."""
        return np.ceil(self.similarity / (1 + self.similarity) * (self.sizes[a] + self.sizes[b]) - 1e-9)

    def alike(self, k: int, others: np.ndarray) -> np.ndarray:
        """Which of the other sets are similar to set k: all are decided by one pass over their shingles."""
        own = self.ranks[self.starts[k] : self.starts[k] + self.sizes[k]]
        self.present[own] = True
        n = self.sizes[others]
        first = np.cumsum(n) - n
        at = np.repeat(self.starts[others] - first, n) + np.arange(n.sum())
        shared = np.add.reduceat(self.present[self.ranks[at]].astype(np.int64), first)
        self.present[own] = False
        return shared >= self.needed(k, others)


def linked(sets: list, asking: np.ndarray, nodes: np.ndarray, similarity: float, at_once: int = 256) -> np.ndarray:
    """For each of the sets one that stands for it: nodes and asking sets that similarities of at least ``similarity`` connect.

    Neighbours in the lists of the rarest shingles are compared first, which joins most copies at the cost of a few
    comparisons a set. Then each asking set is compared with what its prefix finds, unless it is joined to it already;
    shingles that only its own joined sets have are passed over. So a group of unlike sets costs about its size, and so
    does one of copies; every similar pair of an asking set and a node is decided.
    """
    forest = Forest(len(sets))
    if not len(nodes) or not len(asking):
        return forest.up
    index = Prefixes(sets, nodes, similarity)
    empty = np.intersect1d(np.flatnonzero(index.sizes == 0), np.union1d(asking, nodes))
    if len(np.intersect1d(empty, nodes)):
        forest.union(np.full(len(empty), np.intersect1d(empty, nodes)[0]), empty)
    asks = np.zeros(len(sets), dtype=bool)
    asks[asking] = True
    for depth in range(4):
        near = np.flatnonzero((index.tokens[1:] == index.tokens[:-1]) & (index.places[1:] == depth))
        for a, b in zip(index.nodes[near].tolist(), index.nodes[near + 1].tolist()):
            if (asks[a] or asks[b]) and forest.up[a] != forest.up[b] and index.alike(a, np.array([b]))[0]:
                forest.union(np.array([a]), np.array([b]))
    begin = np.flatnonzero(np.append(True, index.tokens[1:] != index.tokens[:-1])) if len(index.tokens) else np.zeros(0, np.int64)
    known, end = index.tokens[begin], np.append(begin[1:], len(index.tokens))
    for k, x in enumerate(asking.tolist()):
        if not len(known) or not index.sizes[x]:
            continue
        if k % at_once == 0:
            low, high = (f.reduceat(forest.up[index.nodes], begin) for f in (np.minimum, np.maximum))
        prefix = index.prefix(x)
        at = np.minimum(np.searchsorted(known, prefix), len(known) - 1)
        mine = np.flatnonzero((known[at] == prefix) & ~((low[at] == high[at]) & (forest.up[low[at]] == forest.up[x])))
        lists = at[mine]
        n = end[lists] - begin[lists]
        rows = np.repeat(begin[lists] - np.cumsum(n) + n, n) + np.arange(n.sum())
        found = index.nodes[rows]
        room = np.minimum(index.sizes[x] - np.repeat(mine, n), index.sizes[found] - index.places[rows])
        found = np.unique(found[(room >= index.needed(x, found)) & (forest.up[found] != forest.up[x])])
        if len(found):
            found = found[index.alike(x, found)]
            forest.union(np.full(len(found), x), found)
    return forest.up


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least ``similarity``; empty sets are equal."""
    if not len(a) or not len(b):
        return len(a) == len(b)
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    both = int(np.count_nonzero(a[at] == b))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def _verified(similarity: float):
    """For applyInArrow over rows (component, shard, tree, rep, shingles) of one shard; tree as in _shards."""
    schema = arrow_schema("a long, b long")

    def run(table: pa.Table) -> pa.Table:
        reps, tree = np.asarray(table.column("rep")), np.asarray(table.column("tree"))
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("shingles").to_pylist()]
        nodes, asking = np.flatnonzero(tree > 0), np.flatnonzero(tree < 2)
        up = linked(sets, asking, nodes, similarity)
        moved = np.flatnonzero(up != np.arange(len(up)))
        return pa.table([pa.array(reps[moved]), pa.array(reps[up[moved]])], schema=schema)

    return run


def exact_edges(docs: DataFrame, candidates: DataFrame, shingle: int, similarity: float, held: int) -> DataFrame:
    """Links (a, b) that connect all documents of a candidate group (node, component) whose exact similarity is high enough.

    Each document's set of shingles is made again and goes to its own group once. A group of more than ``held`` shingles,
    or ``held`` / 256 documents, is cut into parts of about that many, and all of its documents ask each part.
    """
    ddl = "component long, rep long, shingles binary, size long"
    schema = arrow_schema(ddl)

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                sets = [shingle_set(t, shingle) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([len(s) + 256 for s in sets], pa.int64())], schema=schema)

    rows = texts(docs).join(candidates, F.col("doc_id") == F.col("node")).select("component", F.col("node").alias("rep"), "text").dropDuplicates()
    rows = saved(rows.mapInArrow(run, ddl), "sets")
    weigh = lambda size: F.ceil(F.sum("size") / F.lit(size)).cast("int")
    weights = saved(rows.groupBy("component").agg(weigh(held).alias("trees"), weigh(4 * held).alias("slices")), "group-weights")
    rows = dealt(rows.join(weights, "component")).select("component", "shard", "tree", "rep", "shingles")
    rows = rows.repartition(partitions(docs), "component", "shard")  # or else the join's partitioning would keep all shards of a group in one task
    return rows.groupBy("component", "shard").applyInArrow(_verified(similarity), "a long, b long")


def rare_prefixes(docs: DataFrame, reps: DataFrame, shingle: int, similarity: float, common: int = 64) -> DataFrame:
    """rep, tokens: the rarest shingles of each document rep, so many that sets of this similarity share one of them.

    Any one order of all shingles gives that; here those that over ``common`` of the sets have come last, by their number, so
    that passages which many documents share are in no prefix. Texts of one doc_id have the tokens of all of them.
    """
    ddl = "rep long, own long, shingles array<long>"
    schema = arrow_schema(ddl)

    def run(batches):
        import xxhash

        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                sets = [shingle_set(t, shingle) for t in part.column(1).to_pylist()]
                own = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], schema=schema)

    rows = texts(docs).join(reps, F.col("doc_id") == F.col("rep")).select("rep", "text").dropDuplicates()
    sets = saved(rows.mapInArrow(run, ddl), "prefix-sets")
    flat = sets.select("rep", "own", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    often = saved(flat.groupBy("s").count().where(F.col("count") > common), "common-shingles")
    ordered = flat.join(often, "s", "left").groupBy("rep", "own", "n").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("c"), "s"))).alias("v"))
    length = (F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - F.lit(1e-9)) + 1).cast("int")
    return ordered.select("rep", F.explode(F.slice(F.col("v")["s"], F.lit(1), length)).alias("s")).groupBy("rep").agg(F.collect_set("s").alias("tokens"))


def refined(docs: DataFrame, points: DataFrame, most: int, shingle: int, similarity: float) -> DataFrame:
    """points (rep, fps, keys) in which a key that more than ``most`` of them share gives way to the documents' rarest shingles.

    Of documents that share such a key those of this similarity share one of these too, so none of their links is lost.
    """
    slim = points.select("rep", F.posexplode("keys").alias("pos", "key"))
    large = saved(slim.groupBy("key").count().where(F.col("count") > most), "large-keys")
    if not large.head(1):
        return points
    hot = saved(slim.join(large, "key").groupBy("rep").agg(F.collect_set("pos").alias("hot")), "large-key-points")
    finer = rare_prefixes(docs, hot.select("rep"), shingle, similarity)
    marked = points.join(hot, "rep", "left").join(finer, "rep", "left")
    cold = F.filter("keys", lambda _, at: ~F.array_contains("hot", at))
    keys = F.concat(cold, F.transform(F.coalesce("tokens", F.array().cast("array<long>")), lambda t: F.xxhash64(F.lit(2), t)))
    return saved(marked.select("rep", "fps", F.when(F.col("hot").isNull(), F.col("keys")).otherwise(keys).alias("keys")), "refined-points")


def similar_documents(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, words: int = 4, bands: int = 20, rows: int = 4, tree_size: int = 4096, held: int = 2_000_000) -> DataFrame:
    """doc_id, component_id: groups of documents whose sets of word shingles have a Jaccard similarity of ``similarity`` or more.

    Fingerprints and keys are made of distinct shingles and only find candidates; links are decided by the sets themselves.
    A pair of similarity s shares one of the MinHash keys with probability 1 - (1 - s ** rows) ** bands: 0.99997 at 0.8. Its
    64 * words fingerprint bits differ in a share acos(2s / (1 + s)) / pi, 0.15 at 0.8, or up to 3/16 where sets are as
    small as 4 and 5 shingles; the BK-trees' radius is that and four deviations more. At such a radius a tree's search
    passes over little, so a key with more than ``tree_size`` sets gives way to its documents' rarest shingles before trees
    are built, by which no link of documents that share the key is lost, however many there are. What candidates reach is a candidate group, in which every pair is decided. Equal sets are one point.

    Null texts are empty, and texts without a word are alike; texts may be of any length (their sets are made in parts);
    a null doc_id joins no group, but has the component of equal sets; equal rows are equal documents; an empty table
    gives no rows; further columns are ignored.
    """
    import math

    share = max(3 / 16, math.acos(2 * similarity / (1 + similarity)) / math.pi)
    radius = math.ceil(64 * words * share + 4 * math.sqrt(64 * words * share * (1 - share)))
    fps = saved(texts(docs).mapInArrow(_sketches(shingle, words, bands, rows), SKETCH), "fingerprints")
    points = saved(fps.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("fps").alias("fps"), F.first("keys").alias("keys")).where("rep is not null"), "points")
    near = tree_edges(refined(docs, points.select("rep", "fps", "keys"), tree_size, shingle, similarity), F.col("keys"), radius, tree_size, 256)
    candidates = components(near)
    candidates = candidates.union(candidates.select("component", "component")).distinct()
    found = components(exact_edges(docs, candidates, shingle, similarity, held))
    reps = points.join(found, points["rep"] == found["node"], "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(reps, "digest", "left").select("doc_id", "component_id")
