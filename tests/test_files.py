"""Sequences, publication, the history of patches, and caches."""

import os
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lineara.operators import history, merge
from lineara.sinks import caches, publication
from lineara.sources import sequences

# ---- sequences


def plain_fasta(text):
    out = []
    for line in text.split("\n"):
        if line.startswith(">"):
            out.append([line[1:].rstrip("\r"), ""])
        elif out:
            out[-1][1] += "".join(line.split())
    return [(h.split()[0] if h.split() else "", " ".join(h.split()[1:]) or None, s, len(s)) for h, s in out]


def fasta(seed, n, ending="\n"):
    r = random.Random(seed)
    out = []
    for k in range(n):
        out.append(f">p{k} some protein" + (" > of two" if k % 7 == 0 else "") if k % 5 else f">p{k}")
        out += ["".join(r.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(60)) for _ in range(r.choice([0, 1, 2, 30]))]
        out += ["MK*"] if k % 3 else []
    return ending.join(out) + ending


def test_sequences_over_splits_equal_one_piece(spark, tmp_path):
    texts = {"a.fa": fasta(1, 700), "b.fasta": fasta(2, 40, "\r\n"), "c.fa": ">only\nMK", "d.fa": "", "x/e.fa": "\n\n>f\nM\nK\n\n"}
    for name, text in texts.items():
        os.makedirs((tmp_path / name).parent, exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "n.txt").write_text(">no")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        frame = sequences.read_sequences(spark, str(tmp_path))
        assert frame.rdd.getNumPartitions() > 10
        got = {}
        for r in frame.collect():
            got.setdefault(r.path.split("/")[-1], []).append((r.id, r.description, r.residues, r.length))
        for name, text in texts.items():
            assert sorted(got.get(name.split("/")[-1], []), key=repr) == sorted(plain_fasta(text), key=repr)
        counted = {r.path.split("/")[-1]: (r.records, r.residues) for r in sequences.counts(frame).collect()}
        assert counted["a.fa"] == (700, sum(x[3] for x in plain_fasta(texts["a.fa"])))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_records_of_texts(spark):
    text = "; a remark\n>a one\nMK\nL\n>b\n>c three > four\r\nM M\r\n"
    got = [tuple(r) for r in sequences.records(spark.createDataFrame([(1, text), (2, None), (3, "none")], "k int, t string"), ["k"], "t").orderBy("ordinal").collect()]
    assert got == [(1, 0, "a", "one", "MKL", 3), (1, 1, "b", None, "", 0), (1, 2, "c", "three > four", "MM", 2)]


# ---- publication


def tree(root):
    return {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file() and not any(x.startswith("_") or x.startswith(".") for x in p.relative_to(root).parts)}


def publish(spark, rows_, root):
    df = spark.createDataFrame(rows_, "d string, n string, t string").repartition(3)
    return publication.publish(df, str(root), F.col("d"), F.col("n"), F.col("t"))


def test_publication_writes_what_changed(spark, tmp_path):
    first = [(f"d{k % 4}", f"f{k}", f"text {k}") for k in range(20)] + [(None, "x", "y"), ("d", "n", None), ("d0", "f0", "a lesser text")]
    assert publish(spark, first, tmp_path / "o") == {"files": 20, "written": 20}
    assert tree(tmp_path / "o") == {f"d{k % 4}/f{k}": f"text {k}" for k in range(20)}
    stamp = (tmp_path / "o/d1/f1").stat().st_mtime_ns
    assert publish(spark, first, tmp_path / "o") == {"files": 20, "written": 0}
    assert publish(spark, [("d1", "f1", "text 1"), ("d2", "f2", "new"), ("é ü", "n;1", "more")], tmp_path / "o") == {"files": 3, "written": 2}
    assert (tmp_path / "o/d1/f1").stat().st_mtime_ns == stamp
    assert tree(tmp_path / "o") == {f"d{k % 4}/f{k}": f"text {k}" for k in range(20)} | {"d2/f2": "new", "é ü/n;1": "more"}
    assert not list((tmp_path / "o").glob("_attempt*")) and publication.published(spark, f"file://{tmp_path}/o").count() == 21
    assert publish(spark, [], tmp_path / "none") == {"files": 0, "written": 0}


def test_a_publication_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    publish(spark, [("d", f"f{k}", "old") for k in range(6)], tmp_path / "o")
    plain = publication._writer

    def broken(root, attempt):
        inner = plain(root, attempt)

        def write(batches):
            yield from inner(batches)
            raise RuntimeError("task killed")

        return write

    monkeypatch.setattr(publication, "_writer", broken)
    with pytest.raises(Exception, match="task killed"):
        publish(spark, [("d", f"f{k}", "new") for k in range(6)], tmp_path / "o")
    assert set(tree(tmp_path / "o").values()) == {"old"}
    monkeypatch.undo()
    assert publish(spark, [("d", f"f{k}", "new") for k in range(6)], tmp_path / "o") == {"files": 6, "written": 6}
    assert set(tree(tmp_path / "o").values()) == {"new"} and not list((tmp_path / "o").glob("_attempt*"))


def test_a_publication_is_finished_after_its_decision(spark, tmp_path, monkeypatch):
    """Interrupted while files are moved: the next run completes the first publication before its own."""
    publish(spark, [("d", f"f{k}", "old") for k in range(6)], tmp_path / "o")
    plain = publication._mover

    def half(root, attempt):
        inner = plain(root, attempt)

        def move(batches):
            yield from inner(b.slice(0, 1) for b in batches)
            raise RuntimeError("driver lost")

        return move

    monkeypatch.setattr(publication, "_mover", half)
    with pytest.raises(Exception, match="driver lost"):
        publish(spark, [("d", f"f{k}", "new") for k in range(6)], tmp_path / "o")
    monkeypatch.undo()
    assert publish(spark, [("e", "g", "later")], tmp_path / "o") == {"files": 1, "written": 1}
    assert tree(tmp_path / "o") == {f"d/f{k}": "new" for k in range(6)} | {"e/g": "later"}


# ---- history


def test_log_and_its_views(spark, tmp_path):
    r, log, plain = random.Random(6), history.PatchLog(spark, str(tmp_path / "log"), buckets=8), []
    assert log.view("last").count() == 0 == log.compact()
    schema = "db string, species_id int, meta_key string, meta_value string, ordinal int"
    for n in range(5):
        patch = [(f"db{r.randrange(3)}", r.choice([1, None]), f"k{r.randrange(6)}", f"v{r.randrange(99)}", o) for o in range(25)]
        assert log.append(spark.createDataFrame(patch, schema), f"run {n}") == n
        plain += [(n, *p) for p in patch]
        if n == 3:
            assert log.compact() <= 2 * len({p[1:4] for p in plain}) and log.segments() == ["compacted/000000000003"]
    assert log.append(spark.createDataFrame(patch, schema), "run 1") == 1, "a run is in the log once, also after compaction"
    for kind, pick in (("last", max), ("first", min)):
        want = {}
        for n, db, species, key, value, o in plain:
            now = (n, o, value)
            want[db, species, key] = pick(want[db, species, key], now) if (db, species, key) in want else now
        assert {(x.db, x.species_id, x.meta_key): x.meta_value for x in log.view(kind).collect()} == {k: v[2] for k, v in want.items()}
    log.compact()
    assert log.rows().count() <= 2 * len(want) and len(log.segments()) == 1


def test_first_write_is_insert_ignore(spark):
    r = random.Random(1)
    base, more = ([(r.randrange(20), r.randrange(5), o) for o in range(30)] for _ in range(2))
    df = spark.createDataFrame([(k, v, 0, o) for k, v, o in base] + [(k, v, 1, o) for k, v, o in more], "k int, v int, run int, o int")
    target = history.first_write(df.where("run = 0"), ["k"], ["v"], [F.col("run"), F.col("o")])
    patch = history.first_write(df.where("run = 1"), ["k"], ["v"], [F.col("run"), F.col("o")])
    assert rows(history.first_write(df, ["k"], ["v"], [F.col("run"), F.col("o")])) == rows(merge.insert_ignore(target, patch, ["k"], ["v"]))


# ---- caches


def test_cache_opens_only_hopeful_buckets(spark, tmp_path):
    cache = caches.Cache(spark, str(tmp_path / "c"), ["a", "b"], "a string, b int, v string", buckets=32)
    asked = spark.createDataFrame([("k1", 1), ("k1", None), (None, 2), ("none", 5), ("k1", 1), ("k900", 900)], "a string, b int")
    assert cache.probe(asked).where("cached").count() == 0 and cache.rows().count() == 0
    have = [(f"k{k}", k, f"v{k}") for k in range(1500)] + [("k1", None, "null b"), (None, 2, "null a")]
    cache.append(spark.createDataFrame(have[:700], "a string, b int, v string"))
    cache.append(spark.createDataFrame(have[700:], "a string, b int, v string"))
    assert cache.rows().count() == len(have)
    found = cache.lookup(asked)
    assert sorted(r.v for r in found.collect()) == ["null a", "null b", "v1", "v900"]
    hopes = {r.bucket for r in cache.hopeful(asked.distinct()).collect()}
    assert len(list((tmp_path / "c/rows").glob("bucket=*"))) == 32 and len(hopes) <= 5
    assert "PartitionFilters: [bucket" in found._jdf.queryExecution().executedPlan().toString()
    saved = {f: f.read_bytes() for f in (tmp_path / "c/rows").rglob("*.parquet") if int(f.parent.name[7:]) not in hopes}
    for f in saved:
        f.write_bytes(b"not to be opened")
    assert sorted(r.v for r in cache.lookup(asked).collect()) == ["null a", "null b", "v1", "v900"]
    for f, content in saved.items():
        f.write_bytes(content)
    got = sorted(repr(tuple(r)) for r in cache.probe(asked).collect())
    assert got == sorted(map(repr, [("k1", 1, True), ("k1", None, True), (None, 2, True), ("none", 5, False), ("k1", 1, True), ("k900", 900, True)]))
    strangers = spark.range(20_000).selectExpr("concat('s', id) AS a", "CAST(id AS INT) AS b")
    assert cache.hopeful(strangers).count() < 200, "false hopes are few"
    known = spark.createDataFrame([h[:2] for h in have], "a string, b int")
    assert cache.hopeful(known).count() == len(have), "a filter never hides a key"
    assert rows(strangers.union(known).join(cache.rows(), ["a", "b"], "left_anti")) == rows(cache.probe(strangers.union(known)).where("NOT cached AND a IS NOT NULL AND b IS NOT NULL").drop("cached").union(known.where("a IS NULL OR b IS NULL")))
