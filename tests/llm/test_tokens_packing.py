"""Operators 1 and 3: token files and packing against whole-text encoding."""

import bisect
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lineara.llm import packing, token_files, tokens
from lineara.llm.common import shared_dir

PIECES = [" ", "\n", "  ", "\t", "a", "B", "é", "Σ", "ς", "ss", ".", ",", "!!", "'s", "12", "\x00", " ", "　", "\x1c", "é", "İ", "ß", "🎉", "漢", "<|endoftext|>", " <|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "\r\n", "foo", " the"]


def whole(name, control=True):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary(name))
    t.encode_special_tokens = not control
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("control", [True, False])
def test_chunks_encode_as_whole_texts(name, control):
    encoder, ids = tokens.ChunkEncoder(tokens.vocabulary(name), limit=300, control=control), whole(name, control)
    assert (len(ids("a <|endoftext|> b")) < 5) == control

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), max_size=8))
    def check(texts):
        for text, got in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(got, "<u4").tolist() == ids(text)

    check()


def test_token_files_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    folder, got = token_files.token_files(docs, shards=5)
    ids, start = whole("byte_bpe_50k.json"), 0
    by_id = {r.doc_id: r for r in got.collect()}
    assert len(by_id) == docs.count()
    for r in docs.orderBy("doc_id").collect():
        want = np.array([*ids(r.text), 0], dtype="<u4")
        assert (by_id[r.doc_id].start, by_id[r.doc_id].n_tokens, by_id[r.doc_id].ids_crc32) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)


def test_readers_take_only_frames_wanted(tmp_path, monkeypatch):
    path = f"file://{tmp_path}/s.zst"
    monkeypatch.setattr(token_files, "FRAME_IDS", 1000)
    documents = [(None, b""), (3, np.arange(5, dtype="<u4").tobytes()), (7, np.arange(2500, dtype="<u4").tobytes()), (7, b"\1\0\0\0")]
    assert token_files.write_shard(path, "0.part", documents)[:2] == (4, 2506)
    assert [p.name for p in tmp_path.iterdir()] == ["s.zst"]
    reader, asked = token_files.ShardReader(path), []
    frame = reader.frame
    reader.frame = lambda k: asked.append(k) or frame(k)
    got = [(d, n, b"".join(f)) for d, n, f in reader.documents({7})]
    assert got == [(7, 2500, documents[2][1]), (7, 1, documents[3][1])] and asked == [2, 3, 4, 5]
    assert [(d, b"".join(f)) for d, _, f in reader.documents()] == documents
    raw = bytearray((tmp_path / "s.zst").read_bytes())
    raw[int(reader.starts[2]) + 12] ^= 0xFF
    (tmp_path / "s.zst").write_bytes(raw)
    with pytest.raises(Exception):
        token_files.ShardReader(path).frame(2)


def test_a_common_zstd_reader_reads_the_file(tmp_path):
    import zstandard

    path = f"file://{tmp_path}/s.zst"
    token_files.write_shard(path, "0.part", [(1, b"\1\0\0\0"), (2, b"\2\0\0\0")])
    with open(tmp_path / "s.zst", "rb") as f:
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read(8) == b"\1\0\0\0\2\0\0\0"


def test_odd_rows(spark, odd, none):
    got = token_files.token_files(odd)[1].collect()
    assert len(got) == 8 and sorted(r.n_tokens for r in got)[:2] == [1, 1] and sum(r.doc_id is None for r in got) == 1
    assert token_files.token_files(none)[1].count() == 0
    pieces = packing.pack(odd).collect()
    assert sum(r.length for r in pieces if r.doc_id == 1) == 2 * next(r.doc_tokens for r in pieces if r.doc_id == 1)
    assert {r.source for r in pieces} == {None, "a", "b"}
    assert packing.pack(none).count() == 0
    with pytest.raises(ValueError, match="sources"):
        packing.pack(odd, max_sources=1)
    assert shared_dir(spark) != shared_dir(spark)


def test_round_robin_against_a_simulation():
    rng = random.Random(1)
    for trial in range(120):
        k = rng.randint(1, 6)
        totals = [rng.randint(1, 3000) for _ in range(k)]
        robin = packing.RoundRobin(totals, [rng.random() + 0.01 for _ in totals] if trial % 2 else totals, rng.choice([8, 16, 64]), rng.choice([1, 2, 4, 8]))
        sent, credit, stream = [0] * k, [0] * k, []
        while len(stream) < sum(totals):
            for s in range(k):
                credit[s] += int(robin.units[s])
                granules, credit[s] = divmod(credit[s], robin.step)
                n = min(granules * robin.granule, totals[s] - sent[s])
                stream += [(s, sent[s] + i) for i in range(n)]
                sent[s] += n
        whole_ = len(stream) // robin.window * robin.window
        borders, at = list(range(0, whole_, robin.window)), whole_
        for bit in range(20, -1, -1):
            if (len(stream) - whole_) >> bit & 1:
                borders.append(at)
                at += 1 << bit
        want = {t: (q := bisect.bisect_right(borders, p) - 1, p - borders[q]) for p, t in enumerate(stream)}
        got = {}
        for s in range(k):
            j = 0
            while j < totals[s]:
                n = min(totals[s] - j, rng.randint(1, 500))
                _, *places = robin.places(np.array([s]), np.array([j]), np.array([n]))
                for _, lo, length, seq, off in zip(*robin.sequences(*places)):
                    assert length > 0
                    got |= {(s, j + int(lo) + i): (int(seq), int(off) + i) for i in range(length)}
                j += n
        assert got == want


def test_packing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pieces, ids = packing.pack(docs).collect(), whole("word_bpe_49k.json")
    texts = {r.doc_id: np.array([*ids(r.text), 1], dtype="<u4") for r in docs.collect()}
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length, p.source))
        assert zlib.crc32(texts[p.doc_id][p.start : p.start + p.length].tobytes()) == p.ids_crc32 and p.doc_tokens == len(texts[p.doc_id])
    for doc, parts in by_doc.items():
        ends = [0] + [s + n for s, n in sorted(parts)]
        assert [s for s, _ in sorted(parts)] == ends[:-1] and ends[-1] == len(texts[doc])
    total, padding, shares = sum(map(len, texts.values())), 0, {}
    for p in pieces:
        shares[p.source] = shares.get(p.source, 0) + p.length / total
    for seq in by_seq.values():
        ends = [0] + [o + n for o, n, _ in sorted(seq)]
        assert [o for o, _, _ in sorted(seq)] == ends[:-1] and ends[-1] <= 2048
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else 2048 - ends[-1]
        if ends[-1] == 2048:
            for source, share in shares.items():
                assert abs(sum(n for _, n, s in seq if s == source) - 2048 * share) <= 2 * 64 + 64 * len(shares) / 4
    assert padding == 0


def test_targets(spark):
    docs = spark.createDataFrame([(k, "word " * 400, "ab"[k % 2]) for k in range(40)], "doc_id long, text string, source string")
    first = [p for p in packing.pack(docs, window=512, granule=8, targets={"a": 3, "b": 1}).collect() if p.sequence_id == 3]
    assert abs(sum(p.length for p in first if p.source == "a") - 384) <= 16


def test_rows_without_ids_are_dealt_over_shards(spark, tmp_path):
    docs = spark.createDataFrame([(None if k % 3 else 7, f"words of row {k} " * 20, "ab"[k % 2]) for k in range(600)], "doc_id long, text string, source string")
    shards = packing.encoded(docs, packing.vocabulary("word_bpe_49k.json"), 1, 4).groupBy("shard").count().collect()
    assert len(shards) == 4 and max(r["count"] for r in shards) < 300
    assert sum(p.length for p in packing.pack(docs, shards=4).collect()) == sum(p.n_tokens for p in packing.encoded(docs, packing.vocabulary("word_bpe_49k.json"), 1, 4).collect())
    manifest = token_files.write_tokens(docs, f"file://{tmp_path}/t", packing.vocabulary("byte_bpe_50k.json"), 0, 4).collect()
    assert len(manifest) == 4
    got = token_files.token_files(docs)[1].orderBy("start").collect()
    assert len(got) == 600 and [r.doc_id for r in got] == [None] * 400 + [7] * 200
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


def test_chunks_that_come_again_are_kept():
    """600,000 chunks are encoded once, not again when they come a second time."""
    coder = tokens.ChunkEncoder(tokens.vocabulary("word_bpe_49k.json"))
    plain, encoded = coder._ids, []
    coder._ids = lambda chunks: encoded.append(len(chunks)) or plain(chunks)
    texts = [" ".join(f"w{k}" for k in range(at, at + 10_000)) for at in range(0, 600_000, 10_000)]
    assert coder.encode(texts) == coder.encode(texts)
    assert sum(encoded) == 600_000


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_batch_asks_once_for_each_distinct_chunk(name):
    class Young(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    coder, ids = tokens.ChunkEncoder(tokens.vocabulary(name)), whole(name)
    coder.young = Young()
    texts = [f"{' one two' * 500} three{k}" for k in range(20)]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == list(map(ids, texts))
    assert coder.young.asked < 100


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_encoded_once_whatever_punctuation_follows(name):
    coder, ids = tokens.ChunkEncoder(tokens.vocabulary(name)), whole(name)
    plain, encoded = coder._ids, []
    coder._ids = lambda chunks: encoded.extend(chunks) or plain(chunks)
    odd = [" Été?!", " a'", " a'.", " a''s", " a1!", " 1!", " a!b.", " ...", " .", " x_", " <|", " é≮", " ʰ!", " Ǆ$$$", " ß;", " á!", " a….", "a!  b?", " a\x1f!", " x" * 50 + "y" * 100 + "!!", "", "  ", "\n\n!", " ", " a ", " a!\r\n"]
    texts = [*odd, "".join(odd), "".join(reversed(odd)), " word word&&& word?! word... word\nword,"]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == list(map(ids, texts))
    assert [w for w in encoded if w.startswith((" word", "word"))] == [" word"] * (name[0] == "b") + ["word"] * (name[0] == "w")


def test_batches_have_bounded_rows_and_characters(monkeypatch):
    monkeypatch.setattr(tokens, "BATCH_CHARS", 10)
    monkeypatch.setattr(tokens, "BATCH_ROWS", 3)
    assert tokens.batches([4, 6, 1, 0, 0, 0, 25, 25, 2]) == [(0, 2), (2, 5), (5, 6), (6, 7), (7, 8), (8, 9)]
    assert tokens.batches([]) == []
