"""Operators 11 to 13: repair of conversations, Merkle manifest, fingerprints."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import rows

from lineara.llm import fingerprints, merkle, queries, repair

# ---- operator 11


def scripts(symbols, inserts=2):
    """All edit strings of a signature with few inserts at each place, with cost, by brute force."""
    ways = []
    for gaps in itertools.product(range(inserts + 1), repeat=len(symbols) + 1):
        for kinds in itertools.product("DKR", repeat=len(symbols)):
            ways.append("".join("I" * g + k for g, k in zip(gaps, kinds)) + "I" * gaps[-1])
    return ways


def cost_of(symbols, audit):
    """The least cost of an audit over all roles that it may give; None if no roles fit."""
    texts, k, cost = [""], 0, 0
    for edit in audit:
        if edit == "I":
            cost, options = cost + 2, "ua"
        else:
            s, k = symbols[k], k + 1
            if edit == "D":
                cost += 3
                continue
            if s == "-":
                return None
            cost += (2 if edit == "R" else 0) + s.isupper()
            options = s.lower() if edit == "K" else "ua"
        texts = [t + o for t in texts for o in options]
    return cost if any(re.fullmatch("(s?(ua)+)?", t) for t in texts) else None


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_repair_is_cheapest_and_first(length):
    words = sorted("".join(w) for w in itertools.product("-aAsSuUxX", repeat=length))
    words = words if length < 3 else sorted(random.Random(1).sample(words, 60))
    for word, cost, audit in repair.solve(words):
        found = [(c, a) for a in scripts(word) if (c := cost_of(word, a)) is not None]
        assert (cost, audit) == min(found)


def test_layers_of_shared_prefixes_are_kept(monkeypatch):
    taken = []
    monkeypatch.setattr(repair, "step", lambda layer, symbol, f=repair.step: taken.append(symbol) or f(layer, symbol))
    words = ["u" * 50 + x + y for x in "asu" for y in "asu"]
    got = list(repair.solve(sorted(words)))
    assert len(taken) == 50 + 3 + 9
    assert got == [next(repair.solve([w])) for w in sorted(words)]


def test_long_signature_costs_linear_time():
    word, cost, audit = next(repair.solve(["ua" * 100_000]))
    assert cost == 0 and audit == "K" * 200_000


CONV = "conv_id long, turn long, role string, text string, n_chars long, fault string, live string"


def brute_conversation(turns, damage=True):
    """The contract for one conversation, in plain Python."""
    told = lambda v: " " if v is None else str(v)
    rows_ = []
    for conv, turn, role, text in turns:
        kind = zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20 if damage else 9
        role, text = told(role), told(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows_ += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    rows_.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows_:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    kinds = [r[1][:1] if r[1][:1] in ("s", "u", "a") else "x" for r in rows_]
    word = "".join("-" if f in ("blank", "duplicate") else k.upper() if f == "truncated" else k for k, f in zip(kinds, faults))
    _, cost, audit = next(repair.solve([word]))
    turns_ = [r[0] for r in rows_ if r[0] is not None]
    gaps = max(turns_) - min(turns_) + 1 - len(set(turns_)) if turns_ else 0
    said, state, k = [], "", 0
    for edit in audit:
        role = "assistant" if state[-1:] == "u" else "user"
        if edit == "I":
            said.append(role + ":")
        else:
            _, own, text = rows_[k]
            k += 1
            if edit == "D":
                continue
            role = own if edit == "K" else role
            said.append(f"{role}:{text}")
        state += role[:1]
    assert re.fullmatch("(s?(ua)+)?", state)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows_, rows_[1:]))
    count = Counter(faults)
    return (turns[0][0], gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def random_turns(seed):
    r = random.Random(seed)
    texts = ["Hello.", "hello", "", " \n", "Is it so? ", "yes!", None, "a ", "long " * 2000 + "."]
    out = []
    for conv in [None, *range(120)]:
        turn = 0
        for _ in range(r.randrange(0, 7) or 1):
            turn = r.choice([turn, turn + 1, turn + 1, turn + 3, None if r.random() < 0.2 else turn + 1]) if turn is not None else 1
            out.append((conv, turn, r.choice(["user", "assistant", "system", None, "", "tool", "user", "assistant"]), r.choice(texts)))
    return out


@pytest.mark.parametrize("damage", [True, False])
def test_repair_against_plain_python(spark, damage):
    turns = random_turns(3 + damage)
    df = spark.createDataFrame([(*t, 1, "x", "y") for t in turns], CONV).repartition(5)
    got = repair.digests(*repair.repair(repair.damaged(df) if damage else repair.undamaged(df)))
    want = [brute_conversation([t for t in turns if t[0] == c], damage) for c in dict.fromkeys(t[0] for t in turns)]
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got.columns == columns
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))


def test_repaired_turns_are_legal_and_hash_alike(spark):
    df = spark.createDataFrame([(*t, 1, "x", "y") for t in random_turns(9)], CONV)
    marked, report = repair.repair(repair.undamaged(df))
    told = {}
    for r in repair.repaired_turns(marked, report).orderBy("conv_id", "place").collect():
        told.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for r in repair.digests(marked, report).collect():
        said = told.get(r["conv_id"], [])
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in said).encode()).hexdigest() == r["repaired_sha256"]
        assert re.fullmatch("(s?(ua)+)?", "".join(a[:1] for a, _ in said))


def test_repair_of_an_empty_table(spark):
    df = spark.createDataFrame([], CONV)
    assert repair.digests(*repair.repair(repair.damaged(df))).count() == 0


# ---- operator 12


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            first = at[k] // 3 * 3
            path.append(("".join(nodes[first : at[k]]), "".join(nodes[at[k] + 1 : first + 3])))
            at[k] //= 3
        nodes = [H(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute_manifest(docs):
    by = {}
    for d in docs:
        by.setdefault(d[3], []).append(d)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf(*d)))
    lower = [tree([leaf(*d) for d in by[s]]) for s in sources]
    root, upper = tree([t[0] for t in lower])
    out = []
    for s, (subroot, paths), top in zip(sources, lower, upper):
        for (doc_id, text, *more), path in zip(by[s], paths):
            path = path + top
            own = leaf(doc_id, text, *more)
            node = own
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                node = leaf(doc_id, text.replace("\n", ""), *more)
            for left, right in path:
                node = H(left, node, right)
            out.append((doc_id, own, subroot, root, H(*[a + b for a, b in path]), node, node == root))
    return out


DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank long, n long, grp string, path string, node string"
DIGESTS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest_rows(spark, docs):
    df = spark.createDataFrame([(*d, 5, 6, "g", "p", "q") for d in docs], DOCS).repartition(3)
    return sorted(map(repr, map(tuple, merkle.report(merkle.manifest(df)).select(*DIGESTS).collect())))


def some_docs():
    """Sparse and negative ids, null ids, sources of one row, many copies of one row, one id with many texts."""
    r = random.Random(7)
    docs = [(r.choice([1, -1]) * r.getrandbits(r.choice([5, 20, 40, 62])), f"text {k}\nmore", "en", r.choice(["b", "a", "é", None]), k) for k in range(900)]
    docs += [(7, "same", None, "copies", 4)] * 40 + [(8, f"one id {k}", "fr", "versions", None) for k in range(60)]
    docs += [(None, f"no id {k % 9}", "fr", "b", 1) for k in range(30)] + [(1, None, None, "single", None), (2, "", "en", "", 0)]
    return docs + [(k, "x\n" * 50_000, "en", f"s{k}", 100_000) for k in range(3)]


@pytest.mark.parametrize("crowded", [1 << 20, 4])
def test_manifest_against_plain_python(spark, monkeypatch, crowded):
    monkeypatch.setattr(merkle, "CROWDED", crowded)
    docs = some_docs()
    assert manifest_rows(spark, docs) == sorted(map(repr, brute_manifest(docs)))


@pytest.mark.parametrize("n", [1, 4, 28, 730])
def test_trees_of_all_shapes(spark, n):
    docs = [(k, "t", "en", "a", 1) for k in range(n)]
    if n > 30:
        assert manifest_rows(spark, docs) == sorted(map(repr, brute_manifest(docs)))
    else:
        docs += [(k, "t", "en", f"s{k}", 1) for k in range(n)]
        assert manifest_rows(spark, docs) == sorted(map(repr, brute_manifest(docs)))


def test_manifest_of_odd_rows_and_none(spark, odd, none):
    docs = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in odd.collect()]
    got = merkle.report(merkle.manifest(odd)).select(*DIGESTS).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_manifest(docs)))
    assert merkle.report(merkle.manifest(none)).count() == 0


# ---- operator 13


def slow_features(data, ranks):
    """Positions of the chosen runs, straight from the definition."""
    w, n = fingerprints.WINDOW, fingerprints.NEIGHBOURS
    levels = []
    for s in range(len(data) - w + 1):
        weight = sum(int(fingerprints._STEP[:c].sum()) for c in Counter(data[s : s + w]).values())
        levels.append(((fingerprints.LEVELS << 17) + (1 << 16) - weight) >> 17)
    r = [int(ranks[x]) for x in levels]
    popular = Counter()
    for s in range(max(1, len(r) - n + 1) if r else 0):
        at = min(range(s, min(s + n, len(r))), key=lambda p: (r[p], p))
        if r[at] < fingerprints.NEVER:
            popular[at] += 1
    need = min(fingerprints.POPULAR, max(1, (len(r) - n + 1) // 2))
    return [p for p in sorted(popular) if popular[p] >= need]


def corpus(n=60):
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randrange(2, 9))) for _ in range(500)]
    return [" ".join(r.choice(words) for _ in range(r.choice([0, 1, 3, 8, 30, 200, 900]))) for _ in range(n)] + ["=" * 300, "é" * 40, "x" * 31, "y" * 32, "ab" * 64]


def test_entropy_is_shannons():
    data = corpus()[5].encode() + bytes(range(64))
    got = fingerprints.entropies(np.frombuffer(data, np.uint8))
    for s in range(len(got)):
        h = -sum(c / 32 * math.log2(c / 32) for c in Counter(data[s : s + 32]).values())
        assert abs(got[s] - 200 * h) <= 0.51


@pytest.mark.parametrize("bits", [20, 10])
def test_features_against_the_definition(monkeypatch, bits):
    """Also where texts are cut in pieces of 1,024 positions."""
    monkeypatch.setattr(fingerprints, "PIECE_BITS", bits)
    data = [t.encode() for t in corpus()]
    counts = fingerprints.level_counts(data)
    assert counts.sum() == sum(max(0, len(d) - 31) for d in data)
    ranks = fingerprints.ranks_of(counts)
    got = {}
    for owner, found in fingerprints.chosen(data, ranks):
        for k, h in zip(owner.tolist(), found.tolist()):
            got.setdefault(k, []).append(h)
    for k, d in enumerate(data):
        runs = np.array([list(d[p : p + 32]) for p in slow_features(d, ranks)], np.uint8).reshape(-1, 32)
        assert got.get(k, []) == fingerprints.hashes(runs).tolist()


def test_fingerprints_do_not_depend_on_company():
    data = [t.encode() for t in corpus()]
    ranks = fingerprints.ranks_of(fingerprints.level_counts(data))
    together = [str(p) for p in fingerprints.fingerprints(data, ranks)]
    assert together == [str(fingerprints.fingerprints([d], ranks)[0]) for d in data]
    assert together[0 if not data[0] else [len(d) for d in data].index(0)] == "0:"
    assert all(str(fingerprints.Fingerprint.parse(t)) == t for t in together)


def test_likeness_follows_what_is_shared():
    r = random.Random(1)
    said = [" ".join("".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randrange(2, 9))) for _ in range(3000)) for _ in range(2)]
    parts = [said[0], said[0][: len(said[0]) // 2] + said[1][len(said[0]) // 2 :], said[1], said[0][:-200], "", "ab"]
    ranks = fingerprints.ranks_of(fingerprints.level_counts([p.encode() for p in parts]))
    a, half, b, most, none, short = fingerprints.fingerprints([p.encode() for p in parts], ranks)
    assert fingerprints.likeness(a, a) == fingerprints.likeness(none, none) == 1
    assert fingerprints.likeness(a, none) == 0
    assert fingerprints.likeness(a, b) < 0.1 < 0.4 < fingerprints.likeness(a, half) < 0.7 < 0.9 < fingerprints.likeness(a, most)
    assert fingerprints.likeness(a, half) == fingerprints.likeness(half, a)
    assert short.features == 1


def brute_prints(docs, spark):
    ranks = fingerprints.ranks_of(fingerprints.level_counts([(t or "").encode() for _, t in docs]))
    hashed = spark.createDataFrame([(k, d, t or "") for k, (d, t) in enumerate(docs)], "k long, d long, t string").selectExpr("k", "xxhash64(t) AS h").collect()
    h = {r["k"]: r["h"] for r in hashed}
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is not None, docs[k][0] or 0, h[k], docs[k][1] or ""))
    out = []
    for at, nxt in zip(order, order[1:] + order[:1]):
        text, after = docs[at][1] or "", docs[nxt][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        a, e, b = fingerprints.fingerprints([x.encode() for x in (text, new, after)], ranks)
        out.append((docs[at][0], len(text), hashlib.sha256(new.encode()).hexdigest(), str(a), str(e), fingerprints.likeness(a, e), fingerprints.likeness(a, b)))
    return sorted(map(repr, out))


@pytest.mark.parametrize("n", [1, 2, 70])
def test_compared_against_plain_python(spark, n):
    texts = corpus()
    docs = [(k * 3 - 50, texts[k % len(texts)]) for k in range(n)]
    if n > 2:
        docs += [(None, "no id"), (None, "none either"), (4, "same"), (4, "same"), (5, None)] + [(9, f"one id, many texts {k}") for k in range(300)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, bucket long, ahead string").repartition(4)
    got = fingerprints.compared(df, fingerprints.learn(df))
    assert sorted(map(repr, map(tuple, got.collect()))) == brute_prints(docs, spark)


def test_fingerprints_of_odd_rows_and_none(spark, odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted(map(repr, map(tuple, fingerprints.compared(odd, fingerprints.learn(odd)).collect()))) == brute_prints(docs, spark)
    assert fingerprints.compared(none, fingerprints.learn(none)).count() == 0
    same = fingerprints.fingerprinted(odd, fingerprints.learn(odd)).where("doc_id = 1").distinct()
    assert same.count() == 1


def test_documents_on_whole_tables(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op13_fingerprints(spark, sf)
    docs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert sorted(map(repr, map(tuple, got.collect()))) == brute_prints(docs, spark)


@pytest.mark.parametrize("name", ["op11_structure_repair", "op12_merkle_manifest"])
def test_structures_agree_with_sql(spark, sf, duck, name):
    got = queries.QUERIES[name](spark, sf)
    columns, want = duck(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == columns
    assert rows(got) == want
