"""Token ids of whole texts by a public tokenizer, with a cache of white-space-delimited chunks.

The pre-tokenizers of both vocabularies never join what stands before a space or newline with the word after it. So a
text is cut before each space or newline that a visible character follows, each distinct chunk is encoded once by the
tokenizers library, and the ids of the text are those of its chunks in order. Chunks where this cut would not be safe
(further white space follows) are joined to the chunk before them. A vocabulary whose normalizer drops white space and
lower-cases is cut at all white space, in lower-case ASCII. Both also part a word of letters from the punctuation after it.
Arrow cuts a batch of texts, numbers its distinct chunks and puts their ids together; Python sees each of them once a batch.

A vocabulary's control strings ("<|endoftext|>") in a text become their ids, as the library's own call with its defaults
gives them; the text is parted at them first, as the library does. With ``control=False`` they are text like any other.
"""

import os
import re
import unicodedata
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept

SAFE_LENGTH = 80
#: Texts that are encoded together: as many characters, and rows.
BATCH_CHARS, BATCH_ROWS = 4_000_000, 4096
TOGETHER = 200
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: White space to Python but not to the tokenizers.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """encode(texts) returns for each text its ids as little-endian unsigned 32-bit integers.

    Two generations of at most ``limit`` chunks are kept; when the young one is full it becomes the old one.
    """

    def __init__(self, path: str, limit: int = 400_000, control: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder().items() if control else []
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for _, t in added):
            raise ValueError("control strings that depend on the text around them")
        self.controls = {t.content: np.array([i], dtype="<u4").tobytes() for i, t in added}
        self.control = re.compile("(" + "|".join(map(re.escape, sorted(self.controls, key=len, reverse=True))) + ")") if added else None
        names = sorted((i, t) for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items())
        self.lengths = np.zeros(names[-1][0] + 1, dtype=np.int64)  # bytes that each id stands for
        self.lengths[[i for i, _ in names]] = [len(t) - 4 * t.endswith("</w>") for _, t in names]
        self.normal = self.tokenizer.normalizer is not None
        self.stops: dict = {}
        self.young: dict = {}
        self.old: dict = {}
        self.limit = limit

    def _one_by_one(self, chunks: list) -> list:
        got = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in got]

    def _bytes(self, chunk: str) -> int:
        """Bytes of a chunk that its ids stand for."""
        if chunk.isascii():
            return len(chunk)
        return len((unicodedata.normalize("NFC", chunk).lower() if self.normal else chunk).encode())

    def _ids(self, chunks: list) -> list:
        """Ids of new chunks: many are encoded as one text and parted again where their bytes end."""
        alone = [] if self.normal else [c for c in chunks if c[:1] not in (" ", "\n")]
        found = dict(zip(alone, self._one_by_one(alone)))
        rest = [c for c in chunks if c not in found]
        groups = [rest[k : k + TOGETHER] for k in range(0, len(rest), TOGETHER)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(list(map((" " if self.normal else "").join, groups)), add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            ends = np.cumsum(self.lengths[ids])
            want = np.cumsum(np.fromiter(map(self._bytes, group), dtype=np.int64, count=len(group)))
            at = np.searchsorted(ends, want) + 1
            if len(ids) and at[-1] == len(ids) and np.array_equal(ends[at - 1], want):
                raw, cut = ids.tobytes(), [0, *(4 * at).tolist()]
                found.update((c, raw[x:y]) for c, x, y in zip(group, cut, cut[1:]))
            else:
                found.update(zip(group, self._one_by_one(group)))
        return [found[c] for c in chunks]

    def _letters(self, word: str) -> bool:
        return word.isalpha() and (word.isascii() or not self.normal or unicodedata.normalize("NFC", word).lower().isalpha())

    def _unsafe(self, chunk: str) -> bool:
        return not self.normal and chunk[:1] in (" ", "\n") and (len(chunk) == 1 or chunk[1].isspace())

    def _merged(self, pieces: list) -> list:
        out = [pieces[0]]
        for p in pieces[1:]:
            if self._unsafe(p):
                out[-1] += p
            else:
                out.append(p)
        return out

    def _learn(self, missing: list) -> None:
        """Have the ids of distinct chunks that aren't among the young there; None where a chunk has to be joined to the one before."""
        young, whole, new = self.young, [], []
        if self.old:
            found = list(map(self.old.get, missing))
            young.update([(w, x) for w, x in zip(missing, found) if x is not None])
            missing = [w for w, x in zip(missing, found) if x is None]
        if not self.normal:
            unsafe = set(filter(self._unsafe, missing))
            young.update(dict.fromkeys(unsafe))
            missing = [w for w in missing if w not in unsafe] if unsafe else missing
        for w in missing:
            stem = w.rstrip(punctuation) if w[-1:] in punctuation else w
            if len(w) - len(stem) in (1, 2, 3) and self._letters(stem.lstrip(" \n")):
                whole.append((w, stem, w[len(stem) :]))
            else:
                new.append(w)
        stems = {stem for _, stem, _ in whole}.difference(young)
        for w in (w for w in stems if w in self.old):
            young[w] = self.old[w]
        new += stems.difference(young, new)
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            young.update(zip(part, self._ids(part)))
        stops = list({stop for _, _, stop in whole}.difference(self.stops))
        self.stops.update(zip(stops, self._one_by_one(stops)))
        young.update([(w, young[stem] + self.stops[stop]) for w, stem, stop in whole])

    def _known(self, chunks: list) -> list:
        """The ids of distinct chunks, or None."""
        got = list(map(self.young.get, chunks))
        if missing := [w for w, x in zip(chunks, got) if x is None]:
            self._learn(missing)
            learned = map(self.young.__getitem__, missing)
            got = [next(learned) if x is None else x for x in got]
            self._forget(missing)
        return got

    def _forget(self, learned: list) -> None:
        """Keep no long chunks, and no more than the limit."""
        for w in learned:
            if len(w) > SAFE_LENGTH:
                self.young.pop(w, None)
                self.young.pop(w.rstrip(punctuation), None)
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}

    def encode(self, texts: list) -> list:
        parts = [self.control.split(t) if any(c in t for c in self.controls) else [t] for t in texts]
        if len(parts) == sum(map(len, parts)):
            return self._plain(texts)
        got = iter(self._plain([p for pieces in parts for p in pieces[::2]]))
        return [b"".join(self.controls[p] if k % 2 else next(got) for k, p in enumerate(pieces)) for pieces in parts]

    def _plain(self, texts: list) -> list:
        """The ids of texts without control strings."""
        return [x for a, b in batches(list(map(len, texts))) for x in self._encode(texts[a:b])]

    def _cut(self, texts: list) -> pa.ListArray:
        """The chunks of each text."""
        if self.normal:
            lower = pa.array([t.encode("utf-8", "replace").translate(LOWER) for t in texts], pa.large_binary())
            return pc.utf8_split_whitespace(lower.view(pa.large_string()))
        marked = pc.replace_substring(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", "\0\n"), " ", "\0 ")
        return pc.split_pattern(marked, "\0")

    def _encode(self, texts: list) -> list:
        odd = {k for k, t in enumerate(texts) if any(c in t for c in (SEPARATORS if self.normal else "\0"))}
        cut = self._cut(["" if k in odd else t for k, t in enumerate(texts)] if odd else texts)
        coded = cut.values.dictionary_encode()
        known = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(known, pa.large_binary()).take(coded.indices)
        out = pc.binary_join(pa.ListArray.from_arrays(cut.offsets, ids), pa.scalar(b"", pa.large_binary())).to_pylist()
        for k in odd:
            out[k] = self._one_by_one([texts[k]])[0]
        for k in (k for k, x in enumerate(out) if x is None):  # some chunks have to be joined
            pieces = self._merged(cut[k].as_py())
            whole = [self._one_by_one(pieces[:1])[0]] if self._unsafe(pieces[0]) else []  # white space that the text begins with
            rest = pieces[len(whole) :]
            distinct = list(dict.fromkeys(rest))
            out[k] = b"".join([*whole, *map(dict(zip(distinct, self._known(distinct))).__getitem__, rest)])
        return out


def batches(lengths: list) -> list:
    """Where batches of texts of these lengths begin and end: of BATCH_ROWS texts and BATCH_CHARS characters at most, or one text."""
    out, begin, n = [], 0, 0
    for k, m in enumerate(lengths):
        if k > begin and (n + m > BATCH_CHARS or k - begin == BATCH_ROWS):
            out.append((begin, k))
            begin, n = k, 0
        n += m
    return [*out, (begin, len(lengths))] if lengths else []


def encoder(path: str, control: bool = True) -> ChunkEncoder:
    """One encoder in a Python worker, kept over its tasks."""
    return kept(("encoder", path, control), lambda: ChunkEncoder(path, control=control))
