"""Operator 4: personal data by patterns and a skip-chain conditional random field.

Base spans (email, ip, card, phone) are the leftmost matches of four fixed patterns that pass their checks. The field
adds spans for mentions that the patterns miss: a telephone number without its plus, an address with "(at)", a card in
groups of its own, and a further kind, secret (access tokens, keys and passwords of letters and digits).

A document's nodes are its mentions: words with a digit or an at sign, neighbouring pieces of one number joined. Each
node has features of its shape, of its neighbours' shapes, of how it is set (in quotes, after a name and a sign, how mixed
its characters are) and of the words before it. Nodes next to each other are
linked in a chain, and mentions with the same last digits or the same spelling are linked to the next such mention however
far away it is; these skip links share one table of potentials, so what one mention's surroundings say holds for all of
them. Nodes on base spans are observed. Loopy sum-product message passing gives each node's label; a label of a node
that no base span touches becomes a span if its probability is at least ``certain``.

Node, chain and skip weights are trained together by gradient steps on the likelihood of documents generated here
(TRAINING of them, with a fixed seed), whose expected counts come from the same message passing, over all documents
as one graph. Whole texts are read; patterns and mentions take time in proportion to a text's length. A null text is
empty; a null doc_id stays null; equal rows give equal results; an empty table gives no rows. All columns but doc_id and
text are ignored.
"""

import functools
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_schema, texts

KINDS = ["email", "ip", "card", "phone", "secret"]
LABELS = ["none", *KINDS]
TRAINING, STEPS, ROUNDS, DAMPING = 1500, 160, 20, 0.3
OBSERVED = 12.0
#: Letters of a mention beyond which its skip link by spelling needs no digits, and digits that make one by digits.
SAME_DIGITS = 7

#: The contract's patterns; the first parts are written so that no start is tried twice within a run.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SOME = re.compile(r"[0-9@]|[\[(]at[\])]")
WORD = re.compile(r"\S+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NUMERIC = re.compile(r"[+(]?[0-9][0-9().+/-]*\Z")
AT = re.compile(r"[\[(]at[\])]|@", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list:
    """(kind, start, end) of the patterns' matches, in order of kind and start."""
    out, at, past = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > past and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
        past = m.end() if m else at + 1
        at = text.find("@", past)
    for m in IP.finditer(text):
        if all(len(q := p.lstrip("0")) <= 3 and int(q or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 40 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def mentions(text: str) -> list:
    """(start, end) of the nodes: words with a digit or at sign without outer punctuation, pieces of one number joined."""
    out: list = []
    for m in WORD.finditer(text):
        w = m[0]
        if not SOME.search(w):
            continue
        core = w.strip(",;:!?\"'<>{}*#$&|=")
        if core.endswith("."):
            core = core.rstrip(".")
        if core.startswith("(") and ")" not in core or core.startswith("["):
            core = core[1:] if "at]" not in core[:4] else core
        core = core[:-1] if core.endswith(")") and "(" not in core or core.endswith("]") else core
        if not core or not SOME.search(core):
            continue
        start = m.start() + w.index(core)
        end = start + len(core)
        if out and NUMERIC.match(core) and start - out[-1][1] == 1 and NUMERIC.match(text[out[-1][0] : out[-1][1]].replace(" ", "")):
            before = text[out[-1][0] : out[-1][1]]
            if before.count(".") < 3 and core.count(".") < 3 and len(digits_of(before)) + len(digits_of(core)) <= 19:
                out[-1] = (out[-1][0], end)
                continue
        out.append((start, end))
    return out


#: Words that tell a kind when they stand before a mention, by kind; the last are those of other numbers.
CUES = {
    "email": "email mail e-mail contact write reach inbox correo courriel",
    "ip": "ip host server addr address ping node gateway from",
    "card": "card visa mastercard amex credit debit pan tarjeta karte carte",
    "phone": "phone tel telephone call mobile cell fax sms whatsapp ring dial telefon telefono",
    "secret": "token key secret password passwd pwd apikey api_key auth bearer credential access_key private",
    "other": "order invoice version page id no number year isbn sku ref commit sha hash build total price checksum md5 case part room since in",
}
CUE = {w: k for k, words in enumerate(CUES.values()) for w in words.split()}
LAST_WORDS = re.compile(r"[^\W\d]+(?:[_-][^\W\d]+)*")


def shape(s: str) -> list:
    """Features of one mention."""
    digits = digits_of(s)
    n, dots, parts = len(digits), s.count("."), s.split(".")
    bucket = next(k for k, most in enumerate((0, 2, 4, 6, 7, 9, 11, 12, 19, 1 << 62)) if n <= most)
    letters = sum(map(str.isalpha, s))
    groups = [len(g) for g in re.findall("[0-9]+", s)]
    at = AT.search(s)
    core = re.sub(r"^.*[=:]", "", s)
    mixed = bool(re.fullmatch(r"[A-Za-z0-9_+/-]+", core)) and letters > 0 and n > 1
    return [
        *(float(k == bucket) for k in range(10)), float("@" in s), float(bool(at)), float(bool(at) and "." in s[at.end() :] if at else 0), float(s.startswith("+")), float("(" in s and n > 3),
        float(s.count("-") == 1), float(s.count("-") >= 2), *(float(min(dots, 4) == k) for k in range(5)), float(letters == 0), float(letters > 3), float("/" in s), float("=" in s or ":" in s),
        float(len(groups) == 4 and not letters and all(g.isdigit() and len(g) < 4 and int(g) < 256 for g in re.findall("[0-9]+", s))), float(13 <= n <= 19 and not letters and luhn(digits)),
        float(groups[-2:] == [3, 4]), float(groups[-3:] == [3, 3, 4]), float(len(groups) == 4 and set(groups) == {4}), float(len(groups) == 1), float(len(groups) == 3 and groups[0] == 4), float(len(parts) == 4 and dots == 3 and not letters),
        float(mixed and 8 <= len(core) < 16), float(mixed and 16 <= len(core) < 32), float(mixed and len(core) >= 32), float(mixed and bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", core))), float(mixed and any(map(str.isupper, core)) and any(map(str.islower, core))),
        float(mixed and bool(re.match(r"[A-Za-z]+[0-9]+$|[0-9]+[A-Za-z]+$", core))),
    ]


def cues(text: str, start: int, end: int) -> list:
    """Which kinds of words stand in the 40 characters before a mention (the last four count), and in it before an equals sign."""
    found = [0.0] * len(CUES)
    words = LAST_WORDS.findall(text[max(0, start - 40) : start].lower())[-4:]
    words += re.split("[=:]", text[start:end].lower())[:-1]
    for w in words:
        for part in {w, *w.split("_")}:
            if part in CUE:
                found[CUE[part]] = 1.0
    return found


ASSIGNED = re.compile(r"[^\W\d]\s{0,2}[=:]\s{0,2}[\"']?\Z")


def setting(text: str, start: int, end: int) -> list:
    """What a mention looks like as a value: in quotes, after a name and a sign, both; and how mixed its characters are."""
    quoted = text[start - 1 : start] in ("'", '"') and text[end : end + 1] == text[start - 1 : start]
    assigned = bool(ASSIGNED.search(text, max(0, start - 6), start)) or "=" in text[start:end]
    core = re.sub(r"^.*[=:]", "", text[start:end]).strip("\"'")
    share = np.unique(np.frombuffer(core.encode(), np.uint8), return_counts=True)[1] / max(1, len(core.encode()))
    mixed = float(-(share * np.log2(share)).sum()) if len(core) >= 12 and any(map(str.isalpha, core)) and any(map(str.isdigit, core)) else 0.0
    return [float(quoted), float(assigned), float(quoted and assigned), *(float(mixed >= b) for b in (2.5, 3.0, 3.4, 3.8)), float(assigned and mixed >= 3.0), float(quoted and assigned and mixed >= 3.0)]


def nodes_of(text: str, spans: list) -> np.ndarray:
    """Features of each mention: its shape, setting and cues, the number of digits of those before and after it, and a constant."""
    own = np.array([shape(text[s:e]) + setting(text, s, e) for s, e in spans])
    said = np.array([cues(text, s, e) for s, e in spans])
    blank = np.zeros((1, 10))
    return np.hstack([own, said, np.vstack([blank, own[:-1, :10]]), np.vstack([own[1:, :10], blank]), np.ones((len(own), 1))])


def skip_links(text: str, spans: list) -> list:
    """Pairs of mentions alike in their last digits or spelling, each with the next such one."""
    last: dict = {}
    links = set()
    for k, (s, e) in enumerate(spans):
        word = text[s:e]
        digits = digits_of(word)
        keys = [("s", AT.sub("@", re.sub(r"^.*[=:]", "", word)).strip("\"'").lower())]
        if len(digits) >= SAME_DIGITS and not AT.search(word) and not any(map(str.isalpha, word)):
            keys += [("d", digits[-SAME_DIGITS:]), ("f", digits)]
        for key in keys:
            if key in last:
                links.add((last[key], k))
            last[key] = k
    return sorted(links)


def chain_links(spans: list) -> list:
    """Neighbouring mentions, unless they are far apart."""
    return [(i, i + 1) for i in range(len(spans) - 1) if spans[i + 1][0] - spans[i][1] <= 80]


class Graph:
    """Nodes with chain and skip links, and messages along them in both directions."""

    def __init__(self, n: int, chain: list, skip: list):
        self.n, self.chains = n, len(chain)
        edges = np.array([*chain, *skip], dtype=np.int64).reshape(-1, 2)
        self.a, self.b = edges[:, 0], edges[:, 1]
        self.to, self.source = np.concatenate([self.b, self.a]), np.concatenate([self.a, self.b])
        self.m = np.full((2 * len(edges), len(LABELS)), -np.log(len(LABELS)))

    def _along(self, out: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> np.ndarray:
        c, e = self.chains, len(self.a)
        p = np.exp(out - out.max(axis=1, keepdims=True))
        return np.concatenate([p[:c] @ chain, p[c:e] @ skip, p[e : e + c] @ chain.T, p[e + c :] @ skip.T])

    def into(self, unary: np.ndarray) -> np.ndarray:
        """Unary scores with all messages that come in."""
        total = unary.copy()
        for k in range(unary.shape[1]):
            total[:, k] += np.bincount(self.to, self.m[:, k], self.n)
        return total

    def back(self) -> np.ndarray:
        e = len(self.a)
        return np.concatenate([self.m[e:], self.m[:e]])

    def passed(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray, rounds: int) -> np.ndarray:
        """The nodes' scores after some rounds of sum-product messages, which go on from those of the last call."""
        grown = np.exp(chain), np.exp(skip)
        for _ in range(rounds if len(self.to) else 0):
            new = np.log(self._along(self.into(unary)[self.source] - self.back(), *grown))
            new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
            new = DAMPING * self.m + (1 - DAMPING) * new
            done = np.abs(new - self.m).max() < 1e-5
            self.m = new
            if done:
                break
        return self.into(unary)

    def pairs(self, total: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected counts of label pairs over chain links and over skip links."""
        e = len(self.a)
        p, q = _softmax(total[self.a] - self.m[e:]) if e else np.zeros((0, len(LABELS))), _softmax(total[self.b] - self.m[:e]) if e else np.zeros((0, len(LABELS)))
        out = []
        for part, table in ((slice(0, self.chains), np.exp(chain)), (slice(self.chains, e), np.exp(skip))):
            x, y = p[part], q[part]
            whole = np.einsum("ei,ij,ej->e", x, table, y)
            out.append(table * ((x / whole[:, None]).T @ y))
        return out[0], out[1]


class Field:
    """A trained skip-chain field: node weights, chain and skip potentials."""

    def __init__(self, weights: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.weights, self.chain, self.skip = weights, chain, skip

    def marginals(self, text: str, spans: list, observed: dict) -> np.ndarray:
        """Label probabilities of each mention by loopy message passing."""
        unary = nodes_of(text, spans) @ self.weights
        for i, label in observed.items():
            unary[i, label] += OBSERVED
        return _softmax(Graph(len(spans), chain_links(spans), skip_links(text, spans)).passed(unary, self.chain, self.skip, ROUNDS))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _made_document(rng: random.Random) -> tuple:
    """A generated text with the labels of its mentions: entities in plain and unusual forms, with and without words that tell, and other numbers."""
    pick, num = rng.choice, lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("aeinorstlu") for _ in range(rng.randint(2, 9)))
    some = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    hexes, mixed = "0123456789abcdef", "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789"

    def card() -> str:
        head = pick("3456") + num(14)
        return next(head + c for c in "0123456789" if luhn(head + c))

    def entity(kind: int) -> list:
        if kind == 1:
            user, host = f"{word()}{pick(['.', '_', ''])}{num(rng.randint(0, 3))}", f"{word()}.{pick(['com', 'org', 'example.net'])}"
            return [f"{user}@{host}", f"{user}(at){host}", f"{user}[at]{host}"]
        if kind == 2:
            return [".".join(parts := [str(rng.randint(0, 255)) for _ in range(4)]), "-".join(parts), " ".join(["", ":".join([".".join(parts), "80"])]).strip()]
        if kind == 3:
            c = card()
            return [c, f"{c[:4]} {c[4:8]} {c[8:12]} {c[12:]}", ".".join(c[k : k + 4] for k in range(0, 16, 4)), "/".join(c[k : k + 4] for k in range(0, 16, 4))]
        if kind == 4:
            a, b, c = num(3), num(3), num(4)
            return [f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"{a}{b}{c}", f"1{a}{b}{c}"]
        made = pick([some(hexes, 40), some(hexes, 32), some(mixed, rng.randint(16, 44)), pick(["sk-", "ghp_", "AK"]) + some(mixed, rng.randint(16, 36))])
        name = pick([word(), word(), f"{word()}_{word()}", word().upper(), pick(CUES["secret"].split())])
        return [made, f'"{made}"', f"{name}={made}", f'{name} = "{made}"', f"{name}: '{made}'", f'{name}="{made}"'] if any(c.isdigit() for c in made) else entity(5)

    def other() -> tuple:
        plain = [
            num(rng.randint(1, 6)), f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{rng.randint(0, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}", f"{num(2)}:{num(2)}", f"{word().upper()}{num(4)}{word().upper()}",
            f"{num(3)}.{num(2)}", f"{num(2)}/{num(2)}/{num(4)}", f"@{word()}", f"{word()}{num(2)}", f"({num(4)})", f"{num(4)}-{num(4)}", f"+{num(2)}%", f"{word()}={num(4)}",
            f'{word()} = "{word()}{num(2)}"', f"{word()} = {num(rng.randint(1, 9))}", f'{word()}: "{num(4)}-{num(2)}-{num(2)}"', f'{word()} = "{some(hexes, 6)}"', f"{word()}: {num(3)}.{num(2)}", f'{word()} = "{num(rng.randint(4, 12))}"',
            f'{pick(["sha", "commit", "md5", "checksum", "hash", "ref"])}{pick([" = ", ": ", "="])}{some(hexes, pick([32, 40]))}', f'{pick(["sha", "commit", "md5", "checksum", "hash"])} = "{some(hexes, pick([32, 40]))}"',
        ]
        long = [num(rng.randint(7, 12)), num(10), num(rng.randint(14, 18)), some(hexes, 40), some(hexes, 32), some(mixed, rng.randint(8, 14))]
        if rng.random() < 0.6:
            return pick(plain), ""
        return pick(long), pick([*CUES["other"].split(), "", "", word()])

    pieces: list = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.randint(0, 5)
        if kind == 0:
            form, cue = other()
            pieces += [(cue, form, 0)] * rng.randint(1, 2)
            continue
        forms, told = entity(kind), pick([0.3, 0.7])
        for _ in range(rng.randint(1, 3)):
            cue = pick(CUES[KINDS[kind - 1]].split()) if rng.random() < told else ""
            pieces.append((cue and cue + pick(["", ":", " is", " =", " no"]), pick(forms), kind))
    rng.shuffle(pieces)
    text, marks = "", []
    for cue, form, kind in pieces:
        text += " ".join(word() for _ in range(rng.randint(1, 12))) + " " + (cue + " " if cue else "")
        marks.append((len(text), len(text) + len(form), kind))
        text += form + pick(["", ".", ","]) + " "
    spans = mentions(text)
    return text, spans, [next((k for s, e, k in marks if s < b and a < e), 0) for a, b in spans]


def observed_in(spans: list, base: list) -> dict:
    """The label of each mention that a base span touches."""
    order, observed, k = sorted((s, e, kind) for kind, s, e in base), {}, 0
    for i, (s, e) in enumerate(spans):
        while k < len(order) and order[k][1] <= s:
            k += 1
        for j in range(k, len(order)):
            if order[j][0] >= e:
                break
            observed[i] = order[j][2] + 1
    return observed


def train(documents: int = TRAINING, seed: int = 7, steps: int = STEPS) -> Field:
    """Fit all weights together on generated documents."""
    rng, k = random.Random(seed), len(LABELS)
    xs, ys, chain, skip, clamp, at = [], [], [], [], [], 0
    for _ in range(documents):
        text, spans, labels = _made_document(rng)
        if not spans:
            continue
        known = observed_in(spans, base_spans(text))
        labels = [known.get(i, y) for i, y in enumerate(labels)]
        xs.append(nodes_of(text, spans))
        ys += labels
        clamp += [OBSERVED * (i in known) for i in range(len(spans))]
        chain += [(at + a, at + b) for a, b in chain_links(spans)]
        skip += [(at + a, at + b) for a, b in skip_links(text, spans)]
        at += len(spans)
    x, y = np.vstack(xs), np.eye(k)[ys]
    held, graph = y * np.array(clamp)[:, None], Graph(at, chain, skip)
    seen = [y[graph.a[part]].T @ y[graph.b[part]] for part in (slice(0, graph.chains), slice(graph.chains, None))]
    params = [np.zeros((x.shape[1], k)), np.zeros((k, k)), np.zeros((k, k))]
    speed = [np.zeros_like(p) for p in params]
    for _ in range(steps):
        w, c, s = params
        total = graph.passed(x @ w + held, c, s, 2)
        near, far = graph.pairs(total, c, s)
        far, told = (far + far.T) / 2, (seen[1] + seen[1].T) / 2
        slopes = [x.T @ (y - _softmax(total)) / at, (seen[0] - near) / at, (told - far) / at]
        for p, v, slope, pull, rate in zip(params, speed, slopes, (2e-4, 1e-4, 1e-4), (0.5, 2.0, 4.0)):
            v *= 0.9
            v += rate * (slope - pull * p)
            p += v
    return Field(*params)


@functools.cache
def trained() -> Field:
    """The field with all its settings as they are, fitted once in a program."""
    return train()


def find(text: str, field: Field, certain: float = 0.9) -> tuple[list, list]:
    """Base spans, and the spans that the field adds."""
    if not SOME.search(text):
        return [], []
    base = base_spans(text)
    spans = mentions(text)
    if not spans:
        return base, []
    observed = observed_in(spans, base)
    if len(observed) == len(spans):
        return base, []
    p = field.marginals(text, spans, observed)
    best = p.argmax(axis=1)
    return base, [(int(best[i]) - 1, *_trimmed(text, s, e, int(best[i]) - 1)) for i, (s, e) in enumerate(spans) if i not in observed and best[i] and p[i, best[i]] >= certain]


def _trimmed(text: str, start: int, end: int, kind: int) -> tuple[int, int]:
    """A secret's span without the name before it and without quotes."""
    if KINDS[kind] == "secret":
        start += len(re.match(r"(?:[A-Za-z_-]+[=:])?[\"']?", text[start:end])[0])
        while end > start + 1 and text[end - 1] in "\"'":
            end -= 1
    return start, end


def told(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def private_data(docs: DataFrame, certain: float = 0.9) -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans of every document."""
    ddl = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    schema = arrow_schema(ddl)
    shared = docs.sparkSession.sparkContext.broadcast(trained())

    def run(batches):
        field = shared.value
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part, rows = b.slice(k, 512), []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    base, added = find(text, field, certain)
                    kinds = [x[0] for x in base]
                    rows.append((doc_id, *(kinds.count(k) for k in range(4)), hashlib.sha256(told(base).encode()).hexdigest(), told(base + added), len(added)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return texts(docs).mapInArrow(run, ddl)
