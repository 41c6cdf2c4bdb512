"""Operators 4, 5, 6, 9 and 10."""

import hashlib
import html
import itertools
import random
import re

import numpy as np
import pytest

from lineara.llm import chat, language, main_text, private_data, quality, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: "".join(c for c in m[0] if c in "0123456789")
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and private_data.luhn(digits(m))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


@pytest.fixture(scope="module")
def field():
    return private_data.train()


def test_base_spans(spark, sf):
    rng = random.Random(9)
    parts = ["1", "22", "333", "255", ".", ".", "@", "@", "a", "b-", "+", "-", " ", "(", ")", "%", "4111111111111111", "a@b.c", "10.0.0.1", "+1 (988) 555-2485", "_", "é", "٣", "-."]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert private_data.base_spans(text) == plain(text)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in queries.op4_private_data(spark, sf).collect()}
    for r in docs.collect():
        base = plain(r.text)
        told = ",".join(f"{private_data.KINDS[k]}:{s}:{e}" for k, s, e in sorted(base))
        row = got[r.doc_id]
        assert row.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == x for k, _, _ in base) for x in range(4)]
        assert set(told.split(",")) <= set(row.spans.split(","))


def test_patterns_are_linear(field):
    import time

    for made in ("1", "a", "1.", "a@", "+1", "x1", "1 ", "a1=", "4111111111111111 ", "a(at)b.c "):
        took = []
        for n in (20_000, 80_000):
            begin = time.process_time()
            private_data.find(made * n, field)
            took.append(time.process_time() - begin)
        assert took[1] < 12 * took[0] + 0.5, made


def marginals_by_hand(unary, chain, skip, near, far):
    """Label probabilities from the sum over all labellings."""
    n, k = unary.shape
    out = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        score = sum(unary[i, y] for i, y in enumerate(labels)) + sum(chain[labels[a], labels[b]] for a, b in near) + sum(skip[labels[a], labels[b]] for a, b in far)
        for i, y in enumerate(labels):
            out[i, y] += np.exp(score)
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("near,far,most", [([(0, 1), (1, 2), (2, 3)], [], 1e-4), ([(0, 1)], [(1, 3), (1, 2)], 1e-4), ([(0, 1), (1, 2), (2, 3)], [(0, 3), (1, 3)], 0.1)])
def test_messages_give_marginals(near, far, most):
    rng, k = np.random.default_rng(3), len(private_data.LABELS)
    for _ in range(4):
        unary, chain, skip = rng.normal(0, 1.5, (4, k)), rng.normal(0, 0.6, (k, k)), rng.normal(0, 0.6, (k, k))
        skip = (skip + skip.T) / 2
        got = private_data._softmax(private_data.Graph(4, near, far).passed(unary, chain, skip, 300))
        assert np.abs(got - marginals_by_hand(unary, chain, skip, near, far)).max() < most


#: Written by hand, in other words and forms than those of training; spans that the patterns miss stand in double brackets.
BY_HAND = [
    "For questions dial [[phone:(212) 555-0187]] between 9 and 5. After hours use [[phone:2125550187]] as well; ticket 48213 is closed.",
    "Our office line is +1 (415) 555-0134. Staff know it as [[phone:4155550134]] and it has been in use since 2019.",
    "Write to [[email:jane.doe(at)example.org]] or, if that bounces, to jane.doe@example.org. Room 114, floor 3.",
    "mail: [[email:support[at]shop.example.com]] -- order 9981273 shipped 2021-11-03",
    'export API_KEY=[[secret:9f86d081884c7d659a2feaa0c55ad015]] before you run version 2.4.1 of the client.',
    'The password = "[[secret:Xk29fLq81MzPw0Rt6Yc4]]" was committed in build 5521.',
    "Two years later the same string [[secret:Xk29fLq81MzPw0Rt6Yc4]] turned up: secret [[secret:Xk29fLq81MzPw0Rt6Yc4]], page 12.",
    "Charge card [[card:4111.1111.1111.1111]] for 25.00 today; the receipt of 4111 1111 1111 1111 is number 77120.",
    "We took the amex [[card:3782/8224/6310/0051]] on 14/02/2020.",
    "Commit 1b4f0e9851971998e732078544c96b36c3d01ced fixed issue 381 in 2018.",
    "The file has sha 60303ae22b998861bce3b28f33eec1be758a213c and size 10482.",
    "In 1987 some 23000 people lived there, 3.5 percent of them over 90.",
    "ISBN 9783161484100, page 211, price 19.99, order 5566778.",
    "Meet at 10:30 in room 204, bring form 1099 and 12 copies.",
    "Her mobile: [[phone:646-555-0172]]. She said that 646-555-0172x is wrong and that [[phone:6465550172]] is right.",
    "call [[phone:1-800-555-0199]] now and quote reference 20233381",
    "bearer [[secret:ghp_16C7e42F292c6912E7710c838347Ae178B4a]] expires in 30 days",
    "login root, auth [[secret:c3ab8ff13720e8ad9047dd39466b3c89]] and host 10.12.0.7; c3 and 8ff are bays",
    "Later in the log, with no word about it: [[secret:c3ab8ff13720e8ad9047dd39466b3c89]] again, and the auth [[secret:c3ab8ff13720e8ad9047dd39466b3c89]] once more.",
    "v1.2.3, v1.2.4 and 2.0.0 differ in 14 of 1024 bytes (1.4%).",
    "Seats 12-14, rows 20-25, gates B7 and C12, flight XY1234, 18:45.",
    "checksum d41d8cd98f00b204e9800998ecf8427e of part 7, total 1000000",
    "Reached him on tel [[phone:303.555.0145]]; the number [[phone:303.555.0145]] was [[phone:3035550145]] on his card.",
    "Gateway 192.168.4.20 answers, the copy in the sheet says [[ip:192-168-4-20]] and port 8080.",
]


def by_hand(field):
    """(wanted, found) sets of added spans over all texts, as (text, kind, start, end)."""
    wanted, found = set(), set()
    for n, marked in enumerate(BY_HAND):
        text, at = "", 0
        for m in re.finditer(r"\[\[(\w+):(.*?)\]\](?!\])", marked):
            text += marked[at : m.start()]
            wanted.add((n, m[1], len(text), len(text) + len(m[2])))
            text, at = text + m[2], m.end()
        text += marked[at:]
        found |= {(n, private_data.KINDS[k], s, e) for k, s, e in private_data.find(text, field)[1]}
    return wanted, found


def test_spans_of_texts_written_by_hand(field):
    wanted, found = by_hand(field)
    alone = by_hand(private_data.Field(field.weights, field.chain, 0 * field.skip))[1]
    by_skip = (found & wanted) - alone
    print("recall", len(wanted & found) / len(wanted), "precision", len(wanted & found) / len(found), "by skip links", len(by_skip) / len(found & wanted), wanted - found, found - wanted)
    assert len(wanted & found) >= 0.9 * len(wanted) and len(wanted & found) >= 0.9 * len(found)
    assert len(by_skip) >= 4


def test_secrets_of_the_documents(field):
    import duckdb

    for doc_id, text in duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall():
        tokens = {m.span(1) for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', text)}
        assert {(s, e) for k, s, e in private_data.find(text, field)[1] if private_data.KINDS[k] == "secret"} == tokens, doc_id


@pytest.mark.parametrize("name", ["value", "nonce", "session", "tok"])
def test_secrets_behind_names_that_no_list_has(field, name):
    """What stands after a name and a sign is told by how it is set and how mixed it is."""
    import duckdb

    assert not any(name in words.split() for words in private_data.CUES.values())
    hit, n, other = 0, 0, 0
    for (text,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet' WHERE regexp_matches(text, '(?i)token = \"[0-9a-f]{40}\"')").fetchall():
        text = re.sub(r'(?i)\btoken = "', name + ' = "', text)
        want = {m.span(1) for m in re.finditer(rf'\b{name} = "([0-9a-fA-F]{{40}})"', text)}
        found = {(s, e) for k, s, e in private_data.find(text, field)[1] if private_data.KINDS[k] == "secret"}
        hit, n, other = hit + len(want & found), n + len(want), other + len(found - want)
    assert n > 100 and hit >= 0.85 * n and other == 0


def test_values_that_are_no_secrets(field):
    text = 'color = "ff00aa" and width = 1200, date: "2024-10-11", name = "report12", sha = "60303ae22b998861bce3b28f33eec1be758a213c", size: 10482'
    assert private_data.find(text, field)[1] == []


def test_training_is_done_once(monkeypatch):
    calls = []
    private_data.trained.cache_clear()
    monkeypatch.setattr(private_data, "train", lambda: calls.append(1) or "field")
    assert private_data.trained() == private_data.trained() == "field" and calls == [1]
    private_data.trained.cache_clear()


def test_private_data_of_repeated_rows_with_spans(spark):
    text = "mail bob.1@x.com from 10.0.0.1, token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\""
    df = spark.createDataFrame([(1, text, 5, "x")] * 3 + [(None, text, 5, "y")], "doc_id long, text string, n_email int, spans string")
    got = {tuple(r)[1:] for r in private_data.private_data(df).collect()}
    assert len(got) == 1 and next(iter(got))[:2] == (1, 1) and "secret:" in next(iter(got))[5]
    assert sum(r.doc_id is None for r in private_data.private_data(df).collect()) == 1


def test_skip_links_carry_labels(field):
    text = "call +1 (988) 555-2485 today, later 9885552485 and bob.1@x.com or bob.1(at)x.com, in 2024 some 1234567 rows"
    base, added = private_data.find(text, field)
    assert [text[s:e] for _, s, e in base] == ["bob.1@x.com", "+1 (988) 555-2485"]
    assert {(private_data.KINDS[k], text[s:e]) for k, s, e in added} == {("phone", "9885552485"), ("email", "bob.1(at)x.com")}
    assert private_data.find("nothing but 9885552485 here", field)[1] == []


def test_field_on_unseen_documents(field):
    rng, right, n, clean = random.Random(99), 0, 0, 0
    for _ in range(200):
        text, spans, labels = private_data._made_document(rng)
        if spans:
            known = private_data.observed_in(spans, private_data.base_spans(text))
            best = field.marginals(text, spans, known).argmax(axis=1)
            right, n = right + sum(int(best[i]) == y for i, y in enumerate(labels) if i not in known), n + len(labels) - len(known)
    assert right / n > 0.97
    for _ in range(100):
        words = " ".join(rng.choice(["in", "2024", "about", "12", "people", "paid", "3.50", "for", "v1.2.3", "at", "10:30"]) for _ in range(60))
        clean += len(private_data.find(words, field)[1])
    assert clean <= 2


def test_private_data_of_odd_rows(odd, none):
    got = private_data.private_data(odd).collect()
    assert len(got) == 8 and all((r.n_email, r.n_ip, r.n_card, r.n_phone, r.spans) == (0, 0, 0, 0, "") for r in got)
    assert sorted(r.doc_id is None for r in got)[-1] and private_data.private_data(none).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) x="</p>";</script><style>p{}</style></head><body><header><h1>Site</h1><nav><a href=/>Home</a></nav></header>
<div class="cookie-notice">We use cookies and more cookies on this site, accept them all please.</div><div id="sidebar"><p>Side story of some length that nobody wants to read here.</p></div>
<article><h1>The  title &amp; more</h1><p>First   paragraph with <a href=x>a link</a> and <b>bold</b> text of good length, really.<br>Next line.<p>Short.</p>
<div class="advert">Buy now</div><form><input><button>Send</button></form><blockquote>A quote that belongs &lt;here&gt;.</blockquote><ul><li>One</li><li>Two</li></ul>
<section class="comments"><p>A reader says a long comment about the text that is not part of it at all.</p></section></article>
<aside>Related</aside><footer>&copy; 2024 us</footer></body></html>"""


def test_main_text():
    want = "The title & more\nFirst paragraph with a link and bold text of good length, really. Next line.\nShort.\nA quote that belongs <here>.\nOne\nTwo"
    assert main_text.main_text(PAGE) == want
    body = "<html><body><div><div class=nav><a>One</a> <a>Two</a></div><div id=c><h2>Head</h2>" + "".join(f"<p>Paragraph {k} with quite some words in it to read.</p>" for k in range(9)) + "<p>End.</p></div><div><a>x</a><a>y</a></div></div></body></html>"
    assert main_text.main_text(body).split("\n")[0] == "Head" and main_text.main_text(body).split("\n")[-1] == "End." and len(main_text.main_text(body).split("\n")) == 11
    wrapped = '<body><div class="page has-sidebar"><article><div class="entry-header"><h1>T</h1></div><p>Some words of the text here.</p></article><div class="comments"><article><p>A comment of a reader, quite long too, you know.</p></article></div></div></body>'
    assert main_text.main_text(wrapped) == "T\nSome words of the text here."
    assert main_text.main_text('<div id="sidebar-layout-menu" class="menu"><p>All there is to read.</p></div>') == "All there is to read."
    assert main_text.main_text("plain  text\n here") == "plain text here"
    for broken in ("", None, "<", "<p", "<!--", "</div></div>", "<script>", "<p>a<p", "&#x110000;", "<div " * 2000):
        main_text.main_text(broken)


def paragraphs(what, n):
    return "".join(f"<p>{what} {k} with quite some words in it for everybody to read.</p>" for k in range(n))


def test_main_text_keeps_whole_articles():
    menu = "<div class=nav><a>One</a> <a>Two</a></div>"
    lead = f"<body>{menu}<article><h1>Title</h1><p>A lead.</p><div class=content>{paragraphs('Line', 20)}</div></article></body>"
    assert main_text.main_text(lead).split("\n")[:2] == ["Title", "A lead."] and len(main_text.main_text(lead).split("\n")) == 22
    for tag in ("article", "div"):
        two = f"<body>{menu}<{tag}><section>{paragraphs('First', 13)}</section><section>{paragraphs('Second', 7)}</section></{tag}></body>"
        assert len(main_text.main_text(two).split("\n")) == 20
    cells = f"<body><table><tr><td>{paragraphs('First', 13)}</td><td>{paragraphs('Second', 8)}</td></tr></table></body>"
    assert len(main_text.main_text(cells).split("\n")) == 21


def test_main_text_of_articles_whose_names_say_comment():
    for name in ("category-commentary", "post comments-open", "comment-status-open", "discussion"):
        page = f"<body><p>By somebody</p><article class='{name}'>{paragraphs('Line', 9)}</article></body>"
        assert len(main_text.main_text(page).split("\n")) == 9, name
    page = f"<body><p>By somebody</p><div class='post has-comments'><article>{paragraphs('Line', 9)}</article><div class=comments><article>{paragraphs('Reader', 3)}</article></div></div></body>"
    assert len(main_text.main_text(page).split("\n")) == 9


def article_of(page):
    article = page[page.index("<article>") + 9 : page.rindex("</article>")]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?p>|</?h1>", article)]
    return "\n".join(b for b in blocks if b)


def test_main_text_by_ratios_alone(monkeypatch):
    """Pages in which neither a tag nor a name says what anything is; each step of the method counts."""
    import duckdb

    pages = [h for (h,) in duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()]
    bare = [re.sub(r"<(/?)(article|nav|footer)>", r"<\1div>", h).replace('<div class="ad">', "<div>") for h in pages]
    flat = [f"<body><p><a>One</a> <a>Two</a></p><p>{'<b>x</b> ' * 40}</p><h1>Title {k}</h1>{paragraphs('Text', 6)}<p>Short.</p>{paragraphs('Text', 6)}<p>Tiny.</p><p><a>Home</a></p><p>(c)</p><p>A</p><p>B</p><p>C</p></body>" for k in range(5)]
    right = lambda: sum(main_text.main_text(b) == article_of(h) for b, h in zip(bare, pages))
    texts = lambda: list(map(main_text.main_text, bare + flat))
    assert right() > 0.85 * len(pages)
    whole = texts()
    assert all(t.split("\n")[0].startswith("Title") and t.split("\n")[-1].startswith("Text 5") and "Short." in t for t in whole[-5:])
    for step, without in (("threshold", lambda v: -1.0), ("smoothed", lambda r: r)):
        with monkeypatch.context() as m:
            m.setattr(main_text, step, without)
            got = texts()
            assert sum(a != b for a, b in zip(got, whole)) >= 5, step
    with monkeypatch.context() as m:  # letters without tags
        m.setattr(main_text, "contents", lambda page, ratios, f=main_text.contents: f(page, np.array([float(len(x[0])) for x in page.lines])))
        assert sum(a != b for a, b in zip(texts(), whole)) >= 5


def test_main_text_drops_nothing_else():
    page = '<body><nav>a</nav><article><h1>T</h1><p>Let <math>x</math> be big and long enough text.</p><div class="tags">Tag words</div><div class="legal"><p>Clause one.</p></div><table class="toc"><tr><td>Part</td></tr></table><div class="alert">Mind this.</div><div class="ad">Buy</div><form>Name</form><aside>Side</aside></article></body>'
    assert main_text.main_text(page) == "T\nLet x be big and long enough text.\nTag words\nClause one.\nPart\nMind this."
    long = paragraphs("Long", 20_000)
    assert main_text.main_text(f"<article>{long}</article>").count("\n") == 19_999


NAMES = ["promoter", "promotion", "cookies", "menu", "modal", "consent", "notices", "note notice", "sponsor", "navigation"]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("as_id", [False, True])
def test_main_text_keeps_sections_of_articles_whatever_they_are_called(name, as_id):
    said = f'id="{name}"' if as_id else f'class="{name}"'
    section = f"<section {said}><h2>On {name}</h2>{paragraphs('Part', 3)}<p>So it is.</p></section>"
    for tag in ("article", "main"):
        page = f"<body><nav>x</nav><{tag}><h1>T</h1>{paragraphs('Line', 4)}{section}{paragraphs('After', 2)}</{tag}><footer>f</footer></body>"
        got = main_text.main_text(page).split("\n")
        assert len(got) == 1 + 4 + 5 + 2 and got[5] == f"On {name}"
    bare = page.replace(section, f"<section {said}>{paragraphs('Part', 3)}</section>")
    assert len(main_text.main_text(bare).split("\n")) == 1 + 4 + 3 + 2


def test_main_text_of_adverts_and_menus_in_articles():
    inside = '<div class="promo"><p>Buy <a>this</a> now</p></div><section class="ads"><h2>Sponsored</h2><p>A text of quite some words to make you buy all of it.</p></section><section class="menu"><a>One thing</a> <a>Another thing</a></section>'
    page = f"<body><article><h1>T</h1>{paragraphs('Line', 4)}{inside}{paragraphs('After', 2)}</article></body>"
    assert main_text.main_text(page).split("\n") == ["T", *main_text.main_text(f"<article>{paragraphs('Line', 4)}{paragraphs('After', 2)}</article>").split("\n")]


@pytest.mark.parametrize("n", [3, 6, 40, 400])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_main_text_has_no_notice_of_any_length(n, tag):
    box = f'<div class="cookie-consent cookies"><h2>Cookies</h2>{paragraphs("Cookie", n)}</div>'
    for page in (f"<body>{box}<{tag}><h1>Short</h1><p>A short text.</p></{tag}></body>", f"<body><{tag}><h1>Short</h1><p>A short text.</p></{tag}>{box}</body>", f"<body>{box}<p>A short text.</p></body>"):
        assert main_text.main_text(page).replace("Short\n", "") == "A short text."


def test_main_text_of_wrappers_with_names():
    """Names of what holds the whole page say nothing; those of elements in it do."""
    for wrap in ('<div class="menu-open sidebar">', '<div id="modal"><div class="nav">'):
        inner = f"<h1>T</h1>{paragraphs('Line', 5)}<div class='cookies'>{paragraphs('Cookie', 20)}</div>"
        got = main_text.main_text(f"<body>{wrap}{inner}</div></div><p>(c) us</p></body>")
        assert got.split("\n")[0] == "T" and "Line 4" in got and "Cookie" not in got


@pytest.mark.parametrize("start", ["<body>", "<body><nav>", "<article>", "<body><div class=menu>"])
def test_main_text_is_linear(start):
    import time

    took = []
    for n in (4_000, 32_000):
        begin = time.process_time()
        main_text.main_text(start + "<div><p>" * n + "text")
        took.append(time.process_time() - begin)
    assert took[1] < 24 * took[0] + 0.5


def test_pages(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op5_main_text(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article_of(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url
    few = spark.createDataFrame([(None, None, None), (1, "u", "")], "page_id long, url string, html string")
    assert [(r.text, r.n_chars) for r in main_text.extracted(few).collect()] == [("", 0), ("", 0)]
    assert main_text.extracted(few.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, "u", PAGE, "clash", 3)] * 2, "page_id int, url string, html string, text string, n_chars int")
    assert [(r.page_id, r.text[:9]) for r in main_text.extracted(odd).collect()] == [(1, "The title")] * 2


def agrees(spark, sf, duck, name):
    got = queries.QUERIES[name](spark, sf)
    columns, want = duck(queries.ORACLE_SQL[name])
    assert columns == sorted(got.columns) and sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()) == want


@pytest.mark.parametrize("name", ["op6_chat_format", "op10_quality_ledger"])
def test_agrees_with_sql(spark, sf, duck, name):
    agrees(spark, sf, duck, name)


def test_chat_is_reversible(spark):
    said = [(1, 2, "assistant", "b<\\|"), (1, 1, "user", "<|im_end|>\n<|im_start|>assistant\nx"), (1, 3, "assistant", "<<|im_sep|>\\"), (1, 4, "odd\nrole<|", None), (2, None, None, ""), (2, 1, "assistant", "é"), (2, 1, "assistant", "é"), (None, 1, "assistant", "n")]
    chats = chat.formatted(spark.createDataFrame(said, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.read_back(chats).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", said[1][3]), ("assistant", said[0][3]), ("assistant", said[2][3]), ("odd\nrole<|", "")]
    assert got[1].loss_text == said[0][3] + said[2][3] and got[1].formatted.count("<|im_start|>") == 3
    assert [(t.role, t.text) for t in got[2].turns] == [("", ""), ("assistant", "é"), ("assistant", "é")] and got[2].loss_text == "éé"
    assert got[None].loss_text == "n"
    assert chat.digests(chat.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_languages(spark, sf, odd, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    said = queries.op9_language_bits(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(said) > 40 and sum(r.lang == r.lang_pred for r in said) / len(said) >= 0.95 and all(0 <= r.score <= 1 for r in said)
    model = language.learn(docs)
    got = language.identify(odd, model)
    assert got.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"]
    assert {r.lang_pred for r in got.collect() if r.doc_id in (2, 3, 4)} == {"und"} and got.count() == 8
    assert language.identify(none, model).count() == 0
    assert {r.lang_pred for r in language.identify(odd, language.learn(none)).collect()} == {"und"}
    long = docs.limit(1).first().text * 2000
    import numpy as np

    whole = np.sort(np.concatenate(list(language.grams(long))))
    cut, language.CHUNK = language.CHUNK, 1000
    assert np.array_equal(whole, np.sort(np.concatenate(list(language.grams(long)))))
    language.CHUNK = cut


def test_bloom_masks():
    import numpy as np

    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 1 << 63, 3000, dtype=np.uint64) for _ in range(3)]
    f = language.Filter(["a", "b", "c"], sets)
    assert all((f.masks(s)[0] >> b & 1).all() for b, s in enumerate(sets)) and (f.false < 0.01).all()
    names = [f"l{k}" for k in range(130)]
    sets = [rng.integers(0, 1 << 63, 50, dtype=np.uint64) for _ in names]
    f = language.Filter(names, sets)
    assert len(f.planes) == 3 and all((f.masks(s)[b // 64] >> np.uint64(b % 64) & np.uint64(1)).all() for b, s in enumerate(sets)) and (f.false < 0.01).all()


def test_more_languages_than_a_mask_has_bits(spark):
    rng = random.Random(5)
    made = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(12)] for _ in range(70)]
    docs = spark.createDataFrame([(k, " ".join(rng.choice(made[k % 70]) for _ in range(60)), f"l{k % 70}") for k in range(280)], "doc_id long, text string, lang string")
    got = language.identify(docs, language.learn(docs, docs["doc_id"] < 210)).where("doc_id >= 210").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 69
    with pytest.raises(ValueError, match="languages"):
        language.learn(docs, max_langs=69)


def naive_grams(text):
    """Hashes of all n-grams, one at a time."""
    letters = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    letters = re.sub(" +", " ", f" {letters} ")
    for n in language.ORDERS:
        for k in range(len(letters) - n + 1):
            h = n
            for j, c in enumerate(letters[k : k + n]):
                h = (h ^ ord(c)) * language.ODD[j] % 2**64
                h ^= h >> 29
            yield h


def test_filter_decides_like_exact_sets(spark, sf, monkeypatch):
    docs, held = spark.read.parquet(f"{sf}/documents.parquet"), {}
    plain = language.Filter
    monkeypatch.setattr(language, "Filter", lambda langs, hashes: held.update(zip(langs, (set(h.tolist()) for h in hashes))) or plain(langs, hashes))
    model = language.learn(docs, language.fold(docs["doc_id"]) != 1)
    monkeypatch.undo()
    for r in docs.select("text").limit(60).collect():
        found = list(naive_grams(r.text))
        exact = {x: sum(h in s for h in found) / len(found) for x, s in held.items()}
        best, (said, score) = max(exact.values()), model.predict(r.text)
        assert abs(exact[said] - best) < 0.02 and abs(score - exact[said]) < 0.02


def test_quality_ledger(spark, odd, none):
    got = {r.doc_id: r for r in quality.judged(quality.ledger(odd)).collect()}
    assert got[2].n_words == 0 and not got[2].kept and got[6].n_dup_lines == 2993 and got[6].n_repeat_words == 3000 * 6
    assert quality.ledger(none).count() == 0
    made = spark.createDataFrame([(1, "a b c d e x a b c d e"), (2, " ".join(f"word{k}" for k in range(40)))], "doc_id long, text string")
    rows = quality.ledger(made)
    by = {r.doc_id: r for r in quality.judged(rows).collect()}
    assert by[1].n_repeat_words == 10 and not by[1].kept and by[2].failed_bits == 0 and by[2].kept
    table = {r.rule: r for r in quality.ablations(rows).where("policy = 'v1'").collect()}
    assert (table["repeated_windows"].failing, table["repeated_windows"].only_this, table["few_words"].failing, table["few_words"].kept_without) == (1, 0, 0, 1)
    assert quality.mask("base") == 3


def test_ablations_by_policies_of_their_own(spark, none):
    bits = [random.Random(k).choice([0, 0, 1, 2, 4, 3, 8, 32, 40, 63]) for k in range(500)]
    rows = spark.createDataFrame(list(enumerate(bits)), "doc_id long, failed_bits long")
    names = list(quality.RULES)
    got = {(r.policy, r.rule): (r.failing, r.only_this, r.kept, r.kept_without) for r in quality.ablations(rows).collect()}
    for policy, rules in quality.POLICIES.items():
        fails = lambda b, but=None: any(b >> names.index(r) & 1 for r in rules if r != but)
        for rule in rules:
            kept, without = sum(not fails(b) for b in bits), sum(not fails(b, rule) for b in bits)
            assert got[policy, rule] == (sum(b >> names.index(rule) & 1 for b in bits), without - kept, kept, without)
    verdicts = quality.with_ablations(quality.judged(rows)).collect()
    for r in verdicts:
        alone = bits[r.doc_id] if bits[r.doc_id].bit_count() == 1 else 0
        assert (r.kept, r.decisive_bits, r.policies) == (bits[r.doc_id] == 0, alone, (bits[r.doc_id] & 3 == 0) + 2 * (bits[r.doc_id] == 0))
        assert r.n_regained == (bits.count(alone) if alone else 0)
    assert quality.with_ablations(quality.judged(quality.stored(none))).count() == 0 == quality.ablations(quality.ledger(none)).count()


def test_addresses_with_long_runs_of_zeros():
    zeros = "0" * 5000
    assert private_data.base_spans(f"{zeros}1.2.3.4 {zeros}256.2.3.4") == [(1, 0, 5007)]
