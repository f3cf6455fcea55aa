import gzip
import random
from hashlib import sha1

import pytest

from tidemark.llm import html_text, warc

PAGE = (
    "<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href='/'>Home</a></ul></nav><div class='cookie-notice'>We use cookies</div><div class='promo ad'>Buy</div>"
    "<article><header><h1>Title {n}</h1></header><p><b>First &amp; best\n  {n}<br>line<p>Second&nbsp;&lt;{n}&gt;<script>var x='<p>no</p>'</script></p><ul><li>one {n}<li>two</ul><div class='box'><em>Sign up</em> now</div><form><p>name</p></form><div id='comments'><p>I agree</p></div></article>"
    "<aside>More</aside><div>Powered by X</div><footer>(c)</footer></body></html>"
)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_main_text(spark):
    rows = [(i, f"https://a.example/{i}", PAGE.replace("{n}", str(i))) for i in range(12)] + [(50, None, None), (51, "x", ""), (52, "http://b.example", "plain text  only"), (53, "http://b.example", "<p>open <div>block</div></nosuch> tail"), (0, "https://a.example/0", PAGE.replace("{n}", "0"))]
    got = {r.page_id: r for r in html_text.main_text(pages(spark, rows)).collect()}
    assert got[3].text == "Title 3\nFirst & best 3 line\nSecond <3>\none 3\ntwo" and got[3].n_chars == len(got[3].text)
    assert got[50].text == got[51].text == "" and got[52].text == "plain text only" and got[53].text == "open\nblock\ntail"
    assert html_text.main_text(pages(spark, [])).count() == 0


def test_template_only_from_many_different_pages(spark):
    body = lambda n: f"<div><p>Welcome to our site</p></div><div><p>Story {n} goes here</p></div>"
    rows = [(i, "http://h.example/x", body(i)) for i in range(10)] + [(20 + i, "http://same.example/x", body(1)) for i in range(10)]
    got = {r.page_id: r.text for r in html_text.main_text(pages(spark, rows)).collect()}
    assert got[4] == "Story 4 goes here"  # the greeting recurs over the host
    assert got[24] == "Welcome to our site\nStory 1 goes here"  # copies of one page make no template


def test_warc_round_trip(spark):
    big = "é" * 600 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"
    rows = [(1, "http://a/1", big), (5, "http://a/5", big), (3, "bad\r\nurl", big), (4, None, "short"), (6, "u", "short"), (7, "u", None), (None, "u", big), (8, "u", ""), (5, "http://a/5", big)]
    got = sorted(map(tuple, warc.round_trip(pages(spark, rows)).drop("url").collect()), key=str)
    size, digest = len(big.encode()), sha1(big.encode()).hexdigest()
    want = [(i, size, digest, "response" if i == 5 else "revisit", None if i == 5 else 5) for i in (1, 5, 3, None, 5)]
    want += [(i, 5, sha1(b"short").hexdigest(), "response", None) for i in (4, 6)] + [(i, 0, sha1(b"").hexdigest(), "response", None) for i in (7, 8)]
    assert got == sorted(want, key=str)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_streams_are_split_whatever_their_pieces():
    records = [f"WARC/1.1\r\nContent-Length: {n}\r\n\r\n".encode() + b"\r\n\r\n"[: n % 5] + b"x" * max(0, n - min(n, n % 5)) for n in (0, 1, 3, 70_000)]
    records = [r.partition(b"\r\n\r\n")[0] + b"\r\n\r\n" + (b"y" * n) + b"\r\n\r\n" for r, n in zip(records, (0, 1, 3, 70_000))]
    whole = b"".join(records)
    for data in (gzip.compress(whole), b"".join(map(gzip.compress, records))):
        assert list(warc.split(warc.inflated(data))) == records
    with pytest.raises(ValueError):
        list(warc.inflated(gzip.compress(whole)[:-9]))


def test_counts_remove_what_no_name_marks(spark):
    """Shared text blocks and link blocks that differ in text go by counts; article prose that recurs stays; a brute-force count agrees on what recurs."""
    menu = lambda n: f"<div class='zone'><a href='/{n}'>topic {n}</a> <a href='/x'>item {n * 7}</a></div>"
    body = lambda n: f"<html><body>{menu(n)}<div>Powered by X</div><article><p>We quote each other.</p><p>Story {n}.</p></article><div>Loose {n} text</div></body></html>"
    rows = [(i, "http://h.example/x", body(i)) for i in range(20)] + [(30, "http://lone.example", body(30))]
    got = {r.page_id: r.text for r in html_text.main_text(pages(spark, rows)).collect()}
    assert got[4] == "We quote each other.\nStory 4.\nLoose 4 text"
    assert got[30] == "topic 30 item 210\nPowered by X\nWe quote each other.\nStory 30.\nLoose 30 text"  # one page has no template
    n = html_text.removed(pages(spark, rows)).first()
    assert (n.by_counts, n.by_names) == (20 * 7, 0)
    times = {}
    for _, _, page in rows[:20]:
        for h in {h for _, text, shape in html_text.hashed(html_text.parse(page))[0] for h in (text, shape) if h is not None}:
            times[h] = times.get(h, 0) + 1
    found = html_text.templates(spark.createDataFrame([("h", p) for _, _, p in rows[:20]], "host string, html string")).first().template
    assert set(found) == {h for h, k in times.items() if k >= html_text.MIN_PAGES and k >= html_text.SHARE * 20}


def test_a_large_list_of_templates_is_joined_by_salted_hosts(spark, monkeypatch):
    body = lambda n: f"<div>Welcome to our site</div><div><p>Story {n} goes here</p></div>"
    rows = [(i, "http://h.example/x", body(i)) for i in range(10)] + [(None, None, None)]
    monkeypatch.setattr(html_text, "MOST_SHARED", 0)
    got = {r.page_id: r.text for r in html_text.main_text(pages(spark, rows)).collect()}
    assert got == {**{i: f"Story {i} goes here" for i in range(10)}, None: ""}


def test_names_inside_articles_and_text_beside_them(spark):
    rows = [
        (1, "u", "<main><p>Intro</p><article><p>Body</p></article></main>"), (2, "u", "<article><div class='entry-header'><h1>Title</h1></div><p>Body</p></article>"),
        (3, "u", "<article><section class='search'><p>How we search</p></section></article>"), (4, "u", "<article><p>Body</p><div class='comments'><p>First!</p></div></article>"),
    ]
    got = {r.page_id: r.text for r in html_text.main_text(pages(spark, rows)).collect()}
    assert got == {1: "Intro\nBody", 2: "Title\nBody", 3: "How we search", 4: "Body"}


def test_deep_long_and_odd_pages(spark):
    rows = [
        (1, "u", "<div>" * 5000 + "deep"), (2, "u", "<div>" + "<font>" * 3000 + "inline" + "</p>" * 3000), (3, "u", "<b>" * 20_000 + "x" + "</i>" * 20_000),
        (4, "u", " ".join(f"<p>w{i}" for i in range(30_000))), (None, None, "<p>a"), (None, None, "<p>a"), (5, None, None), (6, "u", "<"),
    ]
    extra = [(*r, "h", 7, "t") for r in rows]
    got = sorted(((r.page_id, r.n_chars) for r in html_text.main_text(spark.createDataFrame(extra, "page_id long, url string, html string, host string, template int, text string")).collect()), key=str)
    assert got == sorted([(1, 4), (2, 6), (3, 1), (4, len("\n".join(f"w{i}" for i in range(30_000)))), (None, 1), (None, 1), (5, 0), (6, 1)], key=str)


KEPT = [
    ("div", "class='main-header-story'", False), ("div", "id='search-engine-history'", False), ("section", "class='notice-of-award'", False), ("div", "class='related-work'", True), ("div", "class='share-price'", True),
    ("div", "class='header-image-caption'", True), ("div", "class='promoted_by_hand notes'", True), ("section", "class='menu'", True), ("div", "id='sidebar-politics-debate'", False), ("div", "class='entry content'", False),
]
GONE = [
    ("div", "class='site-header'", False), ("div", "class='cookie-notice'", False), ("div", "id=comments", True), ("div", "class='x share-buttons'", True), ("div", "class='related_posts'", True), ("div", "class='ad'", True), ("div", "class='ad-slot-3'", True),
    ("div", "class='sponsored-links'", True), ("div", "class='page-footer'", False), ("div", "class='sidebar-left'", False), ("div", "class='Newsletter-Signup'", True), ("div", "id='search'", False),
]


def test_names_are_whole_words_of_classes(spark):
    """An article's own words are never cut by parts of its class names; every part of a page has words of its own, so what stays is known."""
    rows, want = [], {}
    for i, (tag, attrs, inside, gone) in enumerate([(*x, False) for x in KEPT] + [(*x, True) for x in GONE]):
        part = f"<{tag} {attrs}>part {i} words</{tag}>"
        page = f"<article><p>first {i}</p>{part}<p>last {i}</p></article>" if inside else f"<body>{part}<article><p>first {i}</p><p>last {i}</p></article></body>"
        lines = [f"first {i}", f"last {i}"]
        want[i] = "\n".join(lines if gone else [lines[0], f"part {i} words", lines[1]] if inside else [f"part {i} words", *lines])
        rows.append((i, f"http://h{i}.example/", page))
    assert {r.page_id: r.text for r in html_text.main_text(pages(spark, rows)).collect()} == want


def test_known_articles_of_generated_sites(spark):
    """Articles of invented sites with menus, notices, sidebars and comments around them come back word by word, whether names, counts or tags mark the rest."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows, want = [], {}
    for site in range(4):
        menu, notice, side = [prose(2) for _ in range(6)], prose(12), [prose(4) for _ in range(5)]
        named = site % 2 == 0  # the other sites' classes say nothing
        for n in range(12):
            i, body = 100 * site + n, [prose(rng.randint(5, 30)) for _ in range(rng.randint(2, 6))]
            top = f"<div class='{'site-header' if named else 'q1'}'>" + " ".join(f"<a href='/{k}'>{m}</a>" for k, m in enumerate(menu)) + "</div>"
            told = f"<div class='{'cookie-notice' if named else 'q2'}'>{notice}</div>"
            beside = f"<div class='{'sidebar' if named else 'q3'}'><ul>" + "".join(f"<li><a href='/s{k}'>{m}</a></li>" for k, m in enumerate(side)) + "</ul></div>"
            said = f"<section class='comments'><p>{prose(8)}</p></section>"
            rows.append((i, f"http://s{site}.example/{n}", f"<html><head><title>{prose(3)}</title></head><body>{top}{told}<article><h1>{body[0]}</h1>{''.join(f'<p>{p}</p>' for p in body[1:])}</article>{beside}{said}<script>{prose(5)}</script></body></html>"))
            want[i] = "\n".join(body)
    assert {r.page_id: r.text for r in html_text.main_text(pages(spark, rows)).collect()} == want
