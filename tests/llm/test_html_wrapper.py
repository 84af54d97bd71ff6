from __future__ import annotations

import html as H
import re

from martflow.llm import html_wrapper as W
from martflow.llm.queries import QUERIES
from tests.conftest import SF0001, need_testdata


def blog(n, ps, extra=""):
    body = "".join(f"<p>Paragraph {i} of page {n} with <b>some</b> words &amp; more.</p>" for i in range(ps))
    return (f"<html><head><title>T</title><script>var a = '<p>no</p>';</script></head><body>"
            f"<header><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a></li><li><a href=/b>About</a></li></ul></nav>"
            f"<div class=cookie-notice>We use cookies</div><div class=wrap{n}><div class='post-content'>"
            f"<h2>Title {n}</h2>{body}{extra}</div><aside>Side {n} text</aside></div>"
            f"<form><input><label>Mail</label></form><div id=comments><p>Reader {n} says hi</p></div>"
            f"<footer>&copy; site</footer></body></html>")


def want(n, ps):
    return f"Title {n} " + " ".join(f"Paragraph {i} of page {n} with some words & more." for i in range(ps))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, wrapper int")


def test_alignment_makes_slots_optionals_and_repeats():
    pages = ["<div><h1>A</h1><p>x</p><p>y</p><i>same</i></div>", "<div><h1>B</h1><p>z</p><ul><li>1</ul><i>same</i></div>"]
    a, b = (W.items_of(W.blocks_of(p).kids) for p in pages)
    [root] = W.aligned(a, b)
    assert [(x["l"], x.get("rep", False), x["opt"]) for x in root["kids"]] == [
        ("h1", False, False), ("p", True, False), ("ul", False, True), ("#", False, False)]
    assert root["kids"][0]["kids"][0]["fixed"] is None and root["kids"][3]["fixed"] is not None


def test_repeated_groups():
    kids = W.blocks_of("<h2>a</h2><p>b</p><h2>c</h2><p>d</p><h2>e</h2><p>f</p>").kids
    [(label, parts)] = W.fold(kids)
    assert label == "(h2 p)" and len(parts) == 3


def test_main_text_of_a_template(spark):
    rows = [(n, f"http://h.example/{n}", blog(n, 1 + n % 4)) for n in range(12)]
    rows += [(50, "https://h.example:8080/x", blog(50, 2, "<blockquote>Quoted words</blockquote>"))]
    got = {r.page_id: r.text for r in W.main_texts(frame(spark, rows)).collect()}
    assert {n: got[n] for n in range(12)} == {n: want(n, 1 + n % 4) for n in range(12)}
    assert got[50] == want(50, 2) + " Quoted words"


def test_layout_without_names(spark):
    page = lambda n: (f"<body><table><tr><td><a href=1>One</a> <a href=2>Two</a></td></tr></table><div><div>"  # noqa: E731
                      f"<h3>Head {n}</h3>Long own text of page {n} " + "word " * 40 + f"<br>next line {n}</div></div>"
                      "<div>All rights reserved</div></body>")
    rows = [(n, "http://t.example/", page(n)) for n in range(6)]
    got = {r.page_id: r.text for r in W.main_texts(frame(spark, rows)).collect()}
    assert got[3] == "Head 3 Long own text of page 3 " + "word " * 40 + "next line 3"


def test_copies_of_one_page_are_extracted(spark):
    page = "<body><nav>Menu</nav><article><h1>One title</h1><p>One text</p></article><footer>f</footer></body>"
    rows = [(n, "http://copies.example/", page) for n in range(9)]
    assert {r.text for r in W.main_texts(frame(spark, rows)).collect()} == {"One title One text"}


def words(n, k):
    return " ".join(f"w{n}x{i}" for i in range(k))


def test_every_template_of_a_host_has_its_article(spark):
    page = lambda n: (f"<body><nav>Menu</nav><div class={'post-content' if n % 10 < 7 else 'entry'}><h1>Title {n}</h1>"  # noqa: E731
                      f"<p>{words(n, 30)}</p></div><div>Side {n}</div></body>")
    rows = [(n, f"http://two.example/{n}", page(n)) for n in range(20)]
    kinds = lambda n: (f"<body><article class={'news' if n % 10 < 7 else 'review'}><h1>Title {n}</h1>"  # noqa: E731
                       f"<p>{words(n, 30)}</p></article><div>Side {n}</div></body>")
    rows += [(100 + n, f"http://kinds.example/{n}", kinds(n)) for n in range(20)]
    rows += [(200 + n, None, f"<body><div class={c}><h1>Title {200 + n}</h1><p>{words(200 + n, 30)}</p></div></body>")
             for n, c in enumerate(["story"] * 5 + ["entry", "text"])]
    got = {r.page_id: r.text for r in W.main_texts(frame(spark, rows)).collect()}
    for n in range(20):
        assert got[n] == f"Title {n} {words(n, 30)}"
        assert got[100 + n] == f"Title {n} {words(n, 30)}"
    for n in range(200, 207):
        assert got[n] == f"Title {n} {words(n, 30)}"


def test_links_inside_the_article_stay(spark):
    inner = lambda n: (f"<h1><a href=/{n}>Title {n}</a></h1><p>{words(n, 30)}</p><p><a href=/x>Single link {n}</a></p>"  # noqa: E731
                       f"<ul><li><a href=/1>Source {n} one</a></li><li><a href=/2>Source {n} two</a></li></ul>")
    text = lambda n: f"Title {n} {words(n, 30)} Single link {n} Source {n} one Source {n} two"
    rows = [(n, "http://tag.example/", f"<body><ul><li><a href=/>Go {n}</a></li></ul><article>{inner(n)}</article></body>")
            for n in range(6)]
    rows += [(10 + n, "http://name.example/", f"<body><ul><li><a href=/>Go {n}</a></li></ul>"
              f"<div class=entry>{inner(10 + n)}</div></body>") for n in range(6)]
    rows += [(20 + n, "http://plain.example/", f"<body><ul><li><a href=/>Go {n}</a></li></ul><div><h1><a href=/>Title {n}</a>"
              f"</h1><p>{words(n, 9)}</p><p>{words(n, 9)}</p></div></body>") for n in range(6)]
    got = {r.page_id: r.text for r in W.main_texts(frame(spark, rows)).collect()}
    assert all(got[n] == text(n) for n in [*range(6), *range(10, 16)])
    assert all(got[20 + n].removeprefix(f"Title {n} ") == f"{words(n, 9)} {words(n, 9)}" for n in range(6))


def test_no_share_of_the_article_is_lost(spark):
    plain = lambda n: (f"<body><ul><li><a href=/{n}>Go {n}</a></li></ul><div><h1>Title {n}</h1><div class=intro>{words(n, 20)}</div>"  # noqa: E731
                       f"<div class=rest>{words(n, 60)}</div></div><div>All rights reserved</div></body>")
    rows = [(n, "http://plain.example/", plain(n)) for n in range(6)]
    parts = lambda n: (f"<body><main><section class=content>{words(n, 60)}</section><section>{words(n, 40)}</section>"  # noqa: E731
                       f"<div class=share>Share {n}</div></main><div>Side {n}</div></body>")
    rows += [(10 + n, "http://main.example/", parts(10 + n)) for n in range(6)]
    posts = lambda n: "<body><div>" + "".join(f"<div class=entry><p>{words(n, k)}</p></div>" for k in (9, 8, 7)) + "</div></body>"
    rows += [(20 + n, "http://list.example/", posts(20 + n)) for n in range(6)]
    got = {r.page_id: r.text for r in W.main_texts(frame(spark, rows)).collect()}
    assert all(got[n] == f"Title {n} {words(n, 20)} {words(n, 60)}" for n in range(6))
    assert all(got[n] == f"{words(n, 60)} {words(n, 40)}" for n in range(10, 16))
    assert all(got[n] == f"{words(n, 9)} {words(n, 8)} {words(n, 7)}" for n in range(20, 26))


def test_copies_without_an_article_block_are_extracted(spark):
    page = "<body><ul><li><a href=/>Go</a></li></ul><div><h1>One title</h1><div>One text</div></div><nav>Menu %d</nav></body>"
    rows = [(n, "http://copies.example/", page % n) for n in range(9)]
    other = "<body><div><h1>Title %d</h1><div>Text %d</div></div><div>All rights reserved</div></body>"
    rows += [(10 + n, "http://mixed.example/", other % (max(n, 5), max(n, 5))) for n in range(9)]
    rows += [(20 + n, "http://same.example/", f"<body><div><p>Not found</p></div><a href=/>Link {n}</a></body>") for n in range(9)]
    rows += [(30 + n, "http://links.example/", f"<body><a href=/>Link {n}</a></body>") for n in range(5)]
    got = {r.page_id: r.text for r in W.main_texts(frame(spark, rows)).collect()}
    assert {got[n] for n in range(9)} == {"One title One text"}
    assert all(got[10 + n] == f"Title {max(n, 5)} Text {max(n, 5)}" for n in range(9))
    assert {got[20 + n] for n in range(9)} == {"Not found"}
    assert all(got[30 + n] == f"Link {n}" for n in range(5))


def test_query_on_the_given_pages(spark):
    need_testdata()
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op4_html_wrapper"](spark, SF0001).collect()}
    pages = spark.read.parquet(f"{SF0001}/pages.parquet").collect()
    for p in pages:
        article = p.html.split("<article>")[1].split("</article>")[0]
        parts = [" ".join(H.unescape(x).split()) for x in re.split(r"<(?:/?p|/?h1|br|/?b|/?t[dr])[^>]*>", article)]
        text = " ".join(x for x in parts if x)
        assert got[p.page_id] == (text, len(text))


def test_odd_pages(spark):
    long = "<article><p>" + "deep " * 100_000 + "</article>"
    rows = [(1, None, None), (2, "", ""), (3, "not a url", "plain &lt;text&gt; only"), (None, "http://a.example", "<p>a"),
            (4, "http://a.example", "<article><p>a<p>b</article"), (4, "http://a.example", "<article><p>a<p>b</article"),
            (5, "http://b.example", long), (6, "http://c.example", "<div>" * 3000 + "<p>x" + "</div>" * 10),
            (7, "http://d.example", "<script>only code"), (8, "http://d.example", "<!-- never closed <p>x</p>")]
    out = W.main_texts(frame(spark, rows))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert len(got) == 10 and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == by[7] == by[8] == "" and by[5] == ("deep " * 100_000).strip() and by[6] == "x"
    assert by[3] == "plain <text> only" and by[4] == "a b"
    assert W.main_texts(frame(spark, rows).limit(0)).count() == 0


def test_blocks_of_any_depth_and_levels_of_any_width():
    deep = "<div>" * 85 + "<article><nav>MENU</nav><p>Body</p><footer>FOOT</footer></article>" + "</div>" * 85
    assert W.extract(deep, W.mark(W.page_items(deep))) == "Body"
    deeper = "<div>" * 5000 + "<nav>MENU</nav><p>Body text of the page.</p>" + "</div>" * 5000
    wrapper = W.mark(W.aligned(W.page_items(deeper), W.page_items(deeper)))
    assert W.dump(W.load(W.dump(wrapper))) == W.dump(wrapper)
    assert W.extract(deeper, wrapper) == "Body text of the page."
    wide = "<article>" + "".join(f"<p>{i}</p><div class=c{chr(97 + i * i % 7)}>x{i}</div>" for i in range(4000)) + "</article>"
    other = wide.replace("<p>7</p>", "<h2>7</h2>")
    wrapper = W.mark(W.aligned(W.page_items(wide), W.page_items(other)))
    for page in (wide, other):
        assert W.extract(page, wrapper) == " ".join(f"{i} x{i}" for i in range(4000))


def test_wide_levels_are_aligned_like_small_ones(monkeypatch):
    import random

    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("pqrs") for _ in range(rng.randrange(30))] for _ in range(2))
        monkeypatch.setattr(W, "TABLE", 1 << 16)
        table = W.pairs_of(a, b)
        monkeypatch.setattr(W, "TABLE", 6)
        halved = W.pairs_of(a, b)
        assert [i for i, _ in halved if i is not None] == list(range(len(a)))
        assert [j for _, j in halved if j is not None] == list(range(len(b)))
        both = [(i, j) for i, j in halved if i is not None and j is not None]
        assert all(a[i] == b[j] for i, j in both) and len(both) == sum(i is not None and j is not None for i, j in table)


def test_the_wrapper_decides_inside_an_article():
    def page(i):
        return (f"<html><body><article class=post><header><h1>Title {i}</h1></header><p>First words of story {i}.</p>"
                f"<div class=share-price>Shares rose {i} percent on the day.</div><p>More about {i} here.</p>"
                f"<div class=share><a href=/x>Tweet</a> <a href=/y>Mail</a></div>"
                "<p>Written by Sam. All rights reserved.</p></article></body></html>")

    pages = [page(i) for i in range(8)]
    wrapper = W.page_items(pages[0])
    for p in pages[1:]:
        wrapper = W.aligned(wrapper, W.page_items(p))
    wrapper = W.mark(wrapper)
    for i, p in enumerate(pages):
        body = f"Title {i} First words of story {i}. Shares rose {i} percent on the day. More about {i} here."
        assert W.extract(p, wrapper) == body
        assert W.extract(p, None) == body + " Written by Sam. All rights reserved."
