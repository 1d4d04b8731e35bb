"""HTML extraction: hand-made pages, template counting, and the sample pages against a plain reading of their form."""

import html as entities
import re

from tidemark.llm import html_text


def text(html):
    page = html_text.Page(html)
    return [page.texts[i] for i in page.main_blocks()]


def test_blocks():
    assert text("<p>a <b>b</b>\n c<p>d<br>e") == ["a b c", "d e"]
    assert text("x<script>var a='<p>no</p>';</script>y &amp; &lt;z&am") == ["xy & <z&am"]
    assert text('<nav>n</nav><article><header><h1>T</h1></header><p>one</p><aside>s</aside><div class="ad-box">x</div><p>two</article><footer>f') == ["T", "one", "two"]
    assert text("<body><header>h</header><main><p>a</p></main><p>b") == ["a"]
    assert text('<article><p>a <span class="share">no<i>x</i></span> b</p><section id="comments"><p>c</p></section></article>') == ["a b"]
    assert text("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == ["a", "b", "c d"]
    assert text('<p title="a>b">c</p></div></p>d<!-- <p>e -->f<!-- g') == ["c", "df"]
    assert text('<article><p>a<span class="ad">b<p>c</article>') == ["a", "c"]
    assert text("") == [] and text("<") == ["<"] and text("a < b") == ["a < b"]
    assert text("<div>" * 3000 + "deep") == ["deep"]
    assert text('<article class="comment"><p>no</p></article><article><p>yes</p></article>') == ["yes"]


def test_names_count_as_a_whole():
    assert text('<div class="content no-sidebar"><p>a</p></div>') == ["a"]
    assert text('<div id="page" class="has-sidebar"><article><p>a</p></article></div>') == ["a"]
    assert text('<article class="post related-topic"><p>a</p></article><article><p>b</p></article>') == ["a", "b"]
    assert text('<p>a</p><p class="legal">b</p>') == ["a", "b"]
    assert text('<p>long enough</p><div class="ad-slot-3">b</div><div id="siteFooter">c</div><div class="x main-menu">d</div>') == ["long enough"]


def test_names_never_delete_the_main_text():
    long = "so it goes on " * 30
    assert text('<div class="sidebar"><article><p>a</p></article></div><div class="ad">longer</div>') == ["a"]
    assert text('<div class="widget"><div class="sidebar"><main>a</main></div></div>') == ["a"]
    assert text('<x-app class="menu"><article>a</article></x-app>') == ["a"]
    assert text('<article class="sponsored">a</article>') == ["a"]
    assert text(f'<div class="sidebar"><p>{long}</p></div><p>b</p>') == [long.strip(), "b"]
    assert text(f'<article>a</article><div class="ad">{long}</div><div id="comments"><article>{long}</article></div>') == ["a"]
    assert text(f'<p>a</p><div id="comments">{long}</div>') == ["a"]


def test_templates_are_counted_per_host(spark):
    box = '<div class="x"><p>Follow our site for more</p></div>'
    page = lambda i: f"<article><p>text {i}</p>{box}<p>said again</p></article>"
    rows = [(i, "http://a.b/1", page(i), "x") for i in range(20)] + [(100 + i, "http://c.d/", page(50), "x") for i in range(20)]
    rows += [(200, None, None, "x"), (201, "u", "", "x"), (202, "http://a.b/", page(0), "x"), (202, "http://a.b/", page(0), "x")]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert got[3] == "text 3\n\nsaid again" and got[202] == "text 0\n\nsaid again"
    assert got[100] == "text 50\n\nFollow our site for more\n\nsaid again"  # copies of one text are no template
    assert got[200] == got[201] == ""
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_small_articles_and_unnamed_templates(spark):
    story = lambda i: f"<p>story {i} " + "and so on " * 20 + "</p>"
    said = lambda i: f"story {i} " + " ".join(["and so on"] * 20)
    assert text(f'<article><h2>card</h2></article><div class="x">{story(1)}</div>') == ["card", said(1)]
    assert text(f"<article><h1>only a heading</h1></article>{story(1)}") == ["only a heading", said(1)]
    box = f'<div class="x7">{"<p>visit our other sites</p>" * 30}</div>'
    page = lambda i, more="": f"<body>{more}<div><p>{i}</p></div></body>"
    rows = [(i, "http://small.a/", page(f"t{i}", box)) for i in range(3)]  # on all pages of a small host
    rows += [(10 + i, "http://pair.a/", page(f"t{i}", box)) for i in range(2)]  # too few to tell
    rows += [(20 + i, "http://some.a/", page(f"t{i}", box if i else "")) for i in range(5)]  # not on all
    rows += [(100 + i, "http://art.a/", f"{box}<article><p>piece {i}</p></article>") for i in range(9)]  # larger than the article
    rows += [(1000 + i, "http://large.a/", page(f"t{i}", box if i < 1000 else "<p>also</p>" if i < 1999 else "")) for i in range(22_000)]
    rows += [(50_000 + i, "http://rare.a/", page(f"t{i}", box if i < 900 else "")) for i in range(22_000)]  # neither the share nor the number
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    kept = "\n\n".join(["visit our other sites"] * 30)
    assert got[1] == "t1" and got[11] == f"{kept}\n\nt1" and got[22] == "t2" and got[20] == "t0"
    assert got[103] == "piece 3"
    assert got[1005] == "t5" and got[2500] == "also\n\nt1500" and got[9000] == "t8000"
    # a paragraph of the box alone is on 900 pages too, so it stays as well
    assert got[50_005] == f"{kept}\n\nt5" and got[60_000] == "t10000"


def nested(html):
    """Elements of well-formed markup as (tag, parts), by recursion, and the text they hold."""
    at = 0

    def element(tag):
        nonlocal at
        parts = []
        while at < len(html):
            m = re.compile(r"<(/?)([a-z0-9]+)[^>]*>|([^<]+)").match(html, at)
            at = m.end()
            if m[3]:
                parts.append(" ".join(m[3].split()))
            elif m[1]:
                return tag, tuple(p for p in parts if p)
            else:
                parts.append(element(m[2]))
        return tag, tuple(p for p in parts if p)

    return element("")


def test_counting_equals_brute_force(spark):
    import random
    from collections import Counter

    rng = random.Random(4)
    words = [f"w{i}" for i in range(6)]

    def piece(depth):
        if depth == 0 or rng.random() < 0.4:
            return f"<p>{rng.choice(words)}</p>"
        return f"<div>{''.join(piece(depth - 1) for _ in range(rng.randrange(1, 3)))}</div>"

    pages = [(i, f"http://h{i % 3}.a/", f"<div>{''.join(piece(2) for _ in range(rng.randrange(1, 5)))}<p>own {i}</p></div>") for i in range(90)]
    counts = Counter()

    def subtrees(e):
        yield e
        for p in e[1]:
            if isinstance(p, tuple):
                yield from subtrees(p)

    for i, url, html in pages:
        counts.update((url, e) for e in {*subtrees(nested(html)[1][0])})

    def kept(url, e):
        if counts[url, e] >= 3:  # 5 % of 30 pages are less
            return []
        return [t for p in e[1] for t in (kept(url, p) if isinstance(p, tuple) else [p])]

    got = html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    want = {i: "\n\n".join(kept(url, nested(html)[1][0])) for i, url, html in pages}
    assert {r.page_id: r.text for r in got} == want and sum(r.n_template for r in got) > 100


def test_long_and_broken_pages_take_time_in_proportion():
    import time

    start = time.process_time()
    for part in ("<div>", "<a ", "<p><article>", '<div class="ad">x', "<!", "</", '<a ">', "<a ' >", "<b title='x' y=\"", "<script>", "<!-- ", "<span class=share>a", "&amp;<", "<li><ul>", "<p>a</div>"):
        html_text.Page(part * 200_000)
    took = time.process_time() - start
    assert took < 90, took
    start = time.process_time()
    html_text.Page("<a " * 200_000)
    assert html_text.Page("<div>" * 200_000 + "deep").texts == ["deep"]
    assert time.process_time() - start < 6
    assert text("<b title='x>' y=\">a") == ["' y=\">a"] or text("<b title='x>' y=\">a") == ["a"]


def test_queries_and_clashing_columns(spark):
    rows = [(1, "http://a.b/", "<p>x</p>", "t", 5, None), (None, None, None, "", 6, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, _id int, gone int")
    assert sorted((r.page_id or 0, r.text) for r in html_text.extract(df).collect()) == [(0, ""), (1, "x")]


def test_sample_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = (" ".join("".join(entities.unescape(t) for t in re.split(r"<[^>]*>", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)
    counted = html_text.extract(pages).agg({"n_template": "sum", "n_named": "sum"}).first()
    assert min(counted) > 0
