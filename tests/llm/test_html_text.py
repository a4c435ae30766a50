"""Main text: against the pages' own article element, and on pages with other parts and faults."""

import html as entities
import re

from zoneflow.llm import catalog, html_text


def article(page):
    """Plain reading of the given pages: blocks of the article element."""
    body = re.split(r"<article[^>]*>", page, maxsplit=1)[-1].split("</article>")[0]
    body = re.sub(r"<[^<>]*\Z", "", body)
    blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(b for b in blocks if b)


def test_query_equals_the_articles(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = catalog.QUERIES["op1_html"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id]), r.page_id
        assert r.n_chars == len(r.text)


P = "This paragraph of the article has a good number of words in it, so that it reads like prose {}."


def test_other_parts_go():
    prose = "".join(f"<p>{P.format(i)}</p>" for i in range(8))
    parts = ('<header><a href="/">Home</a><p>Slogan of the site that is rather long as slogans go</p></header>'
             '<div class="cookie-notice"><p>We use cookies to make this site better for you, please accept them all now.</p></div>'
             '<aside class="sidebar"><h3>More</h3><p>Text in a sidebar that is long enough to be taken for prose, really long.</p></aside>'
             '<form><label>Your name</label><input name="n"><button>Send it</button></form>')
    comments = '<section id="comments"><h2>Comments</h2><div class="comment"><p>I am a reader and I have a long opinion about all of this.</p></div></section>'
    want = ["Title & more", *[P.format(i) for i in range(8)]]
    for open_, close in (("<article>", "</article>"), ("<main>", "</main>"), ('<div id="content">', "</div>"), ("", "")):
        page = f"<html><body>{parts}{open_}<h1>Title &amp; more</h1>{prose}{close}{comments}<footer>&copy; all rights reserved</footer></body></html>"
        assert html_text.main_text(page).split("\n") == want, open_
    inside = f"<body><article><h1>Title &amp; more</h1>{prose}{comments}<div class='ad'>Buy this now and be happy for ever after.</div></article>"
    assert html_text.main_text(inside).split("\n") == want


def test_parts_of_the_article_stay():
    prose = "".join(f"<p>{P.format(i)}</p>" for i in range(4))
    page = (f'<body><main><div class="breadcrumb"><a>Home</a></div><article class="post"><div class="post-header"><h1>Title</h1></div>{prose}'
            '<p><a href="x">A paragraph that is a link</a></p><ul><li>First point</li><li><a href="y">Second</a></li></ul>'
            '<ul class="list"><li><a>One</a></li><li><a>Two</a></li><li><a>Three</a></li></ul></article>'
            '<p>Filed under things</p></main></body>')
    assert html_text.main_text(page).split("\n") == ["Title", *[P.format(i) for i in range(4)], "A paragraph that is a link", "First point", "Second"]
    wrapped = f'<body><div class="page with-sidebar"><div><h1>Title</h1>{prose}</div></div></body>'
    assert html_text.main_text(wrapped).split("\n")[0] == "Title"


def test_long_comments_go():
    prose = "".join(f"<p>{P.format(i)}</p>" for i in range(4))
    comments = "".join(f'<article class="comment"><p>Reader {i}: {P.format(i)} {P.format(i)}</p></article>' for i in range(9))
    for root in ("article", "div"):
        page = f'<body><{root}><h1>Title</h1>{prose}</{root}><section id="comments"><h3>Comments</h3>{comments}</section></body>'
        assert html_text.main_text(page).split("\n") == ["Title", *[P.format(i) for i in range(4)]], root


def test_faults_and_edges():
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p> </p><script>x</script>") == ""
    assert html_text.main_text("just text &lt;b&gt;") == "just text <b>"
    assert html_text.main_text("<article><p>one two<p>three  four<b>five</b> six<a hre") == "one two\nthree fourfive six"
    assert html_text.main_text("<nav><article><p>in an unclosed menu</p></article>") == "in an unclosed menu"
    assert html_text.main_text("<script>if (a</b) '</p>'</script><article><p>x&nbsp;y\n z</p>") == "x y z"
    assert html_text.main_text("<p>" + "word " * 200_000) == ("word " * 200_000).strip()
    assert html_text.main_text("<div>" * 3000 + "deep" + "</div>" * 10) == "deep"


def test_time_is_linear_in_unclosed_and_stray_tags():
    import time
    start = time.perf_counter()
    for unclosed in ("<div>", "<b>", "<article><div>", '<div class="ad">', "<a><p>"):
        assert html_text.main_text((unclosed + "some text here ") * 50_000)
    html_text.main_text("<div>" * 50_000 + "x</span>" * 50_000)
    assert time.perf_counter() - start < 60


def test_nothing_is_looked_for_in_a_few_open_elements_only():
    deep = "<b>" * 20
    prose = "".join(f"<p>{P.format(i)}</p>" for i in range(6))
    # a paragraph under many open elements ends where the next block begins, and a link's text counts under them
    assert html_text.main_text(f"<article>{prose}<p>{deep}one<div>two</div></article>").split("\n")[-2:] == ["one", "two"]
    menu = "".join(f'<li><a href="#">{deep}Part {i}{"</b>" * 20}</a></li>' for i in range(4))
    assert "Part" not in html_text.main_text(f"<article>{prose}<ul>{menu}</ul></article>")
    titles = [f"Something of the length of a title, part {i}" for i in range(5)]
    reading = "".join(f'<li><a href="#">{t}</a></li>' for t in titles)
    assert html_text.main_text(f"<article>{prose}<ul>{reading}</ul></article>").split("\n")[-5:] == titles


def test_frames(spark):
    rows = [(1, None, None, "t"), (2, "u", "<p>a</p>", None), (2, "u", "<p>a</p>", None), (None, "", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted(r.text for r in html_text.page_texts(pages).collect()) == ["", "", "a", "a"]
    assert html_text.page_texts(pages.limit(0)).count() == 0
