import html as entities
import re
import time

import duckdb
from kotonoha.llm import html


def test_fixture_pages_equal_their_articles():
    rows = duckdb.sql("SELECT html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall()
    for (page,) in rows:
        article = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert html.extract(page) == "\n".join(b for b in blocks if b)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav>
<div id="cookie-banner"><p>We use cookies</p></div>
<div class="main has-sidebar"><article><header><h1>Title &amp; more</h1></header>
<p>First   <b>para</b>graph
goes on.<p>Second &copy; &#233;<br>line.
<div class="ad"><p>Buy!<p>Now!</div><ul><li>one<li>two</ul>
<p>ok</p><form><button>Send</button></form>
<section class="comments"><p>A very long comment of a reader that says many things about nothing.</p></section>
</article></div><aside>Side</aside><script>var x = "</p>";</script><footer>&copy; F</footer></body></html>"""


def test_article_without_the_rest():
    assert html.extract(PAGE).split("\n") == [
        "Title & more", "First paragraph goes on.", "Second © é line.", "one", "two", "ok",
    ]


def test_page_without_an_article_element():
    text = "Some words that make up a paragraph of the text. " * 4
    page = f"<body><div class=menu><a>x</a> <a>y</a></div><div id=text><p>{text}</p><p>{text}</p><p>End.</p></div><div class=footer>f</div>"
    assert html.extract(page) == "\n".join([text.strip(), text.strip(), "End."])


def test_all_of_the_article_beside_its_body_div():
    body = "Some words that make up a paragraph of the text. " * 40
    page = f"<article><h1>Title</h1><p>lead</p><div class=entry><p>{body}</p><p>{body}</p></div><p>end</p></article>"
    whole = "\n".join(["Title", "lead", body.strip(), body.strip(), "end"])
    assert html.extract(page) == whole
    assert html.extract(f"<body><div><a href=x>Home</a></div><main><div>{page}</div></main><p>Imprint</p></body>") == whole
    # Without an article element the lead and the end are in the cluster.
    lead = "A lead that says in some words what comes. " * 9
    assert html.extract(f"<body><h1>Title</h1><p>{lead}</p><div>{body}</div><p>end</p></body>").split("\n") == [
        "Title", lead.strip(), body.strip(), "end",
    ]
    # Links beside the text do not widen the region.
    assert html.extract(f"<body><div><a href=x>Home</a> | <a href=y>News</a></div><div><p>{body}</p><p>ok</p></div></body>") == f"{body.strip()}\nok"


def test_late_sections_of_an_article():
    first, last = "The long first section of the article. " * 95, "The short last section. " * 5
    sections = f"<section>{first}</section><section>{last}</section>"
    for page in (f"<article>{sections}</article>", f"<body>{sections}</body>", f"<article>{first}</article><article>{last}</article>"):
        assert html.extract(page).split("\n") == [first.strip(), last.strip()]


def test_everyday_words_as_names_in_an_article():
    kept = """<section id=related-work class="section related"><h2 id=search class=notice>Search</h2><p class=share-price>The share</p></section>
<div id=notice-period class=alert><p>One month</p></div><pre>a = 1 <span class=hljs-comment># comment</span> <span class=comment># two</span></pre>
<section id=comments><p>Comments start with a hash</p></section><p class="widget menu">Widgets</p>
<p>The sum <math><semantics><mrow><mi>a</mi><mo>+</mo><mi>b</mi></mrow><annotation encoding=tex>a+b</annotation></semantics></math> is here.</p>"""
    dropped = """<div class="share-buttons"><p>Share</p></div><div id=cookieBanner>Cookies</div><div class=related_posts>More</div>
<ol class=comment-list><li>Reader</ol><div class="x ad-slot">Buy</div><div hidden>no</div>"""
    lines = ["Search", "The share", "One month", "a = 1 # comment # two", "Comments start with a hash", "Widgets", "The sum a+b is here."]
    for tag in ("article", "main"):
        assert html.extract(f"<body><{tag}>{kept}{dropped}</{tag}></body>").split("\n") == lines
    assert html.extract(f"<body><div role=main>{kept}{dropped}</div></body>").split("\n") == lines
    # Outside an article whole names mark blocks, never headings or parts of compounds.
    around = "<div class=notice>x</div><div id=site-header>y</div><div class=footerWidgets>z</div><ul class=menu><li>m</ul>"
    text = "<h2 id=search>Search</h2><p class=share-price>The share</p><p>see <span class=comment># c</span></p>"
    assert html.extract(f"<body>{around}<div>{text}</div></body>").split("\n") == ["Search", "The share", "see # c"]


TEXT = "Some words that make up a paragraph of the text, one of several. " * 6


def test_a_main_part_is_no_licence():
    around = "<div class=sidebar><p>About this site and its authors</p></div><div class=menu><a href=x>Home</a></div><div class=footer>Imprint</div>"
    page = f"<body><main><div class=content><h1>Title</h1><p>{TEXT}</p><p>End.</p></div>{around}</main></body>"
    assert html.extract(page).split("\n") == ["Title", TEXT.strip(), "End."]
    assert html.extract(page.replace("<main>", "<div role=main>").replace("</main>", "</div>")).split("\n") == ["Title", TEXT.strip(), "End."]
    beside = f"<div class=comment><p>{TEXT}</p></div><div class=related><p>{TEXT}</p></div><div class=notice><p>We use cookies on this page</p></div>"
    page = f"<body><main><article><h1>Title</h1><p>{TEXT}</p><p>End.</p></article>{beside}</main></body>"
    assert html.extract(page).split("\n") == ["Title", TEXT.strip(), "End."]


def test_named_blocks_in_an_article_go_where_their_text_agrees():
    def lines(block):
        return html.extract(f"<article><h1>Title</h1><p>{TEXT}</p>{block}<p>{TEXT}</p><p>End.</p></article>").split("\n")

    plain = lines("")
    for block in (
        "<div class=notice><p>We use cookies on this page</p></div>",
        "<div class=comment><p>Nice post mate!</p></div>",
        "<div id=comments><p>Nice post mate!</p><p>Thanks</p></div>",
        "<div class=promo>Buy now</div>",
        "<div class=sidebar><ul><li>One<li>Two</ul></div>",
        f"<div class=sidebar><p><a href=x>{TEXT}</a></p></div>",
        f"<div><div class=comment><p>{TEXT}</p></div><div class=comment><p>{TEXT} Really.</p></div></div>",
        "<ul class=menu><li><a href=x>Home</a><li><a href=y>News</a></ul>",
    ):
        assert lines(block) == plain, block
    # Long text of its own stays, as do headings, paragraphs and sections of any name.
    for block in (
        f"<div class=notice><p>{TEXT}</p></div>",
        "<section class=notice>One month</section>",
        "<h2 class=menu>Menu</h2>",
        "<p class=comment>A remark</p>",
        "<div class=alert>Mind the step</div>",
    ):
        assert len(lines(block)) == len(plain) + 1, block


def test_stray_end_tags_in_linear_time():
    def seconds(n):
        begin = time.process_time()
        assert html.extract("<div>" * n + "x" + "</span>" * n) == "x"
        return time.process_time() - begin

    seconds(1000)
    assert seconds(40_000) < 4


def test_smoothing_and_clusters():
    assert html.smoothed([5.0, 5.0, 5.0]) == [5.0, 5.0, 5.0]
    lines = [("x", 4, 0), ("y", 4, 0), ("z", 4, 0), ("z", 4, 0), ("w" * 300, 1, 0), ("v" * 300, 1, 0)]
    assert html.content_lines(lines) == [False, False, False, False, True, True] or html.content_lines(lines)[-2:] == [True, True]


def test_broken_markup():
    assert html.extract("<p>a<p>b</div></p></x>c") == "a\nb\nc"
    assert html.extract("<![weird[x]]><p>a</p>") != ""
    assert html.extract("plain text, no tag") == "plain text, no tag"
    assert html.extract("<p>unclosed <b>bold <i>both") == "unclosed bold both"
    assert html.extract("<div class=ad>only this</div>") == ""
    assert len(html.extract("<p>" + "long words " * 200_000)) == 11 * 200_000 - 1
    assert html.extract("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def test_odd_rows(spark):
    rows = [(1, "u", "<p>a  b</p>"), (2, None, None), (3, "u", ""), (None, "v", "<p>\U0001f600é</p>"), (1, "u", "<p>a  b</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "7 AS text", "8 AS _key")
    found = html.extract_pages(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["url"] or "", r["text"], r["n_chars"]) for r in found.collect()) == [
        (0, "v", "\U0001f600é", 2), (1, "u", "a b", 3), (1, "u", "a b", 3), (2, "", "", 0), (3, "u", "", 0),
    ]
    assert html.extract_pages(pages.where("false")).count() == 0
