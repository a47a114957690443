import pytest

from spokewise.llm import html as H


@pytest.mark.parametrize(
    "page, text",
    [
        ("<body><nav>menu</nav><article><h1>T &amp; X</h1><p>a<b>b</b> c&nbsp;d<br>e<p>f</article><footer>f</footer>", "T & X ab c d e f"),
        ("<header>site</header><main><p>one\n two</p><aside>no</aside><form>no</form></main>", "one two"),
        ("<article><header><h2>own</h2></header><div class='ad box'>no</div><p>text</p><section id=comments><p>no</p></section></article>", "own text"),
        ("<article><script>var t='</p>';</script><style>p{}</style><!-- no --><p>x &lt;b&gt; &#233;</article>", "x <b> é"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table><pre>f  g</pre></article>", "a b c d e f g"),
        ("<article><p>a</b></i></div>b</article>", "ab"),
        ("<article><p>open <!-- never closed", "open"),
        ("<article>a<script>never closed", "a"),
        ("<div role='main'><p>r</p></div><p>no</p>", "r"),
        ("<p>plain</p><div class='cookie-notice'>no</div><p hidden>no</p>text", "plain text"),
        ("<article><p>one</p></article><article><p>two</p></article>", "one two"),
        ("<article><img alt='no'/><p title='a > b' data-x=\"'\">q</p></article>", "q"),
        ("a < b and c", "a < b and c"),
        ("<html><head><title>no</title></head><body class='has-sidebar'>yes</body></html>", "yes"),
        ("", ""),
        ("<article></article>", ""),
    ],
)
def test_main_text(page, text):
    assert H.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div class='layout has-sidebar'><article><h1>T</h1><p>own</p></article><div class=sidebar>no</div></div>", "T own"),
        ("<div id='page' class='share-enabled'><main><p>own</p></main></div><p>no</p>", "own"),
        ("<main><div class='post no-comments'><article><p>own</p></article></div></main>", "own"),
        ("<form><div class=nav>no</div><article><p>own</p><form>no</form></article></form>", "own"),
        ("<div class=has-sidebar><div role=main><p>own</p></div></div>", "own"),
        ("<div class=share><article><h1>T</h1>own</article></div><div class=more><article>teaser</article></div>", "T own teaser"),
        ("<div class=has-sidebar><article>own</article><div id=comments><article>no</article></div></div>", "own"),
        ("<article>own</article><div id=comments><article>no, a long one</article></div>", "own"),
        ("<main><p>own and long</p><div id=comments><article>no</article></div></main>", "own and long"),
        ("<p>own and long</p><div class=related><article>no</article></div>", "own and long"),
        ("<div class=has-sidebar hidden><article>no</article></div><p>own</p>", "own"),
        ("<div class=no-comments><article>one</article></div><div class=no-comments><article>two</article></div>", "one two"),
        ("<article>own<div id=comments><article>no</article></div></article>", "own"),
    ],
)
def test_names_of_wrappers_do_not_hide_the_article(page, text):
    assert H.main_text(page) == text


def test_deep_and_long_pages_need_no_recursion():
    assert H.main_text("<div>" * 5000 + "x" + "</div>" * 5000) == "x"
    assert len(H.main_text("<article><p>" + "word " * 300_000)) == 5 * 300_000 - 1


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, hashes int")


def test_template_of_a_site_goes_and_articles_stay(spark):
    box = "<div class='x'>Read this every day</div>"
    rows = [(k, f"http://A.example/{k}", f"<body>{box}<p>own {k}</p><div><p>mine {k}</p></div></body>", "", 0) for k in range(8)]
    rows += [(100 + k, f"http://b.example/{k}", f"<body>{box}<p>own {k}</p></body>", "", 0) for k in range(2)]
    same = f"<body><article><h1>T</h1><p>same text</p>{box}</article></body>"
    rows += [(200 + k, f"https://u@c.example:80/{k}", same, "", 0) for k in range(9)]
    found = {r.page_id: r.text for r in H.extract(pages(spark, rows), ["page_id", "url"]).collect()}
    assert found[3] == "own 3 mine 3"
    assert found[101] == "Read this every day own 1"
    assert found[204] == "T same text"


def test_odd_pages(spark):
    rows = [(1, None, None, "t", 1), (2, "not a url", "", "t", 1), (2, "not a url", "", "t", 1), (None, "http://h/", "<p>x", "t", 1)]
    found = H.extract(pages(spark, rows), ["page_id", "url"])
    assert sorted((r.page_id or 0, r.text) for r in found.collect()) == [(0, "x"), (1, ""), (2, ""), (2, "")]
    assert H.extract(pages(spark, rows).limit(0), ["page_id"]).count() == 0
