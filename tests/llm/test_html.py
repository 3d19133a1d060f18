import numpy as np
import pytest

from dialogprep.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head>
<body class="with-sidebar"><header class="site-header"><a href="/">Site name</a></header><nav><ul><li><a href="/a">Home</a><li><a>About us</a></ul></nav><!-- ad <p>x</p> -->
<div class="cookie-notice">We use cookies to make this page work well for all of its many readers. <button>OK</button></div>
<main><article><header><h1>The  title &lt;1&gt;</h1></header><p>First <b>bold</b> text<br>goes&nbsp;on &#233;&#x41; here.
<p>Second, with <a href="x">one link</a> in it.</p><div class="ad">Buy now, it is cheap and good, do not wait.</div><ul><li>One.</li><li>Two.</ul>
<blockquote>Quoted words.</blockquote><p>Un.</p><form><label>Your name</label><input><select><option>A</select></form>
<aside>Related: <a>other article</a></aside></article></main>
<section id="comments"><h2>Comments</h2><p>I read this long article with joy and would like more of the same, thank you all.</p></section>
<footer>&copy; 2020 Somebody, all rights reserved.</footer></body></html>"""


def test_page_with_everything():
    want = "The title <1>\nFirst bold text goes on éA here.\nSecond, with one link in it.\nOne.\nTwo.\nQuoted words.\nUn."
    assert html.main_text(PAGE, html.tree()) == want


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""), ("plain text of a page that has some words", "plain text of a page that has some words"),
    ("<div>" * 3000 + "a text of many words in deep nesting that goes on and on" + "</div>" * 3000, "a text of many words in deep nesting that goes on and on"),
    ("<p>broken <a href='x>text without an end of its quote, which goes on for long enough to count", ""),
    ("<script>never ends <p>text</p>", ""), ("<!-- never ends <p>text</p>", ""), ("a < b and c > d in a text that is long enough to be kept here", "a < b and c > d in a text that is long enough to be kept here"),
])
def test_odd_pages(page, want):
    assert html.main_text(page, html.tree()) == want


def test_tree_fits_its_table():
    x = [html.features([html.Block("", w, k, bool(f), bool(a), bool(h), bool(i)) for w, k, f, a, h, i, _ in page]) for page in html.LABELLED]
    y = np.array([row[-1] for page in html.LABELLED for row in page], bool)
    assert (html.predict(html.tree(), np.vstack(x)) == y).mean() > 0.97
    held = [k for k in range(len(x)) if k % 3 == 0]
    train = [k for k in range(len(x)) if k % 3]
    model = html.fit_tree(np.vstack([x[k] for k in train]), np.concatenate([[r[-1] for r in html.LABELLED[k]] for k in train]).astype(bool))
    right = np.concatenate([html.predict(model, x[k]) == np.array([r[-1] for r in html.LABELLED[k]], bool) for k in held])
    assert right.mean() > 0.85


def test_over_tables(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (None, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.extracted(pages).collect()
    assert sorted(str(r.page_id) for r in got) == ["1", "1", "2", "None"]
    assert all(r.text == html.main_text(r.html, html.tree()) for r in got)
    assert html.extracted(pages.limit(0)).count() == 0


def test_given_pages(spark):
    """The article element of the given pages, told apart by its tags alone."""
    import re
    from html import unescape

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)>", inside)]
        assert html.main_text(r.html, html.tree()) == "\n".join(p for p in parts if p)
