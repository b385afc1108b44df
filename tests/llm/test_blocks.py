import html
import re

import numpy as np
import pytest

from tests.llm.cases import table
from threadlens.llm import blocks as B


def text_of(page):
    return B.main_text(page, B.trained_tree())


def test_tree_fits_its_table():
    t = B.labelled_table()
    assert (B.trained_tree().main(t[:, :-1]) == t[:, -1].astype(bool)).all()


def test_pages_equal_the_article_element(spark):
    pages = {r.page_id: r.html for r in table(spark, "pages", "sf0.01").collect()}
    rows = B.op4_main_text(table(spark, "pages", "sf0.01")).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:h1|p)>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


STORY = "The council met on Tuesday evening to discuss the new bridge, and the vote was closer than anyone had expected."


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<html></html>", ""), ("<p>", ""), ("<!-- only a comment", ""),
    (f"<nav><a href=x>Home</a></nav><main><h2>News</h2><p>{STORY}</p></main><footer>About us</footer>", f"News\n{STORY}"),
    (f"<article><p>a &lt;b&gt; &amp;amp; caf&eacute;&nbsp;x</p><div class='comments'><p>{STORY}</p></div></article>", "a <b> &amp; café x"),
    (f"<article><h1>T</h1><script>if (a<b) document.write('<p>{STORY}</p>')</script><p>One<!-- x > y --> two</p></article>", "T\nOne two"),
    (f"<body><div id=sidebar><p>{STORY}</p></div><div class=post><p>{STORY}</p><p>{STORY} {STORY}</p></div></body>", f"{STORY}\n{STORY} {STORY}"),
    (f"<article><p>{STORY}<form><label>Mail</label><input value='a>b'><button>Go</button></form><p>Ends</article>", f"{STORY}\nEnds"),
    (f"<article><p title='a > b'>{STORY}</p><p>x < y and y<z</p>", f"{STORY}\nx < y and y"),
])
def test_small_pages(page, want):
    assert text_of(page) == want


def test_long_and_broken_pages():
    assert len(text_of("<article>" + "<p>word " * 20_000)) == 20_000 * 5 - 1
    assert text_of("<article><p>" + "x" * 300_000).startswith("xxx")
    text_of('<a "' * 5000 + "<p" * 5000 + "</" * 5000)


def test_features_look_at_neighbours():
    f = B.features(B.blocks("<p>one two <a>three</a></p><p>four</p>"))
    assert f[0][:6].tolist() == [3, 1 / 3, 0, 0, 1, 0] and f[1][2:4].tolist() == [3, 1 / 3]
    assert B.features([]).shape == (0, len(B.FEATURES))
    assert np.isfinite(f).all()


def test_awkward_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, `a b` int"
    rows = [(1, None, None, "x", "y", 1), (2, "u", "", "x", "y", 1), (3, "u", "<article><p>Some text</article>", "x", "y", 1), (3, "u", "<article><p>Some text</article>", "x", "y", 1), (None, None, "<p>", None, None, None)]
    got = B.op4_main_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0)] * 3 + [("Some text", 9)] * 2
    assert B.extract(spark.createDataFrame(rows, schema)).columns == ["page_id", "url", "a b", "text", "n_chars"]
    assert B.op4_main_text(spark.createDataFrame([], schema)).count() == 0


P = f"<p>{STORY}</p><p>{STORY} {STORY}</p><p>Short one.</p><p>{STORY}</p>"
MAIN = f"{STORY}\n{STORY} {STORY}\nShort one.\n{STORY}"
MENU = "<ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul>"


@pytest.mark.parametrize("page,want", [
    # names of wrappers, layouts and topics say nothing about what is in them
    (f'<div id="page" class="has-sidebar"><nav>{MENU}</nav><div class="content"><h1>A title</h1>{P}</div><div class="sidebar"><p>{STORY}</p></div></div>', f"A title\n{MAIN}"),
    (f'<div id="page" class="has-sidebar"><article><h1>A title</h1>{P}</article><div class="sidebar"><p>{STORY}</p></div></div>', f"A title\n{MAIN}"),
    (f'<article class="post tags-news"><h1>A title</h1>{P}</article><footer>{STORY}</footer>', f"A title\n{MAIN}"),
    (f'<article class="post category-social tag-newsletter hentry"><h1>A title</h1>{P}</article>', f"A title\n{MAIN}"),
    (f'<article><header class="entry-header"><h1>Title here</h1></header>{P}</article>', f"Title here\n{MAIN}"),
    (f'<article><div class="article-header"><h1>Title here</h1></div>{P}</article>', f"Title here\n{MAIN}"),
    (f'<form id="aspnetForm"><div id="nav">{MENU}</div><div id="main-content"><h1>A title</h1>{P}</div><div id="footer">{STORY}</div></form>', f"A title\n{MAIN}"),
    (f'<nav class="navbar">{MENU}</nav><div class="row"><div class="col-md-8 blog-main"><h2 class="blog-post-title">A title</h2>{P}</div><div class="col-md-4 blog-sidebar"><h4>About</h4><p>{STORY}</p></div></div>', f"A title\n{MAIN}"),
    # side parts by name, by heading and by element, inside the article and outside
    (f'<article><h1>A title</h1>{P}<section><h3>Comments (3)</h3><p>I think {STORY}</p><p>Agreed</p></section></article>', f"A title\n{MAIN}"),
    (f'<article><h1>A title</h1>{P}<h2>2 Comments</h2><p>I think {STORY}</p><h2>Afterwards</h2><p>{STORY}</p></article>', f"A title\n{MAIN}\nAfterwards\n{STORY}"),
    (f'<article><h1>A title</h1><p class="advert">{STORY}</p>{P}<div class="ad ad-300">Buy now</div></article>', f"A title\n{MAIN}"),
    (f'<article>{P}</article><div id="comments" class="comments-area"><h2>One thought</h2><ol class="comment-list"><li class="comment"><article class="comment-body"><p>{STORY}</p></article></li></ol></div>', MAIN),
    (f'<div class="cookie-banner"><p>{STORY}</p></div><main><h1>A title</h1>{P}</main><div style="display: none"><p>{STORY}</p></div>', f"A title\n{MAIN}"),
])
def test_common_site_markup(page, want):
    assert text_of(page) == want


def test_words_and_links_alone_flip_the_verdict():
    """The same markup with other words and links."""
    link = "<a href=x>{}</a>"
    page = "<div>{0}</div><div>{1}</div><div>{2}</div><div>{1}</div><div>{0}</div>"
    assert text_of(page.format(STORY, STORY, STORY)) == "\n".join([STORY] * 5)
    assert text_of(page.format(link.format("Home"), link.format("World news"), link.format(STORY))) == ""
    middle = "<article><p>" + STORY + "</p>{}<p>" + STORY + "</p></article>"
    assert text_of(middle.format("<p>A few words of the text</p>")).count("\n") == 2
    linked = "".join(f"<li>{link.format(w)}</li>" for w in ("One story", "Another story of the week", "The third", "A fourth one"))
    assert text_of(middle.format(f"<ul>{linked}</ul>")) == f"{STORY}\n{STORY}"
    tree = B.trained_tree()
    assert {"words", "density", "around_density"} <= {B.FEATURES[f] for f in tree.feature if f >= 0}
