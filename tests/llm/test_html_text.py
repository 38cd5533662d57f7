import html
import re

import duckdb

from tallyframe.llm import html_text as X

TREE = X.grow(*X.labelled())


def get(page):
    return X.extract(page, TREE)


def test_tree_fits_its_labelled_table():
    x, y = X.labelled()
    assert [X.decide(TREE, r) for r in x] == y and 0 < sum(y) < len(y)


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header class="site-header"><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav>
    <!-- <p>old</p> --><div class="ad">Buy <p>now</p></div><div id="cookie-notice"><p>We use cookies on this site for you.</p></div>
    <article><header><h1>Head &amp; title</h1></header><p>First <b>bold</b>word.<br>Next&nbsp;line</p><p>A <a href=x>link</a>.
    <p class="ad">Advert in the article</p><p>Un<span class="ad">sponsored words</span>broken</p><form><p>Sign up</p><input></form>
    <ul><li>one<li>two</ul><p hidden>secret</p></article>
    <aside><p>Side text that is rather long, as long as an article paragraph would be.</p></aside>
    <section class="comments"><article><p>Great article, I have read it twice and then again.</p></article></section>
    <footer>&copy; site</footer></body></html>"""
    assert get(page) == "Head & title\nFirst boldword. Next line\nA link.\nUnbroken\none\ntwo"


def test_page_without_article_element():
    p = "word " * 60
    page = f"<div><a>Home</a> <a>About us</a></div><div><p>{p}</p><p>{p}</p></div><div><a>Next page</a> <a>Top</a></div>"
    assert get(page) == "\n".join([p.strip()] * 2)


def test_cut_off_and_empty_pages():
    assert get(None) == get("") == get("<nav>a</nav>") == ""
    assert get("<article><p>Text here</p><p>more &am") == "Text here\nmore &am"
    assert get("<article><p>Text here</p><p cla") == get("<article><p>Text here</p><!-- x") == "Text here"
    assert get("<article><p>a < b and 1<2</p></article>") == "a < b and 1<2"
    long = "<article>" + "<p>x y</p>" * 20_000
    assert get(long).count("\n") == 19_999


def plain(page):
    """The test tables' layout, cut by hand."""
    a = page.find("<article>")
    b = page.find("</article>")
    s = re.sub(r"<[a-z/]*$", "", page[a:b if b >= 0 else None])
    parts = [re.sub(r"</?b>", "", p).replace("<br>", " ") for p in re.split(r"</?(?:p|h1|article)>", s)]
    return "\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


def test_all_pages_of_the_test_table():
    for (page,) in duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall():
        assert get(page) == plain(page)


def test_operator(spark):
    rows = spark.createDataFrame([(1, None, None, "x"), (2, "u", "<article>é 𝒳</article>", "x"), (2, "u", "<article>é 𝒳</article>", "x")],
                                 "page_id long, url string, html string, text string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in X.op10(rows).collect())
    assert got == [(1, "", 0), (2, "é 𝒳", 3), (2, "é 𝒳", 3)]
    assert X.op10(rows.limit(0)).columns == ["page_id", "url", "text", "n_chars"] and X.op10(rows.limit(0)).count() == 0


def test_unclosed_elements_do_not_swallow_the_page():
    p = "Words of the article that are long enough to be a paragraph of their own. " * 3
    body = f"<article><h1>Head</h1><p>{p}</p><p>Last.</p></article>"
    want = f"Head\n{p.strip()}\nLast."
    for tag in ("button", "select", "object", "svg", "iframe", "noscript", "audio", "video", "canvas", "template"):
        assert get(f"<{tag}>x{body}") == want, tag
        assert get(f"<nav><a>Home</a><{tag}>x</nav>{body}<footer>x<{tag}></footer>") == want, tag
        assert get(f"<{tag}>a<{tag}>b</{tag}>c</{tag}>{body}") == want, tag  # nested
        assert get(f"<{tag}>{body}</{tag}>{body}") == want, tag
    assert get(f"<select><option>One<option>Two{body}") == want
    assert get(f"<article><p>A <button>Share</button>b <svg><title>t</title><text>u</text></svg>c</p><p>{p}</p></article>") == f"A b c\n{p.strip()}"
    assert get("<article>" + "<p>x y<button>z</p>" * 5_000).count("\n") == 4_999
    assert get(f"{body}<script>var a = '<p>x</p>'") == want
