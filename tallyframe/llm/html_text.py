"""Main text of web pages: flat blocks classified by a small decision tree.

A page becomes a flat list of text blocks (text between the starts and ends of block
elements; inline tags and ``<br>`` don't split a block).  Each block has its own word
count and link density, those of its neighbours, whether it is a heading, and
what encloses it: containers that are boilerplate by element or by the words in
class, id or role, and containers that are the article.  A CART tree trained on
``EXAMPLES`` (small pages whose main blocks are marked) decides each block.

Scripts, styles, comments, controls and hidden parts are markup, not text.
Character references are decoded; white space inside a block becomes one space.

Edge cases: null html is empty and has empty text; a tag or comment that the end
of the page cuts off is markup; unclosed elements end with their parent;
repeated rows are extracted one by one; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: element names of HTML, by role.
SKIP = frozenset("script style noscript template iframe object svg math canvas audio video select button textarea title head datalist".split())
#: Of these, the ones whose text runs to the closing tag whatever it holds, and to the page's end without one.
RAW = frozenset("script style textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul caption label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {  # an opening element ends an open one of these
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
#: Elements that are not the article wherever they stand.
NOISE_TAGS = frozenset("nav footer aside form menu dialog search label legend option optgroup".split())
MAIN_TAGS = frozenset("article main".split())
#: Words in class, id or role that mark boilerplate, and the article.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner "
    "sidebar rail menu nav navbar navigation breadcrumb breadcrumbs topbar footer masthead comment comments "
    "disqus reply replies respond discussion cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup signin login register share sharing social related recommended "
    "recommendations trending widget toolbar searchbox pagination pager copyright disclaimer paywall toc "
    "contentinfo complementary skip".split())
MAIN_WORDS = frozenset("article content post story entry main maincontent articlebody".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_TAG = re.compile(r"""<(?:!--(?:.*?-->|.*\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|/[^a-zA-Z][^>]*(?:>|\Z)|([a-zA-Z/][^>]*)(?:>|\Z))""", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _marks(tag: str, attrs: str) -> tuple[bool, bool, bool]:
    """(boilerplate by words or hidden, article by words, marked in an example)."""
    if not attrs or attrs.isspace():
        return False, False, False
    words: set[str] = set()
    hidden = marked = False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            words.update(_SPLIT.split(_CAMEL.sub("-", value).lower()))
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
        elif name == "data-main":
            marked = True
    return hidden or bool(words & NOISE_WORDS), bool(words & MAIN_WORDS), marked


class Block:
    __slots__ = ("text", "words", "links", "noise", "main", "heading", "marked")

    def __init__(self, text, links, noise, main, heading, marked):
        self.text, self.noise, self.main, self.heading, self.marked = text, noise, main, heading, marked
        self.words = len(text.split())
        self.links = min(1.0, links / max(1, self.words))


def _closed(page: str, tag: str) -> dict[int, int]:
    """End of the opening tag -> end of its closing tag, for the elements of this name that have one."""
    out, open_ = {}, []
    for m in re.finditer(rf"<(/?){tag}(?=[\s/>])[^>]*(?:>|\Z)", page, re.I):
        if not m[1]:
            open_.append(m.end())
        elif open_:
            out[open_.pop()] = m.end()
    return out


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order.

    Elements without text of the page (SKIP) are left out with all they hold, also where they nest.  One that is never closed
    leaves out the words up to the next block or its parent's end; only RAW ones reach to the page's end.
    """
    closed: dict[str, dict[int, int]] = {}
    out: list[Block] = []
    text: list[str] = []
    stack: list[tuple[str, int, int, bool, bool]] = []  # tag, boilerplate, article, inline, marked
    noise = main = link = 0  # enclosing containers; open links
    link_words = 0
    skipped = 0  # open inline boilerplate
    at, end = 0, len(page)

    def flush(heading: bool = False) -> None:
        nonlocal link_words
        if text:
            joined = " ".join(_html.unescape("".join(text)).split())
            if joined:
                out.append(Block(joined, link_words, noise, main, any(s[0] in HEADINGS for s in stack), any(s[4] for s in stack)))
            text.clear()
        link_words = 0

    def pop() -> None:
        nonlocal noise, main, skipped
        _, n, m, inline, _ = stack.pop()
        if inline:
            skipped -= 1
        noise -= n
        main -= m

    while at < end:
        m = _TAG.search(page, at)
        upto = m.start() if m else end
        if upto > at and not skipped:
            piece = page[at:upto]
            text.append(piece)
            if link:
                link_words += len(piece.split())
        if not m:
            break
        at = m.end()
        tag = m[2].lower() if m[2] else None
        if tag is None:
            continue
        if m[1]:  # end tag
            if tag == "a":
                link = max(0, link - 1)
            elif tag == "br":
                text.append(" ")
            if any(s[0] == tag for s in stack):
                if tag in BLOCK:
                    flush()
                while True:
                    last = stack[-1][0]
                    if stack[-1][3] is False:
                        flush()
                    pop()
                    if last == tag:
                        break
            elif tag in BLOCK:
                flush()
            continue
        attrs = m[3] or ""
        if tag in SKIP:
            if attrs.endswith("/"):
                continue
            if tag in RAW or tag == "head":
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                if tag == "head" and close is None:  # an unclosed head ends where the body begins
                    close = re.compile(r"(?=<body[\s>])", re.I).search(page, at)
                at = close.end() if close else end
                continue
            if tag not in closed:
                closed[tag] = _closed(page, tag)
            if at in closed[tag]:
                at = closed[tag][at]
            else:
                stack.append((tag, 0, 0, True, False))
                skipped += 1
            continue
        if tag == "br":
            if not skipped:
                text.append(" ")
            continue
        if tag == "a":
            link += 1
        bad, good, marked = _marks(tag, attrs)
        if tag in BLOCK:
            flush()
            ends = CLOSES.get(tag, {"p", "option", "optgroup"})
            while stack and stack[-1][0] in ends:
                pop()
            while stack and stack[-1][3]:  # inline boilerplate ends with its block
                pop()
            if tag in VOID:
                continue
            is_main = tag in MAIN_TAGS or good
            is_noise = tag in NOISE_TAGS or bad or (tag == "header" and not main)
            if tag in ("body", "html"):
                is_main = is_noise = False
            stack.append((tag, int(is_noise), int(is_main and not is_noise), False, marked))
            noise += int(is_noise)
            main += int(is_main and not is_noise)
        elif bad and tag not in VOID and not attrs.endswith("/"):
            stack.append((tag, 0, 0, True, False))
            skipped += 1
    flush()
    return out


def features(bs: list[Block]) -> list[tuple[float, ...]]:
    """Per block: words, link density, both of the block before and after, heading, boilerplate, article, page has an article."""
    has_main = float(any(b.main and not b.noise for b in bs))
    out = []
    for i, b in enumerate(bs):
        p = bs[i - 1] if i else None
        n = bs[i + 1] if i + 1 < len(bs) else None
        out.append((float(b.words), b.links, float(p.words if p else 0), p.links if p else 0.0,
                    float(n.words if n else 0), n.links if n else 0.0, float(b.heading), float(b.noise > 0),
                    float(b.main > 0), has_main))
    return out


# ---------------------------------------------------------------------------
# Decision tree: (feature, threshold, left, right) or the class at a leaf.
# ---------------------------------------------------------------------------


def grow(x: list[tuple[float, ...]], y: list[int], depth: int = 7):
    """CART with Gini impurity; ties take the first feature and threshold."""
    ones = sum(y)
    if depth == 0 or ones in (0, len(y)):
        return int(2 * ones > len(y))
    best = None
    for f in range(len(x[0])):
        values = sorted({r[f] for r in x})
        for lo, hi in zip(values, values[1:]):
            cut = (lo + hi) / 2
            left = [b for r, b in zip(x, y) if r[f] <= cut]
            a, n = sum(left), len(left)
            b, m = ones - a, len(y) - n
            impurity = a * (n - a) / n + b * (m - b) / m
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, cut)
    if best is None:
        return int(2 * ones > len(y))
    _, f, cut = best
    side = [r[f] <= cut for r in x]
    part = lambda s: ([r for r, t in zip(x, side) if t is s], [b for b, t in zip(y, side) if t is s])
    return f, cut, grow(*part(True), depth - 1), grow(*part(False), depth - 1)


def decide(tree, row: tuple[float, ...]) -> int:
    while not isinstance(tree, int):
        f, cut, left, right = tree
        tree = left if row[f] <= cut else right
    return tree


_S = "one two three four five six seven eight nine ten, "  # filler of ten words
#: The labelled table: small pages; elements with data-main hold the main text.
EXAMPLES = [
    f"<nav><a>Home</a> <a>News</a></nav><article data-main><h1>Title here</h1><p>{_S * 3}</p><p>Short end.</p></article><footer>&copy; site {_S}</footer>",
    f"<div class=ad>{_S * 2}</div><article data-main><h1>A title</h1><p>{_S}</p><p><a>{_S}</a></p><p>Yes.</p></article><div class=ad>Buy now</div><footer>x</footer>",
    f"<header><h1>Site name</h1><p>{_S}</p></header><main data-main><h2>Head</h2><p>{_S * 8}</p><ul><li>One</li><li><a>Two</a></li></ul></main><aside><p>{_S * 5}</p></aside>",
    f"<div class=menu><a>A</a><a>B</a></div><div class=content data-main><p>Tiny.</p><p>{_S * 6}</p></div><div id=comments><p>{_S * 4}</p><p>I agree.</p></div>",
    f"<p>Site bar</p><article><div data-main><p>{_S * 4}</p><p>End.</p></div><div class=share>Share this <a>now</a></div><form>{_S}</form></article><p>{_S * 2}</p>",
    f"<article><div data-main><h1>Big</h1><p>Of.</p><p>{_S * 20}</p></div><section class=comments><p>{_S * 9}</p></section></article><p>More on this {_S}</p>",
    f"<div><a>Home</a> <a>About</a></div><div data-main><h1>Plain page title</h1></div><div data-main><p>{_S * 4}</p><p>{_S * 7}</p><p>{_S * 2}</p></div><div><a>Next</a> <a>Top</a></div><div>Site 2020</div>",
    f"<ul><li><a>One link</a></li><li><a>Two</a></li></ul><h2 data-main>Heading words</h2><p data-main>{_S * 5}</p><p data-main>{_S * 3}</p><p><a>{_S}</a></p><p>All rights</p>",
    f"<div><a>{_S * 2}</a></div><p data-main>{_S * 3}</p><p data-main>A short one between.</p><p data-main>{_S * 6}</p><div><a>x</a> | <a>y</a></div>",
    f"<div class=cookie-notice><p>{_S * 3}</p></div><div data-main><p>{_S * 4}</p></div><aside>{_S * 3}</aside><div class=newsletter><p>{_S * 2}</p></div>",
    "<nav><a>Home</a></nav><div><a>Log in</a></div><footer>Site</footer>",
    f"<article data-main><h1>T</h1></article><footer>{_S * 3}</footer><div class=sidebar>{_S * 4}</div>",
    "<article data-main><p>Only block.</p></article>",
    f"<article data-main><p>{_S * 2}</p><p><a>{_S}</a></p></article>",
    f"<article data-main><p><a>First</a></p><p><a>{_S}</a></p><p>{_S * 9}</p><h2>End</h2></article>",
    f"<p>{_S * 9}</p><article data-main><p><a>Linked</a></p></article><p>{_S * 12}</p><h2>Other</h2><p>{_S * 3}</p>",
    f"<h1>Site</h1><p>{_S}</p><p>{_S * 30}</p><main data-main><p>Text.</p><p><a>x</a></p><p>{_S}</p></main><p>{_S * 6}</p>",
    f"<p data-main>{_S * 4}</p><p data-main>{_S * 6}</p>",
    f"<p data-main>{_S * 7}</p><footer><p>{_S * 9}</p></footer>",
    f"<div class=ad>{_S * 7}</div><p data-main>{_S * 9}</p><div class=comments><p>{_S * 8}</p></div><p data-main>{_S * 8}</p>",
    f"<nav><a>Home</a></nav><h1 data-main>The title</h1><p data-main>{_S * 3}</p><p data-main>Ends here.</p><footer>Site</footer>",
    f"<div><a>Home</a></div><p data-main>{_S * 3}</p><div class=related><p>{_S * 4}</p></div><p data-main>{_S * 5}</p><div class=share>{_S}</div>",
    f"<p>Top line</p><p>{_S * 2}</p><p>{_S}</p><article data-main><p><a>a b</a> c</p></article><h3>Read on</h3><p>{_S * 4}</p><p>{_S * 4}</p>",
]


def labelled() -> tuple[list[tuple[float, ...]], list[int]]:
    x, y = [], []
    for page in EXAMPLES:
        bs = blocks(page)
        x += features(bs)
        y += [int(b.marked) for b in bs]
    return x, y


def extract(page: str | None, tree) -> str:
    if not page:
        return ""
    bs = blocks(page)
    return "\n".join(b.text for b, f in zip(bs, features(bs)) if decide(tree, f))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text."""
    tree = grow(*labelled())

    @F.pandas_udf("string")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            yield s.map(lambda page: extract(page, tree), na_action=None)

    return pages.select("page_id", "url", run(F.coalesce("html", F.lit(""))).alias("text"))


def op10(pages: DataFrame) -> DataFrame:
    return main_text(pages).withColumn("n_chars", F.char_length("text").cast("long"))
