"""Main text of pages with unusual markup, and in languages without stop words."""

import time
from html.parser import HTMLParser

import pytest

from finlake.llm import pages
from tests.llm.test_methods import LONG, page
from tests.oracle import connect

ITALIAN = "Questa mattina il sindaco della nostra piccola citta ha presentato ai cittadini riuniti nella piazza grande tutte le opere previste dal bilancio comunale: strade, scuole, giardini pubblici, illuminazione nuova, tetti riparati."
CHINESE = "今天上午市政府在中心广场向市民介绍了明年的预算和全部工程计划。" * 8
RUSSIAN = "Сегодня утром глава города рассказал жителям о планах строительства новых школ и дорог, которые появятся через год. " * 3


@pytest.mark.parametrize("body, want", [
    (f"<article><svg class=icon/><p>{LONG}</p></article>", [LONG]),
    (f"<article><math/><p>{LONG}</p></article>", [LONG]),
    (f"<article><p>a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b</p><p>{LONG}</p></article>", ["a x=2 b", LONG]),
    (f"<article><p>{LONG}</p><figure><img src=a><figcaption>A caption.</figcaption></figure></article>", [LONG, "A caption."]),
    (f"<article><p>{LONG}</p></article><figure><figcaption>Not inside.</figcaption></figure>", [LONG]),
    (f"<article><div><svg class=icon><path d=x></div><p>{LONG}</p></article>", [LONG]),
    (f"<article><svg><path d=x><p>{LONG}</p></article>", [LONG]),
    (f"<article><div><video src=x>no video</div><p>{LONG}</p></article>", [LONG]),
    (f"<article><div><svg><foreignObject><div>x</div></foreignObject><svg></svg></svg>y</div><p>{LONG}</p></article>", ["y", LONG]),
    (f"<article><p>{LONG}</p><script>var a = '<p>no</p>';</article>", [LONG]),
])
def test_markup(body, want):
    assert pages.extract(page(body)) == "\n\n".join(" ".join(w.split()) for w in want)


@pytest.mark.parametrize("text", [ITALIAN, CHINESE, RUSSIAN])
def test_languages_without_stop_words(text):
    body = f"<ul><li><a href=a>Home page of all things</a></li></ul><div><p>{text}</p><p>{text}</p></div>"
    assert pages.extract(page(body)) == "\n\n".join([text.strip()] * 2)


def test_junk_is_left_out_where_the_language_is_known():
    junk = "zzkx qwrt plmk vbnh " * 20
    assert pages.extract(page(f"<div><p>{LONG}</p><p>{junk}</p></div>")) == " ".join(LONG.split())


WHOLE = " ".join(LONG.split())


@pytest.mark.parametrize("body, want", [
    ('<body class="single no-sidebar"><p>{}</p></body>', [WHOLE]),
    ('<article class="post has-comments"><p>{}</p></article>', [WHOLE]),
    ('<article class="post category-social tag-search"><p>{}</p></article>', [WHOLE]),
    ('<article data-id="comment-12"><p>{}</p></article>', [WHOLE]),
    ('<article title="a hidden gem"><p>{}</p></article>', [WHOLE]),
    ("<nav><a href=x>Home</a><article><p>{}</p></article>", [WHOLE]),
    ("<nav><a href=x>Home</a><main><p>{}</p></main>", [WHOLE]),
    ("<aside>See <article>a card</article></aside><article><p>{}</p></article>", [WHOLE]),
    ("<article><p>{}</p><p><a href=x>The link of it</a></p></article>", [WHOLE, "The link of it"]),
    ("<article><p>{}</p><ul><li><a href=x>One</a><li><a href=x>Two</a><li><a href=x>Three</a></ul></article>", [WHOLE]),
    ("<article><a href=x>teaser</a></article><div><p>{0}</p><p>{0}</p></div>", [WHOLE, WHOLE]),
    ('<form id="aspnet"><div><p>{}</p></div></form>', [WHOLE]),
    ('<div class="wrapper with-sidebar"><p>{}</p><div class="sidebar">x y z</div></div>', [WHOLE]),
    ('<div class="sidebar-left"><div class="content"><p>{}</p></div></div>', [WHOLE]),
    ('<article><p>{0}</p></article><div class="comment-list"><p>{0}</p><p>{0}</p></div>', [WHOLE]),
    ('<p>{}</p><div class="siteFooter">x</div><div style="display: none">y</div><div hidden>z</div>', [WHOLE]),
    ("<article><p>A.</p></article><footer>The long footer of the page, which is longer than all of it.</footer>", ["A."]),
    ("<noscript><p>Switch it on.</p></noscript><p>{}</p>", [WHOLE]),
    ('<p>{}</p><b title="an unclosed quote><p>it goes on</p>', [WHOLE, "it goes on"]),
    ("<article><p>{}</p><!-- never closed <p>and on</p></article>", [WHOLE, "and on"]),
])
def test_ordinary_markup_loses_nothing(body, want):
    assert pages.extract(page(body.format(LONG))) == "\n\n".join(want)


HOSTILE = {
    "svg": "<svg><p>x", "ends": "<div></section>", "navs": "<nav>x", "quotes": "<a \"' ", "angles": "<", "comments": "<!--", "frames": "<iframe>",
    "raw": "<title>", "sections": "<![CDATA[", "paragraphs": "<p>the of and to x", "lists": "<ul><li>", "parts": "<article><div class=ad>x",
    "entities": "&amp", "attributes": "<p a = b class='no-sidebar x'>",
}


@pytest.mark.parametrize("unit", HOSTILE.values(), ids=HOSTILE)
def test_time_grows_with_the_page(unit):
    """Four times the page takes about four times as long, whatever stays open."""
    seconds = []
    for size in (100_000, 400_000):
        started = time.perf_counter()
        pages.extract("<div>" * 1000 + unit * (size // len(unit)))
        seconds.append(time.perf_counter() - started)
    assert seconds[1] < 10 * seconds[0] + 0.5


class Tree(HTMLParser):
    """A plain extractor for pages whose article is marked: text of the article by block, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.text, self.inside, self.skip = [], [], False, 0

    def flush(self):
        for part in "".join(self.text).split("\0"):
            if clean := " ".join(part.split()):
                self.out.append(clean)
        self.text = []

    def handle_starttag(self, tag, attributes):
        if tag in ("p", "h1", "h2", "div", "ul", "li", "blockquote", "article"):
            self.flush()
        self.inside |= tag == "article"
        if tag in ("script", "style", "nav", "aside", "form", "footer") or dict(attributes).get("class") in ("ad", "comments", "sidebar", "cookie"):
            self.skip += 1
            self.skipping = tag
        if tag == "br":
            self.text.append("\n")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "h2", "div", "ul", "li", "blockquote", "article"):
            self.flush()
        if tag == "article":
            self.inside = False
        if self.skip and tag == self.skipping:
            self.skip -= 1

    def handle_data(self, data):
        if self.inside and not self.skip:
            self.text.append(data)


def test_all_pages_give_the_text_of_their_parsed_article():
    rows = connect("/root/testdata/sf0.01").execute("select html from pages where html like '%<article>%'").fetchall()
    assert len(rows) > 100
    for (html,) in rows:
        tree = Tree()
        tree.feed(html)
        tree.close()
        tree.flush()
        assert pages.extract(html) == "\n\n".join(tree.out)
