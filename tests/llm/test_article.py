"""Main text of pages: the given template against another parser, hand-made pages of other kinds, and broken markup."""

from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import article


class Plain(HTMLParser):
    """Paragraphs and headings inside the article element of the given pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.parts = False, [[]]

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        if tag in ("p", "h1"):
            self.parts.append([])
        if tag == "br":
            self.parts[-1].append(" ")

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside = False
        if tag in ("p", "h1", "article"):
            self.parts.append([])

    def handle_data(self, data):
        if self.inside:
            self.parts[-1].append(data)


def plain(page):
    reader = Plain()
    reader.feed(page)
    reader.close()
    parts = [" ".join("".join(p).split()) for p in reader.parts]
    return "\n\n".join(p for p in parts if p)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_pages(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    want = {(r.page_id, r.url): plain(r.html) for r in pages.collect()}
    got = article.extracted(pages).collect()
    assert {(r.page_id, r.url): r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == pages.count()


LONG = "It was the best of all the days that we had in the town, and there was nothing that they could do about it. " * 3
LANGE = "Es war der beste Tag, den wir in der Stadt hatten, und es gab nichts, was sie dagegen tun konnten, wenn auch nicht alle. " * 3
TEXT, TEXT_DE = LONG.strip(), LANGE.strip()
COOKIES = "<div class='cookie-banner'><p>We use cookies on this site so that we can give you the best of it, and you agree to that if you go on. " + LONG + "</p></div>"
MENU = "<ul class='x'>" + "".join(f"<li><a href='/{i}'>Entry {i}</a></li>" for i in range(8)) + "</ul>"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>No</title>{head}</head><body class='layout with-sidebar'>{body}</body></html>"


CASES = {
    "no article element": (
        f"<header><h2>Site</h2></header>{MENU}<div id='c7'><h1>A title</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p></div>"
        f"<div class='sidebar'><p>{LONG}</p></div><footer>{LONG}</footer>",
        ["A title", TEXT, "Short one.", TEXT],
    ),
    "named content": (f"{COOKIES}<div class='entry-content'><p>Tiny.</p><p>{LONG}</p></div><div><p>{LONG}</p></div>", ["Tiny.", TEXT]),
    "main with form and aside": (
        f"<main><form><p>{LONG}</p><input></form><h1>T</h1><p>{LONG}</p><aside>{LONG}</aside><p>End.</p></main>", ["T", TEXT, "End."],
    ),
    "comments of readers": (
        f"<article><h1>T</h1><p>{LONG}</p><div class='ad'>{LONG}</div><p>So.</p><section id='comments'><article class='comment'><p>{LONG}</p>"
        f"</article></section></article><div class='comment-list'><p>{LONG}</p></div>",
        ["T", TEXT, "So."],
    ),
    "header inside the article": (f"<article><header><h1>T</h1></header><p>{LONG}</p><footer>by me</footer></article>", ["T", TEXT]),
    "related links inside": (f"<article><p>{LONG}</p>{MENU}<p>Bye.</p></article>", [TEXT, "Bye."]),
    "another language": (f"{MENU}<div><p>{LANGE}</p><h3>Weiter</h3><p>{LANGE}</p></div>", [TEXT_DE, "Weiter", TEXT_DE]),
    "references": ("<article><p>a &lt;b&gt; &amp;amp; &eacute;&#x41;&#66; &copy &nbsp; x&hellip;</p></article>", ["a <b> &amp; éAB © x…"]),
    "markup inside words": ("<article><p>un<b>broken</b> wo<!-- no -->rd<br>next <em>\n\tline</em></p>after</article>", ["unbroken word next line", "after"]),
    "breaks": ("<article>one<br><br>two<hr>three<table><tr><td>x<td>y</table></article>", ["one", "two", "three", "x", "y"]),
    "scripts": ("<article><p>a</p><script>if (1<2) { '</p>' }</script><style>p{}</style><noscript>n</noscript><svg><text>s</text></svg><p>b</p></article>", ["a", "b"]),
    "hidden": ("<article><p>a</p><p hidden>b</p><div style='display: none'>c</div><div aria-hidden='true'>d</div></article>", ["a"]),
    "only short": ("<p>Hello there.</p><nav><a href='/'>Home</a></nav>", ["Hello there."]),
    "wrapped by a widget": (f"<div class='widget'><article><p>{LONG}</p></article></div>", [TEXT]),
    "a third language": (f"<div><p>{'Lorem ipsum dolor sit amet consectetur. ' * 8}</p></div>", [("Lorem ipsum dolor sit amet consectetur. " * 8).strip()]),
    "only navigation": (f"<nav>{MENU}</nav>{MENU}", []),
}


@pytest.mark.parametrize("name", CASES)
def test_kinds_of_pages(name):
    body, want = CASES[name]
    assert article.main_text(page(body)).split("\n\n") == (want or [""])


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (None, ""), ("", ""), ("   ", ""), ("just text", "just text"), ("a < b and c", "a < b and c"), ("<article>a<b", "a<b"),
        ("<article><p title='x>y'>a</p><p title=\"b>c</p>d", "a\n\nc\n\nd"), ("<article>x<!-- never closed", "x"), ("<article>x<script>never closed", "x"),
        ("</p></div><article>x</b></article></article>", "x"), ("<ARTICLE><P>x<P>y</ARTICLE>", "x\n\ny"), ("<article><p>a<div>b</div>c</p>d</article>", "a\n\nb\n\nc\n\nd"),
    ],
)
def test_broken_markup(raw, want):
    assert article.main_text(raw) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<a href=x>", "</a>", "<div class='ad'>", "</div>", "<", ">", "<!--", "-->", "'", '"', "x ", LONG, "&am", "<br>", "<script>", "</script>", "<li>", "</"]), max_size=30))
def test_any_markup_gives_blocks(parts):
    for b in article.read_blocks("".join(parts)):
        assert b.text == " ".join(b.text.split()) and b.text


def test_time_grows_with_the_page():
    """Unclosed and unmatched tags don't make the reader go back over the page."""
    for part in ("<b>", "</b>", "<div>", "<a '", "<!-- ", "<x", "</div>", "<p>", "<script ", "</script ", "<b><p></i>"):
        for end in ("", ">", "'>"):
            assert isinstance(article.main_text(part * 40_000 + end), str)


def test_rows(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars bigint"
    rows = [(1, "u", "<article>é😀</article>", "t", 7), (1, "u", "<article>é😀</article>", "t", 7), (None, None, None, None, None), (2, "", "", "", 0)]
    df = spark.createDataFrame(rows, schema)
    got = sorted((tuple(r) for r in article.extracted(df).collect()), key=str)
    assert got == sorted([(1, "u", "é😀", 2), (1, "u", "é😀", 2), (None, None, "", 0), (2, "", "", 0)], key=str)
    assert article.extracted(df.limit(0)).collect() == []
    blocks = article.labelled_blocks(df).collect()
    assert [(b.page_id, b.block, b.text, b.good) for b in blocks] == [(1, 0, "é😀", True)] * 2
