"""Main text of the test pages and of pages with every kind of noise."""

import html
import re
import time

import pytest

from innledger.llm import html_text
from innledger.llm.queries import QUERIES


def plain(page):
    """The article of a test page, which has only these tags in it."""
    inside = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    if not inside:
        return ""
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inside[1].replace("<br>", " ")))
    found = (" ".join(html.unescape(x).split()) for x in parts)
    return "\n".join(x for x in found if x)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op6_html_extraction"](spark, sf).collect()
    assert {r.page_id for r in rows} == set(pages) and len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url and r.text == plain(pages[r.page_id].html)
        assert r.n_chars == len(r.text)


LONG = "A sentence of the article that is long enough to count, with commas, and an end. " * 3
NOISE = [
    "<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>About us</a></li></ul></nav>",
    "<header>Site name and motto</header>", "<footer>&copy; somebody</footer>",
    "<aside>Side remarks that go on and on</aside>", "<div class='cookie-notice'>We use cookies</div>",
    "<div class=\"ad\">Buy this now, it is cheap</div>", "<form><p>Name</p><input name=x></form>",
    "<script>var x = '<p>no</p>';</script>", "<style>p { color: red }</style>",
    f"<div id='comments'><p>{LONG}</p><p>{LONG}</p></div>", "<!-- <p>hidden</p> -->",
    "<div role=alert>Notice!</div>", "<div style='display: none'>unseen</div>", "<p hidden>unseen</p>",
    f"<section class='related posts'><p>{LONG}</p></section>", "<select><option>a<option>b</select>",
]


@pytest.mark.parametrize("wrap", ["article", "main", "div class=entry", "section"])
def test_noise_of_every_kind(wrap):
    name = wrap.split()[0]
    core = f"<h1>Title &amp; more</h1><p>{LONG}<p>{LONG}<b>Bold</b> end<br>after<ul><li>One<li>Two</ul>"
    page = (
        "<html><head><title>No</title></head><body>" + "".join(NOISE)
        + f"<{wrap}>{core}{''.join(NOISE)}</{name}>" + "".join(NOISE) + "</body></html>"
    )
    text = LONG.strip()
    want = ["Title & more", text, f"{text} Bold end after", "One", "Two"]
    assert html_text.main_text(page).split("\n") == want


def test_links_weigh_less_than_text():
    links = "<div><p>" + "".join(f"<a href=/{i}>a link with a long text</a> " for i in range(40)) + "</p></div>"
    page = f"<body>{links}<div><p>{LONG}</p><p>{LONG}</p></div>{links}</body>"
    assert html_text.main_text(page) == "\n".join([LONG.strip()] * 2)


def test_odd_pages(spark):
    pages = [
        (1, "u", None, "a", 1), (2, None, "", "a", 1), (3, "u", "no tags at all", None, None),
        (3, "u", "no tags at all", None, None), (None, "u", "<p>one<p>two", "a", 1),
        (4, "u", "<div>" * 3000 + "deep" + "</div>" * 2000, "a", 1), (5, "u", "<p>" + "x " * 300_000, "a", 1),
        (6, "u", "<p title=\"a>b\" class='>'>quoted</p>", "a", 1), (7, "u", "<a '<a \"<p>open > quote", "a", 1),
        (8, "u", "1 < 2 and 3 > 2 <> </> </p></div>", "a", 1), (9, "u", "<p>un<!-- c -->cut&nbsp;&#65;&eacute;", "a", 1),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, density string, sum int")
    rows = html_text.extracted(df).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == len(pages) and got[3].density is None
    assert [got[i].text for i in (1, 2, 3, None, 4, 6)] == ["", "", "no tags at all", "one\ntwo", "deep", "quoted"]
    assert got[5].n_chars == 599_999 and got[9].text == "uncut Aé"
    assert got[8].text.startswith("1 < 2 and 3 > 2")
    assert html_text.extracted(df.limit(0)).collect() == []


def test_unclosed_quotes_take_no_long():
    start = time.process_time()
    html_text.main_text("<a '\"" * 20_000)
    html_text.main_text("<a '\"" * 1_000 + ">")
    assert time.process_time() - start < 20


def paragraphs(n, size=200):
    return [(f"Paragraph {k} " + "of plain words " * size)[:size].strip() for k in range(n)]


def test_sections_below_a_heading():
    first, second = paragraphs(6), [x.replace("plain", "other") for x in paragraphs(6)]
    section = lambda texts: "<div>" + "".join(f"<p>{x}</p>" for x in texts) + "</div>"
    inside = f"<h1>Title</h1><p>Lead paragraph.</p>{section(first)}{section(second)}"
    links = "<div>" + "".join(f"<p><a href=/{i}>a link with a long text</a></p>" for i in range(20)) + "</div>"
    want = ["Title", "Lead paragraph.", *first, *second]
    for page in (f"<div id=content>{inside}</div>", f"<body>{inside}</body>", f"{links}<div id=content>{inside}</div>{links}"):
        assert html_text.main_text(page).split("\n") == want
    page = f"<div id=content>Own text <a href=/>linked</a><p><a href=/>Home</a></p>{section(first)}{section(second)}</div>"
    assert html_text.main_text(page).split("\n") == ["Own text linked", *first, *second]


def test_several_articles():
    parts = [[f"Title {k}", *(x.replace("plain", f"plain{k}") for x in paragraphs(4 + k))] for k in range(3)]
    article = lambda p: f"<article><h2>{p[0]}</h2>" + "".join(f"<p>{x}</p>" for x in p[1:]) + "</article>"
    links = "<div>" + "".join(f"<p><a href=/{i}>a link with a long text</a></p>" for i in range(20)) + "</div>"
    page = f"<body>{links}{''.join(map(article, parts))}{links}</body>"
    assert html_text.main_text(page).split("\n") == sum(parts, [])


def test_text_blocks_outside_the_core():
    text = paragraphs(1, 400)[0]
    links = "".join(f"<p><a href=/{i}>a link with a long text</a></p>" for i in range(20))
    page = f"<div>{links}<blockquote>{text}</blockquote></div><div>" + "".join(f"<p>{x}</p>" for x in paragraphs(5)) + "</div>"
    assert html_text.main_text(page).split("\n") == [text, *paragraphs(5)]


def test_class_words_are_evidence():
    """Words of noise in other names do not cut an article; names of noise alone do."""
    texts = paragraphs(4)
    inside = (
        f"<h1>Title</h1><p>{texts[0]}</p>"
        f"<section class='related-work'><h2>Related work</h2><p>{texts[1]}</p></section>"
        f"<div class='share-price-table'><p>{texts[2]}</p></div>"
        f"<p class=notice>{texts[3]}</p><p>{texts[0]}</p>"
    )
    noise = (
        f"<div class=relatedPosts><p>{LONG}</p></div><div class='ad-slot-300x250'>Buy</div>"
        f"<div class='post-comments'><p>{LONG}</p></div><div id=cookieNotice><p>{LONG}</p></div>"
        "<ul class='share-on-mastodon'><li><a href=/>Share this on one</a><li><a href=/>or the other</a></ul>"
        f"<p class='advert'>{LONG}</p><div class='site-notice-bar'>{LONG}</div>"
    )
    want = ["Title", texts[0], "Related work", *texts[1:], texts[0]]
    for wrap in ("article", "main", "div", "section", "div class=story"):
        page = f"<body>{noise}<{wrap}>{inside}{noise}</{wrap.split()[0]}>{noise}</body>"
        assert html_text.main_text(page).split("\n") == want


def test_the_core_may_have_any_class():
    texts = paragraphs(6)
    page = f"<div id='menu-of-the-week'>{''.join(f'<p>{x}</p>' for x in texts)}</div><nav>Home</nav>"
    assert html_text.main_text(page).split("\n") == texts


def test_columns_of_the_same_names_are_replaced(spark):
    pages = spark.createDataFrame([("old", 1, "<p>A b</p>", "x")], "text string, n_chars int, html string, other string")
    assert html_text.extracted(pages).first().asDict() == {"other": "x", "text": "A b", "n_chars": 3}
