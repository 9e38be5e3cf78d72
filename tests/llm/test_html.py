"""Main text of small pages."""

import pytest

from starmart.llm.html_text import main_text, page_texts

PAGES = [
    ("", ""), ("plain text", "plain text"), ("<p>only</p>", "only"), ("<b>", ""),
    ("<nav><a href=x>Menu</a></nav><article><h1>T</h1><p>a &lt; b &amp;\n c<script>x</script> d<p>e<form>q</form></article><footer>f</footer>", "T\n\na < b & c d\n\ne"),
    ("<div class=sidebar>x y z</div><div><p>Hello   world this is text long enough.</p><p>two</p></div><div class='comments'><p>nice</p></div>", "Hello world this is text long enough.\n\ntwo"),
    ("<body class='sidebar-page'><main><p>x</p><aside>y</aside></main></body>", "x"),
    ("<article><header><h1>T</h1><span>by me</span></header><p>one<br>two</p><div class='ad'>buy</div></article>", "T\n\none two"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\n\nc"), ("<ul><li>one<li>two</ul><p>three", "one\n\ntwo\n\nthree"),
    ("<article><p>main</p><article class=comment>reply</article></article>", "main"),
]


@pytest.mark.parametrize(("html", "text"), PAGES)
def test_main_text(html, text):
    assert main_text(html) == text


def test_pages(spark):
    rows = [(1, "u", "<article><p>é</p></article>", "x"), (None, None, None, "x"), (2, "v", "", "x"), (2, "v", "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in page_texts(df).collect())
    assert got == [(0, None, "", 0), (1, "u", "é", 1), (2, "v", "", 0), (2, "v", "", 0)]
    assert page_texts(df.limit(0)).count() == 0


LONG = "This sentence stands for one of the long paragraphs of the page's text. " * 4
TEASER = "<article><a href=x>A teaser card of a few words</a></article>"


def test_text_outside_articles_is_compared_with_them():
    body = f"<p>{LONG}</p><p>short</p><p>{LONG}</p>"
    want = f"{LONG.strip()}\n\nshort\n\n{LONG.strip()}"
    for page in (f"<div>{body}</div>{TEASER}", f"{TEASER}<div>{body}</div>", f"<div><p>{LONG}</p>{TEASER}<p>short</p><p>{LONG}</p></div>"):
        assert main_text(page) == want
    # Little text outside goes, as much as the article's stays.
    assert main_text(f"<div>some words outside</div><article>{body}</article>") == want
    assert main_text(f"<article><p>{LONG}</p></article><div><p>{LONG}</p></div>") == f"{LONG.strip()}\n\n{LONG.strip()}"


def test_article_of_many_short_lines_stays_beside_one_long_line():
    items = "".join(f"<li><a href=x>Item {k} has</a> <b>few</b> <i>words</i></li>" for k in range(30))
    page = f"<article><p>{LONG * 2}</p><p>a</p><p>b</p><p>c</p></article><article><ul>{items}</ul></article>"
    assert all(f"Item {k} has few words" in main_text(page) for k in range(30))


@pytest.mark.parametrize(
    "page",
    [
        "<main class='has-sidebar'>{}</main>", "<article class='post comments-open'>{}</article>", "<div class='content-sidebar-wrap'><article>{}</article></div>",
        "<div id='search-layout'><p>x</p>{}</div>", "<div class='widget'><article>{}</article></div>", "<article class='sponsored'>{}</article>",
        "<div class='header-layout'><main>{}</main></div>", "<div class='header'><div class='search'>{}</div></div><div class='sidebar'>few words</div>",
        "<div class='sidebar'>few words</div><main><div role='search'>{}</div></main>",
    ],
)
def test_names_do_not_drop_the_text(page):
    assert LONG.strip() in main_text(page.format(f"<p>{LONG}</p>"))
    assert "few words" not in main_text(page.format(f"<p>{LONG}</p>"))


def test_names_still_drop_parts():
    for name in ("sidebar", "site-footer", "searchBox", "comments comments-2", "ADS"):
        assert main_text(f"<div><p>{LONG}</p><div class='{name}'>few words</div></div>") == LONG.strip()
    comments = "<div class='comments'><article class='comment'>few words</article></div>"
    assert main_text(f"<article><p>{LONG}</p>{comments}</article>") == LONG.strip()


def test_text_all_in_named_elements_stays():
    got = main_text(f"<div class='sidebar'><p>{LONG}</p></div><div class='widget'><p>{LONG}</p></div>")
    assert got.count(LONG.strip()) == 2
    assert main_text("<nav class='menu'>x</nav><div hidden>y</div>") == ""


def test_math_stays():
    assert main_text("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p></article>") == "so x=1 holds"
