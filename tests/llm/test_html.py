"""Pages whose markup is broken, deep or oddly named keep their text."""

import pytest

from tidepanel.llm import html

BODY = "<body><nav><a href='/'>Home</a></nav>{}<footer>Imprint</footer></body>"
ARTICLE = "<article><h1>Title</h1><p>First words of it.</p><p>Second words of it.</p></article>"
TEXT = "Title\nFirst words of it.\nSecond words of it."


def extracted(spark, pages):
    rows = [(i, f"http://host{i}.example/a", page) for i, page in enumerate(pages)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(got, key=lambda r: r["page_id"])]


CASES = {
    "open head": f"<html><head><meta charset='utf-8'><title>x</title><style>p{{}}</style>{BODY.format(ARTICLE)}</html>",
    "open title": f"<html><head><title>x{BODY.format(ARTICLE)}",
    "open button": BODY.format("<button>" + ARTICLE),
    "open select": BODY.format("<select><option>" + ARTICLE),
    "class that says what there is not": BODY.format(f'<main class="content no-sidebar">{ARTICLE}</main>'),
    "class that says how it is set": BODY.format(ARTICLE.replace("<article>", '<article class="post comments-open share-enabled">')),
    "quote in a value": BODY.format(ARTICLE.replace("<p>First", "<p title='it's fine'>First")),
    "sign in a value": BODY.format(ARTICLE.replace("<p>First", '<p title="a > b" data-x=\'<i>\'>First')),
    "deep": BODY.format("<div>" * 1500 + ARTICLE + "</div>" * 1500),
    "deep and open": BODY.format("<div>" * 1500 + ARTICLE),
    "sidebar beside it": BODY.format(f'<div class="site-sidebar left">Buy now</div><div id="cookie-banner">Yes</div>{ARTICLE}'),
    "script without an end": BODY.format(ARTICLE) + "<script>var a = '<p>no</p>'",
}


@pytest.fixture(scope="module")
def texts(spark):
    return dict(zip(CASES, extracted(spark, list(CASES.values()))))


@pytest.mark.parametrize("name", CASES)
def test_text_of_odd_pages(texts, name):
    assert texts[name] == TEXT


def test_deep_boilerplate_is_still_dropped(spark):
    deep = "<div>" * 1200 + "<div class='advert'>Buy now</div>" + ARTICLE
    assert extracted(spark, [BODY.format(deep), None, "", "no markup at all"]) == [TEXT, "", "", "no markup at all"]


def test_odd_rows_and_clashing_columns(spark):
    rows = [(None, None, None, "x"), (1, "nohost", BODY.format(ARTICLE), "x"), (1, "nohost", BODY.format(ARTICLE), "x"), (2, "http://a.example", "<p>a</p>" * 30_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = sorted(((r["page_id"] or 0, r["text"]) for r in html.extract(df).collect()))
    assert got == [(0, ""), (1, TEXT), (1, TEXT), (2, "\n".join(["a"] * 30_000))]
