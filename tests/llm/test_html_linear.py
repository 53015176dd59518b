"""The page parser on hostile pages: linear time, and paths as they nest."""

import time

import pytest

from tessera.llm import html_main

MB = 1_000_000
HOSTILE = ['<p ">x ', '<p "> "y', "<p '\">z ", "<div>x", '<a href="', "<i><custom><b></i>z", "<div></span></p></x>t",
           "<main><p>x", "<ul><li>x", "<b>x</i>", "<!-", "<table><tr><td>x", '<div class="a b">x', "< ", "<p =\"'>"]


@pytest.mark.parametrize("unit", HOSTILE)
def test_a_megabyte_of_broken_markup(unit):
    html = unit * (MB // len(unit))
    start = time.time()
    html_main.extract(html, ["html/body/article", "body"])
    long = time.time() - start
    start = time.time()
    html_main.extract(html[:MB // 4], ["html/body/article", "body"])
    # Four times the page: 16 times the time if quadratic. The constant allows for a busy machine.
    assert long < 8 * (time.time() - start) + 1


def test_quotes_in_tags():
    assert html_main.extract("<a title='x > y'>k</a> <b \"c\">l</b>", None) == "k l"
    assert html_main.extract("<p \">one <a href='z>q'>two</a>", None) == "one two"  # a quote without an end hides nothing
    assert html_main.extract("<p title=\"a>b\">one <p \">two", None) == "one two"


def test_paths_join_by_name_and_nest():
    page = html_main.blocks("<div class='w-1/2 c12'><p>one two</p></div><div class='c7 w-1/2'><section><p>three</p></section></div>")
    assert [page.path(v) for v, _, _ in page.blocks] == ["div.c#.w-#|#", "div.c#.w-#|#/section"]
    assert html_main.best_path(page) == "div.c#.w-#|#" and page.find("div.c#.w-#|#/section") == page.blocks[1][0]
    assert [t for _, t, _ in page.under(page.find("div.c#.w-#|#/section"), page.blocks)] == ["three"]
    assert page.find("div/none") is None and page.under(None, page.blocks) == []


def test_the_host_mends_a_page_without_article(spark):
    """No page has an article or main element; one page's own vote is too wide."""
    body = "A sentence of the story that goes on for a while. " * 12
    usual = "<body><div class=story><p>{}</p><p>" + body + "</p></div></body>"
    odd = "<body><div class=story><p>odd</p><p>" + body + "</p></div><div class=box><p>Call our shop today</p></div></body>"
    rows = [(i, f"http://h.com/{i}", usual.format(f"t{i}")) for i in range(9)] + [(9, "http://h.com/9", odd)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_main.extract_main_text(pages).collect()}
    assert got == {**{i: f"t{i} {body.strip()}" for i in range(9)}, 9: f"odd {body.strip()}"}
    assert html_main.extract(odd, None).endswith("shop today")
