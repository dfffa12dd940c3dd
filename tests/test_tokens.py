"""The HTML tokenizer: states of the standard, whole links, linear time."""

import time

import pytest

from tabloom.sources import markup, tokens

FORMS = {
    '<a title="x>y" href="/a">1</a>': [("/a", "1")],
    "<a href='/b'>2</a>": [("/b", "2")],
    "<a href=/c>3</a>": [("/c", "3")],
    '<a href="/d" title="p>q">D</a>': [("/d", "D")],
    "<A\nHREF = '/e' href=/no > E <b title='>'>&lt;x</b></A >": [("/e", "E <x")],
    "<a/href=q/>i</a>": [("q/", "i")],
    "<a href=a'b>k</a>": [("a'b", "k")],
    "<a href>m</a>": [("", "m")],
    "<a = href=1>h</a>": [("1", "h")],
    '<a href="/x': [],
    '<a href=">g</a>': [],
    "<a href=1>one<a href=2>two</a>three": [("1", "one"), ("2", "two")],
    "<a name=x>no</a><abbr href=1>no</abbr><a href=2>open": [],
    "<!-- <a href=1>x</a> --><a href=2>y</a>": [("2", "y")],
    "<!--><a href=1>x</a>": [("1", "x")],
    '<a href=1>x<script>"</a>"</script>y</a>': [("1", "xy")],
    "<style><a href=1>x</a></style><title><a href=2>y</a></title>": [],
    "a < b <a href=1>3 < 4</a>": [("1", "3 < 4")],
    "": [],
}


@pytest.mark.parametrize("html", FORMS)
def test_links(html):
    assert tokens.links(html) == FORMS[html]


def test_titles():
    assert tokens.title('<title class="a>b"> x &amp; <b> </title><title>no</title>') == "x & <b>"
    assert tokens.title("<p>none</p>") == ""


@pytest.mark.parametrize("html", ["<div a='b'>" * 100_000, '<a x="' * 100_000, "<!--" * 100_000, "<a " * 100_000, "</p>" * 100_000, "<" * 100_000])
def test_malformed_pages_take_linear_time(html):
    started = time.perf_counter()
    list(tokens.tokens(html))
    assert time.perf_counter() - started < 10


def test_unclosed_posts_take_linear_time():
    reader = markup._PostReader()
    started = time.perf_counter()
    reader.feed("<div class='expando'><span>x</p>" * 20_000 + "<div class='thing'><a class='title' href='/t'>T</a>")
    reader.close()
    assert time.perf_counter() - started < 20
    assert reader.posts[0]["title"] == ["T"]


def test_pages_without_links_have_no_rows(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "<a href=x>X</a>")], "id int, html string")
    assert [tuple(r) for r in markup.page_links(rows, "id").collect()] == [(3, 0, "x", "X")]
