"""Pages with excluded and raw elements, closed and not."""

import time

import pytest

from revisit.llm import dom


def runs(source):
    return [t for _, t in dom.Page(source).runs]


@pytest.mark.parametrize("name", ["button", "svg", "video", "audio", "canvas", "object", "select", "template"])
def test_an_unclosed_element_does_not_end_the_page(name):
    assert runs(f"<div><{name}>x</div><article><p>one</p><p>two</p></article>") == ["one", "two"]
    assert runs(f"<{name}>x<article><p>one</p><p>two</p></article>") == ["one", "two"]
    assert runs(f"<article><p>one <{name}>x</p><p>two</p></article><p>three</p>") == ["one", "two", "three"]
    assert runs(f"<{name}>x<article><p>one <{name}>y</{name}>more</p></article>")[0].split() == ["one", "more"]


@pytest.mark.parametrize("name", ["button", "svg", "video", "object"])
def test_a_closed_element_goes_with_all_inside(name):
    page = dom.Page(f"<p>a <{name} class=c>x<div>y<p>z</p></div><a href=u>l</a>w</{name}>b</p><p>c</p>")
    assert [t.split() for _, t in page.runs] == [["a", "b"], ["c"]] and page.tag == ["html", "p", "p"] and page.links == [0, 0]


def test_excluded_elements_nest():
    assert runs("<p>a<svg><g><path/><svg><text>x</text></svg><text>y</text></g></svg>b</p><p>c") == ["ab", "c"]
    assert runs("<p>a<object><video>x<p>y</video>z</object>b</p><p>c") == ["ab", "c"]
    assert runs("<p>a<object><video>x<p>y</object>b</p><p>c") == ["ab", "c"]


def test_raw_text_ends_in_either_case():
    assert runs("<p>İ</p><SCRIPT>if (a<b) '</p>'</SCRIPT><p>one</p><style>x</STYLE ><p>two") == ["İ", "one", "two"]
    assert runs("<title>a</titles></TITLE><p>one") == ["one"]


def test_stray_end_tags_take_no_look_at_the_stack():
    """A look at all open elements per stray tag would take minutes here."""
    n = 60_000
    started = time.process_time()
    page = dom.Page("<div>" * n + "text" + "</section>" * n)
    assert len(page.tag) == n + 1 and [t for _, t in page.runs] == ["text"] and time.process_time() - started < 5
