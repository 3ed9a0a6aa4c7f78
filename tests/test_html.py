import pytest
from pyspark.sql import functions as F

from deckspark.functions import html as H
from deckspark.plans import corpus as CP


@pytest.fixture()
def found(spark):
    def run(page, make):
        df = spark.createDataFrame([(page,)], "html string").select(H.tokens(H.visible("html")).alias("toks"))
        return df.select(make("toks").alias("x")).first().x

    return run


def texts(name, where=None, nested=False, sep=""):
    return lambda toks: F.transform(H.elements(toks, name, where, nested), lambda e: H.text_of(H.inner(e), sep))


@pytest.mark.parametrize("page,want", [
    ("<div>one <div>two</div> three</div>", ["one two three"]),
    ("a<div>1</div>b<div>2<div>3</div></div>c", ["1", "23"]),
    ("<div>open <p>on", ["open on"]),
    ("</div></div><div>x</div></div>", ["x"]),
    ("<DIV CLASS='a'>x</Div ><divx>no</divx>", ["x"]),
    ('<div title="a > b">x &lt; y</div>', ["x < y"]),
    ("<div/><div>x</div>", ["x"]),
    ("<!-- <div> --><div>x<script>'</div>'</script>y</div>", ["xy"]),
    ("1 < 2 <div>3 < 4</div>", ["3 < 4"]),
    ("", []), (None, []), ("no tags", []),
])
def test_elements_end_at_their_own_tag(found, page, want):
    assert found(page, texts("div")) == want


def test_nested_elements_are_found_with_a_stack(found):
    page = "<ul><li>a<ul><li>b</li><li>c</li></ul></li><li>d"
    assert found(page, texts("li", nested=True)) == ["abc", "b", "c", "d"]
    assert found(page, texts("li")) == ["abc", "d"]
    marked = "<div>0<div class=x>1<div>2</div><div class=x>3</div></div></div>"
    assert found(marked, texts("div", H.has_class("x"), nested=True)) == ["123", "3"]
    assert found(marked, texts("div", H.has_class("x"))) == ["123"]


def test_attributes(found):
    tag = '<a href="/x?a=1&b=2" class=\'big  red\' data-n=5 hidden>'
    get = lambda n: found(tag + "t", lambda toks: H.attribute(F.get(toks, 0), n))
    assert [get(n) for n in ("href", "class", "data-n", "hidden", "id", "n")] == ["/x?a=1&b=2", "big  red", "5", "", None, None]
    has = lambda w: found(tag + "t</a>", lambda toks: F.size(H.elements(toks, "a", w))) == 1
    assert has(H.has_class("red")) and not has(H.has_class("bi")) and has(H.has_attribute("hidden"))
    assert has(H.has_attribute("data-n", "5")) and not has(H.has_attribute("data-n", "6")) and not has(H.has_attribute("id"))


def test_chains_of_searches(found):
    """A section's second view, in it the links of the rows."""
    page = """<section id="top"><div class="view-content">no</div><div class="view-content more">
      <div class="views-row"><b><a rel="bookmark" href="/g/one">1</a></b></div>
      <div class="views-row"><div><a href="/no">x</a><a rel="bookmark" href="/g/two">2</a></div></div></div></section>
      <div class="views-row"><a rel="bookmark" href="/outside">3</a></div>"""

    def hrefs(toks):
        section = H.first(H.elements(toks, "section", H.has_attribute("id", "top")))
        view = F.get(H.elements(section, "div", H.has_class("view-content")), 1)
        rows = H.elements(H.inner(view), "div", H.has_class("views-row"))
        return F.transform(rows, lambda r: H.attribute(F.get(H.first(H.elements(r, "a", H.has_attribute("rel", "bookmark"))), 0), "href"))

    assert found(page, hrefs) == ["/g/one", "/g/two"]
    assert found("<p>none</p>", hrefs) is None


def test_jobs_on_nested_pages(spark):
    page = """<html><h1> T<i>it</i>le </h1><article><div>x</div><p>one <b>two</b><br>three</p><p>no</p></article>
      <ul><li><a href="/a/b">B</a><ul><li> <a href="/c">C</a> tail</li></ul></li><li>plain <a href="/no">n</a></li></ul>
      <div class="l">v1<div>v2</div>v3</div><div class="l">w</div></html>"""
    pages = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string")
    assert [tuple(r) for r in CP.extract_article(pages).orderBy("page_id").collect()] == [(1, "Title", "one two three"), (2, None, None), (3, None, None)]
    assert [tuple(r) for r in CP.extract_items(pages).orderBy("k").collect()] == [(1, 1, "/a/b", "b", "B"), (1, 2, "/c", "c", "C")]
    got = {r.page_id: r.text for r in CP.extract_text(pages, "div", H.has_class("l")).collect()}
    assert got == {1: "v1\nv2\nv3\n\nw", 2: "", 3: ""}


def test_a_page_of_many_elements(found):
    n = 5000
    page = "<div>" * n + "x" + "</div>" * n + "<p>y</p>" * n
    assert found(page, texts("div")) == ["x"]
    assert found(page, lambda toks: F.size(H.elements(toks, "p"))) == n
