from __future__ import annotations

import re
from html import unescape

import __spark_entry__ as contract
import numpy as np
import pytest
from llm_helpers import SMALL, table
from reviewlens.llm import dom, pagetext

LOREM = ("It was late in the day when the ship came in, and nobody on the quay had expected her. The captain, a small "
         "man with a red face, said that the wind had been kind; the crew said nothing at all. ")


@pytest.fixture(scope="module")
def model(spark):
    return pagetext.fit(spark.read.parquet(f"{SMALL}/pages.parquet"))


def text(spark, model, html):
    return pagetext.main_text(spark.createDataFrame([(1, html)], "page_id int, html string"), model).first().text


def test_query_gives_the_article(spark):
    got = {r.page_id: r for r in contract.queries()["op4_page_text"](spark, SMALL).collect()}
    pages = table("pages")
    assert len(got) == len(pages)
    for key, url, html in zip(pages.page_id, pages.url, pages.html):
        body = re.search(r"<article>(.*?)</article>", html, re.S)[1].replace("<br>", " ")
        body = re.sub(r"<[^>]*>", "", re.sub(r"</?(h1|p)>", "\x01", body))
        want = "\n".join(b for b in (" ".join(unescape(x).split()) for x in body.split("\x01")) if b)
        assert (got[key].text, got[key].n_chars, got[key].url) == (want, len(want), url)


def test_other_parts_go(spark, model):
    html = f"""<html><head><title>T</title></head><body>
      <header><a href=/>Home</a> Site name</header><nav class="main-nav"><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
      <div class="cookie-notice">We use cookies. <button>OK</button></div>
      <main><h1>The &quot;ship&quot;</h1><p>{LOREM}<p>She &lt;the ship&gt; was <b>old</b>,&nbsp;<i>very</i>
        old.<br>{LOREM}<script>var x = "</p>";</script><style>p{{}}</style>
        <div class="ad banner">Buy now, {LOREM}</div><form><label>Mail</label><input name=m></form>
        <aside>Related: {LOREM}</aside><p>{LOREM}</p></main>
      <section id="comments"><h2>Comments</h2><div class="comment"><p>{LOREM}</p></div></section>
      <div class="sidebar"><p>{LOREM}</p></div><footer>(c) 2024 {LOREM}</footer></body></html>"""
    line = LOREM.strip()
    assert text(spark, model, html) == f'The "ship"\n{line}\nShe <the ship> was old, very old. {line}\n{line}'


@pytest.mark.parametrize("start, end", [
    ("<form id=aspnetForm>", "</form>"), ("<div class='layout has-sidebar'>", "</div>"),
    ("<main class='no-sidebar'>", "</main>"), ("<div class='post meta related'>", "</div>")])
@pytest.mark.parametrize("inner", ["article", "div"])
@pytest.mark.parametrize("all_of_it", [True, False])
def test_the_text_stays_inside_a_wrapper_named_like_no_text(spark, model, start, end, inner, all_of_it):
    links = "".join(f"<li><a href={k}>Link {k}</a></li>" for k in range(6))
    line = (LOREM * 2).strip()
    head = f"<nav><ul>{links}</ul></nav><div class=ad>Buy now.</div>"
    body = f"<{inner}>" + f"<p>{line}</p>" * 6 + f"</{inner}>"
    side = f"<div class=sidebar><p>{LOREM}</p></div><footer>(c) 2024</footer>"
    html = f"{start}{head}{body}{side}{end}" if all_of_it else f"{head}{start}{body}{end}{side}"
    assert text(spark, model, html) == "\n".join([line] * 6)


def test_lessons_of_wrapped_pages():
    page = pagetext.read_page(f"<form><nav>a</nav><article><p>{LOREM}</p><p>{LOREM}</p></article></form>")
    assert page.label.tolist() == [False, False, False, True, True, True]
    side = pagetext.read_page(f"<article><p>{LOREM * 4}</p></article><aside><article><p>{LOREM}</p></article></aside>")
    assert side.label.tolist() == [False, True, True, False, False, False]
    for inner in (page.tree, pagetext.plain(page.tree)):
        outer, order = pagetext.wrapped(inner, [3])
        assert order.tolist() == [0, 1, 2, -1, 3, 4, 5] and outer.parent == [-1, 0, 1, 1, 3, 4, 4]
        whole, order = pagetext.one_wrapper(inner)
        assert order.tolist() == [0, -1, 1, 2, 3, 4, 5] and whole.parent == [-1, 0, 1, 2, 2, 4, 4]
    more = pagetext.with_copy(page.tree, [4])
    assert more.parent == [-1, 0, 1, 1, 3, 3, 0, 6] and pagetext.page_of(more).letters[6] == len(LOREM)


def test_a_page_without_telling_names(spark, model):
    links = "".join(f"<li><a href={k}>Link {k}</a></li>" for k in range(12))
    html = f"<div><ul>{links}</ul></div><div>" + f"<p>{LOREM * 3}</p>" * 5 + "</div>"
    got = text(spark, model, html)
    assert "\n".join([(LOREM * 3).strip()] * 5) in got


def test_no_text_is_kept_inside_a_dropped_part():
    rng = np.random.default_rng(0)
    page = pagetext.read_page(f"<article><div><p>{LOREM}</p><ul><li>a<li>b</ul></div><div><p>x</p></div></article><div>y</div>")
    for _ in range(50):
        odds = rng.normal(size=len(page.tree.tag)) * 3
        kept = pagetext.decode(page, odds, 3.0)
        assert all(kept[page.tree.parent[i]] or page.tree.parent[i] == 0 or not kept[i] for i in range(1, len(kept)))


def test_markup_that_is_not_well_formed():
    tree = dom.parse("<p>a<div>b</p>c<b>d<p>e</b>f<li>g<li>h</ul></div>i<!-- <p>j --><td>k<br/>l<p")
    said = dom.text_of(tree.parts, [True] * len(tree.tag))
    assert said.split("\n") == ["a", "b", "cd", "ef", "g", "h", "i", "k l"]
    assert dom.text_of(dom.parse("a < b & c &amp; d <3").parts, [True]) == "a < b & c & d <3"
    assert dom.parse("<script>never closed <p>x").parts == []
    deep = dom.parse("<div>" * 3000 + "x" + "</div>" * 3000)
    assert len(deep.tag) == 3001
    assert dom.names_of(' class="navBar main-menu" id=top2') == {"nav", "bar", "main", "menu", "top", "2"}


def test_nulls_long_pages_repeated_rows_and_clashing_columns(spark, model):
    rows = [(None, None, None, "t"), (1, "u", "", "t"), (1, "u", "", "t"), (2, "u", "plain words only", "t"),
            (3, "u", f"<article>{f'<p>{LOREM}</p>' * 3000}</article>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = pagetext.main_text(pages, model)
    out = got.collect()
    assert got.columns == ["page_id", "url", "html", "text"] and len(out) == 5
    assert [out[i].text for i in range(3)] == ["", "", ""]
    assert out[4].text == "\n".join([LOREM.strip()] * 3000)
    nothing = pagetext.fit(pages.filter("1 = 0"))
    assert pagetext.main_text(pages.filter("1 = 0"), nothing).collect() == []
    named = f"<nav>x</nav><p>{LOREM}</p>"
    assert text(spark, nothing, named) == LOREM.strip()


LINKS = "".join(f"<li><a href={k}>Source number {k} of this text</a></li>" for k in range(8))


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_links_in_the_article_stay(spark, scale):
    """Links in a paragraph, lists of sources, tables of links: all of the article comes out."""
    fitted = pagetext.fit(spark.read.parquet(f"/root/testdata/{scale}/pages.parquet"))
    line = LOREM.strip()
    bodies = {
        f"<h1>A title</h1><p>{LOREM}</p><p>{LOREM}</p><p>See <a>the first source</a>.</p>":
            ["A title", line, line, "See the first source."],
        f"<h1>A title</h1><p>{LOREM}</p><p>{LOREM}</p><ul>{LINKS}</ul>":
            ["A title", line, line, *[f"Source number {k} of this text" for k in range(8)]],
        f"<p>{LOREM}</p><p><a href=x>{LOREM}</a> {LOREM}</p><p>{LOREM}</p>": [line, f"{line} {line}", line],
        f"<p>{LOREM}</p><table><tr><td><a href=1>One name</a></td><td><a href=2>Two names</a></td></tr></table><p>{LOREM}</p>":
            [line, "One name Two names", line],
    }
    nav = "<nav><ul>" + "".join(f"<li><a href={k}>Page {k}</a></li>" for k in range(6)) + "</ul></nav>"
    for body, want in bodies.items():
        for head, foot in (("", ""), (nav, "<footer>(c) us</footer>")):
            html = f"<body>{head}<article>{body}</article>{foot}</body>"
            assert text(spark, fitted, html).replace("\n", " ") == " ".join(want)


@pytest.mark.parametrize("odds", [-3.0, 3.0])
def test_a_kept_article_never_loses_all_its_blocks(odds):
    page = pagetext.read_page(f"<nav>x y</nav><div><article><p>{LOREM}</p><aside>Buy</aside><ul><li>a</li></ul></article></div>")
    scores = np.array([2.0 if t == "article" else -3.0 for t in page.tree.tag])
    scores[page.tree.tag.index("div")] = odds
    kept = pagetext.decode(page, scores, 3.0)
    said = dom.text_of(page.tree.parts, kept)
    assert LOREM.strip() in said and "Buy" not in said and "x y" not in said
