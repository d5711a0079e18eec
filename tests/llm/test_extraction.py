"""Frames around the article, neighbours, linear time, and the edge cases of page extraction on Spark."""

import time

import pytest

from corpusloom.llm import extraction as ex

SAY = "Some words of the article stand here, enough of them to be a paragraph of a page."
BODY = f"<h1>A title</h1><p>{SAY}</p><p>Short one.</p><p>{SAY} More.</p>"
WANT = f"A title\n{SAY}\nShort one.\n{SAY} More."
NAV = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
FOOT = "<footer>Copyright of somebody. All of it.</footer>"


@pytest.fixture(scope="module")
def tree(spark):
    return ex.train_tree(spark)


def used(tree):
    return {tree[0]} | used(tree[2]) | used(tree[3]) if isinstance(tree, tuple) else set()


def test_neighbours_decide(tree):
    names = {ex.FEATURES[k] for k in used(tree)}
    assert names & {"words_before", "links_before", "words_behind", "links_behind"}
    menu = "<ul><li><a href='/1'>One</a></li><li><a href='/2'>Two</a></li></ul>"
    page = f"<body>{menu}<h3>Part one</h3><p>{SAY} {SAY}</p><h3>Part two</h3><p>{SAY} {SAY}</p><h3>More links</h3>{menu}</body>"
    text = ex.main_text(page, tree)
    assert "Part one" in text and "Part two" in text and "More links" not in text and "One\n" not in text


@pytest.mark.parametrize("frame", [
    "<div id='page-with-sidebar'><main>{}</main></div>", "<div class='layout menu-open'><article>{}</article></div>", "<form action='/x'><div><article>{}</article></div></form>",
    "<body class='has-sidebar'><article class='post comments-open'>{}</article></body>", "<div class=\"no-sidebar wide\"><article>{}</article></div>", "<article>{}</article>",
])
def test_frames(tree, frame):
    assert ex.main_text(NAV + frame.format(BODY) + FOOT, tree) == WANT


@pytest.mark.parametrize("part", [
    f"<div class='comments'><article class='comment'><p>{SAY}</p></article></div>", f"<form><p>{SAY[:40]}</p></form>", f"<div class='ad'>{SAY}</div>", f"<aside><p>{SAY}</p></aside>",
    f"<div class='cookie-notice'><p>{SAY}</p></div>", f"<section id=related-posts><p>{SAY}</p></section>",
])
def test_furniture_goes(tree, part):
    assert ex.main_text(f"{NAV}<article>{BODY}{part}</article>{FOOT}", tree) == WANT
    assert ex.main_text(f"{NAV}<article>{BODY}</article>{part}{FOOT}", tree) == WANT


def test_linked_paragraph_of_an_article(tree):
    link = "One word and two more words that <a href='/x'>link to something that is quite a bit longer than that</a>"
    assert ex.main_text(f"<article>{BODY}<p>{link}</p><p>{SAY}</p></article>", tree).count("\n") == 5


@pytest.mark.parametrize("unit", ["<div>", "<b>x", "<p><b>", "<a href='/x'>w ", "</div>", "<form>"])
def test_linear_time(unit):
    start = time.time()
    ex.blocks("<article>" + unit * 200_000 + SAY)
    assert time.time() - start < 20


def test_edges_on_spark(spark):
    page = f"{NAV}<article>{BODY}</article>{FOOT}"
    rows = [(1, "u", page, "clash", 5), (1, "u", page, "clash", 5), (2, None, None, None, None), (3, "u", "", "", 0), (None, "u", "<article><p>é &amp; &#228;</p></article>", "x", 1), (4, "u", f"<article><p>{'long word. ' * 200_000}</p></article>", "", 0)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int").repartition(2)
    got = {}
    for r in ex.extract_text(df).collect():
        got.setdefault(r.page_id, []).append(r)
    assert len(got[1]) == 2 and got[1][0] == got[1][1] and got[1][0].text == WANT and got[1][0].n_chars == len(WANT)
    assert got[2][0].text == got[3][0].text == "" and got[2][0].n_chars == 0
    assert got[None][0].text == "é & ä" and got[None][0].n_chars == 5 and got[4][0].n_chars == 11 * 200_000 - 1
    assert ex.extract_text(df.where("FALSE")).isEmpty()
