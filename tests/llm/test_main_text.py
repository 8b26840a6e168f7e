"""Main text: the tree and its scores against a plain recursion, layouts, special pages."""

import random
from html import escape

import pytest
from llm_rows import prose

from tallyforge.llm import main_text as m

SCHEMA = "page_id bigint, url string, html string"


def says(i, words=40):
    return ", ".join(prose(i * 10 + k, words // 4) for k in range(4)) + "."


def p(i):
    return f"<p>{says(i)}</p>"


def text(page):
    return " ".join(m.main_text(page))


def test_layout_with_telling_tags():
    page = (
        f"<html><head><title>no</title><style>p{{}}</style><script>var t='</p>';</script></head><body><header>{p(90)}</header>"
        f"<nav><ul><li><a href=/a>menu</a></ul></nav><div class='ad'>{p(91)}</div><article><h1>The title</h1>{p(1)}"
        f"<p>Short.</p><aside>{p(92)}</aside><form>{p(93)}<input></form>{p(2)}<footer>by</footer></article>"
        f"<section id=comments>{p(94)}{p(95)}{p(96)}</section><footer>&copy; {says(97)}</footer></body></html>"
    )
    assert m.main_text(page) == ["The title", says(1), "Short.", says(2)]


def test_layout_of_plain_divisions():
    page = (
        f"<div id='header'><h1>Site</h1></div><div class='layout has-sidebar'><div class='col'><h2>Head</h2>{p(1)}{p(2)}"
        f"<ul><li>one</li><li>two</li></ul><div>{says(3)}</div></div><div class='sidebar'>{p(8)}</div></div>"
        f"<div class=cookieNotice>{p(9)}</div><div id=disqus_thread>{p(10)}{p(11)}{p(12)}{p(13)}</div>"
    )
    assert m.main_text(page) == ["Head", says(1), says(2), "one", "two", says(3)]


def test_link_lists_lose_and_siblings_stay():
    links = "".join(f"<p><a href=/{i}>{says(50 + i)}</a></p>" for i in range(9))
    page = f"<div>{links}</div><h2>Head</h2><div>{p(1)}{p(2)}</div><div>{p(3)}</div><div><a href=x>next</a></div>"
    assert m.main_text(page) == ["Head", says(1), says(2), says(3)]


def test_menu_inside_the_article():
    items = "".join(f"<li><a href=/{i}>item {i}</a></li>" for i in range(4))
    assert m.main_text(f"<article>{p(1)}<ul>{items}</ul><ul><li>a <a href=x>b</a></li></ul></article>") == [says(1), "a b"]


def test_short_section_of_an_article_stays():
    page = f"<main><article><header><h1>T</h1><p>By me</p></header><section>{p(1)}{p(2)}</section><section><p>x</p></section></article><section><p>y</p></section></main>"
    assert m.main_text(page) == ["T", says(1), says(2), "x"]


@pytest.mark.parametrize(
    "page, blocks",
    [
        ("", []),
        (" \n ", []),
        ("no markup &amp; more", ["no markup & more"]),
        ("<h1>only a heading</h1>", ["only a heading"]),
        ("<p>a<b>b</b>c<br>d&nbsp; \n e</p>", ["abc", "d e"]),
        ("<p><b>one.<br><p>two</b> three</p>", ["one.", "two three"]),
        ("<p>cut <a href='x", ["cut"]),
        ("<p>cut</p><!-- open <p>x</p>", ["cut"]),
        ("<p>a</p><script>if (a<b) '</p>'", ["a"]),
        ("x<!-- y --><!>z", ["xz"]),
        ("<p title='a>b'>q</p>", ["q"]),
        ("<p title='a>q</p>", ["q"]),
        ("< p>3 < 4 and 5 > 2", ["< p>3 < 4 and 5 > 2"]),
        ("<P CLASS=x>A&LT;b &#228;&#x1F600; &am</P>", ["A<b ä😀 &am"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<ul><li>a<li>b</ul><dl><dt>c<dd>d</dl>", ["a", "b", "c", "d"]),
        ("<p>梦，梦、梦</p><p hidden>x</p><p style='display: none'>y</p><p aria-hidden=true>z</p>", ["梦，梦、梦"]),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, ["deep"]),
    ],
)
def test_special_pages(page, blocks):
    assert m.main_text(page) == blocks


@pytest.mark.parametrize(
    "page", ['<a "' * 50_000, "<" * 100_000, "<li><ul>" + "<span>" * 20_000 + "<li></li>" * 5000, "<script>" * 20_000, "&" * 90_000]
)
def test_hostile_pages_take_no_square_time(page):
    m.main_text(page)


def test_very_long_page():
    page = "<article>" + "".join(f"<p>{prose(i, 300)}</p>" for i in range(2000)) + "</article>"
    assert text(page) == " ".join(prose(i, 300) for i in range(2000))


def random_page(draw, depth=0):
    """A nested list: tag and children, or a text."""
    if depth == 4 or draw.random() < 0.3:
        return says(draw.randrange(99), draw.choice([4, 20, 60]))
    tag = draw.choice(["div", "section", "p", "ul", "a", "b", "h2", "blockquote"]) if depth else "body"
    if tag in ("p", "a", "b", "h2"):
        return [tag, says(draw.randrange(99), draw.choice([4, 20]))]
    return [tag, *(random_page(draw, depth + 1) for _ in range(draw.randrange(1, 5)))]


def markup(part):
    return escape(part) if isinstance(part, str) else f"<{part[0]}>{''.join(map(markup, part[1:]))}</{part[0]}>"


def measures(part, linked=False):
    """By plain recursion: own and own linked characters, commas, all characters, link characters, passed."""
    if isinstance(part, str):
        n = len(part.strip())
        return n, n * linked, part.count(","), n, n * linked, 0.0
    linked = linked or part[0] == "a"
    own = own_links = commas = size = links = 0
    passed = 0.0
    for child in part[1:]:
        c = measures(child, linked)
        size, links = size + c[3], links + c[4]
        if isinstance(child, str) or child[0] in ("a", "b"):
            own, own_links, commas = own + c[0], own_links + c[1], commas + c[2]
            passed += c[5]
        else:
            points = (1 + c[2] + c[0] / 100) * (1 - c[1] / c[0]) if c[0] and child[0] in m.PARAGRAPHS else 0
            inner = c[5] - points if child[0] in m.PARAGRAPHS and child[0] != "p" else c[5]
            passed += points + inner / 2
    if part[0] in m.PARAGRAPHS and part[0] != "p" and own:
        passed += (1 + commas + own / 100) * (1 - own_links / own)
    return own, own_links, commas, size, links, passed


def walk(part):
    yield part
    for child in part[1:]:
        if not isinstance(child, str):
            yield from walk(child)


@pytest.mark.parametrize("seed", range(60))
def test_scores_equal_plain_recursion(seed):
    page = random_page(random.Random(seed))
    if isinstance(page, str):
        page = ["body", page]
    nodes = m.in_page_order(m.tree(markup(page)))[1:]  # without the page itself
    found = m.scores([nodes[0].parent, *nodes])
    wanted = list(walk(page))
    assert [n.tag for n in nodes] == [w[0] for w in wanted]
    for node, part in zip(nodes, wanted):
        own, own_links, commas, size, links, passed = measures(part)
        score = found[node]
        assert (score.own, score.own_links, score.commas, score.characters, score.links) == (own, own_links, commas, size, links)
        assert score.passed == pytest.approx(passed)


def test_rows(spark):
    rows = [(1, "u", f"<article>{p(1)}</article>"), (1, "u", f"<article>{p(1)}</article>"), (2, None, None), (None, "v", "<p>x</p>"), (3, "w", "")]
    clashing = spark.createDataFrame([r + ("t", 1) for r in rows], SCHEMA + ", text string, n_chars int")
    for pages in (spark.createDataFrame(rows, SCHEMA), clashing):
        found = m.extract(pages).collect()
        assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in found) == sorted(
            [(1, "u", says(1), len(says(1)))] * 2 + [(2, "", "", 0), (0, "v", "x", 1), (3, "w", "", 0)]
        )
        assert all(" ".join(r.blocks) == r.text for r in found)
    empty = m.extract(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["page_id", "url", "blocks", "text", "n_chars"] and empty.collect() == []


def test_is_one_narrow_stage(spark, capsys):
    m.extract(spark.createDataFrame([], SCHEMA)).explain()
    assert "Exchange" not in capsys.readouterr().out
