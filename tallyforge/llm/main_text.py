"""The main text of web pages, by scoring the tree of elements.

A page is read into a tree. Elements that never hold the article (navigation, forms, scripts,
adverts, reader comments and the like) are left out by tag, role, or a telling class or id.
Every paragraph then passes points to the elements around it: one, one for each comma and one
for each 100 characters, less the share of its text that is links. Its parent gets them whole
and each ancestor above half of what the one below got. A container's score is again discounted
by its links. The best container is kept, widened to the ``article`` or ``main`` element it lies
in, along with those of its siblings that score like it, are a paragraph of prose or are the
headings before it. Inside, lists of nothing but links go, and of a header only the headings stay.
The text is returned as blocks in page order.

Results for special pages: a null page counts as empty, and an empty page, or one without text
outside what is left out, gives the empty text. A page without markup is one block. Text cut off
within a tag loses that tag, and within a comment or script what follows. Nothing is dropped for
its length, and a page is held by one task at a time: its tree takes some 500 bytes for each
element besides the text. Rows that repeat an id are pages of their own, null ids stay null, an
empty table gives an empty result, and other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tags by what they mean in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote body center details dialog dir div dl dd dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: A start tag that ends an open element of these tags, up to the nearest of the boundaries.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
}
LEFT_OUT = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form frameset head iframe input map math "
    "menu nav noscript object optgroup option progress script search select style svg template textarea "
    "title video".split()
)
LEFT_OUT_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status "
    "toolbar tooltip".split()
)
#: Words of a class or id that tell what is not the article.
TELLING = frozenset(
    "ad ads adbox adcontainer adsbygoogle adsense adslot adunit advert advertisement advertisements "
    "advertising adverts alert alerts banner banners breadcrumb breadcrumbs colophon comment commentlist "
    "comments consent cookie cookiebanner cookiebar cookies copyright disclaimer discussion disqus feedback "
    "footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices "
    "notification notifications outbrain overlay pager pagination paywall popup promo promos promotion "
    "recommended related replies reply respond responses search searchform share sharing sidebar sidebars "
    "sidenav signup skip social sponsor sponsored sponsors subnav subscribe subscription taboola teaser "
    "teasers toast toolbar topbar topnav widget widgets".split()
)
#: A telling word behind one of these says what the element has around it, not what it is.
ABOUT = frozenset("has hide is no non not show with without".split())
HEADERS = frozenset(("header", "masthead"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset(("article", "main"))
#: Elements whose own text is a paragraph.
PARAGRAPHS = frozenset("p pre td th li dd dt blockquote div section article main body figcaption".split())

#: Elements nested deeper become siblings, as in browsers, so that no search of the open ones is long.
DEPTH = 512
CHARACTERS_A_POINT = 100
#: A sibling stays with this share of the best container's score, or as prose of that length
#: with at most that share of links.
SIBLING_SHARE = 0.2
PROSE_CHARACTERS = 80
PROSE_LINKS = 0.25
#: A list or division with so many links that make up that share of its text is a menu.
MENU_ANCHORS = 3
MENU_LINKS = 0.8
MENUS = frozenset("div dl ol section table ul".split())

# A quoted value that holds "<" is not read as quoted, so that no match looks further than the
# next tag and a page is read in one pass.
TAG = re.compile(
    r"""<(?:(?P<comment>!--)|(?P<declared>[!?])|(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*+)"""
    r"""(?P<attributes>(?:[^>"'<]++|"[^"<]*+"|'[^'<]*+')*+>|[^>]*+(?:>|\Z)))"""
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Element:
    __slots__ = ("tag", "parent", "out", "header", "article", "inside", "content")

    def __init__(self, tag: str, parent: Element | None, out=False, header=False, article=False):
        self.tag = tag
        self.parent = parent
        self.out = out
        #: The header of an article, of which only the headings count.
        self.header = header
        self.article = article
        #: Whether it is an article or lies in one.
        self.inside = article or (parent is not None and parent.inside)
        #: Texts and elements, in page order.
        self.content: list[str | Element] = []


def attributes_of(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), unescape("".join(values)))
    return found


def telling(names: str) -> set[str]:
    """The telling words of a class or id, cut at capitals and signs."""
    words = [word.lower() for word in WORD.findall(names)]
    return {w for before, w in zip(["", *words], words) if w in TELLING and before not in ABOUT}


def element(tag: str, source: str, parent: Element) -> Element:
    """The element of a start tag, with whether it is left out and whether it is the article."""
    known = attributes_of(source) if len(source) > 1 else {}
    role = known.get("role", "").strip().lower()
    article = tag in ARTICLE or role in ARTICLE or known.get("itemprop", "").lower() == "articlebody"
    words = set()
    if tag not in ("html", "body", "main"):
        words = telling(f"{known.get('class', '')} {known.get('id', '')}")
    out = (
        tag in LEFT_OUT
        or role in LEFT_OUT_ROLES
        or "hidden" in known
        or known.get("aria-hidden", "").lower() == "true"
        or bool(HIDDEN.search(known.get("style", "")))
        or bool(words - HEADERS)
    )
    header = tag == "header" or bool(words & HEADERS)
    if header and not parent.inside:
        out = True
    return Element(tag, parent, out, header, article and not out)


class Builder:
    """The elements open at a place of the page, as a stack, and how many there are of each tag."""

    def __init__(self) -> None:
        self.root = Element("#page", None)
        self.stack = [self.root]
        self.open: dict[str, int] = {}

    def push(self, node: Element) -> None:
        self.stack.append(node)
        self.open[node.tag] = self.open.get(node.tag, 0) + 1

    def pop_to(self, index: int) -> None:
        for node in self.stack[index:]:
            self.open[node.tag] -= 1
        del self.stack[index:]

    def close_nearest(self, tags: tuple[str, ...], boundaries: tuple[str, ...] = ()) -> None:
        if not any(self.open.get(tag) for tag in tags):
            return
        for index in range(len(self.stack) - 1, 0, -1):
            if self.stack[index].tag in tags:
                return self.pop_to(index)
            if self.stack[index].tag in boundaries:
                return

    def text(self, text: str) -> None:
        if text:
            self.stack[-1].content.append(unescape(text) if "&" in text else text)

    def start(self, tag: str, source: str) -> None:
        if tag in CLOSES_P:
            self.close_nearest(("p",))
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self.pop_to(len(self.stack) - 1)
        if tag in ENDS:
            self.close_nearest(*ENDS[tag])
        if tag == "a":
            self.close_nearest(("a",))
        if tag in ("html", "body") and self.open.get(tag):
            return
        if len(self.stack) > DEPTH:
            self.pop_to(DEPTH)
        node = element(tag, source, self.stack[-1])
        self.stack[-1].content.append(node)
        if tag not in VOID:
            self.push(node)

    def end(self, tag: str) -> None:
        if not self.open.get(tag) or tag in ("html", "body"):
            return
        for index in range(len(self.stack) - 1, 0, -1):
            at = self.stack[index].tag
            if at == tag:
                return self.pop_to(index)
            if tag in INLINE and at not in INLINE:
                return  # an inline end tag does not close a block


def tree(page: str) -> Element:
    """The elements of a page. Whatever the markup, it is read once from left to right."""
    build = Builder()
    at = 0
    while match := TAG.search(page, at):
        build.text(page[at : match.start()])
        at = match.end()
        if match["comment"]:
            end = page.find("-->", match.end() - 2)
            at = len(page) if end < 0 else end + 3
        elif match["declared"]:
            end = page.find(">", at)
            at = len(page) if end < 0 else end + 1
        elif not match["attributes"].endswith(">"):
            break  # the page ends within this tag
        elif match["end"]:
            build.end(match["name"].lower())
        else:
            tag = match["name"].lower()
            build.start(tag, match["attributes"][:-1])
            if tag in RAW:
                closing = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
                at = closing.end() if closing else len(page)
                build.end(tag)
    else:
        build.text(page[at:])
    return build.root


def in_page_order(root: Element) -> list[Element]:
    """The elements that are not left out, parents before children."""
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if not node.out:
            found.append(node)
            waiting.extend(c for c in reversed(node.content) if isinstance(c, Element))
    return found


class Score:
    """What scoring finds out about an element: the characters and commas of the paragraph that
    it is itself, the characters of all its text and of its links, and its points."""

    __slots__ = ("own", "own_links", "commas", "characters", "links", "anchors", "passed")

    def __init__(self) -> None:
        self.own = self.own_links = self.commas = self.characters = self.links = self.anchors = 0
        self.passed = 0.0

    def paragraph(self) -> float:
        if not self.own:
            return 0.0
        points = 1 + self.commas + self.own / CHARACTERS_A_POINT
        return points * (1 - self.own_links / self.own)

    def density(self) -> float:
        return self.links / self.characters if self.characters else 0.0

    def container(self) -> float:
        return self.passed * (1 - self.density())

    def menu(self) -> bool:
        return self.anchors >= MENU_ANCHORS and self.density() >= MENU_LINKS


def scores(nodes: list[Element]) -> dict[Element, Score]:
    """Scores of the elements, from the innermost outwards."""
    found = {node: Score() for node in nodes}
    linked: dict[Element, bool] = {}
    for node in nodes:
        linked[node] = node.tag == "a" or (node.parent in linked and linked[node.parent])
    for node in reversed(nodes):
        mine = found[node]
        for text in node.content:
            if isinstance(text, str) and (size := len(text.strip())):
                commas = text.count(",") + text.count("、") + text.count("，") + text.count("،")
                mine.own += size
                mine.own_links += size if linked[node] else 0
                mine.commas += commas
                mine.characters += size
                mine.links += size if linked[node] else 0
        above = found.get(node.parent)
        if above is None:
            continue
        above.anchors += mine.anchors + (node.tag == "a")
        above.characters += mine.characters
        above.links += mine.links
        if node.tag in INLINE:  # its text is part of the paragraph around it
            above.own += mine.own
            above.own_links += mine.own_links
            above.commas += mine.commas
            above.passed += mine.passed
        else:
            points = mine.paragraph() if node.tag in PARAGRAPHS else 0.0
            above.passed += points + mine.passed / 2
    # Text that lies in no paragraph of its own makes its element one.
    for node in nodes:
        mine = found[node]
        if node.tag in PARAGRAPHS and node.tag != "p" and mine.own:
            mine.passed += mine.paragraph()
    return found


def best_container(nodes: list[Element], found: dict[Element, Score]) -> Element | None:
    """The element with the highest score, the outermost and first of equals."""
    best = None
    for node in nodes:
        if node.tag in INLINE or node.tag in HEADINGS:
            continue
        if best is None or found[node].container() > found[best].container():
            best = node
    if best is None or not found[best].container():
        # No paragraph at all: headings alone, or nothing.
        return nodes[0] if nodes and found[nodes[0]].characters else None
    around = []
    at = best
    while at is not None:
        if at.article:
            around.append(at)
        at = at.parent
    return next((a for a in reversed(around) if a.tag == "article"), around[-1] if around else best)


def kept_parts(best: Element, found: dict[Element, Score]) -> list[str | Element]:
    """The best container and the siblings that go with it, in page order."""
    if best.parent is None:
        return [best]
    least = SIBLING_SHARE * found[best].container()
    kept: list[str | Element] = []
    before = True
    for part in best.parent.content:
        if part is best:
            kept.append(part)
            before = False
        elif isinstance(part, Element) and part in found:
            mine = found[part]
            alike = part.tag not in INLINE and mine.container() >= least > 0
            prose = part.tag in PARAGRAPHS and mine.own >= PROSE_CHARACTERS and mine.density() <= PROSE_LINKS
            heading = before and part.tag in (("h1",) if best.article else HEADINGS)
            if heading or (part.article and alike) or (not best.article and (alike or prose)):
                kept.append(part)
    return kept


def blocks(parts: list[str | Element], found: dict[Element, Score]) -> Iterator[str]:
    """The text of each block in page order, white space as one space. Inline elements do not
    end a block, all others do. Of a header inside an article only the headings count."""
    held: list[str] = []
    waiting: list[tuple[str | Element | None, bool]] = [(part, False) for part in reversed(parts)]
    while waiting:
        part, headings_only = waiting.pop()
        if isinstance(part, str):
            if not headings_only:
                held.append(part)
            continue
        if part is not None and (part.out or (part.tag in MENUS and found[part].menu() and part not in parts)):
            continue
        if part is None or part.tag not in INLINE:
            if text := " ".join("".join(held).split()):
                yield text
            held = []
        if part is None:
            continue
        inside = (headings_only or part.header) and part.tag not in HEADINGS
        if part.tag not in INLINE:
            waiting.append((None, False))
        waiting.extend((child, inside) for child in reversed(part.content))
    if text := " ".join("".join(held).split()):
        yield text


def main_text(page: str) -> list[str]:
    """The blocks of the main text of a page."""
    nodes = in_page_order(tree(page))
    found = scores(nodes)
    best = best_container(nodes, found)
    return list(blocks(kept_parts(best, found), found)) if best is not None else []


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, the ``blocks`` of the main text, ``text`` with a space between them,
    and ``n_chars``, its code points."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [main_text(page.as_py()) for page in batch.column("html")]
            texts = [" ".join(b) for b in found]
            columns = [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(found, pa.list_(pa.string())),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ]
            yield pa.record_batch(columns, names=["page_id", "url", "blocks", "text", "n_chars"])

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    kinds = dict(rows.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, blocks array<string>, text string, n_chars bigint"
    return rows.mapInArrow(batches, schema)
