"""Main text of web pages by composite text density.

A page becomes a tree in flat arrays.  Every element gets its characters per tag, adjusted by the share of characters and tags
that are links; an element's sum is the total over its children.  The subtree with the largest sum is the article; the least
density on its path up to the body is the threshold that other elements must reach for their own densest subtree to count too.
"""

from __future__ import annotations

import html as entities
import math
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from rankflow.llm.common import appended

# Element names of the language, by their role.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
IN_HEAD = frozenset("head meta link base title script style noscript template".split())
# elements that belong to no article, and those that only hold controls or pictures
FURNITURE = frozenset("nav footer aside form dialog menu".split())
SKIPPED = RAW | frozenset("head template svg math canvas audio video object map button select option datalist label fieldset "
                          "legend progress meter applet".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var".split())
NO_BREAK = INLINE | SKIPPED | (VOID - {"hr"})
LISTS = frozenset("ul ol dl table div section p center".split())
# a start tag named first ends an open element of the second kind, unless one of the third lies between
IMPLIED_END = {
    **dict.fromkeys("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split(),
                    (frozenset({"p"}), frozenset("button table td th caption".split()))),
    "a": (frozenset({"a"}), frozenset("table td th caption".split())),
    "li": (frozenset({"li"}), frozenset("ul ol menu dir".split())),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (frozenset({"thead", "tbody", "tfoot"}), frozenset({"table"}))),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
}
# an end tag of another element closes nothing beyond these
BARRIERS = frozenset("table td th caption article main section body html".split())
# words of a class, id or role that name what stands around an article, and those that name reader comments
HINTS = frozenset("ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promos promotion "
                  "promotions banner cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal "
                  "overlay paywall nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars side rail widget widgets "
                  "header footer masthead topbar toolbar pagination pager share sharing social follow subscribe subscription "
                  "newsletter signup login related recommended recommendations trending popular teaser teasers copyright "
                  "disclaimer complementary contentinfo search".split())
COMMENTS = frozenset("comment comments commentlist respond replies discussion".split())
ARTICLE_WORDS = frozenset("article post entry story content".split())
HINTED = frozenset("div section aside ul ol dl p span table td article header figure details center li blockquote".split())

_TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))
    |<(/?)([A-Za-z][^\s/>]*)((?:[^>"'=]++|=\s*"[^"]*"|=\s*'[^']*'|["'=])*+)(?:>|\Z)
    |<[!?/][^>]*>?""", re.S | re.X)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])|\Z", re.I) for name in sorted(RAW)}
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
# why an element may be left out
AROUND, COMMENT, HIDDEN = 1, 2, 3


class Tree(NamedTuple):
    """A page's elements in page order; element 0 is the page itself."""
    name: list[str]
    parent: list[int]  # smaller than the element; -1 for the page
    hint: list[int]  # 0, or what its words or attributes say: AROUND, COMMENT, HIDDEN
    texts: list[tuple[int, str, int]]  # (element, decoded text, its characters without runs of white space), in page order
    breaks: list[int]  # number of texts before each start and end of a block


def _hint(name: str, attributes: str) -> int:
    words = set()
    for key, value in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key == "hidden" or (key == "aria-hidden" and value.strip("\"'") == "true") or (key == "style" and _HIDDEN.search(value)):
            return HIDDEN
        if key in ("class", "id", "role") and name in HINTED:
            words.update(w.lower() for w in _WORD.findall(entities.unescape(value)))
    if words & COMMENTS:
        return COMMENT
    named = words & HINTS
    return AROUND if named and not (named == {"header"} and words & ARTICLE_WORDS) else 0


def parse(page: str) -> Tree:
    """The tree of a page; missing and stray end tags, unquoted attributes and cut-off pages are read much as browsers do."""
    tree = Tree(["#page"], [-1], [0], [], [])
    stack = [0]
    opened: dict[str, int] = {}  # how many elements of a name are open

    def add(text: str) -> None:
        if "&" in text:
            text = entities.unescape(text)
        tree.texts.append((stack[-1], text, len(" ".join(text.split()))))

    def close(names: frozenset[str], stops: frozenset[str]) -> None:
        """Close the innermost open element of these names and all within it, unless a stop lies between."""
        if not any(opened.get(n) for n in names):
            return
        depth = len(stack) - 1
        while tree.name[stack[depth]] not in names:
            if depth == 0 or tree.name[stack[depth]] in stops:
                return
            depth -= 1
        while len(stack) > depth:
            name = tree.name[stack.pop()]
            opened[name] -= 1
            if name not in NO_BREAK:
                tree.breaks.append(len(tree.texts))

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            add(page[at:start])
        if start == size:
            break
        m = _TOKEN.match(page, start)
        if m is None:  # a sign of its own
            add("<")
            at = start + 1
            continue
        at = m.end()
        if m.lastindex is None:
            continue
        name, attributes = m.group(2).lower(), m.group(3)
        if name == "br":
            add(" ")
            continue
        if name not in NO_BREAK:
            tree.breaks.append(len(tree.texts))
        if m.group(1):
            close(frozenset({name}), frozenset() if name in BARRIERS else BARRIERS)
            continue
        if name in ("html", "body") and opened.get(name):
            continue
        if opened.get("head") and name not in IN_HEAD:
            close(frozenset({"head"}), frozenset())
        if name in RAW:  # its content is no markup and no main text
            found = _RAW_END[name].search(page, at).end()
            tail = page.find(">", found)
            at = size if tail < 0 else tail + 1
            continue
        if name in IMPLIED_END:
            close(*IMPLIED_END[name])
        tree.name.append(name)
        tree.parent.append(stack[-1])
        tree.hint.append(_hint(name, attributes) if attributes else 0)
        if name not in VOID and not (name in INLINE and attributes.endswith("/")):
            stack.append(len(tree.name) - 1)
            opened[name] = opened.get(name, 0) + 1
    return tree


def _body(tree: Tree) -> int:
    return tree.name.index("body") if "body" in tree.name else 0


class Counts(NamedTuple):
    """Per element, over its subtree: characters, tags below it, characters in links, links below it."""
    chars: list[int]
    tags: list[int]
    link_chars: list[int]
    links: list[int]


def count(tree: Tree, kept: list[bool]) -> Counts:
    """The counts over the kept elements; an element that is not kept counts nowhere."""
    n = len(tree.name)
    c = Counts([0] * n, [0] * n, [0] * n, [0] * n)
    for element, _, chars in tree.texts:
        if kept[element]:
            c.chars[element] += chars
    for i in range(n - 1, -1, -1):
        is_link = tree.name[i] == "a"
        if is_link:
            c.link_chars[i] = c.chars[i]
        if i and kept[i]:
            up = tree.parent[i]
            c.chars[up] += c.chars[i]
            c.tags[up] += c.tags[i] + 1
            c.link_chars[up] += c.link_chars[i]
            c.links[up] += c.links[i] + is_link
    return c


def kept_elements(tree: Tree) -> list[bool]:
    """False for what stands around an article, by its element, its words or its text being all links, and for all below it.

    Words of a class or id are weak evidence: an element that holds an article or main element, or on a page without one over half
    of the characters, stays in spite of them.  An article or main element inside a menu, as when an end tag is missing, stays too.
    """
    n = len(tree.name)
    # what is no text of any kind does not count in the comparisons below
    gone = [False] * n
    for i in range(1, n):
        gone[i] = gone[tree.parent[i]] or tree.name[i] in SKIPPED or tree.hint[i] in (COMMENT, HIDDEN)
    c = count(tree, [not g for g in gone])
    main = [tree.name[i] in ("article", "main") and not tree.hint[i] and not gone[i] for i in range(n)]
    inside, holds = main[:], main[:]
    for i in range(1, n):
        inside[i] = inside[i] or inside[tree.parent[i]]
    for i in range(n - 1, 0, -1):
        holds[tree.parent[i]] = holds[tree.parent[i]] or holds[i]
    around = [False] * n
    for i in range(1, n):
        if main[i] or gone[i]:
            continue
        if around[tree.parent[i]]:
            around[i] = True
        elif tree.hint[i] == AROUND or tree.name[i] == "form":
            most = holds[i] or (not holds[0] and 2 * c.chars[i] > c.chars[0])
            around[i] = inside[i] or not most
        elif tree.name[i] in FURNITURE or (tree.name[i] == "header" and not inside[i]):
            around[i] = True
        elif tree.name[i] in LISTS and not inside[i] and c.links[i] > 1 and c.link_chars[i] == c.chars[i]:
            around[i] = True
    return [not (g or a) for g, a in zip(gone, around)]


def _lifted(tree: Tree, kept: list[bool]) -> Tree:
    """The tree with kept elements that lie in others, as an article in a menu without an end, placed below the nearest kept one."""
    above = [0] * len(kept)  # the nearest kept element, itself included
    parent = tree.parent[:]
    for i in range(1, len(kept)):
        parent[i] = above[parent[i]]
        above[i] = i if kept[i] else parent[i]
    return tree._replace(parent=parent)


def densities(tree: Tree, kept: list[bool], c: Counts) -> tuple[list[float], list[float]]:
    """(composite density, sum of the children's densities) of every element; one without children sums to its own density."""
    n, body = len(tree.name), _body(tree)
    page_share = c.link_chars[body] / max(c.chars[body], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if not kept[i] or not c.chars[i]:
            continue
        chars, tags, link_chars, links = c.chars[i], max(c.tags[i], 1), max(c.link_chars[i], 1), max(c.links[i], 1)
        base = math.log(chars / max(chars - link_chars, 1) * link_chars + page_share * chars + math.e)
        density[i] = max(chars / tags * math.log(chars / link_chars * tags / links, base), 0.0)
        if not c.tags[i]:
            total[i] = density[i]
        if i:
            total[tree.parent[i]] += density[i]
    return density, total


def main_elements(tree: Tree, kept: list[bool]) -> list[bool]:
    """True for the elements of the main text.

    The subtree of the largest sum (ties: the first) is chosen.  If it lies in an article or main element, or if such elements
    hold at least half of its characters, these bound the main text and are chosen instead, whole.  Otherwise the least density on the path
    from the subtree up to the body is a threshold: every element that reaches it, as do all above it, has its own subtree of the
    largest sum chosen.  Nothing is chosen on a page whose text is all links.
    """
    n, body = len(tree.name), _body(tree)
    c = count(tree, kept)
    density, total = densities(tree, kept, c)
    below = [False] * n  # kept and in the body
    below[body] = True
    for i in range(body + 1, n):
        below[i] = below[tree.parent[i]] and kept[i]
    best = list(range(n))  # the element with the largest sum in each subtree
    for i in range(n - 1, body, -1):
        up = tree.parent[i]
        if below[i] and (total[best[i]], -best[i]) > (total[best[up]], -best[up]):
            best[up] = best[i]
    top = best[body]
    chosen = [False] * n
    if c.chars[body] == c.link_chars[body]:
        return chosen
    bounds = _bounds(tree, below, c, top)
    if bounds:
        for i in bounds:
            chosen[i] = True
    else:
        threshold, i = density[top], top
        while i != body:
            i = tree.parent[i]
            threshold = min(threshold, density[i])
        reached = [False] * n
        for i in range(body, n):
            if below[i] and c.chars[i] and (i == body or reached[tree.parent[i]]) and density[i] >= threshold:
                reached[i] = True
                chosen[best[i]] = True
        chosen[top] = True
    for i in range(1, n):
        chosen[i] = kept[i] and (chosen[i] or chosen[tree.parent[i]])
    return chosen


def _bounds(tree: Tree, below: list[bool], c: Counts, top: int) -> list[int]:
    """The outermost article elements around `top`, or below it if they hold half of its characters; else the main element so."""
    for kind in ("article", "main"):
        path = [i for i in _path(tree, top) if tree.name[i] == kind]
        if path:
            return path[-1:]
        within, found = [False] * len(below), []  # below `top` and in no element of the kind
        within[top] = True
        for i in range(top + 1, len(below)):
            if below[i] and within[tree.parent[i]]:
                within[i] = tree.name[i] != kind
                if not within[i] and c.chars[i]:
                    found.append(i)
        if found and 2 * sum(c.chars[i] for i in found) >= c.chars[top]:
            return found
    return []


def _path(tree: Tree, i: int) -> list[int]:
    """The element and all above it."""
    out = []
    while i >= 0:
        out.append(i)
        i = tree.parent[i]
    return out


def extract(page: str | None) -> str:
    """Main text of one page: its blocks in page order, joined by two line ends; white space inside a block is one space."""
    if not page:
        return ""
    tree = parse(page)
    kept = kept_elements(tree)
    chosen = main_elements(_lifted(tree, kept), kept)
    blocks: list[list[str]] = [[]]
    k = 0
    for i, (element, text, _) in enumerate(tree.texts):
        if k < len(tree.breaks) and tree.breaks[k] <= i:
            blocks.append([])
            while k < len(tree.breaks) and tree.breaks[k] <= i:
                k += 1
        if chosen[element]:
            blocks[-1].append(text)
    lines = (" ".join("".join(block).split()) for block in blocks)
    return "\n\n".join(line for line in lines if line)


def main_texts(pages: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """`pages` with the main text of every page and its code points; columns of these names are replaced.

    A null or empty page, and a page of menus only, has an empty text.  Rows are treated one by one, so repeated rows give equal
    texts.  No shuffle; a page is held whole, its elements as numbers in flat lists, and no step recurses, however deep the page.
    """
    def make():
        def run(column: pa.Array) -> list[pa.Array]:
            texts = [extract(page) for page in column.to_pylist()]
            return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return run

    return appended(pages, [html_col], [(text_col, "string"), (chars_col, "long")], make)
