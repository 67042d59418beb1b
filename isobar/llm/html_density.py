"""Main text of web pages by composite text density.

Every DOM node gets a density: its characters for each tag, lowered the more of them stand in
links. A node's sum adds up its children's densities; the node of the largest sum holds the
article. The least density on its way up to the body is the threshold that blocks beside it
and beside its ancestors must meet to belong to it; titles, prose and bare text there always
do, unless most of it are links. Parts that no reader sees as text are taken out before; parts
that their tag, role, class or id calls boilerplate only if they hold neither the article nor
most of the text. Work is per page, in Arrow batches, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from isobar.llm.common import map_texts

# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td"
    " tfoot th thead tr ul".split())
#: An opening tag ends these open elements, looking up no further than the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Never text of an article.
DROPPED = frozenset(
    "head title script style noscript template iframe object svg canvas button select textarea input audio video math".split())
# Boilerplate by element, role and words of class or id, unless it wraps the article.
ASIDES = frozenset("nav footer aside dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side aside menu nav"
    " navbar navigation breadcrumb breadcrumbs header masthead footer foot notice notices cookie cookies consent gdpr alert"
    " popup modal overlay newsletter subscribe subscription signup login share sharing social pagination pager toolbar widget"
    " copyright".split())
#: Their parts look like articles, so an article, a title or much text outside tells more.
LISTS = frozenset("comment comments disqus respond reply replies discussion related recommended".split())
#: Words that may stand beside a hint in one class name.
NEUTRAL = frozenset(
    "area bar block box button buttons container form google group inner item items link links list main page post posts"
    " section site slot thread top unit wrap wrapper x".split())
LANDMARKS = frozenset(("article", "main", "h1"))
#: Share of the page's text outside links that a wrapper holds.
LARGE = 2 / 3
# Blocks that hold text rather than parts of a page.
PROSE = frozenset("p ul ol li dl dt dd table caption blockquote pre figure figcaption details summary address".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = (
        "tag", "parent", "parts", "dropped", "doubt", "holds", "chars", "tags", "blocks", "link_chars", "link_tags", "density",
        "total")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False, doubt: str = ""):
        self.tag, self.parent, self.dropped, self.doubt = tag, parent, dropped, doubt
        self.holds: frozenset[str] = frozenset()
        self.parts: list[Node | str] = []
        self.chars = self.tags = self.blocks = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _unseen(tag: str, given: dict[str, str | None]) -> bool:
    if tag in ("html", "body"):
        return False
    return tag in DROPPED or "hidden" in given or "display:none" in (given.get("style") or "").replace(" ", "").lower()


def _named(name: str) -> str:
    """What a class name or id says as a whole: "list", "hint" or nothing, as for has-sidebar or ad-free."""
    words = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())) - {""}
    if not words <= HINTS | LISTS | NEUTRAL:
        return ""
    return "list" if words & LISTS else "hint" if words & HINTS else ""


def _doubt(tag: str, given: dict[str, str | None], parent: Node) -> str:
    """Why a node may be boilerplate: "aside" by tag or role, "hint" (also a form) or "list"."""
    if tag in ASIDES or tag == "header" and not _within(parent, ("article", "main")):
        return "aside"
    if (given.get("role") or "").lower() in ROLES and tag not in ("html", "body", "form"):
        return "aside"
    if tag in ("html", "body", "article", "main") or tag in HEADINGS:
        return ""
    if tag == "form":
        return "hint"
    found = {_named(n) for n in [*(given.get("class") or "").split(), given.get("id") or ""]}
    return "list" if "list" in found else "hint" if "hint" in found else ""


def _within(node: Node | None, tags) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


class Builder(HTMLParser):
    """Builds the tree; ``nodes`` lists parents before children."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("#root", None)
        self.nodes = [self.root]
        self._opened = Counter()  # by tag, so that an end tag without a start walks no chain

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._end({"p"}, {"table", "td", "th", "button", "object", "blockquote", "div", "article", "section", "li"})
        if tag in ENDS:
            self._end(*ENDS[tag])
        given = dict(attrs)
        node = Node(tag, self.open, _unseen(tag, given), _doubt(tag, given, self.open))
        self.open.parts.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.open = node
            self._opened[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self._opened[tag]:
            node = self.open
            while node.tag != tag:
                node = node.parent
            self._close(node)

    def handle_data(self, data):
        self.open.parts.append(data)

    def _end(self, tags, stop):
        """Close the topmost open element of the given tags."""
        if not any(self._opened[t] for t in tags):
            return
        node, found = self.open, None
        while node is not None and node.tag not in stop:
            if node.tag in tags:
                found = node
            node = node.parent
        if found is not None:
            self._close(found)

    def _close(self, node):
        """Close an open element with all that is open in it."""
        while self.open is not node.parent:
            self._opened[self.open.tag] -= 1
            self.open = self.open.parent


def _spread(nodes: list[Node]) -> None:
    for node in nodes:
        if node.parent is not None and node.parent.dropped:
            node.dropped = True


def _count(nodes: list[Node]) -> None:
    """Children before parents; dropped parts count nothing."""
    for node in reversed(nodes):
        node.tags = node.blocks = node.link_chars = node.link_tags = 0
        node.holds = LANDMARKS & {node.tag}
        node.chars = sum(len(SPACE.sub(" ", p).strip()) for p in node.parts if isinstance(p, str))
        for child in node.parts:
            if isinstance(child, Node) and not child.dropped:
                node.chars += child.chars
                node.tags += 1 + child.tags
                node.blocks += (child.tag in BLOCK) + child.blocks
                node.link_chars += child.chars if child.tag == "a" else child.link_chars
                node.link_tags += (child.tag == "a") + child.link_tags
                node.holds |= child.holds


def _drop_boilerplate(nodes: list[Node]) -> None:
    """Drop doubtful nodes, unless they hold a landmark or most of the text.

    Where a landmark stands outside all doubtful nodes, asides need more than an article to stay
    (``main``), and lists ``main`` or ``h1``; where an article or main does, no node stays for its text.
    """
    _spread(nodes)
    if not any(n.doubt and not n.dropped for n in nodes):
        return
    _count(nodes)
    plain = lambda n: n.chars - n.link_chars
    most = LARGE * plain(nodes[0])

    def free() -> set[str]:
        """Landmarks in no node that is still doubtful."""
        found, inside = set(), set()
        for n in nodes:
            if n.dropped or n.doubt or n.parent in inside:
                inside.add(n)
            elif n.tag in LANDMARKS:
                found.add(n.tag)
        return found

    large = lambda n: plain(n) > 0 and plain(n) >= most
    for node in nodes:
        if node.doubt == "hint" and node.holds:
            node.doubt = ""
    outside = free()
    for node in nodes:
        if node.doubt == "hint" and large(node) and not outside & {"article", "main"}:
            node.doubt = ""
    outside = free()
    for node in nodes:
        if node.doubt == "list" and node.holds & {"main", "h1"} or node.doubt == "aside" and "main" in node.holds:
            node.doubt = ""
        elif node.doubt in ("list", "aside") and not outside and ("article" in node.holds or large(node)):
            node.doubt = ""
    for node in nodes:
        node.dropped = node.dropped or bool(node.doubt)
    _spread(nodes)


def _measure(nodes: list[Node]) -> None:
    """Counts and densities of what is not dropped."""
    _drop_boilerplate(nodes)
    _count(nodes)
    whole = next((n for n in nodes if n.tag == "body" and not n.dropped), nodes[0])
    share = whole.link_chars / max(whole.chars, 1)
    for node in nodes:
        if node.dropped or not node.chars:
            continue
        tags, links, link_tags = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(node.chars / max(node.chars - node.link_chars, 1) * node.link_chars + share * node.chars + math.e)
        ratio = node.chars / links * tags / link_tags
        node.density = node.chars / tags * max(math.log(ratio) / base, 0.0) if ratio > 1 else 0.0
    for node in nodes:
        node.total = sum(c.density for c in node.parts if isinstance(c, Node) and not c.dropped)


def _text(roots: list[Node | str]) -> str:
    """Blocks in page order, white space inside them as one space, joined by one."""
    out: list[str] = []
    stack: list[Node | str] = list(reversed(roots))
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
        elif not part.dropped:
            if part.tag in BLOCK or part.tag == "br":
                out.append(" ")
                stack.append(" ")
            stack.extend(reversed(part.parts))
    return SPACE.sub(" ", "".join(out)).strip()


def main_text(html: str) -> str:
    """The article's text; empty if the page has none."""
    builder = Builder()
    builder.feed(html)
    builder.close()
    nodes = builder.nodes
    _measure(nodes)
    kept = [n for n in nodes if not n.dropped and n.chars]
    if not kept:
        return ""
    best = max(kept, key=lambda n: n.total)
    if best.total == 0:  # text in no element, or in links only
        best = next((n for n in kept if n.tag in ("article", "main", "body")), kept[0])
    path, article = [], None
    node: Node | None = best
    while node is not None:
        if node.tag in ("article", "main") and (article is None or article.tag != "article"):
            article = node
        if node.tag not in ("html", "#root"):
            path.append(node.density)
        node = node.parent
    if article is not None:
        return _text([article])
    if best.tag in ("body", "html", "#root"):
        return _text([best])
    return _text(_around(best, min(path, default=0.0)))


def _sides(node: Node, stays) -> tuple[list[Node | str], list[Node | str]]:
    """What is kept of the parent before and after the node: blocks that ``stays`` allows, and bare text.

    Bare text goes with the inline elements in it and is left out where most of it are links.
    """
    before: list[Node | str] = []
    after: list[Node | str] = []
    out, run = before, []

    def close() -> None:
        chars = sum(len(p.strip()) if isinstance(p, str) else p.chars for p in run)
        links = sum(0 if isinstance(p, str) else p.chars if p.tag == "a" else p.link_chars for p in run)
        out.extend(run if chars > 2 * links else [" "])
        run.clear()

    for part in node.parent.parts:
        if part is node:
            close()
            out = after
        elif isinstance(part, str):
            run.append(part)
        elif part.tag in BLOCK or part.blocks:
            close()
            out.append(part if not part.dropped and stays(part) else " ")
        elif not part.dropped:
            run.append(part)
    close()
    return before, after


def _around(best: Node, threshold: float) -> list[Node | str]:
    """The node and, from each of its ancestors up to the body, titles, prose, bare text and what meets the threshold.

    The threshold is the least density on this way, so every ancestor meets it.
    """
    unlinked = lambda n: n.chars > 2 * n.link_chars

    def stays(n: Node) -> bool:
        if n.density > 0 and n.density >= threshold or n.tag in HEADINGS and node is best:
            return True
        return unlinked(n) and (n.tag in HEADINGS or n.tag in PROSE or "h1" in n.holds)

    kept: deque[Node | str] = deque([best])
    node = best
    while node.parent is not None and node.tag not in ("body", "html"):
        before, after = _sides(node, stays)
        if node.tag in BLOCK:
            before.append(" ")
            kept.append(" ")
        kept.extendleft(reversed(before))
        kept.extend(after)
        node = node.parent
    return list(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row; null or empty html gives an empty text.

    Repeated rows are treated alike, extra columns are ignored, an empty frame gives an empty one.
    """
    def texts(pages: list[str]) -> list[list]:
        found = [main_text(p) for p in pages]
        return [found, [len(t) for t in found]]

    return map_texts(pages.select("page_id", "url", "html"), lambda: texts, "text string, n_chars long", column="html")
