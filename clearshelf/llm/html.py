"""Main text of web pages by scoring the element tree."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearshelf.llm.common import arrow_map, utf8

# Fixed values of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CLOSED_BY_SAME = {
    "li": frozenset({"ul", "ol", "menu"}), "dd": frozenset({"dl"}), "dt": frozenset({"dl"}),
    "tr": frozenset({"table", "tbody", "thead", "tfoot"}), "td": frozenset({"tr", "table"}),
    "th": frozenset({"tr", "table"}), "option": frozenset({"select"}),
}
# Elements, roles and name parts that never hold the article.
DROPPED_TAGS = frozenset(
    "nav header footer aside script style noscript template iframe object embed svg canvas "
    "button select textarea input dialog menu head title audio video map".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
    "toolbar status".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense adslot banner breadcrumb "
    "breadcrumbs comment comments commentlist respond reply replies disqus consent cookie cookies "
    "gdpr notice notices alert disclaimer footer foot footnav header masthead menu menus nav navbar "
    "navigation newsletter pager pagination pager paywall popup modal overlay promo promoted promotion "
    "related recommended recommendations share sharing shares sidebar sidebars aside rail signup "
    "skip social sponsor sponsored sponsor subscribe subscription tags toolbar widget widgets login "
    "search".split()
)
KEPT_TAGS = frozenset("html body article main".split())
# Elements that go as a rule, but may stand around the whole page.
WRAPPER_TAGS = frozenset("form fieldset label".split())
# First parts of the names of reader comments.
COMMENT_NAMES = frozenset(
    "comment comments commentlist respond reply replies disqus discussion discussions".split()
)
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "score", "points", "size", "linked")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list = []
        self.score = 0.0
        self.points = 0.0  # of all paragraphs below, links discounted
        self.size = self.linked = 0  # characters of text, and of text in links


class _Tree(HTMLParser):
    """Elements and text of a page; boilerplate elements are never entered into the tree."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._close_implied(tag)
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.at = self.at.parent or self.at

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            if tag not in BLOCKS and node.tag in BLOCKS:
                return  # a stray inline end does not close blocks
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)

    def unknown_decl(self, data: str) -> None:
        pass

    def _close_implied(self, tag: str) -> None:
        """A block ends an open paragraph; an item ends the item before it."""
        stops = CLOSED_BY_SAME.get(tag, frozenset())
        if not stops and tag not in BLOCKS:
            return
        node = self.at
        while node.parent is not None:
            if tag in BLOCKS and node.tag == "p":
                self.at = node.parent
                return
            if stops and (node.tag == tag or {node.tag, tag} == {"dd", "dt"} or {node.tag, tag} == {"td", "th"}):
                self.at = node.parent
                return
            if node.tag in stops or node.tag in BLOCKS and not stops:
                return
            node = node.parent


def _dropped(node: Node) -> bool:
    return node.tag in DROPPED_TAGS


def _set_apart(node: Node) -> bool:
    """Is a form or the like, hidden, or of a role of boilerplate?"""
    if node.tag in WRAPPER_TAGS:
        return True
    attrs = node.attrs
    if not attrs or node.tag in KEPT_TAGS:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style") or "", re.I):
        return True
    return (attrs.get("role") or "").lower() in DROPPED_ROLES


def _named(node: Node) -> bool:
    """Has a name part of boilerplate?"""
    attrs = node.attrs
    if not attrs or node.tag in KEPT_TAGS:
        return False
    names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
    return not DROPPED_NAMES.isdisjoint(_NAME.findall(_CAMEL.sub(" ", names).lower()))


def _only_named(node: Node) -> bool:
    """Has a name, as ``cookie-notice``, of parts of boilerplate alone? ``has-sidebar`` is none."""
    tokens = f"{node.attrs.get('class') or ''} {node.attrs.get('id') or ''}".split()
    parts = (_NAME.findall(_CAMEL.sub(" ", t).lower()) for t in tokens)
    return any(p and DROPPED_NAMES.issuperset(p) for p in parts)


def _is_main(node: Node) -> bool:
    role = (node.attrs.get("role") or "").lower()
    return node.tag == "main" or role == "main" or "articleBody" in (node.attrs.get("itemprop") or "")


def _is_article(node: Node) -> bool:
    return node.tag == "article" or (node.attrs.get("role") or "").lower() == "article"


def _prune(root: Node, dropped) -> None:
    open_ = [root]
    while open_:
        node = open_.pop()
        node.children = [c for c in node.children if isinstance(c, str) or not dropped(c)]
        open_ += (c for c in node.children if not isinstance(c, str))


def _has_comments(node: Node) -> bool:
    """Has a name that begins with comments, as ``comment-body``? ``has-comments`` is none."""
    if node.tag in ("html", "body", "main"):
        return False
    tokens = f"{node.attrs.get('class') or ''} {node.attrs.get('id') or ''}".split()
    parts = (_NAME.findall(_CAMEL.sub(" ", t).lower()) for t in tokens)
    return any(p and p[0] in COMMENT_NAMES for p in parts)


#: Paragraphs that show a form or hidden element to be a wrapper of the page's text.
_WRAPPED = 3


def _prune_set_apart(root: Node) -> None:
    """Drop forms, hidden elements and those of a role of boilerplate, but none around the page's text.

    Such an element stays if it has more than half of the points, is no part of the page beside an
    article or main element with points, and holds one itself or three paragraphs with points. In a
    wrapper that stays the same is asked of those inside it.
    """
    nodes = _upwards(root)
    if not any(_set_apart(n) for n in nodes):
        return
    _measure(nodes)
    _score(nodes, [])
    paragraphs: dict[int, int] = {}
    holders: dict[int, int] = {}
    around: dict[int, int] = {}  # article and main elements above, of which the element is a part
    for n in nodes:
        n.score = 0.0
        inner = [c for c in n.children if not isinstance(c, str)]
        paragraphs[id(n)] = (n.tag == "p" and n.points > 0) + sum(paragraphs[id(c)] for c in inner)
        own = (_is_main(n) or _is_article(n)) and n.points > 0
        holders[id(n)] = own + sum(holders[id(c)] for c in inner)
    for n in reversed(nodes):
        above = n.parent
        around[id(n)] = 0 if above is None else around[id(above)] + (
            (_is_main(above) or _is_article(above)) and above.points > 0
        )

    def dropped(node: Node) -> bool:
        if not _set_apart(node):
            return False
        inside = holders[id(node)]
        beside = holders[id(root)] - inside - around[id(node)]
        wraps = inside > 0 or paragraphs[id(node)] >= _WRAPPED
        return beside > 0 or not wraps or 2 * node.points <= root.points

    _prune(root, dropped)


def _prune_named(root: Node) -> None:
    """Drop elements with a name of boilerplate, but none around the page's text.

    Comments go whenever an article or main element with points of its own stands before or around
    them, whatever their own points.

    An element stays that holds a main element, or an article with more points than any article
    outside. On a page without articles or the like outside it, so does one with most of the
    points; if its name is of boilerplate alone, only if all points are in it.
    """
    nodes = _upwards(root)
    if not any(_named(n) or _has_comments(n) for n in nodes):
        return
    _measure(nodes)
    _score(nodes, [])
    for node in nodes:
        node.score = 0.0
    place = {id(n): i for i, n in enumerate(nodes)}  # a subtree is a run that ends at its top
    below: dict[int, int] = {}
    for n in nodes:
        below[id(n)] = 1 + sum(below[id(c)] for c in n.children if not isinstance(c, str))
    mains = [place[id(n)] for n in nodes if _is_main(n)]
    holders = [(place[id(n)], n) for n in nodes if _is_main(n) or _is_article(n)]

    def follows(start: int, end: int, node: Node) -> bool:
        for i, holder in holders:
            if i < start and holder.points > 0 and not _has_comments(holder):
                return True
            if i > end and i - below[id(holder)] < start and holder.points - node.points > 1e-9:
                return True
        return False

    def dropped(node: Node) -> bool:
        comments = _has_comments(node)
        if not comments and not _named(node):
            return False
        end = place[id(node)]
        start = end - below[id(node)] + 1
        if comments and follows(start, end, node):
            return True
        if not _named(node):
            return False
        if any(start <= i <= end for i in mains):
            return False
        inside = outside = 0.0
        for i, holder in holders:
            if start <= i <= end:
                inside = max(inside, holder.points)
            else:
                around = i > end and i - below[id(holder)] < start
                outside = max(outside, holder.points - (node.points if around else 0.0))
        if inside or outside > 1e-9:
            return inside <= outside
        share = 1 - 1e-9 if _only_named(node) else 0.5
        return node.points <= share * root.points

    _prune(root, dropped)


def _upwards(root: Node) -> list[Node]:
    """All elements in the order of the page, each after those below it."""
    order, open_ = [], [root]
    while open_:
        node = open_.pop()
        order.append(node)
        open_ += (c for c in node.children if not isinstance(c, str))
    return order[::-1]  # a node goes before its children here, the last child first


def _measure(nodes: list[Node]) -> None:
    """Characters of text and of text in links below each node."""
    for node in nodes:
        node.size = node.linked = 0
        for child in node.children:
            if isinstance(child, str):
                node.size += len(_SPACE.sub(" ", child).strip())
            else:
                node.size += child.size
                node.linked += child.size if child.tag == "a" else child.linked


def _density(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


def _own_text(node: Node) -> str:
    """Text of a node outside the blocks below it."""
    parts, open_ = [], node.children[::-1]
    while open_:
        child = open_.pop()
        if isinstance(child, str):
            parts.append(child)
        elif child.tag == "br":
            parts.append(" ")
        elif child.tag not in BLOCKS:
            open_ += child.children[::-1]
    return "".join(parts)


def _points(node: Node) -> float:
    """Points of a paragraph or other block with text of its own."""
    if node.tag not in BLOCKS or node.tag in HEADINGS:
        return 0.0
    text = _SPACE.sub(" ", _own_text(node)).strip()
    return 1 + text.count(",") + min(len(text) / 100, 3) if text else 0.0


def _score(nodes: list[Node], scored: list[Node]) -> None:
    """Every paragraph, or other block with text of its own, passes its points upwards: all to its
    parent, half to the next, a third to the next and so on."""
    for node in nodes:
        points = _points(node)
        node.points = points * (1 - _density(node))
        for child in node.children:
            if not isinstance(child, str):
                node.points += child.points
        up, level = (node.parent if node.tag == "p" else node), 1
        while points and up is not None and level <= 4:
            if up.score == 0:
                scored.append(up)
            up.score += points / level
            up, level = up.parent, level + 1


def _widened(best: Node, root: Node) -> Node:
    """The nearest element around ``best`` with four fifths of the page's points: paragraphs that
    stand in nests of their own meet only there."""
    while best.parent is not None and 5 * best.points < 4 * root.points:
        best = best.parent
    return best


def _blocks(node: Node, out: list[list[str]]) -> None:
    """Collect text runs: a block starts a new run before and after itself."""
    open_ = node.children[::-1]
    while open_:
        child = open_.pop()
        if child is None:
            out.append([])
        elif isinstance(child, str):
            out[-1].append(child)
        elif child.tag == "br":
            out[-1].append(" ")
        else:
            if child.tag in BLOCKS:
                out.append([])
                open_.append(None)
            open_ += child.children[::-1]


def _text(nodes: list) -> str:
    runs: list[list[str]] = [[]]
    for node in nodes:
        if isinstance(node, str):
            runs[-1].append(node)
        elif node.tag in BLOCKS:
            runs.append([])
            _blocks(node, runs)
            runs.append([])
        else:
            _blocks(node, runs)
    lines = (_SPACE.sub(" ", "".join(run)).strip() for run in runs)
    return "\n".join(line for line in lines if line)


def _container(node: Node) -> Node | None:
    """The nearest article or main element around a node, itself included."""
    while node is not None:
        attrs = node.attrs
        if node.tag in ("article", "main") or (attrs.get("role") or "").lower() in ("article", "main"):
            return node
        if "articleBody" in (attrs.get("itemprop") or ""):
            return node
        node = node.parent
    return None


def main_text(html: str) -> str:
    """The main text of a page, one line per block; empty if there is none.

    Boilerplate elements go first, forms and hidden elements only where they are no wrapper of the
    page's text, comments wherever an article comes before them. Paragraphs pass points for length and commas to their ancestors,
    whose score is discounted by the share of their text that is in links. The best container is
    widened to the article around it, or else, if it holds under four fifths of all points, to the
    element that does, which is kept but for parts mostly in links. Otherwise it is kept whole, with those siblings that score a fifth of it
    (5 at least) or are paragraphs, headings or other plain blocks mostly outside links. A tag cut
    off by the end of the page is no text.
    """
    tree = _Tree()
    last = html.rfind("<")
    if last >= 0 and re.match(r"</?[A-Za-z][^>]*\Z", html[last:]):
        html = html[:last]  # the page ends inside a tag
    tree.feed(html)
    tree.close()
    _prune(tree.root, _dropped)
    _prune_set_apart(tree.root)
    _prune_named(tree.root)
    nodes = _upwards(tree.root)
    _measure(nodes)
    scored: list[Node] = []
    _score(nodes, scored)
    if not scored:
        return _text(tree.root.children)
    discounted = [(node.score * (1 - _density(node)), -i, node) for i, node in enumerate(scored)]
    points, _, best = max(discounted, key=lambda x: x[:2])
    whole = _container(best)
    if whole is not None:
        best = whole
    elif 5 * best.points < 4 * tree.root.points:
        best = _widened(best, tree.root)
        kept = (c for c in best.children if isinstance(c, str) or c.tag not in BLOCKS or _density(c) < 0.5)
        return _text(list(kept))
    if best.parent is None:
        return _text(best.children)
    least = max(5.0, points / 5)
    scores = {id(node): s for s, _, node in discounted}
    kept = []
    for child in best.parent.children:
        if child is best:
            kept.append(child)
        elif isinstance(child, str) or child.tag not in BLOCKS:
            if whole is None and best.tag == "p":
                kept.append(child)
        elif scores.get(id(child), 0.0) >= least:
            kept.append(child)
        elif whole is None and child.tag in ("p", "pre", "blockquote", *HEADINGS):
            if _density(child) < 0.25:
                kept.append(child)
    return _text(kept)


def extract(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, url, ``text``, ``n_chars``) of every page.

    Character references are decoded, white space inside a block is one space, blocks are joined by
    a line feed. A null or empty html gives an empty text. Repeated rows and null ids stay; an empty
    table gives no rows.
    """
    rows = pages.select(id_col, url_col, F.col(html_col).alias("text"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.decode()) if h else "" for h in utf8(batch, "text")]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    done = arrow_map(rows, extracted, rows.schema)
    return done.withColumn("n_chars", F.char_length("text").cast("long"))
