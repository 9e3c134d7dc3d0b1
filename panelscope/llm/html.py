"""Main text of HTML pages by tree scoring (operator 2).

A page is cut into tags and text by one pass of a pattern, and built into a tree with the usual implied end tags.
Elements that are boilerplate by tag, role or name are left out. Paragraphs give points for their length and
their commas to their parent, half of them to the grandparent and less to those above; an element's points are
discounted by the share of its text that is in links. The best container is kept, widened to the article
around it (without one, to what holds it together with more running text), and so are siblings that score well or read
like paragraphs.

A page is a task's smallest piece of work; pages are independent, so there is no shuffle. Time is linear in a page's length,
however deep or broken its markup.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by what they mean for the text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
DROPPED = RAW | {"nav", "header", "footer", "aside", "form", "button", "select", "option", "datalist", "fieldset", "dialog", "menu", "head",
                 "svg", "math", "object", "applet", "audio", "video", "canvas", "map", "embed", "input", "label"}
BLOCKS = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "figcaption", "figure", "h1",
          "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td",
          "tfoot", "th", "thead", "tr", "ul"} | {"nav", "header", "footer", "aside", "form", "fieldset", "dialog", "menu", "head"}
CLOSES_P = BLOCKS - {"caption", "td", "th", "tr", "tbody", "thead", "tfoot", "html", "head", "body", "summary", "figcaption"}
SAME_LEVEL = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
              "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
              "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
LEVEL_TAGS = set().union(*(closes | scope for closes, scope in SAME_LEVEL.values()))
FORMATTING = {"a", "b", "big", "code", "em", "font", "i", "s", "small", "span", "strike", "strong", "tt", "u", "q", "cite", "sub", "sup", "abbr", "mark", "time"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog"}
NAMES = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "adsense", "adbox", "banner", "breadcrumb", "breadcrumbs", "cookie",
         "cookies", "consent", "disqus", "footer", "footnav", "gdpr", "header", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation",
         "newsletter", "notice", "notices", "notification", "pagination", "pager", "popup", "promo", "promotion", "related",
         "share", "sharing", "shoutbox", "sidebar", "signup", "skyscraper", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "widgets"}
#: Beginnings that stand for longer names too (sidebar2, cookiebar).
STEMS = ("advert", "banner", "breadcrumb", "cookie", "footer", "masthead", "menu", "navbar", "navigation", "newsletter", "popup",
         "promo", "sidebar", "sponsor", "subscri")
#: What readers wrote: whole parts of names, since longer ones mean other things (commentary).
READERS = {"comment", "comments", "commentlist", "commentform", "commentarea", "commentsection", "commentbox", "disqus", "respond", "replies", "reply"}
#: What a part of an article may be called besides one of NAMES and still be that (share-box, top-nav-links); other words make it something
#: else (share-price, menu-item, header-image).
PLACES = {"area", "bar", "block", "bottom", "box", "btn", "button", "buttons", "container", "content", "fixed", "group", "holder", "icons", "inner",
          "left", "links", "list", "main", "mobile", "outer", "panel", "primary", "right", "secondary", "section", "slot", "sticky", "tools", "top",
          "unit", "wrap", "wrapper", "zone"}
CONTROLS = {"form", "button", "input", "select", "textarea"}
#: What running text consists of.
FLOW = {"p", "pre", "blockquote", "ul", "ol", "dl", "table", "figure", "figcaption", "section", "hr", "details"} | {"h1", "h2", "h3", "h4", "h5", "h6"}
NOT_ITSELF = ("has", "with", "no", "without", "is", "hide", "show")
KEPT_CONTAINERS = {"html", "body", "main"}
PARAGRAPHS = {"p", "pre", "blockquote", "li", "td", "dd", "h1", "h2", "h3", "h4", "h5", "h6", "figcaption"}
FAVOURED = {"article": 25.0, "main": 15.0, "section": 3.0, "div": 5.0, "blockquote": 3.0, "pre": 3.0, "td": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "table": -3.0}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACES = re.compile(r"\s+")
SCORED_LENGTH = 25


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "score", "chars", "link_chars", "block", "tops", "in_article", "controls")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.children: list[Node | str] = []
        self.score, self.chars, self.link_chars, self.controls = 0.0, 0, 0, False
        #: The nearest element, itself included, that is no formatting.
        self.block: Node = parent.block if parent is not None and tag in FORMATTING else self
        self.in_article: bool = parent is not None and (parent.in_article or parent.tag == "article")
        #: For each tag of SAME_LEVEL, the outermost open element that its start tag ends.
        self.tops: dict[str, Node | None] = parent.tops if parent is not None else dict.fromkeys(SAME_LEVEL)
        if tag in LEVEL_TAGS:
            self.tops = {t: None if tag in scope else (self if top is None and tag in closes else top)
                         for (t, top), (closes, scope) in zip(self.tops.items(), SAME_LEVEL.values())}


def _is_place(parts: list[str], hits: set[str]) -> bool:
    """Whether a name says that the element is the boilerplate itself: the last part does, or all others only say where it is."""
    return parts[-1] in hits or all(q in hits or q in PLACES or q[:1].isdigit() for q in parts)


def _boilerplate(tag: str, attributes: str, in_article: bool = False) -> str:
    """Why an element is left out: "" (it is not), "sure", or "named", "hinted", "header" or "readers", which what it holds may overrule."""
    if tag == "header":
        return "header"
    if tag in DROPPED:
        return "sure"
    if not attributes or tag in KEPT_CONTAINERS:
        return ""
    names: list[list[str]] = []
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        raw, name = references.unescape(a or b or c), name.lower()
        value = raw.lower().strip()
        if name in ("class", "id"):
            for word in raw.split():
                parts = [q for q in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", word).lower()) if q]
                if parts and parts[0] not in NOT_ITSELF:  # has-sidebar is no sidebar
                    names.append(parts)
        elif name == "role" and value in ROLES:
            return "sure"
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return "sure"
    every = {q for parts in names for q in parts}
    hits = {q for q in every if q in NAMES or q.startswith(STEMS)}
    if every & READERS:
        return "readers"
    if tag == "article":
        return "sure" if every & {"ad", "advert", "promo", "sponsored"} else ""
    if in_article and hits and not any(_is_place(parts, hits) for parts in names):
        return "hinted"
    return "header" if hits and hits <= {"header", "masthead"} else "named" if hits else ""


class _Open:
    """The open elements of a page, and how many there are of a tag, so that an end tag without a start tag costs nothing."""

    def __init__(self, root: Node):
        self.at = root
        self.tags: dict[str, int] = {}
        self.formatting: list[dict[str, int]] = [{}]  # within each open block

    def push(self, node: Node) -> None:
        self.at = node
        if node.tag in FORMATTING:
            self.formatting[-1][node.tag] = self.formatting[-1].get(node.tag, 0) + 1
        else:
            self.tags[node.tag] = self.tags.get(node.tag, 0) + 1
            if node.tag in BLOCKS:
                self.formatting.append({})

    def close(self, outermost: Node) -> None:
        """Close the open elements up to and including ``outermost``."""
        closed = None
        while closed is not outermost:
            closed = self.at
            if closed.tag in FORMATTING:
                self.formatting[-1][closed.tag] -= 1
            else:
                self.tags[closed.tag] -= 1
                if closed.tag in BLOCKS:
                    self.formatting.pop()
            self.at = closed.parent

    def start(self, tag: str) -> None:
        """What the start tag ends: a paragraph by a block, an item by the next one."""
        if tag in CLOSES_P and self.at.block.tag == "p":
            self.close(self.at.block)
        if tag in SAME_LEVEL and (top := self.at.tops[tag]) is not None:
            self.close(top)

    def end(self, tag: str) -> None:
        if not (self.formatting[-1] if tag in FORMATTING else self.tags).get(tag):
            return  # not open; a formatting end tag closes no block
        up = self.at
        while up.tag != tag:
            up = up.parent
        self.close(up)


def parse(page: str) -> Node:
    """The tree of a page; text is kept undecoded."""
    root = Node("#root", None)
    opened, pos, n = _Open(root), 0, len(page)
    unsure: dict[int, str] = {}
    while pos < n:
        m = TOKEN.search(page, pos)
        if m is None:
            opened.at.children.append(page[pos:])
            break
        if m.start() > pos:
            opened.at.children.append(page[pos:m.start()])
        pos = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                opened.at.children.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = m[2].lower()
        if m[1]:
            opened.end(tag)
            continue
        opened.start(tag)
        at = opened.at
        node = Node(tag, at, at.dropped)
        at.controls = at.controls or tag in CONTROLS
        reason = "" if node.dropped else _boilerplate(tag, m[3], node.in_article)
        if reason == "sure":
            node.dropped = True
        elif reason:
            unsure[id(node)] = reason
        at.children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, pos)
            pos = close.end() if close else n
        elif tag not in VOID and not (m[3].endswith("/") and tag not in BLOCKS and tag not in FORMATTING):
            opened.push(node)
    if unsure:
        _decide(root, unsure)
    return root


def _decide(root: Node, unsure: dict[int, str]) -> None:
    """Drop the elements of ``unsure``, inner ones first, that do not hold what keeps them."""
    titles: set[int] = set()  # with the article's title: an article's own header, and what is named for comments around it
    articles: set[int] = set()  # a page may be wrapped in an element named for one of its parts
    in_link = 0
    for node, entering in walk(root):
        if node.tag == "a":
            in_link += 1 if entering else -1
        if entering:
            length = sum(len(c.strip()) for c in node.children if isinstance(c, str))
            node.chars, node.link_chars = length, length if in_link else 0
            continue
        if node.tag == "h1":
            titles.add(id(node))
        if node.tag in ("article", "main"):
            articles.add(id(node))
        reason = unsure.get(id(node))
        if reason == "hinted":  # a word of its name alone: links or controls have to agree
            node.dropped = node.chars == 0 or node.controls or node.link_chars >= 0.5 * node.chars
        elif reason:
            node.dropped = id(node) not in (titles if reason == "readers" or reason == "header" and node.in_article else articles)
        above = node.parent
        if above is not None and not node.dropped:
            above.chars += node.chars
            above.link_chars += node.link_chars
            above.controls = above.controls or node.controls
            titles.update([id(above)] if id(node) in titles else [])
            articles.update([id(above)] if id(node) in articles else [])


def walk(root: Node) -> Iterator[tuple[Node, bool]]:
    """Every kept element, before (True) and after (False) what is in it; no recursion, however deep the page."""
    todo: list[tuple[Node, bool]] = [(root, True)]
    while todo:
        node, entering = todo.pop()
        yield node, entering
        if entering:
            todo.append((node, False))
            todo.extend((c, True) for c in reversed(node.children) if isinstance(c, Node) and not c.dropped)


def measure(root: Node) -> list[Node]:
    """Fill in lengths and points; returns the elements that got points."""
    scored: list[Node] = []
    in_link = 0
    commas: dict[int, int] = {}
    passed: dict[int, list[float]] = {}  # points of an element's own paragraphs, of its children's, and what is left of those below
    for node, entering in walk(root):
        if node.tag == "a":
            in_link += 1 if entering else -1
        if entering:
            node.chars = node.link_chars = 0
            for c in node.children:
                if isinstance(c, str):
                    length = len(SPACES.sub(" ", c).strip())
                    node.chars += length
                    node.link_chars += length if in_link else 0
                    commas[id(node)] = commas.get(id(node), 0) + c.count(",")
            continue
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.link_chars += node.link_chars
            if node.tag not in BLOCKS:
                commas[id(node.parent)] = commas.get(id(node.parent), 0) + commas.get(id(node), 0)
        own = node.tag in PARAGRAPHS or node.tag in BLOCKS and any(isinstance(c, str) and len(c.strip()) >= SCORED_LENGTH for c in node.children)
        if own and node.chars >= SCORED_LENGTH and node.parent is not None:
            points = (1 + commas.get(id(node), 0) + min(node.chars / 100, 3)) * (1 - node.link_chars / node.chars)
            passed.setdefault(id(node.parent if node.tag in PARAGRAPHS else node), [0.0, 0.0, 0.0])[0] += points
        points = passed.pop(id(node), None)
        if points is not None and node.parent is not None:
            own_points, below, rest = points
            node.score = own_points + below / 2 + rest
            scored.append(node)
            above = passed.setdefault(id(node.parent), [0.0, 0.0, 0.0])
            above[1] += own_points
            above[2] += below / 6 + rest * 2 / 3
    return scored


def _points(node: Node) -> float:
    return (node.score + FAVOURED.get(node.tag, 0.0)) * (1 - node.link_chars / max(node.chars, 1))


def _density(node: Node) -> float:
    return node.link_chars / max(node.chars, 1)


def _wider(node: Node) -> Node:
    """The article around a node; the main element where it has several or none; without both, what holds the node and running text alone."""
    found, up = {}, node
    while up is not None:
        if up.tag in ("article", "main"):
            found[up.tag] = up  # the outermost
        up = up.parent
    main = found.get("main")
    if main is not None and "article" in found:
        articles = [n for n, entering in walk(main) if entering and n.tag == "article" and not n.in_article]
        if sum(n.chars > 0 and _density(n) < 0.25 for n in articles) > 1:
            return main
    if found:
        return found.get("article") or main
    while node.parent is not None and node.parent.tag not in ("body", "html", "#root"):
        others = [c for c in node.parent.children if isinstance(c, Node) and c is not node and not c.dropped and c.chars]
        if not all(_density(c) < 0.25 and (c.tag in FLOW or c.tag in FORMATTING or c.score > 0) for c in others):
            break
        node = node.parent
    return node


def main_nodes(root: Node) -> list[Node]:
    """The best container and the siblings kept with it, in page order."""
    scored = measure(root)
    articles = [n for n, entering in walk(root) if entering and n.tag in ("article", "main") and n.chars]
    scored += [a for a in articles if not a.score]
    if not scored:
        bodies = [n for n, entering in walk(root) if entering and n.chars]
        return bodies[:1]
    best = _wider(max(scored, key=_points))
    limit = max(10.0, 0.2 * _points(best))
    if best.parent is None or best.tag in ("body", "html"):
        return [best]

    def joins(n: Node) -> bool:
        if n is best:
            return True
        if n.dropped or not n.chars:
            return False
        density = n.link_chars / n.chars
        if n.tag in ("p", "h1") and best.tag not in ("article", "main"):
            return density < 0.25 and (n.tag == "h1" or n.chars >= 80)
        return best.tag not in ("main",) and n.tag in ("article", "section", "div") and n.score > 0 and density < 0.25 and _points(n) >= max(
            limit, 30.0 if n.tag != best.tag else 0.0)
    return [c for c in best.parent.children if isinstance(c, Node) and joins(c)]


def block_texts(node: Node) -> Iterator[str]:
    """Texts of the blocks of an element in page order, white space folded, references decoded; none is empty."""
    run: list[str] = []

    def flush() -> Iterator[str]:
        if run:
            text = SPACES.sub(" ", references.unescape("".join(run))).strip()
            run.clear()
            if text:
                yield text

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            yield from flush()
        elif isinstance(x, str):
            run.append(x)
        elif not x.dropped:
            if x.tag in BLOCKS:
                yield from flush()
                todo.append(None)
            elif x.tag in ("br", "wbr"):
                run.append(" " if x.tag == "br" else "")
            todo.extend(reversed(x.children))
    yield from flush()


def extract(page: str | None) -> str:
    """Main text of a page, one block a line; empty for a null or empty page and for pages without text."""
    if not page:
        return ""
    return "\n".join(t for n in main_nodes(parse(page)) for t in block_texts(n))


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars.

    Edge cases: a null or empty page has an empty text; null and repeated ids and urls give a row each; broken markup is read as
    far as it goes; no rows give no rows; other columns are not read. Pages are read whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    chosen = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long").withColumnsRenamed({"page_id": id_col, "url": url_col})
