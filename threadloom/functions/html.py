"""Body rules for stored HTML: a small helper that runs inside Arrow batches on the executors.

``outline`` reads one page into a light element tree that closes elements the way browsers do for the
cases news pages have: void elements, a paragraph ended by the next block, inline elements left open.
The rules then are a few lines each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
INLINE = frozenset("a abbr b big cite code em font i mark q s small span strong sub sup tt u".split())


class Node:
    __slots__ = ("tag", "attrs", "items")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.items = tag, attrs, []

    def children(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]

    def walk(self) -> Iterator[Node]:
        pending = [self]
        while pending:
            node = pending.pop()
            yield node
            pending.extend(reversed(node.children()))

    def text(self) -> str:
        out, pending = [], list(reversed(self.items))
        while pending:
            item = pending.pop()
            if isinstance(item, str):
                out.append(item)
            else:
                pending.extend(reversed(item.items))
        return "".join(out)


class _Outline(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH:
            self._end_paragraph()
        node = Node(tag, dict(attrs))
        self.open[-1].items.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        self.open[-1].items.append(data)

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def _end_paragraph(self):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == "p":
                del self.open[depth:]
                return
            if self.open[depth].tag not in INLINE:
                return


def outline(html: str) -> Node:
    parser = _Outline()
    parser.feed(html)
    parser.close()
    return parser.root


def _first(page: Node, test: Callable[[Node], bool]) -> Node | None:
    return next((n for n in page.walk() if test(n)), None)


def _joined(nodes: list[Node]) -> str:
    return "\n\n".join(n.text().strip() for n in nodes)


def title_of(page: Node) -> str:
    node = _first(page, lambda n: n.tag == "title")
    return " ".join(node.text().split()) if node else ""


def default_body(page: Node) -> str:
    """The paragraphs of the first article, main or body element, wherever they sit; empty ones left out."""
    for tag in ("article", "main", "body", "#page"):
        area = _first(page, lambda n: n.tag == tag)
        if area is not None:
            texts = [n.text().strip() for n in area.walk() if n.tag == "p"]
            texts = [t for t in texts if t]
            if texts:
                return "\n\n".join(texts)
    return ""


def article_body(page: Node) -> str | None:
    """Paragraphs directly under the first article; without one, the content block less its trailing links.

    None where the page has neither: the rule does not apply.
    """
    article = _first(page, lambda n: n.tag == "article")
    if article is not None:
        return _joined([n for n in article.children() if n.tag == "p"])
    content = _first(page, lambda n: n.attrs.get("id") == "article-content")
    if content is None:
        return None
    blocks = content.children()
    while blocks and any(n.tag == "a" for n in blocks[-1].walk()):
        blocks.pop()
    return _joined([n for n in blocks if n.tag not in ("meta", "script")])


RULES: dict[str, Callable[[Node], str | None]] = {"article": article_body}
