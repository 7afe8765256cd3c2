"""Forum pages to the text of their posts: a light tree over the standard HTML parser, then text rules as expressions."""

from __future__ import annotations

import re
from functools import partial
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where posts are, and what is no post text.
POST_SELECTORS = ("div.postbody > div.content", "div.postbody div.content", "div.content", ".postbody .content", "div.postbody", "div.message", "article.post")
NAVIGATION_TAGS = ("nav", "menu", "header", "footer", "aside", "div")
NAVIGATION_CLASSES = ("navbar", "breadcrumb", "pagination", "navlinks")
NAVIGATION_IDS = ("social", "breadcrumb", "navbar", "pagination", "jumpbox", "action-bar", "back2top", "signature")
NAVIGATION_LINKS = ("viewforum.php", "index.php", "viewtopic.php")
QUOTE_TAGS = ("blockquote", "quote")
QUOTE_CLASSES = ("signature", "notice")
GALLERY_LINKS = ("PhotoAlbums", ".jpg", ".png", "thumbnails")
GALLERY_TABLES = ("[img]", "photoalbums")
FORM_TAGS = ("form", "input", "button", "select", "textarea", "option", "label")
ARROWS = "⇧⇩↧↨↩⇒⇐↔⇑⇓"
MIN_POST = 50

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
OPEN_REFERENCE = re.compile(r"&(?!#?\w+;)")
BLOCK = frozenset("address article aside blockquote body center dd div dl dt fieldset footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section table tbody td tfoot th thead tr ul br option select textarea".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def walk(self):
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed([c for c in node.children if isinstance(c, Node)]))

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def text(self) -> str:
        """Text with white space folded; block elements stand apart."""
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif node.tag not in ("script", "style"):
                if node.tag in BLOCK:
                    out.append(" ")
                    stack.append(" ")
                stack.extend(reversed(node.children))
        return " ".join("".join(out).split())

    def detach(self) -> None:
        if self.parent is not None:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "li", "option") and self.at.tag == tag:
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str, closed: bool = False) -> Node:
    """Character references are read as HTML has it, some of them without their semicolon too; with ``closed``, only those that end in one."""
    builder = _Builder()
    builder.feed(OPEN_REFERENCE.sub("&amp;", html) if closed else html)
    builder.close()
    return builder.root


def _fits(node: Node, simple: str) -> bool:
    tag, *classes = simple.split(".")
    return (not tag or node.tag == tag) and all(c in node.classes() for c in classes)


def select(root: Node, selector: str) -> list[Node]:
    """Nodes for tags, classes, descendants and ``>`` children."""
    steps = selector.replace(">", " > ").split()

    def matches(node: Node, k: int) -> bool:
        if not _fits(node, steps[k]):
            return False
        if k == 0:
            return True
        up = node.parent
        if steps[k - 1] == ">":
            return up is not None and matches(up, k - 2)
        while up is not None:
            if matches(up, k - 1):
                return True
            up = up.parent
        return False

    return [n for n in root.walk() if n.tag != "#root" and matches(n, len(steps) - 1)]


def _clean(post: Node) -> None:
    def drop(test) -> None:
        # A post chosen by its own tag is detached from its page, and its text stays.
        for node in [n for n in post.walk() if test(n)]:
            node.detach()

    links = lambda n, parts: n.tag == "a" and any(p.lower() in n.attrs.get("href", "").lower() for p in parts)
    drop(lambda n: n.tag in NAVIGATION_TAGS or n.attrs.get("id") in NAVIGATION_IDS or any(c in NAVIGATION_CLASSES for c in n.classes()) or links(n, NAVIGATION_LINKS))
    drop(lambda n: n.tag in QUOTE_TAGS or any(c in QUOTE_CLASSES for c in n.classes()))
    drop(lambda n: n.tag == "img" or links(n, GALLERY_LINKS) or n.tag == "table" and any(t in n.text().lower() for t in GALLERY_TABLES))
    drop(lambda n: n.tag in FORM_TAGS)


def post_texts(html: str | None, selectors: tuple[str, ...] = POST_SELECTORS, closed: bool = False) -> list[str]:
    """The raw text of each post of the first selector that finds any."""
    if not html or not html.strip():
        return []
    root = parse(html, closed)
    for selector in selectors:
        posts = select(root, selector)
        if posts:
            for post in posts:
                _clean(post)
            return [p.text() for p in posts]
    return []


def _posts(batches, html_at, selectors, closed):
    import pyarrow as pa

    for batch in batches:
        posts = [post_texts(h, selectors, closed) for h in batch.column(html_at).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(posts, pa.list_(pa.string()))], [*batch.schema.names, "posts"])


def clean_post(text: Column) -> Column:
    """Without markup tags in brackets and arrows, white space folded."""
    text = F.regexp_replace(text, r"\[/?\w+\]", "")
    text = F.regexp_replace(text, f"[{ARROWS}]", "")
    text = F.regexp_replace(F.regexp_replace(text, "[ \t]+", " "), "\n{3,}", "\n\n")
    return F.trim(text)


def is_navigation(text: Column) -> Column:
    size = F.length(text)
    return text.contains("↳") | ((size > 2000) & text.contains("Перейти")) | ((size > 500) & (text.contains("PhotoAlbums") | text.contains("thumbnails")))


def clean_html(pages: DataFrame, html: str = "html", url: str | None = None, selectors: tuple[str, ...] = POST_SELECTORS, now: str | None = None, closed: bool = False) -> DataFrame:
    """``pages`` with ``cleaned``: the posts of at least MIN_POST characters that are no navigation, empty if there are none.

    With ``url`` (a column) a header names the page and the time. ``closed`` as in ``parse``.
    """
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType

    schema = StructType([*pages.schema.fields, StructField("posts", ArrayType(StringType()))])
    rows = pages.mapInArrow(partial(_posts, html_at=html, selectors=selectors, closed=closed), schema)
    posts = F.filter(F.transform("posts", clean_post), lambda t: (F.length(t) >= MIN_POST) & ~is_navigation(t))
    text = F.array_join(posts, "\n\n")
    if url:
        stamp = F.lit(now) if now else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
        head = F.concat(F.lit("Topic URL: "), F.col(url), F.lit("\nDownloaded: "), stamp, F.lit("\n=====================================\n\n"))
        text = F.when(F.size("posts") > 0, F.trim(F.concat(head, text))).otherwise("")
    return rows.withColumn("cleaned", text).drop("posts")
