"""Main text of web pages by removal of site templates.

Element subtrees are hashed, the pages of each host that hold a subtree are counted in Spark, and subtrees that
recur across many pages of their host are deleted before the text is taken. What a page has for itself but is
never part of an article (menus, forms, scripts, adverts, reader comments) goes by its element or its name.

Only whole boxes are deleted for recurring, never an inline element, a heading or a paragraph among others, and the more
prose a box holds, the more pages must have it. Inside an article, a box that holds prose (paragraphs, headings, list
items, quotations) goes only if it recurs outside of articles as well, for articles may share passages. On a page
without an article or main element, recurring paragraphs at its very end go, and lists of links before all other text.
Copies of a page are one page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import skew_join
from arealis.sources.scratch import materialize

# A template recurs on so many distinct pages of its host, however many the host has.
MIN_PAGES = 5
# As many more for each so many characters of prose in the box.
PROSE_STEP = 500
# Elements nested deeper stay, as siblings.
MAX_DEPTH = 200

# Elements by what HTML says of them.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title xmp iframe noframes noembed".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr br img".split()
)
DROPPED = set(
    "head script style noscript template iframe object embed svg canvas audio video map form button input select "
    "textarea fieldset option datalist nav aside footer menu dialog title xmp noframes noembed".split()
)
PROSE = set("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr figcaption caption".split())
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
SCOPES = set("ul ol dl table tr td th div section article main body html select".split())
# Words of class, id and role names that mark what is not the article.
NAMES = set(
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations trending popular sidebar widget menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager comment comments disqus replies respond reply footer masthead toolbar skip search "
    "complementary contentinfo".split()
)
# A name with one of these words says how a page is laid out or what is allowed on it, as no-sidebar and comments-open.
LAYOUT = set("no not non has have with without hide hidden open opened closed enabled disabled allowed off".split())
# What reader comments inside an article are called: whole classes, and ids of a div.
COMMENTS = set("comments comment-list commentlist comments-area comment-respond disqus_thread respond".split())
# Elements that are furniture unless they hold the article, as a form around a whole page does.
AROUND = {"form", "fieldset"}
HEADER_NAMES = {"header", "topbar", "banner", "masthead"}

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^"'>])*+)>|<[a-zA-Z/!?][^>]*+(?:>|\Z)""", re.DOTALL
)
NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)


class Node:
    __slots__ = ("tag", "attrs", "children", "code", "holds")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children, self.code = tag, attrs, [], 0
        self.holds = False  # an article or main element, or around one

    def names(self) -> set[str]:
        """The words of its names; of an element that is or holds an article only the names of one word."""
        words: set[str] = set()
        for _, *found in NAMED.findall(self.attrs):
            for name in "".join(found).split():
                parts = set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()))
                if not (parts & LAYOUT or (self.holds and len(parts) > 1)):
                    words |= parts
        return words

    def tokens(self, *kinds: str) -> set[str]:
        """Its names of the given attributes, whole."""
        return {name.lower() for kind, *found in NAMED.findall(self.attrs) if kind.lower() in kinds for name in "".join(found).split()}

    def is_main(self) -> bool:
        return self.tag == "main" or "main" in self.attrs and bool(re.search(r"role\s*=\s*[\"']?main", self.attrs))


def parse(page: str) -> Node:
    """The element tree of a page; unclosed, misnested and cut-off markup is taken as browsers roughly do."""
    root = Node("html")
    stack = [root]
    at = 0
    while True:
        tag = TAG.search(page, at)
        stop = tag.start() if tag else len(page)
        if stop > at:
            stack[-1].children.append(html.unescape(page[at:stop]))
        if not tag:
            return root
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            _close(stack, name)
            continue
        if name in ("html", "body") and any(node.tag == name for node in stack[1:] or [root] if name != "html"):
            continue
        _make_room(stack, name)
        node = Node(name, tag[3])
        stack[-1].children.append(node)
        if name == "article" or node.is_main():
            for holder in [*stack, node]:
                holder.holds = True
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID and len(stack) < MAX_DEPTH:
            stack.append(node)


def _close(stack: list[Node], name: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == name:
            del stack[i:]
            return
        if name in INLINE and stack[i].tag not in INLINE:
            return  # an inline end tag does not close blocks


def _make_room(stack: list[Node], name: str) -> None:
    closes = CLOSED_BY.get(name, {"p"} if name not in INLINE else set()) | ({"p"} if name in PROSE - {"td", "th", "tr"} else set())
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in closes:
            del stack[i:]
            return
        if stack[i].tag in SCOPES and not (name in ("tr", "tbody") and stack[i].tag in ("tr", "td", "th")):
            return


def _text(node: Node) -> str:
    return "".join(child if isinstance(child, str) else _text(child) for child in node.children)


def hash_subtrees(node: Node) -> int:
    """Hash of an element with everything in it, set on all elements; white space does not count."""
    parts = [node.tag]
    for child in node.children:
        parts.append(" ".join(child.split()) if isinstance(child, str) else str(hash_subtrees(child)))
    node.code = xxhash.xxh64_intdigest("\x00".join(part for part in parts if part).encode("utf-8", "replace")) - 2**63
    return node.code


def _is_furniture(node: Node, inside: bool) -> bool:
    """Whether an element is never part of an article, by its kind or its name.

    Inside the main element only whole classes and roles count, as ids are made from headings there; prose is
    furniture by a whole class outside of it only.
    """
    if node.tag in AROUND and node.holds:
        return False
    if node.tag in DROPPED or (node.tag == "header" and not inside) or HIDDEN.search(node.attrs):
        return True
    if node.tag in ("html", "body", "main") or not node.attrs:
        return False
    if node.tag in PROSE:
        return not inside and bool(node.tokens("class", "role") & NAMES)
    if inside:
        named = node.tokens("class", "role")
        return bool(named & (NAMES | COMMENTS)) or (node.tag == "div" and bool(node.tokens("id") & COMMENTS))
    return bool(node.names() & (NAMES | HEADER_NAMES))


def _size(node: Node) -> int:
    return sum(len(child) if isinstance(child, str) else 0 if _is_furniture(child, True) else _size(child) for child in node.children)


def main_element(root: Node) -> Node:
    """The longest article, else the main element, else the whole page.

    What lies in furniture counts only if there is no other: then what holds it is none.
    """
    articles: list[Node] = []
    mains: list[Node] = []

    def find(node: Node, anywhere: bool) -> None:
        for child in node.children:
            if isinstance(child, str) or (_is_furniture(child, False) and not (anywhere and child.holds)):
                continue
            if child.tag == "article":
                articles.append(child)
                continue
            if child.is_main():
                mains.append(child)
            find(child, anywhere)

    for anywhere in (False, True):
        if root.holds and not articles and not mains:
            find(root, anywhere)
    return max(articles, key=_size) if articles else max(mains, key=_size) if mains else root


def deletable(root: Node, main: Node) -> Iterator[Node]:
    """Elements that may go for recurring: all outside the main element, and boxes inside an article."""
    for child in root.children:
        if isinstance(child, str) or child is main:
            continue
        if child.tag not in ("html", "head", "body") and not _holds(child, main):
            yield child
        yield from deletable(child, main)


def _holds(node: Node, main: Node) -> bool:
    return any(child is main or (not isinstance(child, str) and _holds(child, main)) for child in node.children)


def boxes(main: Node) -> Iterator[Node]:
    for child in main.children:
        if not isinstance(child, str) and child.tag not in PROSE and child.tag not in INLINE:
            yield child
            yield from boxes(child)


def _holds_prose(node: Node) -> bool:
    return any(not isinstance(child, str) and (child.tag in PROSE or _holds_prose(child)) for child in node.children)


def pages_needed(node: Node, min_pages: int = MIN_PAGES) -> int:
    """Pages that a subtree must recur on to go."""
    prose = len(_text(node)) if node.tag in PROSE or _holds_prose(node) else 0
    return min_pages * (1 + prose // PROSE_STEP)


def _paragraphs(node: Node) -> Iterator[Node]:
    for child in node.children:
        if not isinstance(child, str) and child.tag not in INLINE:
            if child.tag == "p":
                yield child
            elif child.tag not in PROSE:
                yield from _paragraphs(child)


def candidates(page: str) -> tuple[Node, Node, list[Node], list[Node]]:
    """The page, its main element, the elements that may go, and those that count as evidence."""
    root = parse(page)
    hash_subtrees(root)
    main = main_element(root)
    if main is root:
        may_go = [*(box for box in boxes(root) if box.tag not in ("html", "head", "body")), *_paragraphs(root)]
        return root, main, may_go, may_go
    may_go = list(boxes(main))
    return root, main, may_go, [*deletable(root, main), *(box for box in may_go if not _holds_prose(box))]


def _links(node: Node) -> tuple[int, int, int]:
    """Number of links, characters in links, characters."""
    n = linked = whole = 0
    for child in node.children:
        if isinstance(child, str):
            whole += len(child.strip())
            continue
        a, b, c = _links(child)
        if child.tag == "a":
            a, b = a + 1, c
        n, linked, whole = n + a, linked + b, whole + c
    return n, linked, whole


KEEP, MENU, TAIL = range(3)


def extract(page: str, templates: set[int]) -> str:
    """The main text: its blocks in page order, one per line."""
    root, main, may_go, _ = candidates(page)
    gone = {id(node) for node in may_go if node.code in templates}
    inside = main is not root
    blocks: list[tuple[int, list[str]]] = [(KEEP, [])]

    def kind_of(node: Node, kind: int) -> int:
        """Lists of links and recurring paragraphs, on a page without a main element, depend on where they are."""
        if inside or kind != KEEP:
            return kind
        return TAIL if id(node) in gone else MENU if node.tag in ("ul", "ol", "table") and _is_menu(node) else KEEP

    def walk(node: Node, kind: int) -> None:
        for child in node.children:
            if isinstance(child, str):
                blocks[-1][1].append(child)
            elif (id(child) in gone and child.tag not in PROSE) or _is_furniture(child, inside):
                blocks.append((kind, [])) if child.tag not in INLINE else None
            elif child.tag in INLINE:
                blocks[-1][1].append(" " if child.tag == "br" else "")
                walk(child, kind)
            else:
                blocks.append((kind_of(child, kind), []))
                walk(child, blocks[-1][0])
                blocks.append((kind, []))

    walk(main, KEEP)
    lines = [(kind, " ".join("".join(block).split())) for kind, block in blocks]
    lines = [(kind, line) for kind, line in lines if line]
    kept = [i for i, (kind, _) in enumerate(lines) if kind == KEEP]
    if not kept:  # recurring paragraphs stay where there is nothing else
        return "\n".join(line for kind, line in lines if kind == TAIL)
    first, last = kept[0], kept[-1]
    return "\n".join(
        line for i, (kind, line) in enumerate(lines) if kind == KEEP or (kind == MENU and i > first) or (kind == TAIL and i < last)
    )


def _is_menu(node: Node) -> bool:
    n, linked, whole = _links(node)
    return n > 1 and linked >= 0.8 * whole


def _hosted(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(
        F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("html"), host.alias("host")
    ).withColumn("content", F.md5(F.concat_ws(" ", "host", "html").cast("binary")))


def page_elements(hosted: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, content, copies, evidence, may_go, needed``: one row per distinct page of a host, its codes and the pages
    that each code that may go must be on."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[str] = set()
        for batch in batches:
            out = []
            for content, page in zip(batch["content"].to_pylist(), batch["html"], strict=True):
                if content in known:
                    out.append((None, None, None))
                    continue
                known.add(content)
                _, _, may_go, evidence = candidates(page.as_py())
                needed = {node.code: pages_needed(node, min_pages) for node in may_go}
                out.append((list({node.code for node in evidence}), list(needed), list(needed.values())))
            types = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays(
                [batch["host"], batch["content"], *columns], ["host", "content", "evidence", "may_go", "needed"]
            )

    kind = "host string, content string, evidence array<long>, may_go array<long>, needed array<long>"
    rows = hosted.select("host", "content", "html").mapInArrow(read, kind)
    first = [F.first(name, ignorenulls=True).alias(name) for name in ("evidence", "may_go", "needed")]
    return rows.groupBy("host", "content").agg(F.count(F.lit(1)).alias("copies"), *first)


def find_templates(hosted: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``content, copies, codes``: the subtrees to delete from each distinct page that has such, at most its own."""
    elements = materialize(page_elements(hosted, min_pages))
    counted = elements.select("host", F.explode("evidence").alias("code")).groupBy("host", "code").agg(F.count(F.lit(1)).alias("n"))
    often = materialize(counted.filter(F.col("n") >= min_pages))
    total = often.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    places = elements.select("host", "content", "copies", F.explode(F.arrays_zip("may_go", "needed")).alias("_place"))
    places = places.select("host", "content", "copies", F.col("_place.may_go").alias("code"), F.col("_place.needed").alias("needed"))
    found = skew_join(places, often, ["host", "code"], "n", max(1, total), F.col("content"), "inner").filter("n >= needed")
    return found.groupBy("content", "copies").agg(F.collect_list("code").alias("codes"))


def extract_pages(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Per row of ``pages``: key, url, ``text`` (empty if none), ``n_chars`` (its code points).

    Blocks have single spaces and no others, and are joined by one line break. A null page is empty; pages without
    a host share one; rows that repeat are pages like any other; pages of any length are read whole; other
    columns are ignored; an empty table gives no rows. Keys of any type and size come back as they are, null too.
    """
    hosted = _hosted(pages, key, url, payload)
    templates = materialize(find_templates(hosted, min_pages))
    total = templates.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    joined = skew_join(hosted, templates, ["content"], "copies", max(1, total), F.col("page_id"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch["codes"].to_pylist()
            texts = [extract(page.as_py(), set(c or ())) for c, page in zip(codes, batch["html"], strict=True)]
            columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])

    kind = pages.schema[key].dataType.simpleString()
    out = joined.select("page_id", F.col("url").cast("string").alias("url"), "html", "codes")
    out = out.mapInArrow(take, f"page_id {kind}, url string, text string")
    return out.select(F.col("page_id").alias(key), F.col("url").alias(url), "text", F.char_length("text").cast("long").alias("n_chars"))
