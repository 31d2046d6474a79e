"""Main text of web pages by wrapper induction.

Every page is parsed into a tree in which neighbouring nodes of one label are one node, and its tree is
aligned with that of its host's reference page by simple tree matching: two nodes match if their labels
do, and the children of matching nodes are aligned, in order, for the most matches. Text blocks are then
known by the reference node they fall on. Over all pages of the host, a block that stands on the same node
with the same text in at least half of the pages (each distinct page counted once, and two more without it)
is template; what varies is content, and so is all that is marked as the article if any of it varies, as paragraphs may repeat. This is
decided first, over all blocks. Alignment cannot tell the article from other parts that
vary, such as adverts or comments, so of the varying blocks those go that their element or class names call
menus, headers, footers, sidebars, notices, adverts, forms or comments, and those that consist of links and
are not in the article; unless nothing would be left but these names. Within the marked article only elements
that are menus, asides or forms, and those whose whole class or id is a name of adverts or of readers' comments, are
other parts. If at least half of the text that stays is marked as the article, the rest goes too.

Every step takes time in proportion to the page, or nearly so: tags are found by the places of the characters that
end them, and children are aligned after what both lists begin and end with.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ARROW_ROWS, let
from millrace.session import materialize

#: A block is template if this share of its host's distinct pages have it, of which so many more are thought not to: so all
#: of two or three pages must have it, and the page of a host that has but one has no template.
SHARE, UNSEEN = 0.5, 2
#: In the tree that is aligned, deeper elements count as children of an element at this depth. Names are read at any depth.
DEPTH = 60
#: Cells of an alignment of children that are held at once, as bits.
CELLS = 400_000_000

ATTRIBUTE = re.compile(r"""(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: A tag's name, if it is of a sane length, and what follows it up to its end.
TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]{0,199}(?=[\s/>])")
ATTRIBUTES = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
WORD = re.compile("[a-z]+")
HUMP = re.compile("(?<=[a-z])(?=[A-Z])")
#: Elements whose content is no markup, and elements without content.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
          "tt", "u", "var", "wbr"}
#: Elements that end an open element of the named kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"ul", "ol", "dl", "table", "select", "body", "html", "article", "main", "section", "div"}
APART = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "svg", "head", "object",
         "datalist", "fieldset"}
#: Names, in class, id or role, of parts that are not the article.
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
         "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "disqus",
         "discussion", "footer", "gdpr", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation",
         "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "promoted", "related", "replies",
         "respond", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar",
         "widget", "alert", "search", "login", "signup", "feedback", "responses"}
ARTICLE = {"article", "main"}
#: Parts of a marked article that are not its text: elements, and whole classes or ids.
APART_INSIDE = APART - {"header", "footer"}
TOKENS_INSIDE = {"ad", "ads", "advert", "adverts", "advertisement", "ad-slot", "comment", "comments", "comment-list", "comments-area",
                 "reader-comments", "user-comments", "disqus_thread"}
FLAGS = ("apart", "links", "article")


class Node:
    __slots__ = ("label", "children", "apart", "article", "path", "form", "size")

    def __init__(self, label: str, apart: bool, article: bool, path: str):
        self.label, self.children, self.apart, self.article, self.path = label, [], apart, article, path
        self.form, self.size = b"", 1


def digest(*parts: bytes) -> bytes:
    return blake2b(b"\n".join(parts), digest_size=8).digest()


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Tags of a page in one pass: start, end, ``/`` if it closes, name and attributes; comments and the like have no name.

    A ``<`` that no ``>`` outside quotes closes is text.
    """
    places: dict[str, list[int]] = {}
    special: list[int] = []
    dead: set[int] = set()

    def after(where: list[int], at: int) -> int:
        i = bisect_left(where, at)
        return where[i] if i < len(where) else -1

    def close(at: int) -> int:
        """Place of the first ``>`` outside quotes, or -1.

        Once there is none for a tag, the rest of the page is looked up in lists, and no place twice in vain.
        """
        if not places:
            whole = ATTRIBUTES.match(page, at)
            if whole:
                return whole.end() - 1
            places.update({c: [m.start() for m in re.finditer(c, page)] for c in ">\"'"})
            special.extend(sorted(p for ps in places.values() for p in ps))
        seen = []
        while True:
            at = after(special, at)
            if at < 0 or at in dead:
                break
            if page[at] == ">":
                return at
            seen.append(at)
            end = after(places[page[at]], at + 1)
            if end < 0:
                break
            at = end + 1
        dead.update(seen)
        return -1

    at, n, last = 0, len(page), page.rfind(">")
    while 0 <= (start := page.find("<", at)) < n:
        at, mark = start + 1, page[start + 1:start + 2]
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            yield start, (at := n if end < 0 else end + 3), "", "", ""
        elif mark and mark in "!?":
            if start < last:
                yield start, (at := page.index(">", start) + 1), "", "", ""
        else:
            first = start + 1 + (mark == "/")
            name = TAG_NAME.match(page, first) if start < last else None
            end = close(name.end()) if name else -1
            if end >= 0:
                # Where to go on is told by the reader, which may skip what is no markup.
                went = yield start, end + 1, page[start + 1:first], name[0].lower(), page[name.end():end]
                at = went or end + 1


def parse(page: str) -> tuple[Node, list[tuple]]:
    """Tree of a page and its blocks in order, as (node, text, characters of it in links, other part, article)."""
    root = Node("", False, False, "")
    # Open elements with their node and whether they are another part, or in the article.
    stack: list[tuple[str, Node, bool, bool]] = [("", root, False, False)]
    count: Counter[str] = Counter()
    blocks: list[tuple] = []
    text: list[str] = []
    links = in_link = 0

    def flush() -> None:
        nonlocal links
        if text:
            words = " ".join("".join(text).split())
            if words:
                blocks.append((stack[-1][1], words, links, *stack[-1][2:]))
            text.clear()
        links = 0

    def say(piece: str) -> None:
        nonlocal links
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            text.append(piece)
            if in_link:
                links += len(piece)

    def pop_to(names: set[str], stop: set[str]) -> None:
        if not any(count[x] for x in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                flush()
                count.subtract(x[0] for x in stack[k:])
                del stack[k:]
                return
            if stack[k][0] in stop:
                return

    n, at, found = len(page), 0, tags(page)
    tag = next(found, None)
    while tag:
        start, end, closing, name, attributes = tag
        say(page[at:start])
        at, goes_on = end, None
        if name in INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            elif name == "br":
                text.append(" ")
        elif name in RAW:
            if not closing:
                last = re.compile(f"</{re.escape(name)}\\b", re.I).search(page, at)
                at = page.find(">", last.end()) + 1 if last else 0
                at = goes_on = at or n
        elif name:
            flush()
            in_link = 0
            if name in VOID:
                pass
            elif closing:
                pop_to({name}, set())
            else:
                if name not in ("p",) and name in CLOSES:
                    pop_to(CLOSES[name], HOLDS - {"div"})
                else:
                    pop_to({"p"}, HOLDS | {"li", "td", "th"})
                stack.append(_opened(name, attributes, stack))
                count[name] += 1
        try:
            tag = found.send(goes_on) if goes_on else next(found, None)
        except StopIteration:
            tag = None
    say(page[at:])
    flush()
    return root, blocks


def _opened(name: str, attributes: str, stack: list[tuple[str, Node, bool, bool]]) -> tuple[str, Node, bool, bool]:
    """The entry of an element that opens now; neighbours of one label are one node."""
    _, parent, apart, article = stack[-1]
    names, marked, tokens = "", False, set()
    if attributes:
        named_as = [(k.lower(), "".join(v)) for k, *v in ATTRIBUTE.findall(attributes)]
        marked = any("main" in v.lower().split() if k == "role" else "articlebody" in v.lower().split() for k, v in named_as)
        tokens = {t for k, v in named_as if k in ("class", "id") for t in v.lower().split()}
        names = HUMP.sub(" ", " ".join(v for _, v in named_as)).lower()
    words = set(WORD.findall(names)) if names else ()
    label = f"{name} {' '.join(sorted(words))}" if words else name
    if article:
        other = name in APART_INSIDE or not TOKENS_INSIDE.isdisjoint(tokens)
    else:
        other = name in APART or bool(words) and name not in ("body", "html", "main", "article") and (
            not NAMES.isdisjoint(words) or "header" in words)
    if len(stack) > DEPTH:
        node = parent
    elif parent.children and parent.children[-1].label == label:
        node = parent.children[-1]
    else:
        node = Node(label, apart or other, article or name in ARTICLE or marked, digest(parent.path.encode(), label.encode()).hex())
        parent.children.append(node)
    return name, node, apart or other, article or name in ARTICLE or marked


def _sign(root: Node) -> None:
    """Form (a hash of the tree of labels) and size of every node, children first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += node.children
    for node in reversed(order):
        node.form = digest(node.label.encode(), *(c.form for c in node.children))
        node.size = 1 + sum(c.size for c in node.children)


def matching(a: Node, b: Node, known: dict) -> int:
    """Simple tree matching of two trees: the most nodes that match in order, held by the trees' forms."""
    if a.label != b.label:
        return 0
    if a.form == b.form:
        return a.size
    key = a.form, b.form
    if key not in known:
        known[key] = 1 + sum(matching(x, y, known) for x, y in aligned(a.children, b.children, known))
    return known[key]


def aligned(left: list[Node], right: list[Node], known: dict) -> list[tuple[Node, Node]]:
    """The pairs of two lists of trees, in order, with the most matching nodes.

    Equal trees at both ends match each other in some best alignment, so only what lies between is searched.
    """
    low, high = 0, 0
    most = min(len(left), len(right))
    while low < most and left[low].form == right[low].form:
        low += 1
    while high < most - low and left[-1 - high].form == right[-1 - high].form:
        high += 1
    inner = _searched(left[low:len(left) - high], right[low:len(right) - high], known)
    return [*zip(left[:low], right[:low]), *inner, *zip(left[len(left) - high:], right[len(right) - high:])]


def _searched(left: list[Node], right: list[Node], known: dict) -> list[tuple[Node, Node]]:
    if not left or not right:
        return []
    if len(left) * len(right) > CELLS and len(left) > 1:
        # The best place to cut the right list at the middle of the left one.
        half = len(left) // 2
        ahead = _scores(left[:half], right, known)[0]
        back = _scores(left[half:][::-1], right[::-1], known)[0][::-1]
        cut = int(np.argmax(ahead + back))
        return _searched(left[:half], right[:cut], known) + _searched(left[half:], right[cut:], known)
    _, ups, sides = _scores(left, right, known, keep=True)
    i, j, out = len(left), len(right), []
    while i and j:
        if _bit(ups[i - 1], j - 1):
            i -= 1
        elif _bit(sides[i - 1], j - 1):
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((left[i], right[j]))
    return out[::-1]


def _bit(bits: np.ndarray, i: int) -> bool:
    return bool(bits[i >> 3] >> (7 - (i & 7)) & 1)


def _scores(left: list[Node], right: list[Node], known: dict, keep: bool = False) -> tuple[np.ndarray, list, list]:
    """Last row of the table of best scores, and by cell whether the one above, or the one before, is as good."""
    forms: dict[bytes, int] = {}
    kinds = np.array([forms.setdefault(y.form, len(forms)) for y in right])
    some = {y.form: y for y in right}
    weights: dict[bytes, np.ndarray] = {}
    best, ups, sides = np.zeros(len(right) + 1, np.int64), [], []
    for x in left:
        if x.form not in weights:
            weights[x.form] = np.array([matching(x, some[f], known) for f in forms], np.int64)
        row = np.zeros_like(best)
        np.maximum.accumulate(np.maximum(best[1:], best[:-1] + weights[x.form][kinds]), out=row[1:])
        if keep:
            ups.append(np.packbits(row[1:] == best[1:]))
            sides.append(np.packbits(row[1:] == row[:-1]))
        best = row
    return best, ups, sides


def align(a: Node, b: Node, known: dict | None = None) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching of two trees: the number of matching nodes, and which match."""
    known = {} if known is None else known
    for tree in (a, b):
        if not tree.form:
            _sign(tree)
    if a.label != b.label:
        return 0, []
    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        todo += [(p, q) for p, q in aligned(x.children, y.children, known) if p.label == q.label]
    return len(out), out


def numbered(root: Node) -> dict[int, int]:
    """Place of each node in preorder."""
    out, todo = {}, [root]
    while todo:
        node = todo.pop()
        out[id(node)] = len(out)
        todo += reversed(node.children)
    return out


def reference_of(page: str) -> tuple[Node, dict[int, int]]:
    """A reference page's tree and the places of its nodes."""
    root, _ = parse(page)
    return root, numbered(root)


def cut(page: str, reference: tuple[Node, dict[int, int]]) -> list[tuple[str, int, bool, bool, bool]]:
    """Blocks of a page in order: text, a hash of the text and the reference node it falls on, and whether its names
    call it another part than the article, whether it consists of links outside the article, and whether it is marked as the article."""
    root, blocks = parse(page)
    if not blocks:
        return []
    other, places = reference
    place = {id(x): b"%d" % places[id(y)] for x, y in align(root, other)[1]}
    out = []
    for node, text, links, apart, article in blocks:
        key = digest(place.get(id(node), node.path.encode()), text.encode())
        out.append((text, int.from_bytes(key, "big", signed=True), apart, 2 * links > len(text) and not article, article))
    return out


def unnamed(blocks: Column) -> Column:
    """The blocks that names do not call another part; all of them if names would leave none."""
    return let(F.filter(blocks, lambda b: ~b["apart"]), lambda kept: F.when(F.size(kept) > 0, kept).otherwise(blocks))


def length(blocks: Column) -> Column:
    """Characters of the blocks."""
    return F.aggregate(blocks, F.lit(0).cast("long"), lambda n, b: n + F.length(b["t"]))


def article_of(blocks: Column) -> Column:
    """The blocks marked as the article if they are at least half of the text, or else all."""
    return let(F.filter(blocks, lambda b: b["article"]), lambda kept: F.when(2 * length(kept) >= length(blocks), kept).otherwise(blocks))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    The host is the authority of the url, in lower case; pages whose url is null or has none share one
    host. The reference page of a host is the one with the smallest page_id. Null html counts as empty
    and gives an empty text. Markup that is not closed, or nested at any depth, loses no text.
    Rows that repeat a page, or its id with another html, are each returned; other columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    first = rows.where("html <> ''").groupBy("host").agg(
        F.min(F.struct(F.col("page_id"), F.col("html"))).alias("r")).select("host", F.col("r.html").alias("reference"))
    # Written, so that Spark knows its size and shuffles the pages only if it is large.
    first = materialize(first, "references")
    joined = rows.join(first, "host", "left")
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    kind = pa.list_(pa.struct([("t", pa.string()), ("k", pa.int64()), *((c, pa.bool_()) for c in FLAGS)]))

    def run(batches):
        known: dict[str, tuple] = {}

        def blocks_of(page: str, reference: str) -> list[dict]:
            if not page:
                return []
            if reference not in known:
                if len(known) >= 32:
                    known.clear()
                known[reference] = reference_of(reference)
            return [dict(zip(("t", "k", *FLAGS), block)) for block in cut(page, known[reference])]

        for batch in batches:
            found = list(map(blocks_of, batch.column("html").to_pylist(), batch.column("reference").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("page_id", "url", "host")] + [pa.array(found, kind)],
                                             names=["page_id", "url", "host", "blocks"])

    types = dict(pages.dtypes)
    blocks = joined.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, host string, "
                                    f"blocks array<struct<t:string,k:bigint,{','.join(f'{c}:boolean' for c in FLAGS)}>>")
    blocks = materialize(blocks, "blocks")
    # Copies of a page count once, as otherwise a much copied article would look like template.
    distinct = blocks.select("host", F.array_distinct(F.transform("blocks", lambda b: b["k"])).alias("ks")).select(
        "host", "ks", F.xxhash64("ks").alias("page")).dropDuplicates(["host", "page"])
    size = distinct.groupBy("host").agg(F.count("*").alias("pages"))
    seen = distinct.select("host", F.explode("ks").alias("k")).groupBy("host", "k").agg(F.count("*").alias("n")).where(
        F.col("n") > 1)
    # At most 1 / SHARE times a page's mean number of blocks can be template, so a host's list is short.
    often = F.col("n") >= SHARE * (F.col("pages") + UNSEEN)
    template = seen.join(size, "host").where(often).groupBy("host").agg(F.collect_list("k").alias("template"), F.max("pages").alias("pages"))
    template = materialize(template, "templates")
    constant = lambda b: F.coalesce(F.array_contains(F.col("template"), b["k"]), F.lit(False))
    # The fewer pages, the less of a page can be known to be template, as they may be versions of one article.
    least = length(F.col("blocks")) * UNSEEN / (F.coalesce("pages", F.lit(1)) + UNSEEN)
    alive = F.exists("blocks", lambda b: b["article"] & ~constant(b))
    varying = let(F.filter("blocks", lambda b: ~constant(b) | (b["article"] & alive)),
                  lambda kept: F.when(length(kept) >= least, kept).otherwise(F.col("blocks")))
    kept = let(let(F.filter(varying, lambda b: ~b["links"]), unnamed), article_of)
    text = F.array_join(F.transform(kept, lambda b: b["t"]), " ")
    return blocks.join(template, "host", "left").select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
