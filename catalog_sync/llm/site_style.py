"""Main text of web pages by site style trees.

A page is read into blocks of text, each under a path of style nodes: tags with their class and id,
digits left out. The trees of a host's pages are merged by path. A style node's importance comes
from entropy: of its presentation, the sequence of child tags its pages show there, and of its
content, how evenly each text repeats over the distinct pages that have the node. What most pages show alike
tells nothing; what each page says for itself is important. A branch is as important as its blocks
are on average, with a share for its presentation.

Hosts with few pages have little to compare, so a node's standing weighs in: tags, roles and names of
navigation, adverts, notices, forms and comments count as unimportant at once, and where a page has an
article or main element with text, what stands outside does. Within the article only nodes with a
class or id of their own can be of low importance: that paragraphs return on other pages does not
make them less the article.

A mark by name alone can be overruled: a compound name (``nav-fixed``) by the text of its branch, a whole
one by an article or main below it, if all that is kept otherwise is little beside that text. Names that
tell a state (``with-sidebar``, ``has-comments``) are no marks.

Reading takes time and memory linear in the page: a tag without end is searched once, closing tags find
their element by name, paths are chained hashes. As in browsers, plain elements nested deeper than
``DEPTH`` belong to the last one above that depth; their text stays, in blocks of its own.

Statistics are counted per (host, path, text) and per (host, path), never per host in one group; a page
meets the unimportant ones among its own paths only.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_sync.scratch import stage

LEAST_PAGES = 5
LOW = 0.3
LOW_INSIDE = 0.1
PRESENTATION = 0.1
DEPTH = 512
#: Below so many nested marks by name no text overrules them.
NESTED_MARKS = 64

# Elements and attributes of HTML, and names that mark what is not the article.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
DROPPED = set(
    "head script style noscript template iframe svg math form button select input textarea option "
    "nav aside footer menu dialog object canvas audio video map datalist label fieldset".split()
)
ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
MARKS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar topbar toolbar breadcrumb breadcrumbs pagination pager "
    "header masthead footer sidebar aside widget widgets "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay disclaimer "
    "comment comments commentlist respond disqus replies reply discussion "
    "form login signup signin subscribe subscription newsletter search "
    "share sharing social related recommended teaser teasers copyright".split()
)
STATES = set("with without no not has have had is are show hide hides shows".split())
#: Text below a mark by name overrules it from this many times the text kept otherwise.
OVERRULES = 4
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
BARRIERS = {"table", "td", "th", "ul", "ol", "dl", "body", "html", "article", "section", "div", "main", "form"}

OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
REST = re.compile(r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def key_of(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def path_key(styles: list[str]) -> int:
    """The key of the path of these style nodes from the root."""
    key = 0
    for style in styles:
        key = _below(key, style)
    return key


def _below(key: int, style: str) -> int:
    return key_of(f"{key}/{style}")


class Tokens:
    """The tags of a page in order, with the text before each.

    A quote that never closes is found once: tags that would run into it end at their next ``>``.
    """

    def __init__(self, page: str):
        self.page, self.at = page, 0
        self.last = page.rfind(">")
        #: Tags that open before this run into a quote that never closes.
        self.unclosed = 0

    def next(self) -> tuple[str, str, str, str] | None:
        """(text before, "/" of a closing tag, tag or "" of comments and the end, what follows the name)."""
        page, start = self.page, self.at
        look = start
        while True:
            at = page.find("<", look)
            if at < 0:
                self.at = len(page)
                return (page[start:], "", "", "") if start < len(page) else None
            if page.startswith(("<!", "<?"), at):
                self.at = self._skipped(at)
                return page[start:at], "", "", ""
            opened = OPEN.match(page, at) if at < self.last else None
            end = self._end(at, opened.end()) if opened else -1
            if end >= 0:
                self.at = end + 1
                return page[start:at], opened[1], opened[2].lower(), page[opened.end() : end]
            look = at + 1

    def _skipped(self, at: int) -> int:
        """Where the comment or declaration at ``at`` ends."""
        page = self.page
        if page.startswith("<!--", at):
            ends = [(page.find(mark, at + 4), len(mark)) for mark in ("-->", "--!>")]
            return min((e + n for e, n in ends if e >= 0), default=len(page))
        if page.startswith("<![CDATA[", at):
            end = page.find("]]>", at)
            return end + 3 if end >= 0 else len(page)
        end = page.find(">", at)
        return end + 1 if end >= 0 else len(page)

    def _end(self, at: int, named: int) -> int:
        if at >= self.unclosed:
            end = REST.match(self.page, named).end()
            if end < len(self.page) and self.page[end] == ">":
                return end
            self.unclosed = end + 1
        return self.page.find(">", named)

    def skip_raw(self, tag: str) -> None:
        """Go behind the closing tag of an element whose content is no markup."""
        close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(self.page, self.at)
        end = self.page.find(">", close.end()) if close else -1
        self.at = end + 1 if end >= 0 else len(self.page)




class Node:
    __slots__ = (
        "tag", "parent", "key", "style", "inside", "dropped", "named", "children", "heading", "whole", "weak",
        "inline", "block",
    )

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None):
        self.tag, self.parent = tag, parent
        given = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
        parts = [NAME.findall(CAMEL.sub(" ", token).lower()) for token in given]
        names = [n for token in parts for n in token]
        self.named = bool(names)
        self.style = tag + "".join(f".{n}" for n in sorted(set(names)))
        self.key = _below(parent.key if parent else 0, self.style)
        self.children: list[str] = []
        #: Inline elements open in it, by name, and its place in the stack or that of the next block above.
        self.inline: Counter[str] | None = None
        self.block = 0
        self.inside = bool(parent and parent.inside) or tag in ("article", "main") or attributes.get("role") == "main"
        self.heading = tag in HEADINGS or bool(parent and parent.heading)
        marked = (
            tag in DROPPED or tag == "header"
            or attributes.get("role", "").lower() in ROLES or "hidden" in attributes
            or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        )
        marks = MARKS
        if tag in ("html", "body", "article", "main") or self.heading and self.inside:
            marked, marks = False, set() if tag in ("html", "body") or tag in HEADINGS else {"comment", "comments"}
        told = [token for token in parts if not (len(token) > 1 and token[0] in STATES)]
        self.whole = any(len(token) == 1 and token[0] in marks for token in told)
        by_name = self.whole or any(not marks.isdisjoint(token) for token in told)
        above = parent.dropped if parent else ""
        #: The node and those above it that only their names mark.
        self.weak: tuple[Node, ...] = parent.weak if parent else ()
        at_top = self.inside and (tag == "header" or tag not in DROPPED and any("header" in token for token in told))
        # In an article's header its headings stay, whatever the header is called.
        if above == "header" and self.heading and self.inside:
            self.dropped = ""
        elif above:
            self.dropped = above
        elif marked or by_name and at_top:
            self.dropped = "header" if at_top else "out"
        else:
            self.dropped = ""
            if by_name and len(self.weak) == NESTED_MARKS:
                self.dropped = "out"
            elif by_name:
                self.weak = (*self.weak, self)


def attributes_of(source: str) -> dict[str, str]:
    if not source or source.isspace():
        return {}
    out: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), entities.unescape(double or single or bare))
    return out


class Tree:
    """The open elements of a page while it is read, its style nodes and its blocks of text."""

    def __init__(self) -> None:
        self.current = Node("html", {}, None)
        self.stack, self.nodes = [self.current], [self.current]
        self.blocks: list[tuple[Node, str]] = []
        self.parts: list[str] = []
        self.places: dict[str, list[int]] = {}  # where in the stack the elements of a name are
        self.deep: list[str] = []  # plain block elements beyond the depth, within the current node
        self.deep_open: Counter[str] = Counter()

    def finish(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((self.current, text))
            self.parts.clear()

    def _pop_to(self, place: int) -> None:
        self.finish()
        for node in reversed(self.stack[place:]):
            self.places[node.tag].pop()
        del self.stack[place:]
        self.current = self.stack[-1]
        self._leave_deep(0)

    def _leave_deep(self, size: int) -> None:
        for tag in self.deep[size:]:
            self.deep_open[tag] -= 1
        del self.deep[size:]

    def _place(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else 0

    def close(self, tag: str) -> None:
        """Inline elements close within their node only, list items and paragraphs within their article."""
        if tag not in BLOCKS:
            if self.current.inline and self.current.inline[tag] > 0:
                self.current.inline[tag] -= 1
            elif self.current.tag == tag and len(self.stack) > 1:
                self._pop_to(len(self.stack) - 1)
            return
        if self.deep_open[tag] > 0:
            self.finish()
            while self.deep[-1] != tag:
                self._leave_deep(len(self.deep) - 1)
            self._leave_deep(len(self.deep) - 1)
            return
        place = self._place(tag)
        if place and not (tag in ("p", "li") and place < max(map(self._place, ("article", "main", "body")))):
            self._pop_to(place)

    def open_inline(self, tag: str) -> None:
        if self.current.inline is None:
            self.current.inline = Counter()
        self.current.inline[tag] += 1

    def open(self, tag: str, attributes: dict[str, str]) -> None:
        above = self.current.block
        if above and tag in BLOCKS and not self.deep:
            own = self.stack[above].tag
            if own == "p" or own in CLOSES.get(tag, ()):
                self._pop_to(above)
        self.finish()
        if len(self.stack) >= DEPTH and tag in BLOCKS and tag not in DROPPED and tag not in ("article", "main"):
            if not (attributes and _marked(attributes)):
                self.deep.append(tag)
                self.deep_open[tag] += 1
                return
        node = Node(tag, attributes, self.current)
        node.block = len(self.stack) if tag in BLOCKS else self.current.block
        self.current.children.append(node.style)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(node)
        self.nodes.append(node)
        self.current = node


def read(page: str) -> tuple[list[tuple[Node, str]], list[Node]]:
    """(blocks of text with the style node they stand in, all style nodes) of a page in its order."""
    tree, tokens = Tree(), Tokens(page)
    while (token := tokens.next()) is not None:
        text, closing, tag, rest = token
        if text:
            tree.parts.append(entities.unescape(text) if "&" in text else text)
        if not tag:
            continue
        if closing:
            tree.close(tag)
        elif tag in RAW:
            if not rest.endswith("/") or tag in ("script", "style", "title", "textarea"):
                tokens.skip_raw(tag)
        elif tag in ("br", "wbr"):
            tree.parts.append(" " if tag == "br" else "")
        elif tag == "html":
            continue
        elif tag not in BLOCKS and not _matters(rest):
            if tag not in VOID and not rest.endswith("/"):
                tree.open_inline(tag)
        elif tag in VOID:
            if tag == "hr":
                tree.finish()
        else:
            attributes = attributes_of(rest)
            if tag not in BLOCKS and tag not in DROPPED and not _marked(attributes):
                tree.open_inline(tag)
            else:
                tree.open(tag, attributes)
    tree.finish()
    return tree.blocks, tree.nodes


def _matters(rest: str) -> bool:
    return bool(rest) and ("class" in rest or "id=" in rest or "role" in rest or "style" in rest or "hidden" in rest)


def _marked(attributes: dict[str, str]) -> bool:
    node = Node("span", attributes, None)
    return bool(node.dropped or node.weak)


def statistics(page: str) -> Iterator[tuple[int, int, int, bool]]:
    """(path, 0 for texts and 1 for presentations, what it shows, whether the first of its path), each
    once per page."""
    blocks, nodes = read(page)
    seen: set[tuple[int, int, int]] = set()
    paths: set[tuple[int, int]] = set()

    def row(key: int, kind: int, mark: int):
        if (key, kind, mark) not in seen:
            seen.add((key, kind, mark))
            yield key, kind, mark, (key, kind) not in paths
            paths.add((key, kind))

    for node, text in blocks:
        mark = key_of(text)
        # A text counts for its node and the nodes above it: branches are merged on every level.
        for _ in range(DEPTH):
            if node is None or node.tag in ("html", "body"):
                break
            yield from row(node.key, 0, mark)
            node = node.parent
    for node in nodes:
        if node.children and node.tag not in ("html", "body"):
            runs = [c for i, c in enumerate(node.children) if i == 0 or c != node.children[i - 1]]
            yield from row(node.key, 1, key_of(" ".join(runs)))


def extract(page: str, low: dict[int, float]) -> str:
    """The page's main text; ``low``: the importance of its host's unimportant style nodes."""
    blocks, nodes = read(page)
    out: dict[int, bool] = {}
    for node in nodes:
        above = out[id(node.parent)] if node.parent else False
        importance = low.get(node.key, 1.0) if low else 1.0
        if node.inside:
            cut = node.named and node.tag not in ("article", "main") and importance < LOW_INSIDE
        else:
            cut = importance < LOW and node.tag not in ("html", "body")
        out[id(node)] = above or cut
    kept = _unmarked([(node, text) for node, text in blocks if not node.dropped and not out[id(node)]])
    if any(node.inside for node, _ in kept):
        kept = [(node, text) for node, text in kept if node.inside]
    return "\n\n".join(text for _, text in kept)


def _unmarked(blocks: list[tuple[Node, str]]) -> list[tuple[Node, str]]:
    """The blocks below no mark by name, but for the marks that the text below them overrules."""
    stay: set[int] = set()
    while True:
        kept, gains = 0, {}
        for node, text in blocks:
            rest = tuple(w for w in node.weak if id(w) not in stay)
            if not rest:
                kept += len(text)
            elif all(not w.whole or node.inside and not w.inside for w in rest):
                by = tuple(id(w) for w in rest)
                gains[by] = gains.get(by, 0) + len(text)
        best = max(gains, key=gains.get, default=None)
        if best is None or gains[best] <= OVERRULES * kept:
            return [(node, text) for node, text in blocks if all(id(w) in stay for w in node.weak)]
        stay.update(best)


def host_of(url: Column) -> Column:
    """The lower-cased host; NULL and malformed urls share the host ''."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(host)


def importance(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, path (hash), pages, importance: one row per style node of a host's merged tree.

    A page that a host shows several times counts once. Only pages whose hash repeats are compared
    whole, so the others are not shuffled.
    """
    shows = pages.select(F.xxhash64(host_of(F.col(url))).alias("host"), F.coalesce(html, F.lit("")).alias("html"))
    marked = shows.withColumn("mark", F.xxhash64("html"))
    copied = stage(
        marked.groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("host", "mark"), "copied"
    )
    single = marked.join(copied, ["host", "mark"], "left_anti").select("host", "html")
    distinct = single.union(marked.join(copied, ["host", "mark"], "left_semi").select("host", "html").distinct())

    def count(batches):
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for row in statistics(page or ""):
                    columns[0].append(host)
                    for column, value in zip(columns[1:], row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.int64()), pa.array([int(x) for x in columns[4]], pa.int64())],
                names=["host", "path", "kind", "shown", "first"],
            )

    shown = distinct.mapInArrow(
        count, "host long, path long, kind int, shown long, first long"
    )
    spread = shown.groupBy("host", "path", "kind", "shown").agg(
        F.count(F.lit(1)).alias("n"), F.sum("first").alias("first")
    )
    n = F.col("n").cast("double")
    per = spread.groupBy("host", "path").agg(*[
        f(F.when(F.col("kind") == kind, value)).alias(f"{name}{kind}")
        for kind in (0, 1)
        for name, f, value in (("pages", F.sum, F.col("first")), ("shown", F.sum, n), ("logs", F.sum, n * F.log(n)))
    ])
    # Texts: how evenly a text repeats over the node's pages, on average. Presentations: the entropy
    # of the distribution over the node's pages. Both relative to the logarithm of the pages.
    texts = 1 - F.col("logs0") / F.col("shown0") / F.log(F.col("pages0").cast("double"))
    styles = (F.log("shown1") - F.col("logs1") / F.col("shown1")) / F.log(F.col("pages1").cast("double"))
    texts = F.when(F.col("pages0") > 1, F.greatest(texts, F.lit(0.0))).otherwise(1.0)
    styles = F.when(F.col("pages1") > 1, F.greatest(styles, F.lit(0.0))).otherwise(texts)
    return per.select(
        "host", "path", F.coalesce("pages0", "pages1").alias("pages"),
        ((1 - PRESENTATION) * texts + PRESENTATION * styles).alias("importance"),
    )


def _own_low(rows: DataFrame, low: DataFrame) -> DataFrame:
    """__of, __mark, __low: the unimportant ones among a page's own paths, with their importance."""

    def paths(batches):
        for batch in batches:
            owners, keys = [], []
            for i, page in enumerate(batch.column(2).to_pylist()):
                own = {node.key for node in read(page or "")[1]}
                owners += [i] * len(own)
                keys += own
            owner = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(keys, pa.int64())],
                names=["__of", "__mark", "path"],
            )

    hosts = low.select(F.col("host").alias("__of")).distinct()
    shown = rows.join(hosts, "__of", "left_semi").select("__of", "__mark", "__html").mapInArrow(
        paths, "__of long, __mark long, path long"
    )
    met = shown.join(low.withColumnRenamed("host", "__of"), ["__of", "path"])
    # Copies of a page give the same rows: those are one before the group.
    once = met.groupBy("__of", "__mark", "path").agg(F.first("importance").alias("importance"))
    listed = F.map_from_entries(F.collect_list(F.struct("path", "importance")))
    return once.groupBy("__of", "__mark").agg(listed.alias("__low"))


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: key, url, text, n_chars (code points).

    The text is the article's blocks, character references decoded, white space within a block one
    space, joined by two line feeds; empty if there is none. NULL html is empty; pages whose url is
    NULL or has no host share one tree. Pages that a host repeats count once in its tree. An empty
    table gives an empty table.
    """
    low = stage(
        importance(pages, url, html).where((F.col("pages") >= LEAST_PAGES) & (F.col("importance") < LOW))
        .select("host", "path", "importance"),
        "low",
    )  # staged, so that Spark knows its size and broadcasts it only if it is small
    rows = pages.select(
        F.col(key).alias("__key"), F.col(url).alias("__url"), F.col(html).alias("__html"),
        F.xxhash64(host_of(F.col(url))).alias("__of"), F.xxhash64(F.coalesce(html, F.lit(""))).alias("__mark"),
    )
    if low.isEmpty():
        joined = rows.select("__key", "__url", "__html", F.lit(None).cast("map<long,double>").alias("__low"))
    else:
        joined = rows.join(_own_low(rows, low), ["__of", "__mark"], "left").select("__key", "__url", "__html", "__low")
    kind = pages.schema[key].dataType.simpleString()

    def take(batches):
        for batch in batches:
            texts = []
            for page, known in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                texts.append(extract(page or "", dict(known or ())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=[key, url, "text", "n_chars"],
            )

    return joined.mapInArrow(take, f"`{key}` {kind}, `{url}` string, text string, n_chars long")
