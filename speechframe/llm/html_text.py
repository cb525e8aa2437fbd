"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged: elements with the same path of tags and classes are one node of the style tree. A node's
importance has a presentation part, the entropy of the sequences of children it shows, and a content part, one less the mean
entropy with which its texts repeat from page to page; both in logarithms to the base of the pages that have the node. Branches
of low importance are the site's own furniture and are removed from each page, on pages with a marked main part (article, main)
and others alike. All visible text enters the tree, that of menus, adverts and footers too. What a tag or class name says to be furniture
(menus, adverts, forms, reader comments and the like), or what stands outside a marked main part, goes in any case.

A task counts its own pages' nodes first; the counts are summed by host and node, so a host that holds a third of all pages is
no hot key. A page whose text would go entirely keeps it, as the only copies of an article on a mirror would else be lost, and so
does one of which names of classes would leave nothing. The first marked main part of a page is never furniture by such a name.

A body that many pages of a host carry under different titles looks like furniture to the tree. So within a marked main part it
removes boxes and elements with a class, never the article's own headings and its paragraphs, list items, quotes and cells without a class; and the
main part stays whole where the tree would leave headings alone or take more than ``MOST`` of its text. Blocks are joined by one line feed, white space
within a block is one blank, a line break counts as white space. A null html is an empty page, a null url a host of its own;
markup that is cut off or never closed ends with the page. Repeated rows are pages of their own. Other columns are not read.
"""

import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from speechframe.llm.common import map_batches, small
from speechframe.session import materialize

#: Branches below this importance go, where at least so many pages show them.
IMPORTANCE, LEAST_PAGES = 0.3, 8
#: How fast the presentation part gains weight with the number of styles a node has.
DECAY = 0.9
#: A marked main part of which the tree would take a larger share than this is itself what repeats, and stays.
MOST = 0.75

# fixed values: elements and words in class, id and role that mark what is not main text
DROPPED = frozenset("title script style noscript template nav footer aside form button select option textarea iframe svg canvas object menu dialog".split())
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup login sidebar rail widget widgets menu nav navbar navigation breadcrumb breadcrumbs toolbar footer masthead "
    "comment comments respond reply replies disqus discussion share sharing social related recommended teaser teasers pagination pager skip tags copyright search form".split()
)
# elements whose content a reader never sees as text; it does not enter the tree
UNSEEN = frozenset("title script style noscript template option textarea iframe svg canvas object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure footer h1 h2 h3 h4 h5 h6 header hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Opening one of the keys closes an open element of its values that nothing else holds open.
CLOSED_BY = {
    **{t: ("p",) for t in BLOCKS - {"body", "html"}},
    "li": ("p", "li"), "dt": ("p", "dt", "dd"), "dd": ("p", "dt", "dd"), "tr": ("p", "td", "th", "tr"), "td": ("p", "td", "th"), "th": ("p", "td", "th"), "option": ("option",),
}
HOLDS = frozenset("ul ol dl table div section article main blockquote body html nav aside footer header form td th".split())
WORD = re.compile(r"[a-z0-9]+")
#: Elements below this depth belong to the branch of their ancestor there.
DEEPEST = 64
KEPT, BY_NAME, BY_TAG, HIDDEN = 0, 1, 2, 3
MAIN = ("article", "main")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Without a class, these are the running text of a main part, not a box of their own.
FLOW = frozenset("p blockquote pre li dt dd td th caption figcaption".split())


class Dom(HTMLParser):
    """Reads one page into its text blocks, each with the path of its element, and the children that each path shows."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str, int, int, bool]] = []  # tag, path, depth, why it is dropped, in main part
        self.blocks: list[tuple[str, bool, str]] = []  # path, in main part, text
        self.named: list[str] = []  # texts that go by the name of a class, id or role alone
        self.gone: list[tuple[str, str]] = []  # path and text of blocks that go by a name or tag; the tree counts them
        self.children: dict[str, list[str]] = {}
        self.open: list[str] = []
        self.open_named: list[str] = []
        self.open_tagged: list[str] = []
        self.has_main = False

    def top(self):
        return self.stack[-1] if self.stack else ("", "", 0, KEPT, False)

    def flush(self):
        text = " ".join("".join(self.open).split())
        self.open = []
        _, path, _, dropped, main = self.top()
        if text and not dropped:
            self.blocks.append((path, main, text))
        named = " ".join("".join(self.open_named).split())
        tagged = " ".join("".join(self.open_tagged).split())
        self.open_named, self.open_tagged = [], []
        if named:
            self.named.append(named)
        if dropped == BY_NAME and named or dropped == BY_TAG and tagged:
            self.gone.append((path, named if dropped == BY_NAME else tagged))

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br":
                self.open.append(" ")
            elif tag == "hr":
                self.flush()
            return
        closing = CLOSED_BY.get(tag)
        if tag in BLOCKS or tag in DROPPED:
            self.flush()
        if closing:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in closing:
                    del self.stack[i:]
                    break
                if self.stack[i][0] in HOLDS:
                    break
        if tag in ("html", "body"):
            return
        named = {k: v for k, v in attrs if v and k in ("class", "id", "role")}
        _, path, depth, dropped, main = self.top()
        marked = WORD.findall(" ".join(named.values()).lower())
        if tag in UNSEEN or "hidden" in dict(attrs):
            dropped = HIDDEN
        elif tag in DROPPED or (tag == "header" and not main):
            dropped = max(dropped, BY_TAG)
        elif dropped < BY_TAG and tag in MAIN and not self.has_main:
            dropped = KEPT  # names neither of the first main part nor of what it stands in say that it is furniture
        elif not FURNITURE.isdisjoint(marked):
            dropped = max(dropped, BY_NAME)
        main = main or tag in MAIN
        self.has_main |= main and not dropped
        name = tag + "".join(f".{c}" for c in sorted((named.get("class") or "").split()))
        if tag in BLOCKS or tag in DROPPED:
            if dropped != HIDDEN:
                self.children.setdefault(path, []).append(name)
            depth += 1
            path = f"{path}/{name}" if depth <= DEEPEST else path
        self.stack.append((tag, path, depth, dropped, main))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if tag in BLOCKS or tag in DROPPED:
                    self.flush()
                del self.stack[i:]
                return
            if self.stack[i][0] in HOLDS and tag not in HOLDS and tag not in DROPPED:
                return

    def handle_data(self, data):
        dropped = self.top()[3]
        if dropped != HIDDEN:
            (self.open, self.open_named, self.open_tagged)[dropped].append(data)


def read_page(html: str | None) -> Dom:
    dom = Dom()
    dom.feed(html or "")
    dom.close()
    dom.flush()
    return dom


def ancestors(path: str) -> list[str]:
    parts = path.split("/")
    return ["/".join(parts[:i]) for i in range(2, len(parts) + 1)]


def host_of(url: Column) -> Column:
    """Lower-case host of a url, empty for a null."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


NODES = "host string, path string, kind string, value long, pages long"


def _count_nodes(batches):
    for batch in batches:
        counts: Counter = Counter()
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            dom = read_page(html)
            texts = [(path, text) for path, _, text in dom.blocks] + dom.gone
            seen = {("text", path, xxhash.xxh64_intdigest(text) - 2**63) for path, text in texts}
            seen |= {("style", path, xxhash.xxh64_intdigest(" ".join(names)) - 2**63) for path, names in dom.children.items()}
            nodes = {a for path in {path for path, _ in texts} for a in ancestors(path)}
            seen |= {("node", path, 0) for path in nodes}
            counts.update((host, path, kind, value) for kind, path, value in seen)
        keys = list(zip(*counts)) if counts else [[], [], [], []]
        yield pa.RecordBatch.from_pydict({"host": pa.array(keys[0], pa.string()), "path": pa.array(keys[1], pa.string()), "kind": pa.array(keys[2], pa.string()), "value": pa.array(keys[3], pa.int64()), "pages": pa.array(list(counts.values()), pa.int64())})


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, pages, presentation, content, importance) of every node of every host's tree. ``pages`` has host and html."""
    counted = map_batches(pages.select("host", "html"), _count_nodes, NODES).groupBy("host", "path", "kind", "value").agg(F.sum("pages").alias("pages"))
    counted = materialize(counted, "nodes")
    nodes = counted.filter("kind = 'node'").select("host", "path", F.col("pages").alias("m"))
    texts = counted.filter("kind = 'text'").groupBy("host", "path").agg(F.sum(F.log("pages")).alias("logs"), F.count("*").alias("texts"))
    parts = F.split("path", "/")
    upward = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    texts = texts.filter("path <> ''").select("host", F.explode(upward).alias("path"), "logs", "texts").groupBy("host", "path").agg(F.sum("logs").alias("logs"), F.sum("texts").alias("texts"))
    styles = counted.filter("kind = 'style'").groupBy("host", "path").agg(F.sum(F.col("pages") * F.log("pages")).alias("plogs"), F.sum("pages").alias("shown"), F.count("*").alias("styles"))
    joined = nodes.join(texts, ["host", "path"]).join(styles, ["host", "path"], "left")
    base = F.log("m")
    content = F.when(F.col("m") > 1, 1 - F.col("logs") / F.col("texts") / base).otherwise(1.0)
    # entropy of the shares pages/shown, to the base m
    presentation = F.when(F.col("m") > 1, (F.log("shown") - F.col("plogs") / F.col("shown")) / base).otherwise(1.0)
    weight = F.pow(F.lit(DECAY), F.coalesce("styles", F.lit(0)))
    return joined.select(
        "host", "path", F.col("m").alias("pages"), F.coalesce(presentation, F.lit(0.0)).alias("presentation"), content.alias("content"),
        ((1 - weight) * F.coalesce(presentation, F.lit(0.0)) + weight * content).alias("importance"),
    )


def name_of(path: str) -> str:
    return path.rpartition("/")[2]


def is_low(path: str, main: bool, removed) -> bool:
    """Whether a block at ``path`` is in a removed branch; running text and headings of a main part are no branches."""
    low = removed.intersection(ancestors(path))
    if main:
        low = {p for p in low if name_of(p) not in FLOW and name_of(p).split(".")[0] not in HEADINGS}
    return bool(low)


def page_text(html: str | None, removed) -> str:
    """The text of a page: what the site's tree leaves of it, and of that what is in the main part, if the page marks one."""
    dom = read_page(html)
    if not dom.blocks:
        return "\n".join(dom.named)
    low = {place: is_low(*place, removed) for place in {(path, main) for path, main, _ in dom.blocks}} if removed else {}
    blocks = [(path, text, low.get((path, main), False)) for path, main, text in dom.blocks if main or not dom.has_main]
    kept = [(path, text) for path, text, goes in blocks if not goes]
    if dom.has_main and len(kept) < len(blocks):
        whole, left = (sum(len(b[1]) for b in part) for part in (blocks, kept))
        if whole - left > MOST * whole or all(name_of(path).split(".")[0] in HEADINGS for path, _ in kept):
            kept = []
    return "\n".join(text for _, text, *_ in kept or blocks)


def extract(pages: DataFrame, importance: float = IMPORTANCE, least: int = LEAST_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    pages = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    low = style_tree(pages).filter((F.col("importance") < importance) & (F.col("pages") >= least))
    removed = materialize(low.groupBy("host").agg(F.collect_set("path").alias("removed")), "removed")
    schema = T.StructType([pages.schema["page_id"], T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            texts = [page_text(h, frozenset(r or ())) for h, r in zip(batch.column("html").to_pylist(), batch.column("removed").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_batches(pages.join(small(removed), "host", "left").select("page_id", "url", "html", "removed"), run, schema)
