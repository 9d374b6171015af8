"""Main text of web pages: markup rules, then differencing against the nearest page of the host.

Each page is cut into lines, the blocks of its text. Lines inside elements that are never the
article (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
reader comments) are left out, and so are those outside of the article or main element where a page marks one.
A class or id names such an element if all its words do, with words for places and boxes beside them: ``ad-box`` and
``site-footer`` are such names; ``has-sidebar``, ``share-prices`` and ``ad-hoc-report`` are not, and differencing
decides on their lines. No element goes that holds a page's article, nor one named by its class that holds
most of the text (but for reader comments).
Every page is paired with the page of the same host, of the same kind (marked or not) if there is
one, whose URL path is nearest in sorted order, and lines of the two are aligned by a longest common subsequence.
On an unmarked page the shared lines are deleted. In a marked article markup is evidence on them: those of
plain prose stay, those of a kind of named element (by class or id) go unless that kind has lines of the page's own. In both
cases a line is boilerplate only if more than half of the host's pages hold it, for two articles may share a passage;
on a host of fewer than ``FEW_PAGES`` different pages it also has to be part of a run of such lines at the page's
beginning or end. A neighbour that leaves no line over on either side, or whose lines left over are alike, is a copy and says nothing
about boilerplate; pages farther off are asked then.

Pages of equal lines are one node. A node whose neighbours are copies asks those 2, 4, 8 ... places off, at
last those at the ends of the host, until one is no copy.

Pages are numbered in one global order of (host, path), and neighbours met by
number, so a host with most of the pages is dealt like any other.

Defined results: null or empty html gives an empty text; a page without a URL, or alone
on its host, is not compared; repeated rows are pages of their own (and copies of each
other); a null page_id is kept; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import html
import re
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_if_small, keep_table, map_batches, texts_of
from tidewater.llm.setjoin import WordHashes

# ---- markup ---------------------------------------------------------------------------------

# Element names by what they are, words of class, id and role names, and words that only say where
# an element is or that it is a box.
RAW = {"script", "style", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "audio",
       "video", "title"}
DROPPED = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "input", "label"} | RAW
DROPPED_OUTSIDE = {"header"}  # an article's own header belongs to it
MAIN = {"article", "main"}
VOID = {"br", "hr", "img", "input", "meta", "link", "source", "wbr", "area", "base", "col", "embed", "param", "track"}
BLOCK = {"address", "article", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "ol", "p",
         "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul", "caption"}
SPACED = {"br", "td", "th"}
NAMED = {"ad", "ads", "advert", "adverts", "advertisement", "adsbygoogle", "sponsor", "sponsored", "promo", "banner",
         "sidebar", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "masthead", "cookie",
         "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter",
         "subscribe", "subscription", "signup", "comment", "comments", "reply", "replies", "disqus", "respond",
         "related", "recommended", "recommendations", "share", "sharing", "social", "widget", "toolbar", "pagination",
         "pager", "login", "copyright"}
NAMED_OUTSIDE = {"header", "topbar"}
COMMENTS = {"comment", "comments", "reply", "replies", "disqus", "respond"}
PLACES = {"box", "block", "list", "bar", "section", "area", "container", "wrapper", "wrap", "inner", "outer", "left",
          "right", "top", "bottom", "main", "site", "page", "global", "primary", "secondary", "form", "link", "links",
          "button", "buttons", "icon", "icons", "item", "items", "post", "posts", "article", "articles", "story",
          "stories", "entry", "slot", "unit", "title", "body", "text", "panel", "row", "col", "group", "thread", "js",
          "media", "google", "mobile", "desktop", "fixed", "sticky", "header", "us", "this", "more"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "alertdialog", "form",
         "menu", "menubar", "status"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|</?[a-zA-Z][^>]*>""",
                    re.DOTALL)
_ATTRIBUTE = re.compile(r"""([\w:-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: An element named by its class stays if it holds more than this share of the text around it.
MOST = 0.75


def _attributes(raw: str) -> dict[str, str]:
    out = {}
    for name, value in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return out


def _names(attributes: dict[str, str], known: set[str]) -> bool:
    """Whether a class or the id says one of ``known``, and nothing besides but where it is."""
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = {w.lower() for w in _NAME_WORD.findall(name)}
        if words & known and all(w in known or w in NAMED or w in PLACES or len(w) == 1 for w in words):
            return True
    return False


def _is_comment(name: str, raw: str) -> bool:
    return bool(raw.strip()) and _names(_attributes(raw), COMMENTS)


def _drop(name: str, raw: str, in_main: bool) -> int:
    """0: the element stays; 1: it goes unless it holds most of the text; 2: it goes."""
    if name in DROPPED or (name in DROPPED_OUTSIDE and not in_main):
        return 2
    if not raw.strip() or name in ("html", "body"):
        return 0
    if name in MAIN:
        return 2 if _is_comment(name, raw) else 0
    attributes = _attributes(raw)
    if attributes.get("role", "").lower() in ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return 2
    if attributes.get("style", "").replace(" ", "").lower().startswith("display:none"):
        return 2
    if _names(attributes, COMMENTS):
        return 2
    return int(_names(attributes, NAMED) or (not in_main and _names(attributes, NAMED_OUTSIDE)))


class Weights:
    """Characters of text between the tags, and the elements that are a page's articles.

    An article is a marked element, no reader's comment, with at least half of the text of the largest one.
    """

    def __init__(self, page: str, tokens, closed_by: dict[int, int]):
        self.total, at, sums = 0, 0, []
        for start, end, *_ in tokens:
            self.total += len(page[at:start].strip())
            sums.append(self.total)
            at = end
        self.total += len(page[at:].strip())
        self.sums = sums
        marked = [(i, closed_by.get(i, len(tokens))) for i, (_, _, closing, name, raw) in enumerate(tokens)
                  if name in MAIN and not closing and not _is_comment(name, raw)]
        most = max((self.between(*x) for x in marked), default=0)
        self.articles = [x for x in marked if 2 * self.between(*x) >= most]

    def between(self, first: int, last: int) -> int:
        return (self.sums[last] if last < len(self.sums) else self.total) - self.sums[first]

    def holds_article(self, first: int, last: int) -> bool:
        return any(first <= a and z <= last for a, z in self.articles)

    def holds_most(self, first: int, last: int) -> bool:
        """Most of the text of the innermost article around, or of the page if it marks none."""
        around = [self.between(a, z) for a, z in self.articles if a < first and last < z]
        whole = min(around) if around else self.total if not self.articles else None
        return whole is not None and self.between(first, last) > MOST * whole


def _closings(tokens) -> dict[int, int]:
    """Index of the end tag that closes each start tag; start tags that nothing closes are left out."""
    open_: dict[str, list[int]] = {}
    out = {}
    for i, (_, _, closing, name, _) in enumerate(tokens):
        if name and closing:
            if open_.get(name):
                out[open_[name].pop()] = i
        elif name and name not in VOID:
            open_.setdefault(name, []).append(i)
    return out


def _tokens(page: str):
    """(start, end, closing, name, attributes) of the tags; raw elements are one token with what they hold."""
    out, at = [], 0
    while m := _TOKEN.search(page, at):
        at = m.end()
        name = (m[2] or "").lower()
        if name in RAW and not m[1] and not m[3].endswith("/"):
            end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
            if end:
                at = end.end()
                out.append((m.start(), at, "", "", ""))
                continue
        out.append((m.start(), at, m[1] or "", name, m[3] or ""))
    return out


UNMARKED, OUTSIDE, PROSE = -2, -1, 0


def blocks(page: str) -> tuple[list[str], bool]:
    """The blocks of text of a page, and whether they are those of a marked article."""
    texts, roles = lines_of(page)
    return [t for t, r in zip(texts, roles, strict=True) if r != OUTSIDE], any(r > OUTSIDE for r in roles)


def _named(name: str, raw: str) -> str:
    attributes = _attributes(raw)
    words = sorted(attributes.get("class", "").split()) or attributes.get("id", "").split()
    return " ".join([name, *words]) if words else ""


def lines_of(page: str) -> tuple[list[str], list[int]]:
    """The lines of a page and the role of each by its markup.

    UNMARKED on a page without an article; else OUTSIDE of it, PROSE in it, or a number above for the kind (element
    and class names) of the innermost named element of the article that holds the line.
    """
    tokens = _tokens(page)
    closed_by = _closings(tokens)
    weights = Weights(page, tokens, closed_by)
    found: list[tuple[str, int]] = []
    kinds: dict[str, int] = {}
    named: list[tuple[int, int]] = []  # closing token and kind of the open named elements of the article
    parts: list[str] = []
    main: list[int] = []  # token indexes that close the open articles
    skip = -1
    at = 0

    def flush():
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append((text, OUTSIDE if not main else named[-1][1] if named else PROSE))

    for i, (start, end, closing, name, raw) in enumerate(tokens):
        if i <= skip:
            at = end
            continue
        parts.append(page[at:start])
        at = end
        if not name:
            continue
        drop = 0 if closing else _drop(name, raw, bool(main))
        if drop and name in VOID:
            continue
        if drop and i in closed_by and not weights.holds_article(i, closed_by[i]) and (
                drop == 2 or not weights.holds_most(i, closed_by[i])):
            flush()
            skip = closed_by[i]
            continue
        if name in BLOCK or name in MAIN:
            flush()
        elif name in SPACED:
            parts.append(" ")
        if name in MAIN and not closing:
            main.append(closed_by.get(i, len(tokens)))
        elif main and name in BLOCK and not closing and raw.strip() and i in closed_by and (kind := _named(name, raw)):
            named.append((closed_by[i], kinds.setdefault(kind, len(kinds) + 1)))
        while main and main[-1] <= i:
            main.pop()
        while named and (named[-1][0] <= i or not main):
            named.pop()
    parts.append(page[at:])
    flush()
    marked = any(r != OUTSIDE for _, r in found)
    return [t for t, _ in found], [r if marked else UNMARKED for _, r in found]


_URL = re.compile(r"^\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)([^?#]*)")


def host_and_path(url: str | None) -> tuple[str | None, str | None]:
    m = _URL.match(url or "")
    if not m or not m[1]:
        return None, None
    return m[1].rpartition("@")[2].partition(":")[0].lower(), m[2]


# ---- differencing -------------------------------------------------------------------------------

def shared_lines(mine: list[int], other: list[int]) -> list[int]:
    """Positions in ``mine`` of one longest common subsequence with ``other``; rows of bits, one for each line."""
    known = set(other)
    places = [i for i, x in enumerate(mine) if x in known]
    known = {mine[i] for i in places}
    other = [x for x in other if x in known]
    where: dict[int, int] = {}
    for j, x in enumerate(other):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(other)) - 1
    rows, row = [], full  # a 0 bit: the subsequence grows at this line of the other page
    for i in places:
        step = row & where[mine[i]]
        row = ((row + step) | (row - step)) & full
        rows.append(row)
    out, j = [], len(other) - 1
    for k in range(len(places) - 1, -1, -1):
        before = rows[k - 1] if k else full
        zeros = ~rows[k] & ((1 << (j + 1)) - 1) & full
        if not zeros:
            break
        top = zeros.bit_length() - 1
        if not before >> top & 1:
            continue  # as long without this line
        out.append(places[k])
        j = top - 1
    return out[::-1]


def template_lines(shared: list[int], roles: list[int]) -> list[int]:
    """Which of the shared lines are boilerplate, by their roles.

    On an unmarked page all are. In an article plain prose stays, for an article may share a passage with
    its neighbour; lines of a kind of named element go if that kind has no line of the page's own.
    """
    own = {r for i, r in enumerate(roles) if i not in set(shared)} if any(r > PROSE for r in roles) else set()
    return [i for i in shared if roles[i] == UNMARKED or (roles[i] > PROSE and roles[i] not in own)]


ALIKE = 0.6


def pair_hashes(line: str, hashes: WordHashes) -> bytes:
    """Small hashes of the pairs of neighbouring words of a line; a single word is its own."""
    h = np.array([hashes[w] for w in line.encode().split()], np.uint64)
    h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] if len(h) > 1 else h
    return (h >> np.uint64(48)).astype(np.uint16).tobytes()


def alike(mine: list[bytes], other: list[bytes]) -> bool:
    """Whether the lines hold nearly the same pairs of words."""
    a, b = (np.bincount(np.frombuffer(b"".join(x), np.uint16), minlength=1 << 16) for x in (mine, other))
    return np.minimum(a, b).sum() >= ALIKE * np.maximum(a, b).sum()


def boilerplate(mine, neighbours) -> list[int] | None:
    """Positions of lines to delete, by the nearest neighbour that is not a copy; None if all are copies.

    Pages are (lines, roles, pair hashes); ``neighbours``: (has the same kind of markup, length of the common path
    prefix, page).
    """
    def left(page, met):
        return [p for i, (r, p) in enumerate(zip(page[1], page[2], strict=True)) if r != OUTSIDE and i not in met]

    for *_, other in sorted(neighbours, key=lambda n: (-n[0], -n[1])):
        shared = shared_lines(mine[0], other[0])
        own, others = left(mine, set(shared)), left(other, set(shared_lines(other[0], mine[0])))
        if own and others and not alike(own, others):
            return template_lines(shared, mine[1])
    return None


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


# ---- Spark ------------------------------------------------------------------------------------------

def cut_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, path, blocks, lines, roles): all lines, their hashes and roles."""
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())

    def run(batches):
        for batch in batches:
            hosts, paths, texts, lines, roles = [], [], [], [], []
            for url, page in zip(batch.column(1).to_pylist(), texts_of(batch.column(2)), strict=True):
                host, path = host_and_path(url)
                found, of = lines_of(page)
                hosts.append(host)
                paths.append(path)
                texts.append(found)
                hashed = np.array([xxhash.xxh3_64_intdigest(t) for t in found], np.uint64).view(np.int64)
                lines.append(hashed)
                roles.append(of)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                 pa.array(texts, pa.list_(pa.string())), pa.array(lines, longs), pa.array(roles, ints)],
                ["page_id", "url", "host", "path", "blocks", "lines", "roles"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_batches(pages.select("page_id", F.col("url").cast("string"), "html"), run,
                       f"page_id {kind}, url string, host string, path string, blocks array<string>, lines array<bigint>, "
                       "roles array<int>")


def numbered(cut: DataFrame) -> DataFrame:
    """(row, host, marked, path, n): pages of hosts in order of (host, marked, path), numbered without a gap.

    Ranges are sorted where they are; numbers before a range come from one count for each range.
    """
    ordered = keep_table(cut.where("host IS NOT NULL").select("row", "host", "marked", "path")
                         .repartitionByRange("host", "marked", "path", "row")
                         .sortWithinPartitions("host", "marked", "path", "row")
                         .select("*", F.monotonically_increasing_id().alias("at")), "page-order")
    part = F.shiftright("at", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (ordered.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
              .select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before")))
    return (ordered.withColumn("part", part).join(F.broadcast(ranges), "part")  # one row for each partition
            .select("row", "host", "marked", "path", (F.col("at") % (1 << 33) + F.col("before")).alias("n")))


def with_pair_hashes(pages: DataFrame) -> DataFrame:
    """(row, lines, roles, pairs) of (row, lines, roles, blocks)."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            pairs = [[pair_hashes(t, hashes) for t in texts] for texts in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(pairs, pa.list_(pa.binary()))],
                                             ["row", "lines", "roles", "pairs"])

    return map_batches(pages.select("row", "lines", "roles", "blocks"), run,
                       "row bigint, lines array<bigint>, roles array<int>, pairs array<binary>")


def with_shared_lines(place: DataFrame, cut: DataFrame) -> DataFrame:
    """(row, host) of the nodes that share a line with a neighbour that could be boilerplate.

    Every node is aligned with the one before and after it; only these need words and copies told.
    """
    here = place.join(cut.select("row", "lines", "roles"), "row").select(
        F.explode(F.array(F.col("n") - 1, "n", F.col("n") + 1)).alias("m"), F.struct("n", "row", "host", "lines", "roles").alias("page"))

    def run(batches):
        for batch in batches:
            rows, hosts = [], []
            for m, around in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for own in (x for x in around if x["n"] == m):
                    if any(x["n"] != m and x["host"] == own["host"]
                           and template_lines(shared_lines(own["lines"], x["lines"]), own["roles"]) for x in around):
                        rows.append(own["row"])
                        hosts.append(own["host"])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(hosts, pa.string())], ["row", "host"])

    return map_batches(here.groupBy("m").agg(F.collect_list("page").alias("around")), run,  # three at most
                       "row bigint, host string")


def deletions(cut: DataFrame) -> DataFrame:
    """(row, gone): positions of the lines to delete, for pages that lose any."""
    pages = (cut.where("host IS NOT NULL AND size(lines) > 0")
             .select("row", "host", F.expr("roles[0] > -2").alias("marked"), "path", F.xxhash64("lines", "roles").alias("same")))
    nodes = keep_table(pages.groupBy("host", "marked", "same").agg(F.min(F.struct("path", "row")).alias("least"))
                       .select("host", "marked", "same", "least.path", "least.row"), "page-nodes")
    place = keep_table(numbered(nodes), "page-numbers")
    ends = keep_table(place.groupBy("host").agg(F.min("n").alias("first"), F.max("n").alias("last")), "host-ends")
    sharing = keep_table(with_shared_lines(place, cut), "page-sharing")
    if sharing.isEmpty():
        return cut.where("false").select("row", F.expr("cast(array() AS array<int>)").alias("gone"))
    hosts = keep_table(sharing.select("host").distinct(), "page-hosts")
    of_hosts = keep_table(place.join(broadcast_if_small(ends, 64), "host")
                          .join(broadcast_if_small(hosts, 64), "host", "left_semi"), "page-places")
    texts = with_pair_hashes(cut.join(broadcast_if_small(of_hosts.select("row"), 8), "row", "left_semi"))
    mine = keep_table(of_hosts.join(texts, "row"), "page-lines")
    near = mine.select(F.col("n").alias("m"), F.col("host").alias("h"), F.struct(
        "marked", "path", "lines", "roles", "pairs").alias("page"))

    def run(batches):
        for batch in batches:
            rows, settled, gone = [], [], []
            for row, own, around in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                of = [(x["marked"] == own["marked"], _common(own["path"], x["path"]),
                       (x["lines"], x["roles"], x["pairs"])) for x in (y["page"] for y in around)]
                found = boilerplate((own["lines"], own["roles"], own["pairs"]), of)
                if found != []:
                    rows.append(row)
                    settled.append(found is not None)
                    gone.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(settled, pa.bool_()),
                                              pa.array(gone, pa.list_(pa.int32()))], ["row", "settled", "gone"])

    open_, off, found = mine.join(broadcast_if_small(sharing.select("row"), 8), "row", "left_semi"), 1, []
    while True:
        asked = open_.select("row", "host", F.struct("marked", "path", "lines", "roles", "pairs").alias("own"),
                             "n", F.explode(F.array(F.greatest(F.col("n") - off, "first"),
                                                    F.least(F.col("n") + off, "last"))).alias("m"))
        pairs = (asked.where("m <> n").join(near, "m").where("host = h").groupBy("row")
                 .agg(F.first("own").alias("own"), F.sort_array(F.collect_list(F.struct("m", "page"))).alias("near")))
        told = keep_table(map_batches(pairs, run, "row bigint, settled boolean, gone array<int>"), "page-told")
        found.append(told.where("settled").select("row", "gone"))
        left = told.where("NOT settled").select("row")
        if left.isEmpty():
            break
        # until both ends of the host have been asked
        open_ = mine.join(broadcast_if_small(left, 8), "row").where(F.greatest(F.col("n") - F.col("first"),
                                                                             F.col("last") - F.col("n")) > off)
        off *= 2
    of_nodes = on_most_pages(keep_table(reduce(DataFrame.union, found), "page-gone"), nodes, cut)
    return pages.join(broadcast_if_small(keep_table(of_nodes, "node-deletions"), 256),
                      ["host", "marked", "same"]).select("row", "gone")


FEW_PAGES = 4
HOST_PARTS = 32


def on_most_pages(gone: DataFrame, nodes: DataFrame, cut: DataFrame) -> DataFrame:
    """(host, marked, same, gone) of (row, gone): positions whose line more than half of the host's nodes hold.

    Nodes count with those of their kind of markup. Common lines of a host are fewer than two pages of its lines;
    they are dealt to ``HOST_PARTS`` parts of the host's rows.
    """
    host = ["host", "marked"]
    some = broadcast_if_small(keep_table(gone.join(nodes, "row").select(*host).distinct(), "gone-hosts"), 64)
    lines = nodes.join(some, host, "left_semi").select(*host, "same", "row").join(cut.select("row", "lines"), "row")
    holders = lines.select(*host, F.explode(F.array_distinct("lines")).alias("line")).groupBy(*host, "line").agg(
        F.count("*").alias("holders"))
    sizes = nodes.groupBy(*host).agg(F.count("*").alias("of"))
    common = (holders.join(sizes, host).where("2 * holders > of").groupBy(*host, "of")
              .agg(F.collect_list("line").alias("common"))  # under twice the lines of a mean page
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(HOST_PARTS - 1)))))
    met = (gone.join(lines, "row").withColumn("part", F.pmod(F.xxhash64("row"), F.lit(HOST_PARTS)).cast("int"))
           .join(common, [*host, "part"])
           .withColumn("gone", F.filter("gone", lambda at: F.array_contains("common", F.get("lines", at)))))
    # sorted positions: the first n are 0 to n - 1 in a run from the beginning, and likewise from the end
    at_ends = F.filter("gone", lambda at, k: (at == k) | (at - k == F.size("lines") - F.size("gone")))
    return (met.withColumn("gone", F.when(F.col("of") < FEW_PAGES, at_ends).otherwise(F.col("gone")))
            .where(F.size("gone") > 0).select(*host, "same", "gone"))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    cut = keep_table(cut_pages(pages).withColumn("row", F.monotonically_increasing_id()), "page-blocks")
    gone = keep_table(deletions(cut), "page-deletions")
    kept = F.filter("blocks", lambda b, i: (F.get("roles", i) != OUTSIDE)
                    & ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    return (cut.join(broadcast_if_small(gone, 256), "row", "left")
            .select("page_id", "url", F.array_join(kept, "\n\n").alias("text"))
            .select("*", F.length("text").cast("long").alias("n_chars")))
