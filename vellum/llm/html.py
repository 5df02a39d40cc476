"""Operator 8: main text of web pages by site style trees.

The documents of a host are merged into one tree: a node for each path of elements (tag and first class or
id), with the presentations seen under it (sequences of child tags) and the text blocks directly in it.  A
presentation that all pages share, or a block that many pages repeat, has little entropy to offer; a node's
importance combines that of its presentations and of all content below it:

    presentation(E) = - sum p_i log_m p_i            over the l presentations of the m pages that have E
    content(E)      = mean of 1 - log_m c            over the blocks at or below E, each in c of its node's m pages
    importance(E)   = (1 - g**l) presentation(E) + g**l content(E),   g = 0.9

Importance is drawn towards ``UNJUDGED`` as if ``DOUBT`` more pages had shown that much, so that few pages say little; equal pages of a
host count as one.  Branches of importance below ``NOISE`` are cut from each page of the host, inside its article as well.  HTML's own
elements settle the clear cases whatever the host: navigation, asides, page headers and footers, forms and hidden parts never count,
be they blocks or parts of a line.  All else that hints at noise is a prior that lowers importance by a factor: a class for page
furniture, a class for what varies and yet is none of the page's (adverts, comments; lists of related pages, inside the article if most of
their text is links), and a place outside the article or main part.  Headings have no prior, nor has an id inside the article.  A
doubted branch stays if its importance, so lowered, still reaches ``NOISE``.  Branches that hold the
article (without one: most of the page's text) are not cut for their names or repetition; elements inside a line are
judged only if they have a class or id.

Pages are read three times: once for equal ones, once for the statistics, which are summed by host and path before they are
dealt out, and once to extract.  Only the noisy paths of a host and the importance of its doubted ones travel to its pages.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import byte_slices, materialise, small_side

NOISE = 0.3
DECAY = 0.9
#: The importance of a path that no page has shown, and how many pages that weighs as much as.
UNJUDGED, DOUBT = 0.5, 3.0
#: The factors of the priors.
FURNITURE, STRANGE, OUTSIDE = 0.4, 0.2, 0.4
# Elements of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe xmp noembed noframes".split())
NEVER = set("head nav aside footer form button select option datalist menu dialog svg math canvas audio video object applet map".split()) | RAW
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"body", "head", "html", "tbody", "td", "tfoot", "th", "thead", "tr", "caption", "legend"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
SCOPES = set("ul ol dl table article main section div body".split())
_EDGES = (r"(?<![^\s_-])(?<!\bno[_-])(?<!\bhas[_-])(?<!\bwith[_-])(?<!\bwithout[_-])(?:", r")(?=$|[\s_-])")
_NAMED = re.compile(_EDGES[0] + r"banner|cookies?|consent|gdpr|notices?|newsletter|subscribe|subscription|popup|modal|overlay|side-?bar|breadcrumbs?|menu|nav|navbar|navigation|(?:site|page)-?footer|footer|share|sharing|social|pagination|pager|skip-?link|widget|toolbar|login|search" + _EDGES[1], re.I)
#: Names of a heading's block, inside an article its own.
_HEADED = re.compile(_EDGES[0] + r"masthead|(?:site|page)-?header|header" + _EDGES[1], re.I)
#: Names of what varies from page to page and yet is no page's text.
_STRANGE = re.compile(_EDGES[0] + r"ads?|advert\w*|sponsor\w*|promo\w*|comments?|comment-?list|disqus|replies|respond" + _EDGES[1], re.I)
#: Names of lists of other pages, if links make up most of them.
_LISTED = re.compile(_EDGES[0] + r"related|recommend\w*" + _EDGES[1], re.I)
_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?/][^>]*>|[^<]+|<", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


class Node:
    """An open element: path hash, hashes of its ancestors, whether its text counts, the prior of its name, its children's tags, its text in and out of links."""

    __slots__ = ("ancestors", "children", "core", "judged", "label", "linked", "listed", "never", "path", "prior", "refused", "size", "tag", "up")

    def __init__(self, tag: str, label: str, up: Node | None, refused: bool, prior: float = 1.0, listed: bool = False):
        self.tag, self.label, self.children, self.up, self.refused, self.prior, self.listed = tag, label, [], up, refused, prior, listed
        self.path = xxhash.xxh64_intdigest(label, up.path if up else 0) - (1 << 63)
        self.ancestors = (*up.ancestors, self.path) if up else (self.path,)
        self.core = tag in ("article", "main") or bool(up and up.core)
        self.never = refused or bool(up and up.never)
        self.judged = tag in BLOCK or label != tag
        self.linked = self.size = 0


def _line(node: Node | None) -> Iterator[Node]:
    """A node and its ancestors, innermost first."""
    while node:
        yield node
        node = node.up


def _refused(tag: str, attrs: dict[str, str], up: Node | None) -> bool:
    if tag in NEVER or tag == "header" and not (up and up.core):
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    return "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or attrs.get("role", "").lower() in _ROLES


def _prior(tag: str, attrs: dict[str, str], up: Node | None) -> tuple[float, bool]:
    """The prior of an element's names, and whether they are those of a list of other pages."""
    if not attrs or tag in ("html", "body", "main") or tag in HEADINGS:
        return 1.0, False
    inside = bool(up and up.core)
    names = (attrs.get("class", ""),) if inside else (attrs.get("class", ""), attrs.get("id", ""))
    listed = any(map(_LISTED.search, names))
    if any(map(_STRANGE.search, names)) or listed and not inside:
        return STRANGE, False
    if tag != "article" and (any(map(_NAMED.search, names)) or not inside and any(map(_HEADED.search, names))):
        return FURNITURE, False
    return 1.0, listed


def walk(page: str) -> Iterator[tuple[str, Node, list[tuple[Node, str]]]]:
    """("open", node, []) for each element; for each block of text ("text", the outermost element its pieces lie in, the pieces by element), in page order."""
    stack = [Node("", "", None, False)]
    parts: list[tuple[Node, str]] = []

    def flush() -> Iterator[tuple[str, Node, list[tuple[Node, str]]]]:
        if any(text.strip() for _, text in parts):
            yield "text", min((node for node, text in parts if text.strip()), key=lambda n: len(n.ancestors)), list(parts)
        parts.clear()

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.match(page, at)
        at, tag = m.end(), m[2]
        if tag is None:
            if page[m.start()] != "<" or m.end() - m.start() == 1:
                parts.append((stack[-1], entities.unescape(m[0])))
            continue
        tag = tag.lower()
        if m[1]:
            if tag in BLOCK:
                yield from flush()
            if any(n.tag == tag for n in stack[1:]):
                while stack.pop().tag != tag:
                    pass
            continue
        if tag in BLOCK:
            yield from flush()
            if tag in CLOSES_P and any(n.tag == "p" for n in stack):
                k = max(i for i, n in enumerate(stack) if n.tag == "p")
                if not any(n.tag in SCOPES for n in stack[k:]):
                    del stack[k:]
            if tag in SIBLINGS:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in SIBLINGS[tag]:
                        del stack[k:]
                        break
                    if stack[k].tag in ("ul", "ol", "dl", "table", "select"):
                        break
        elif tag in ("br", "wbr"):
            parts.append((stack[-1], " " if tag == "br" else ""))
        attrs = {k.lower(): a or b or c or "" for k, a, b, c in _ATTR.findall(m[3])} if m[3] else {}
        name = (attrs.get("class", "").split() or [attrs.get("id", "")])[0]
        label = f"{tag}.{name}" if name else tag
        stack[-1].children.append(label)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        stack.append(Node(tag, label, stack[-1], _refused(tag, attrs, stack[-1]), *_prior(tag, attrs, stack[-1])))
        yield "open", stack[-1], []
    yield from flush()


def _joined(pieces: list[tuple[Node, str]]) -> str:
    return " ".join("".join(text for _, text in pieces).split())


def judged_nodes(page: str) -> tuple[list[Node], list[tuple[Node, list[tuple[Node, str]]]], set[int], bool]:
    """A page's elements and its blocks that may count, the ids of the nodes that hold its main part, and whether it marks one.

    An article inside a branch with a doubtful name (a teaser, a comment) is the main part only if there is no other.
    """
    opened, blocks = [], []
    for kind, node, pieces in walk(page):
        if kind == "open":
            opened.append(node)
        elif pieces := [(n, text) for n, text in pieces if not n.never]:
            for n, text in pieces:
                size = len(text.strip())
                links = size if any(x.tag == "a" for x in _line(n)) else 0
                for x in _line(n):
                    x.size += size
                    x.linked += links
            if any(text.strip() for _, text in pieces):
                blocks.append((node, pieces))
    for n in opened:
        if n.listed and 2 * n.linked > n.size:
            n.prior = STRANGE
    cores = [n for n in opened if n.core and not n.up.core and not n.never and n.size]
    clear = [n for n in cores if all(x.prior == 1.0 for x in _line(n))]
    if cores:
        holds = {id(x) for n in clear or [max(cores, key=lambda n: n.size)] for x in _line(n)}
    else:
        total = sum(len(text.strip()) for _, pieces in blocks for _, text in pieces)
        root = next((list(_line(n))[-1] for n, _ in blocks), None)
        holds = {id(x) for x in [*opened, *([root] if root else [])] if 2 * x.size > total}
    return opened, blocks, holds, bool(cores)


def _factor(node: Node, holds: set[int], core: bool) -> float:
    """The prior of a node: of its name and of its place outside the main part; 1 where it holds that part."""
    if id(node) in holds:
        return 1.0
    inside = not core or any(x.core and id(x) in holds for x in _line(node))
    return node.prior * (1.0 if inside else OUTSIDE)


def main_text(page: str, noisy: frozenset[int] = frozenset(), doubted: dict[int, float] | None = None, noise: float = NOISE) -> str:
    """The blocks of the page's own text, joined by blank lines.

    Left out are branches whose path is in ``noisy`` and doubtful ones whose importance (``doubted``, by path) does not make up for the prior.
    """
    _, blocks, holds, core = judged_nodes(page)
    known, doubted = {}, doubted or {}

    def own(node: Node) -> bool:
        if id(node) in holds or not node.judged:
            return True
        factor = _factor(node, holds, core)
        return node.path not in noisy and (factor == 1.0 or doubted.get(node.path, UNJUDGED) * factor >= noise)

    def counts(node: Node) -> bool:
        if core and id(node) in holds and not node.core:  # loose text beside the article
            return False
        for n in reversed(list(_line(node))):
            if id(n) not in known:
                known[id(n)] = own(n)
            if not known[id(n)]:
                return False
        return True

    kept = (_joined([(n, text) for n, text in pieces if counts(n)]) for _, pieces in blocks)
    return "\n\n".join(text for text in kept if text)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (url, ...) with their host's hash before them."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([_hash(host_of(u)) for u in batch.column(0).to_pylist()], pa.int64()), *batch.columns], ["host", *batch.schema.names])


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, shape: the page's first presentation, or else a text's hash; the page's share; ancestors once in a batch) of (host, html, n)."""
    for batch in batches:
        for part in byte_slices(batch, 1, 2 << 20):
            rows, told = [], set()
            for host, page, n in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                share, first, blocks = 1.0 / n, {}, set()
                opened, texts, holds, core = judged_nodes(page)
                doubtful = {x.path for x in opened if not x.never and _factor(x, holds, core) < 1.0}
                for node in opened:
                    first.setdefault(node.path, node)
                for node, pieces in texts:
                    blocks.add((node.path, _hash(_joined(pieces))))
                    for inner in {id(x): x for p, _ in pieces for x in _line(p) if x.tag not in BLOCK and x.judged and x is not node}.values():
                        blocks.add((inner.path, _hash(_joined([(p, t) for p, t in pieces if inner in _line(p)]))))
                for path, node in first.items():
                    new = (host, path) not in told
                    told.add((host, path))
                    rows.append((host, path, True, _hash(" ".join(node.children)), share, list(node.ancestors) if new else None, path in doubtful))
                rows += [(host, path, False, h, share, None, None) for path, h in blocks]
            if rows:
                types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["host", "path", "shape", "feature", "share", "ancestors", "doubted"])


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, pages, importance, doubted) of every node of every host's tree; host and path are hashes.

    Equal pages of a host count as one, each for its share.
    """
    texts = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).where("url is not null and html is not null")
    keyed = texts.select("url", F.xxhash64("html").alias("page")).mapInArrow(_hosts, "host long, url string, page long").where(F.col("host") != _hash(""))
    equal = small_side(materialise(keyed.groupBy("host", "page").agg(F.count("*").alias("n")).where("n > 1")))
    placed = texts.select("url", "html").mapInArrow(_hosts, "host long, url string, html string").where(F.col("host") != _hash(""))
    weighed = placed.withColumn("page", F.xxhash64("html")).join(equal, ["host", "page"], "left").select("host", "html", F.coalesce("n", F.lit(1)).alias("n"))
    seen = materialise(weighed.mapInArrow(_statistics, "host long, path long, shape boolean, feature long, share double, ancestors array<long>, doubted boolean"))
    counted = seen.groupBy("host", "path", "shape", "feature").agg(F.round(F.sum("share"), 6).alias("c")).withColumn("c", F.greatest("c", F.lit(1.0)))
    nodes = counted.groupBy("host", "path").agg(
        F.sum(F.when(F.col("shape"), F.col("c"))).alias("m"),
        F.count(F.when(F.col("shape"), 1)).alias("shapes"),
        F.sum(F.when(F.col("shape"), F.col("c") * F.log("c"))).alias("shape_sum"),
        F.count(F.when(~F.col("shape"), 1)).alias("blocks"),
        F.sum(F.when(~F.col("shape"), F.log("c"))).alias("block_sum"),
    )
    places = seen.where("shape").groupBy("host", "path").agg(F.first("ancestors", ignorenulls=True).alias("ancestors"), F.bool_or("doubted").alias("doubted"))
    spread = F.log("m")
    nodes = materialise(nodes.join(places, ["host", "path"]).select("host", "path", "m", "shapes", "doubted", "ancestors", "blocks", F.when(F.col("m") > 1, F.col("blocks") - F.coalesce("block_sum", F.lit(0.0)) / spread).otherwise(F.col("blocks")).alias("fresh"), F.when(F.col("m") > 1, (F.col("m") * spread - F.col("shape_sum")) / (F.col("m") * spread)).otherwise(1.0).alias("presentation")))
    below = nodes.where("blocks > 0").select("host", F.explode("ancestors").alias("path"), "blocks", "fresh").groupBy("host", "path").agg((F.sum("fresh") / F.sum("blocks")).alias("content"))
    share = F.pow(F.lit(DECAY), F.col("shapes"))
    joined = nodes.join(below, ["host", "path"], "left")
    importance = (1 - share) * F.col("presentation") + share * F.coalesce("content", F.lit(0.0))
    drawn = (F.col("m") * importance + DOUBT * UNJUDGED) / (F.col("m") + DOUBT)
    return joined.select("host", "path", F.round("m").cast("long").alias("pages"), drawn.alias("importance"), "doubted")


def _extract(noise: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1, 2 << 20):
                texts = []
                for page, nodes in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    paths = {n["path"]: n["importance"] for n in nodes or ()}
                    texts.append(main_text(page or "", frozenset(k for k, v in paths.items() if v < noise), paths, noise))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["page", "text"])

    return run


def extract(pages: DataFrame, noise: float = NOISE) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages`` (page_id, url, html; others are ignored).

    Null or empty html gives an empty text.  Pages without a host in their url (null, malformed) are
    extracted without a style tree.  Repeated rows and null ids give a row each; an empty table none.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    tree = style_tree(rows)
    telling = tree.where((F.col("importance") < noise) | F.col("doubted"))
    telling = small_side(materialise(telling.groupBy("host").agg(F.collect_list(F.struct("path", "importance")).alias("nodes"))), 50_000)
    placed = rows.select("url", "page_id", "html").mapInArrow(_hosts, "host long, url string, page_id long, html string")
    joined = placed.join(telling, "host", "left").select(F.struct("page_id", "url").alias("page"), "html", "nodes")
    found = joined.mapInArrow(_extract(noise), "page struct<page_id: long, url: string>, text string")
    return found.select("page.page_id", "page.url", "text", F.length("text").cast("long").alias("n_chars"))


#: The query op8_html on the test pages, whose articles hold a heading and paragraphs only.
ORACLE = r"""
WITH inside AS (SELECT page_id, url, regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?b>', '', 'g') AS x FROM pages),
block AS (SELECT page_id, url, list_transform(regexp_split_to_array(x, '</?p>|</?h1>'), lambda b:
  trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(b, '<br */?>', ' ', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS b FROM inside),
page AS (SELECT page_id, url, coalesce(array_to_string(list_filter(b, lambda t: t <> ''), chr(10) || chr(10)), '') AS text FROM block)
SELECT page_id, url, text, length(text) AS n_chars FROM page
"""
