"""Main-text extraction with host-wide consensus.

Every page's containers are scored by the running text they hold. Each page votes for the path of its best container, where a
path is the chain of container tags with their classes, digits left out; Spark counts the votes of each host. Then each page is
read again: the host's winning path names the containers whose text is the main text, and a page without such a container
falls back to its own best one. Equal votes: the path with more text, then the greater path.

Text is everything inside these containers but

* what its tag or role says: scripts, styles, forms, menus (nav), sidebars (aside), footers, and headers outside articles;
* lists and boxes that are links: LEAST_LINKS links or more with LINK_SHARE of the characters;
* boxes whose class or id says so (adverts, notices, comments and so on). A name is a hint only: it counts if all its parts are
  such words or words of layout (ad-box does, share-price doesn't), and not on a box that holds nearly all of the page's text.

Character references are decoded, white space inside a block becomes one space, blocks are joined by a line feed.

Pages are read in one pass; no step looks back further than to the innermost open tag of a kind, so nested, unclosed and broken tags cost
no more than others.

Nulls: a null html is empty and gives an empty text. Pages with a null or odd url have no host and follow their own best
container. Null page_ids and repeated rows are kept as they are; an empty table gives no rows. Columns besides page_id, url and
html are ignored.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.llm import common

#: A tag without < or > in its attributes, which is nearly every tag; others are read attribute by attribute.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>"'=]*+)([^<>"']*+(?:"[^"<>]*+"[^<>"']*+|'[^'<>]*+'[^<>"']*+)*+)>""")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/<>\"'=]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NEXT = re.compile(r"""[>"']""")
#: Tags whose content is no markup.
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
_DROPPED = _RAW | {"nav", "footer", "aside", "form", "button", "select", "svg", "template", "object", "canvas", "dialog", "menu", "head", "label", "audio", "video"}
_CONTAINERS = {"html", "body", "div", "article", "section", "main", "td", "center", "table", "details", "fieldset"}
#: Tags that are judged by their links, and containers with them.
_BOXES = _CONTAINERS | {"ul", "ol", "dl", "header"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCKS = _BOXES | {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "th", "thead", "tbody", "tfoot", "caption", "blockquote", "pre", "figure",
    "figcaption", "address", "hr", "br", "summary", "option", "legend", "hgroup", "footer", "nav", "aside", "form", "menu",
}
#: A start tag that closes an open one of the same group.
_CLOSES = {t: {"p"} for t in ("p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "table", "blockquote", "pre", "section", "article", "form", "hr", "figure")} | {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
    "th": {"td", "th", "p"}, "option": {"option"},
}
#: Tags that the end of another kind of tag doesn't close.
_FENCE = {"html", "body", "div", "article", "section", "main", "table", "ul", "ol", "dl", "form", "nav", "aside", "header", "footer", "blockquote"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "form"}
_NEVER = {"html", "body", "article", "main"}
#: Words of names that hint at what is no main text, those that do so outside articles only, and words of layout beside them.
_NOISE = set(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsors sponsored promo promos promoted promotion cookie cookies consent gdpr notice notices notification notifications alert alerts "
    "popup popups modal overlay newsletter subscribe subscription sidebar sidebars widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer footers comment comments commentlist respond replies reply disqus "
    "share sharing social related recommended recommendations pagination pager login signup search toolbar copyright disclaimer".split()
)
_HEADERS = {"header", "masthead", "banner", "topbar"}
_LAYOUT = set(
    "area bar block bottom box btn button buttons col column container count fixed form global group holder icon icons inner item items left link links list main message messages module more outer page panel posts primary "
    "reader readers region right row secondary section site slot space sticky stories text thread title top unit user users wrap wrapper zone".split()
)
LEAST_LINKS, LINK_SHARE = 3, 0.8
#: A hint doesn't count on a box with so many times the text that stands outside of it.
NEARLY_ALL = 4
_DIGITS = re.compile(r"\d+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def hint(names: str) -> str:
    """'noise', 'header' or '': what a class or id attribute hints at, by its names one by one."""
    out = ""
    for name in names.split():
        parts = {p.lower() for p in _PARTS.findall(name) if len(p) > 1}
        if parts & (_NOISE | _HEADERS) and parts <= _NOISE | _HEADERS | _LAYOUT:
            if parts & _NOISE:
                return "noise"
            out = "header"
    return out


class Page:
    """Nodes (boxes and what hints are given for: parent, path, first and last piece) and pieces of text in page order."""

    __slots__ = ("best", "ends", "gone", "parents", "paths", "pieces", "scores", "starts")

    def __init__(self, html: str):
        self.pieces: list[tuple[str, bool, int]] = []  # text, in a link, node; an empty text is a block's end
        pieces = self.pieces
        # A node's path is a hash of its parent's and its own name; '' for nodes that can't win.
        self.parents, self.paths, self.starts, self.ends = [-1], [""], [0], [0]
        kinds, links = [""], [0]  # what is known of each node at its start ('a': may win with a bonus); links in it
        stack: list[tuple[str, int]] = []  # tag, node that it opened, -1 (none) or -2 (what is in it is dropped)
        where: dict[str, list[int]] = {}  # the places in the stack of each open tag
        fences: list[int] = []
        node = dropped = in_link = articles = at = 0
        size, missing = len(html), set()

        def pop(to: int) -> None:
            nonlocal node, dropped, in_link, articles
            while len(stack) > to:
                tag, own = stack.pop()
                where[tag].pop()
                if tag in _FENCE:
                    fences.pop()
                if own == -2:
                    dropped -= 1
                elif own >= 0:
                    self.ends[own] = len(pieces)
                    node = self.parents[own]
                in_link -= tag == "a"
                articles -= tag in ("article", "main")

        while at < size:
            lt = html.find("<", at)
            text = html[at : lt if lt >= 0 else size]
            if text and not dropped:
                pieces.append((text, in_link > 0, node))
            if lt < 0:
                break
            m = _TAG.match(html, lt)
            if m:
                at, end, tag, rest = m.end(), m[1], m[2].lower(), m[3]
            elif html.startswith("<!--", lt):
                close = html.find("-->", lt + 2)
                at = close + 3 if close >= 0 else size
                continue
            elif html.startswith(("<!", "<?"), lt):
                close = html.find(">", lt)
                at = close + 1 if close >= 0 else size
                continue
            elif m := _NAME.match(html, lt):
                end, tag, begin = m[1], m[2].lower(), m.end()
                at = _end_of_tag(html, begin, missing)
                rest = html[begin : at - 1]
            elif html.startswith("</", lt) and lt + 2 < size:  # no name after it: up to the next >, as a comment
                close = html.find(">", lt)
                at = close + 1 if close >= 0 else size
                continue
            else:
                at = lt + 1
                if not dropped:
                    pieces.append(("<", in_link > 0, node))
                continue
            if tag in _BLOCKS and not dropped and pieces and pieces[-1][0]:
                pieces.append(("", False, node))
            fence = fences[-1] if fences else -1
            if end:
                places = where.get(tag)
                if places and (places[-1] >= fence or tag in _FENCE):
                    pop(places[-1])
                continue
            if closes := _CLOSES.get(tag):
                last = max((where[t][-1] for t in closes if where.get(t)), default=-1)
                if last > fence:
                    pop(last)
            if tag in _VOID or rest.endswith("/") and tag not in _CONTAINERS:
                continue
            if tag in _RAW:
                close = re.compile(rf"</{tag}[^>]*>", re.I).search(html, at)
                at = close.end() if close else size
                continue
            own = -1
            if dropped:
                pass
            elif tag in _DROPPED or tag == "header" and not articles:
                own, dropped = -2, dropped + 1
            else:
                attributes = {k.lower(): a or b or c or "" for k, a, b, c in _ATTRIBUTE.findall(rest)} if rest else {}
                kind = ""
                if attributes and tag not in _NEVER:
                    kind = hint(f"{attributes.get('class', '')} {attributes.get('id', '')}")
                    kind = "" if kind == "header" and articles else kind
                    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
                        kind = "hidden"
                    if attributes.get("role", "").lower() in _ROLES:
                        kind = "role"
                if kind or tag in _BOXES:
                    path = ""
                    if tag in _CONTAINERS:
                        name = tag + "".join("." + c for c in sorted(set(_DIGITS.sub("0", attributes.get("class", "")).lower().split())))
                        path = xxhash.xxh3_128_hexdigest(f"{self.paths[node]}>{name}".encode("utf-8", "surrogatepass"))
                    own = len(kinds)
                    self.parents.append(node)
                    self.paths.append(path)
                    self.starts.append(len(pieces))
                    self.ends.append(-1)
                    kinds.append(kind or ("a" if tag in ("article", "main") else ""))
                    links.append(0)
                    node = own
            if tag == "a":
                in_link += 1
                links[node] += not dropped
            articles += tag in ("article", "main")
            where.setdefault(tag, []).append(len(stack))
            if tag in _FENCE:
                fences.append(len(stack))
            stack.append((tag, own))
        self.ends = [len(pieces) if e < 0 else e for e in self.ends]
        self.ends[0] = len(pieces)
        self._judge(kinds, links)

    def _judge(self, kinds: list[str], links: list[int]) -> None:
        """Which nodes are no main text (gone), the nodes' scores, and the best node."""
        n = len(kinds)
        chars, linked, plain = [0] * n, [0] * n, [0] * n
        for text, link, at in self.pieces:
            if k := len(text.strip()):
                chars[at] += k
                if link:
                    linked[at] += k
                else:
                    plain[at] += k
        for i in range(n - 1, 0, -1):
            up = self.parents[i]
            chars[up] += chars[i]
            linked[up] += linked[i]
            links[up] += links[i]
        self.gone, self.scores = [False] * n, [0.0] * n
        for i in range(1, n):
            hinted = kinds[i] not in ("", "a") and chars[i] <= NEARLY_ALL * (chars[0] - chars[i])
            menu = links[i] >= LEAST_LINKS and linked[i] >= LINK_SHARE * chars[i]
            self.gone[i] = self.gone[self.parents[i]] or hinted or menu
        for i in range(n):
            if not self.gone[i]:
                self.scores[i] += plain[i]
                if i:
                    self.scores[self.parents[i]] += plain[i] / 2
        # the highest score, the first of equals; articles and main count half as much again
        able = [i for i in range(n) if not i or self.paths[i]]
        self.best = max(able, key=lambda i: (self.scores[i] * (1.5 if kinds[i] == "a" else 1.0), -i))

    def text(self, path: str | None) -> str:
        """The text of all containers at path (those inside others once), or of the best container if there is none."""
        chosen = [i for i, p in enumerate(self.paths) if p == path and not self.gone[i]] if path else []
        return (self._blocks(chosen) if chosen else "") or self._blocks([self.best])

    def _blocks(self, nodes: list[int]) -> str:
        blocks, held, upto = [], [], 0
        for i in nodes:  # in page order
            for k in range(max(self.starts[i], upto), self.ends[i] + 1):
                text, _, at = self.pieces[k] if k < self.ends[i] else ("", False, i)
                if text:
                    if not self.gone[at]:
                        held.append(text)
                elif held:
                    if block := " ".join(entities.unescape("".join(held)).split()):
                        blocks.append(block)
                    held = []
            upto = max(upto, self.ends[i])
        return "\n".join(blocks)


def _end_of_tag(html: str, at: int, missing: set[str]) -> int:
    """Where the tag whose attributes start here ends: after the next > outside quotes. missing: quotes that close nowhere from here on."""
    while m := _NEXT.search(html, at):
        at = m.end()
        if m[0] == ">":
            return at
        if m[0] not in missing:
            close = html.find(m[0], at)
            if close < 0:
                missing.add(m[0])
            else:
                at = close + 1
    return len(html) + 1


def votes(pages: DataFrame) -> DataFrame:
    """host, path, pages, chars: the votes of each host's pages."""

    def run(batch: pa.RecordBatch):
        found: dict[tuple[str, str], list[int]] = {}
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if host and html:
                page = Page(html)
                if path := page.paths[page.best]:
                    v = found.setdefault((host, path), [0, 0])
                    v[0] += 1
                    v[1] += int(page.scores[page.best])
        yield {"host": [k[0] for k in found], "path": [k[1] for k in found], "pages": [v[0] for v in found.values()], "chars": [v[1] for v in found.values()]}

    counted = common.arrow_map(pages.select("host", "html"), run, "host string, path string, pages long, chars long")
    return counted.groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum("chars").alias("chars"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page."""
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    winners = common.materialise(votes(pages).groupBy("host").agg(F.max_by("path", F.struct("pages", "chars", "path")).alias("path")))
    few = winners.limit(common.BROADCAST_ROWS // 10 + 1).count() <= common.BROADCAST_ROWS // 10
    joined = pages.join(F.broadcast(winners) if few else winners, "host", "left").select("page_id", "url", "html", "path")

    def run(batch: pa.RecordBatch):
        texts = [Page(h).text(p) if h else "" for h, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": list(map(len, texts))}

    return common.arrow_map(joined, run, "page_id long, url string, text string, n_chars long")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
