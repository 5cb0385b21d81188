"""Main text of web pages with a site style tree.

Pages of one host are merged from the root down: a child element belongs to
the same tree node as another page's if their parents do, the parents' child
sequences (their style) are the same, and so is its place in them. A node's
importance is the entropy of what stands in it, as a share of the most that
its pages allow: of the child sequences for an element, of the text (digits
folded) for a text node. A node of m pages whose content takes one form has
importance 0, one form per page gives 1. Pages that share their longest text
are copies of one page and count once, so a copied article does not look like
a template.

A page is then mapped on its host's tree. A branch's composite importance is
(1 - G^l) * its node's importance + G^l * the mean of its l children's; an
element goes if its composite importance and every node below it stay under
``THRESHOLD`` (a text that takes fewer than sqrt(m) forms on m pages). Nodes
of fewer than ``MIN_PAGES`` pages have importance 1: no evidence. Some branches
are decided by what they call themselves: navigation, header, footer, aside,
form, script, advert, notice, comment and the like (tag, class, id or role)
have importance 0; article and main have importance 1, and where a page names
one that has text, the text outside it goes.

The tree is three aggregates over (node, content, page) hashes, with partial
sums before each shuffle; no host's pages meet in one task. Nodes under the
threshold go to the tasks as a sorted array while there are at most
``max_broadcast`` of them (16 bytes each), else they are joined to the pages'
nodes, dealt over ``SALTS`` parts a node.

Defined results: one row per input row; null, empty or text-free HTML gives an
empty text; white space inside a block (``br`` included) is one space, blocks
are joined by two line feeds; unclosed and misnested tags, an unfinished tag
or comment at the end, and unknown character references are taken as browsers
take them; a null URL or one without ``://`` has no site, so only names decide;
equal rows give equal rows; columns keep their names, whatever they are, but
for one called ``__main``, which the result replaces.
"""

from __future__ import annotations

import re
import struct
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, others

#: A branch goes below this share of the greatest entropy its pages allow.
THRESHOLD = 0.5
#: Weight of the children in a composite importance.
G = 0.9
#: Pages (copies counted once) that a node needs before it can be boilerplate.
MIN_PAGES = 5
#: Low nodes sent to every task as one array; more of them are joined.
MAX_BROADCAST = 1 << 20
SALTS = 16

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul caption".split())
CELLS = frozenset(("td", "th"))
CLOSES_P = BLOCK - {"head", "body", "html", "option", "optgroup", "caption", "tbody", "thead", "tfoot", "tr", "legend"}
#: Elements whose start ends an open one: (names ended, names that shield them).
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}), "body": ({"head"}, set()),
}
# Names of branches that are no article text, and of those that are the article.
NOISE_TAGS = frozenset("nav footer aside form dialog search menu head noscript template select button object canvas audio video svg math map datalist".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NOISE_NAMES = frozenset("ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside widget widgets footer masthead topbar toolbar share sharing social comment comments disqus respond reply replies related recommended recommendations outbrain taboola pagination pager".split())
MAIN_TAGS, MAIN_ROLES = frozenset(("article", "main")), frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"""<(?:!--(?P<comment>.*?)--!?>|(?P<open>!--)|[!?][^>]*>|/(?P<end>[a-zA-Z][^\s/>]*)[^>]*>|(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>)""", re.S)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}
_ATTR = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/"']|$)""", re.I)
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_HOST = re.compile(r"://([^/?#]*)", re.S)
_DIGITS = re.compile(r"\d")
OPEN, NOISE, MAIN = 0, 1, 2


def _kind(tag: str, attrs: str, inside: int) -> int:
    """What an element's names say about it; ``inside`` is its parent's kind."""
    if inside == NOISE or tag in NOISE_TAGS or (tag == "header" and inside != MAIN):
        return NOISE
    kind = MAIN if inside == MAIN or tag in MAIN_TAGS else OPEN
    if attrs and not attrs.isspace():
        given = {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTR.finditer(attrs)}
        role = given.get("role", "").lower()
        if "hidden" in given or given.get("aria-hidden") == "true" or _HIDDEN.search(given.get("style", "")) or role in NOISE_ROLES:
            return NOISE
        names = {n.lower() for a in ("class", "id") for n in _NAMES.findall(given.get(a, ""))}
        if names & NOISE_NAMES and tag not in HEADINGS and tag not in ("html", "body", "main") and not (tag == "article" and not names & {"comment", "comments", "reply"}):
            return NOISE
        if role in MAIN_ROLES:
            return MAIN
    return kind


class Page:
    """The element tree of one page: per element its tag, kind, parent and children (elements' numbers and texts)."""

    def __init__(self, html: str) -> None:
        self.tag, self.kind, self.parent, self.kids = ["#page"], [OPEN], [-1], [[]]
        self._stack, self._open = [0], Counter()
        # after the last '>' no tag can end, so an unfinished one is dropped with what follows it
        at, last = 0, html.rfind(">") + 1
        while m := _TOKEN.search(html, at, last):
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            if tag := m["tag"] or m["tag2"]:
                at = self._start(tag.lower(), m["attrs"] or m["attrs2"] or "", html, at)
            elif m["end"]:
                self._end(m["end"].lower())
            elif m["open"]:
                at = len(html)
            if at > last:
                break
        tail = html[at:]
        self._text(re.split(r"<[a-zA-Z/!?]", tail, maxsplit=1)[0])

    def _text(self, raw: str) -> None:
        if raw:
            self.kids[self._stack[-1]].append(unescape(raw) if "&" in raw else raw)

    def _pop_to(self, depth: int) -> None:
        for n in self._stack[depth:]:
            self._open[self.tag[n]] -= 1
        del self._stack[depth:]

    def _close(self, names: set[str], shields: set[str]) -> None:
        if any(self._open[n] for n in names):
            for depth in range(len(self._stack) - 1, 0, -1):
                tag = self.tag[self._stack[depth]]
                if tag in names:
                    return self._pop_to(depth)
                if tag in shields:
                    return None
        return None

    def _start(self, tag: str, attrs: str, html: str, at: int) -> int:
        if tag in RAW:
            done = _RAW_END[tag].search(html, at)
            return done.end() if done else len(html)
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        if tag in CLOSES_P and self._open["p"]:
            self._close({"p"}, {"td", "th", "caption", "button", "object"})
        here = self._stack[-1]
        n = len(self.tag)
        self.tag.append(tag)
        self.kind.append(_kind(tag, attrs, self.kind[here]))
        self.parent.append(here)
        self.kids.append([])
        self.kids[here].append(n)
        if tag not in VOID and not (attrs.endswith("/") and tag in ("svg", "math", "path", "use")):
            self._stack.append(n)
            self._open[tag] += 1
        return at

    def _end(self, tag: str) -> None:
        if not self._open[tag]:
            return
        block = tag in BLOCK or tag in CELLS
        for depth in range(len(self._stack) - 1, 0, -1):
            name = self.tag[self._stack[depth]]
            if name == tag:
                return self._pop_to(depth)
            if not block and (name in BLOCK or name in CELLS):
                return  # an inline end tag does not close a block

    def blocks(self, gone: set[int] = frozenset()) -> list[tuple[str, bool]]:
        """The blocks' texts in page order, without the branches ``gone``, each with whether it stands in a named article."""
        out: list[tuple[str, bool]] = []
        run: list[str] = []

        def flush(main: bool) -> None:
            if text := " ".join("".join(run).split()):
                out.append((text, main))
            run.clear()

        walk: list[tuple[int, Iterator]] = [(0, iter(self.kids[0]))]
        while walk:
            n, rest = walk[-1]
            main = self.kind[n] == MAIN
            for kid in rest:
                if isinstance(kid, str):
                    run.append(kid)
                    continue
                tag = self.tag[kid]
                edge = tag in BLOCK
                if edge:
                    flush(main)
                if tag == "br" or tag in CELLS:
                    run.append(" ")
                if self.kind[kid] == NOISE or kid in gone:
                    continue
                if self.kids[kid]:
                    walk.append((kid, iter(self.kids[kid])))
                    break
            else:
                walk.pop()
                if self.tag[n] in BLOCK or not walk:
                    flush(main)
                elif self.tag[n] in CELLS:
                    run.append(" ")
        return out

    def nodes(self, host: str) -> list[tuple[int, int, int, int]]:
        """(element, child place or -1 for the element itself, node, content) of every undecided element and text."""
        out, keys = [], {0: _hash(host.encode())}
        for n in range(len(self.tag)):
            key = keys.get(n)
            if key is None:
                continue
            kids = [k for k in self.kids[n] if not isinstance(k, str) or not k.isspace()]
            style = _hash("\n".join("#" if isinstance(k, str) else self.tag[k] for k in kids).encode())
            out.append((n, -1, key, style))
            for place, kid in enumerate(kids):
                below = _hash(struct.pack("<qqq", key, style, place))
                if isinstance(kid, str):
                    out.append((n, place, below, _hash(_folded(kid))))
                elif self.kind[kid] == OPEN:
                    keys[kid] = below
        return out

    def low(self, nodes: list[tuple[int, int, int, int]], importance: list[float]) -> set[int]:
        """Elements whose composite importance and every node below stay under the threshold."""
        own = {n: v for (n, place, _, _), v in zip(nodes, importance, strict=True) if place < 0}
        texts: dict[int, list[float]] = {}
        for (n, place, _, _), v in zip(nodes, importance, strict=True):
            if place >= 0:
                texts.setdefault(n, []).append(v)
        whole, gone = {}, set()
        for n in range(len(self.tag) - 1, -1, -1):  # children come after their parents
            if n not in own:
                whole[n] = 0.0 if self.kind[n] == NOISE else 1.0
                if self.kind[n] == NOISE:
                    gone.add(n)
                continue
            kids = [k for k in self.kids[n] if not isinstance(k, str)]
            below = texts.get(n, []) + [whole[k] for k in kids]
            weight = G ** len(below) if below else 0.0
            whole[n] = (1 - weight) * own[n] + weight * sum(below) / max(len(below), 1)
            if whole[n] < THRESHOLD and all(v < THRESHOLD for v in texts.get(n, ())) and all(k in gone for k in kids):
                gone.add(n)
        return gone

    def longest(self) -> int:
        """Hash of the longest text: tells copies of a page."""
        return _hash(_folded(max((k for kids in self.kids for k in kids if isinstance(k, str)), key=len, default="")))


def _hash(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def _folded(text: str) -> bytes:
    return _DIGITS.sub("0", " ".join(text.split())).encode("utf-8", "surrogatepass")


def host_of(url: str | None) -> str | None:
    """The URL's host, A-Z lower-cased; None without one."""
    m = _HOST.search(url or "")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]) or None if m else None


def _node_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, content, page) hashes, once a batch."""
    for batch in batches:
        rows = set()
        for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if html and (host := host_of(url)):
                page = Page(html)
                copy = page.longest()
                rows.update((key, content, copy) for _, _, key, content in page.nodes(host))
        cols = np.array(sorted(rows), np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([pa.array(cols[:, k]) for k in range(3)], names=["node", "content", "page"])


def site_style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(node, n_pages, importance) of every undecided node of every host's tree."""
    asked = pages.select(F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
    seen = asked.mapInArrow(_node_rows, "node long, content long, page long").distinct()
    forms = seen.groupBy("node", "content").agg(F.count("*").alias("n"))
    nodes = forms.groupBy("node").agg(F.sum("n").alias("n_pages"), F.sum(F.col("n") * F.ln("n")).alias("s"))
    return nodes.select("node", "n_pages", F.when(F.col("n_pages") == 1, 1.0).otherwise(1 - F.col("s") / (F.col("n_pages") * F.ln("n_pages"))).alias("importance"))


def _main_text(html: str | None, url: str | None, importance) -> str:
    if not html:
        return ""
    page, gone = Page(html), set()
    if host := host_of(url):
        nodes = page.nodes(host)
        gone = page.low(nodes, importance([key for _, _, key, _ in nodes]))
    found = page.blocks(gone)
    if any(main for _, main in found):
        found = [b for b in found if b[1]]
    return "\n\n".join(text for text, _ in found)


def _extract(low: tuple[np.ndarray, np.ndarray] | None):
    """Texts of pages; ``low``: the low nodes, sorted, and their importance (None: they come with each page)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def known(keys: list[int]) -> list[float]:
            if not len(low[0]):
                return [1.0] * len(keys)
            want = np.array(keys, np.int64)
            at = np.minimum(np.searchsorted(low[0], want), len(low[0]) - 1)
            return np.where(low[0][at] == want, low[1][at], 1.0).tolist()

        for batch in batches:
            urls, htmls = batch.column("url").to_pylist(), batch.column("html").to_pylist()
            if low is not None:
                texts = [_main_text(h, u, known) for u, h in zip(urls, htmls, strict=True)]
            else:
                texts = []
                for u, h, own in zip(urls, htmls, batch.column("low").to_pylist(), strict=True):
                    mine = {x["node"]: x["importance"] for x in own or ()}
                    texts.append(_main_text(h, u, lambda keys, mine=mine: [mine.get(k, 1.0) for k in keys]))
            texts = [t.encode("utf-8", "replace").decode() for t in texts]  # a lone surrogate has no UTF-8
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    return run


def _with_rid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = set()
        for rid, url, html in zip(batch.column("rid").to_pylist(), batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if html and (host := host_of(url)):
                rows.update((rid, key) for _, _, key, _ in Page(html).nodes(host))
        yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.string()), pa.array([k for _, k in rows], pa.int64())], names=["rid", "node"])


def _low_of_pages(asked: DataFrame, low: DataFrame) -> DataFrame:
    """``asked`` (row, url, html) with each page's low nodes, joined."""
    rid = F.sha2(F.concat_ws("\x01", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))), 256)
    keyed = asked.withColumn("rid", rid).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    mine = keyed.select("rid", "url", "html").mapInArrow(_with_rid, "rid string, node long").distinct()
    mine = mine.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int"))
    hits = mine.join(low.select("node", "importance", salts), ["node", "salt"])
    per_page = hits.groupBy("rid").agg(F.collect_list(F.struct("node", "importance")).alias("low")).select("rid", "low", salts)
    return keyed.join(per_page, ["rid", "salt"], "left").select("row", "url", "html", "low")


def extract(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", keep: list[str] | None = None, max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """``keep`` columns (default all) + ``__main``: struct of the main text and its number of characters."""
    keep = others(pages.columns if keep is None else keep, "__main")
    tree = site_style_tree(pages, url_col, html_col)
    low = cut(tree.where((F.col("importance") < THRESHOLD) & (F.col("n_pages") >= MIN_PAGES)).select("node", "importance"), "style-tree")
    asked = pages.select(
        F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"),
        F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"),
    )
    sent = None
    if low.count() <= max_broadcast:
        held = low.orderBy("node").toPandas()
        sent = held["node"].to_numpy(np.int64), held["importance"].to_numpy(float)
    else:
        asked = _low_of_pages(asked, low)
    out = asked.mapInArrow(_extract(sent), T.StructType([asked.schema["row"], T.StructField("text", T.StringType())]))
    return out.select("row.*", F.struct("text", F.char_length("text").cast("long").alias("n_chars")).alias("__main"))
