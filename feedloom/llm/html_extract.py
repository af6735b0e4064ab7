"""Main text of web pages by site style trees.

The pages of a host are merged into a style tree: a style node is a path of
(tag, class, id) of containers and other elements from the root; digits in names count
as one.  A text belongs to its innermost container.  A container path gets two
importances over the host's m distinct pages that have it, both 1 for m = 1:

* presentation: the entropy, to base m, of the sequences in which its children come;
* content: one minus the mean, over the features that its pages show (the words of its
  own texts, link targets, images), of log_m of the number of pages with that feature.
  What every page repeats adds 1 to that mean, what only one page has adds 0.

    importance = (1 - g^l) * presentation + g^l * content,   g = 0.9

with l child sequences.  Pages of equal text count once, and for a node inside an article
all pages with that article's text do, whatever stands around it.

A page loses the own texts of its nodes of low importance; a branch whose nodes are all
low goes whole.  That never takes an article's own text, or texts that make up a large
share of their pages.  The importance of a branch is 0, whatever its entropies, if its tag
or a class or id names a role that is not main text (menu, header, footer, sidebar,
notice, advert, form, comments), or if it is made of links.  A class names a role if
all its words are role words or words of layout (``site-footer``, ``comments-area``);
outside articles also if it ends with an unmistakable one (``acme-sidebar``).  So
``market-share`` or ``ad-hoc`` name none.  A wrapper that holds an article is not removed
for being a form or dialog or for a word of its layout (``sidebar-right``), nor, where no
other article is left, for another soft name (``sidebar``); only its other branches go, and
an article in a menu, footer, aside or comments goes with it.

Where a page has an article (or main) branch, the text is what is left in it, unless
several articles are all shorter than the text of one container beside them, which makes them
teasers; otherwise it is what is left of the page.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spill

DAMPING = 0.9
#: Importance below which a node's texts are removed; pages of a host that a style node
#: needs for it; share of the page's text that protects them.
THRESHOLD = 0.2
MIN_PAGES = 3
PROTECTED_SHARE = 0.3
#: Share of link text, and links, that make a branch a menu.
LINK_SHARE = 0.8
MIN_LINKS = 3
#: What stands between two blocks of the text.
BLOCK_JOIN = "\n\n"

# fixed values: HTML element kinds and names of roles
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset(
    "article aside blockquote body div dl figure footer form header main menu nav ol section table ul".split())
NOISE_TAGS = frozenset("aside button datalist dialog footer form head input menu nav object select".split())
MAIN_TAGS = frozenset("article main".split())
NOISE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice popup "
    "promo promotion related replies reply share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar topbar widget".split())
#: Names that also remove an article inside; the rest of the names is soft.
HARD_TAGS = NOISE_TAGS - frozenset("button dialog form object".split())
HARD_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising breadcrumb breadcrumbs comment comments disqus footer menu "
    "nav navbar navigation related replies reply".split())
#: Words that a class may add to a role word; role words that may end any class.
LAYOUT_WORDS = frozenset(
    "area articles aside bar block blocks body bottom box button buttons card cards col column container count entry "
    "fixed float form global group header heading holder icon icons inline inner item items left link links list "
    "main mobile module more outer page panel post posts primary right row secondary section site slot sticky "
    "story stories text thread title top unit wrap wrapper".split())
END_WORDS = NOISE_WORDS - frozenset("banner modal notice promo promotion related replies reply share sharing "
                                    "social sponsor sponsored subscribe widget".split())
TEASER_WORDS = frozenset("card excerpt preview teaser".split())
HARD_ROLES = frozenset("complementary contentinfo menu menubar navigation search toolbar".split())
#: A name with one of these words describes the layout around a part.
OPTION_WORDS = frozenset(
    "closed disabled enabled hidden hide layout left off on open right show template visible".split())
#: A name that begins with one of these is never that of the part.
ABOUT_WORDS = frozenset("has have no with without".split())
NOISE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
                        "search toolbar".split())
CLOSES = {  # an opening tag ends these, up to the bounds
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
WORDS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")


def _rank(name: str, label: str, role: str, inside: bool) -> int:
    """How firmly a branch is named as no main text: 0 not at all, 1 by a form or
    its layout, 2 by a soft name, 3 by a name that removes articles too."""
    rank = 0
    if name in NOISE_TAGS or role in NOISE_ROLES:
        rank = 3 if name in HARD_TAGS or role in HARD_ROLES else 1
    if name == "header" and not inside:
        rank = max(rank, 2)
    for token in label.split():
        words = WORDS.findall(token)
        named = [w for w in words if w in NOISE_WORDS or w == "header" and not inside]
        if not named or words[0] in ABOUT_WORDS:
            continue
        if not OPTION_WORDS.isdisjoint(words):
            rank = max(rank, 0 if inside else 1)
        elif (all(w in NOISE_WORDS or w in LAYOUT_WORDS for w in words)
              or not inside and (words[-1] in END_WORDS or words[-1] == "header")):
            rank = max(rank, 2 if HARD_WORDS.isdisjoint(named) else 3)
    return rank


class Page:
    """One parse: nodes (parent, path, tag, rank, main, article) and text pieces."""

    def __init__(self, html: str | None):
        self.parent, self.path, self.tag = [-1], [0], ["#root"]
        self.rank, self.main, self.article, self.style = [0], [False], [False], ["#root"]
        self.pieces: list[tuple[int, int, str, bool]] = []  # block, node, text, in a link
        self.links: list[int] = []  # node of each link
        self.targets: list[tuple[int, str]] = []  # node and address of links and images
        self.open: Counter = Counter()  # open elements by tag
        if html:
            self._read(html)

    def _read(self, html: str) -> None:
        stack, block, link, at, n = [0], 0, False, 0, len(html)
        while at < n:
            m = TOKEN.search(html, at)
            end = m.start() if m else n
            if end > at:
                self.pieces.append((block, stack[-1], unescape(html[at:end]), link))
            if not m:
                break
            at = max(m.end(), end + 1)
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                if name == "a":
                    link = False
                elif name in BLOCK or name in NOISE_TAGS:
                    block += name in BLOCK
                    self._close(stack, name)
                elif self.tag[stack[-1]] == name:
                    self._pop(stack, len(stack) - 1)
                continue
            attributes = m[3]
            if name in RAW:
                if not attributes.rstrip().endswith("/"):
                    close = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(html, at)
                    at = close.end() if close else n
                continue
            if name == "br":
                self.pieces.append((block, stack[-1], " ", link))
                continue
            if name in ("a", "img"):
                for k, x, y, z in ATTRIBUTE.findall(attributes):
                    if k.lower() in ("href", "src"):
                        self.targets.append((stack[-1], x or y or z))
                if name == "a":
                    link = True
                    self.links.append(stack[-1])
                continue
            if name in BLOCK:
                block += 1
                self._imply(stack, name)
            if name in VOID or (name not in BLOCK and not attributes.strip() and name not in NOISE_TAGS):
                continue
            stack.append(self._add(stack[-1], name, attributes))

    def _add(self, parent: int, name: str, attributes: str) -> int:
        style, label, role, body = name, "", "", False
        if attributes.strip():
            named = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}
            label = f"{named.get('class', '')} {named.get('id', '')}".strip().lower()
            role = named.get("role", "").strip().lower()
            if label:
                style = f"{name}.{DIGITS.sub('0', label)}"
            body = role == "main" or named.get("itemprop") == "articleBody"
        inside, body = self.main[parent], body or name in MAIN_TAGS
        rank = _rank(name, label, role, inside)
        if name in ("html", "body") or body and (rank == 1 or rank == 2 and not inside):
            rank = 0  # their classes often describe the page's options
        if name == "article" and not TEASER_WORDS.isdisjoint(label.split()):
            rank = max(rank, 2)
        self.open[name] += 1
        self.parent.append(parent)
        self.path.append(xxhash.xxh64_intdigest(f"{self.path[parent]}/{style}") >> 1)
        self.tag.append(name)
        self.style.append(style)
        self.rank.append(rank)
        self.article.append(body and not rank)
        self.main.append(inside or self.article[-1])
        return len(self.tag) - 1

    def _pop(self, stack: list[int], k: int) -> None:
        for node in stack[k:]:
            self.open[self.tag[node]] -= 1
        del stack[k:]

    def _close(self, stack: list[int], name: str) -> None:
        if not self.open[name]:  # closes nothing: the stack is not searched
            return
        for k in range(len(stack) - 1, 0, -1):
            if self.tag[stack[k]] == name:
                self._pop(stack, k)
                return

    def _imply(self, stack: list[int], name: str) -> None:
        ends, bounds = CLOSES.get(name, ((), ()))
        if any(self.open[e] for e in ends):
            for k in range(len(stack) - 1, 0, -1):
                tag = self.tag[stack[k]]
                if tag in ends:
                    self._pop(stack, k)
                    return
                if tag in bounds:
                    break
        if not self.open["p"]:
            return
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[k]]
            if tag == "p":
                self._pop(stack, k)
                return
            if tag in CONTAINER or tag in ("td", "th", "li", "dd", "button"):
                return

    def _containers(self) -> list[int]:
        """The innermost container of each node, itself included; 0 without one."""
        out = [0] * len(self.tag)
        for k in range(1, len(self.tag)):
            out[k] = k if self.tag[k] in CONTAINER else out[self.parent[k]]
        return out

    def statistics(self) -> list[tuple[int, int, int, float, list[int]]]:
        """(path, unit, children, share, features) of each container path; equal paths of
        a page count as one node.

        The unit is a hash of the text of the article around the node, else of the
        page.  ``children`` is a hash of the sequence of the children's styles (runs count
        once), ``share`` that of the node's own texts in the page's.  Features of own
        texts are given where they can decide: not for an article, a large share, or a
        branch that its name removes.
        """
        n = len(self.tag)
        home, top, named = self._containers(), [0] * n, [False] * n
        for k in range(1, n):
            p = self.parent[k]
            top[k] = top[p] or (k if self.article[k] else 0)
            named[k] = named[p] or self.rank[k] > 1
        kids: dict[int, list[str]] = {}
        for k in range(1, n):
            row = kids.setdefault(self.path[self.parent[k]], [])
            if not row or row[-1] != self.style[k]:
                row.append(self.style[k])
        first: dict[int, int] = {}  # the first node of each container path
        for k in range(1, n):
            if self.tag[k] in CONTAINER:
                first.setdefault(self.path[k], k)
        texts: dict[int, list[str]] = {}
        units = {0: xxhash.xxh64()} | {k: xxhash.xxh64() for k in set(top)}
        chars, total = Counter(), 0
        for _, node, text, _ in self.pieces:
            t = " ".join(text.split())
            if t:
                total += len(t)
                for u in {0, top[node]}:
                    units[u].update(t.encode("utf-8", "surrogatepass") + b"\n")
                path = self.path[home[node]]
                chars[path] += len(t)
                texts.setdefault(path, []).append(t)
        targets: dict[int, list[str]] = {}
        for node, address in self.targets:
            targets.setdefault(self.path[home[node]], []).append(address)
        out = []
        for path, k in first.items():
            share = chars[path] / total if total else 0.0
            found: set[int] = set()
            if share < PROTECTED_SHARE and not self.article[k] and not named[k] and path in texts:
                for t in texts[path]:
                    found.update(xxhash.xxh64_intdigest(w) >> 1 for w in t.lower().encode().split())
                found.update(xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 1) >> 1
                             for x in targets.get(path, ()))
                found.discard(0)
            out.append((path, units[top[k]].intdigest() >> 1,
                        xxhash.xxh64_intdigest("\n".join(kids.get(path, ())).encode("utf-8", "surrogatepass")) >> 1,
                        share, sorted(found)))
        return out

    def text(self, low: set[int]) -> str:
        """The blocks that are left without noise and without own texts of the paths ``low``."""
        n = len(self.tag)
        home = self._containers()
        has_main = list(self.main)
        for k in range(n - 1, 0, -1):
            if has_main[k]:
                has_main[self.parent[k]] = True
        chars, linked, links = [0] * n, [0] * n, [0] * n
        for _, node, text, link in self.pieces:
            c = len(text.strip())
            chars[node] += c
            linked[node] += c * link
        for node in self.links:
            links[node] += 1
        for k in range(n - 1, 0, -1):
            for a in (chars, linked, links):
                a[self.parent[k]] += a[k]
        top = [0] * n  # the outermost article of each node, 0 without
        for k in range(1, n):
            top[k] = top[self.parent[k]] or (k if self.article[k] else 0)
        holds = [a and c > 0 for a, c in zip(self.article, chars)]  # an article with text
        last, firm = [True] * n, [0] * n
        for k in range(n - 1, 0, -1):
            if holds[k]:
                holds[self.parent[k]], last[self.parent[k]] = True, False
        for k in range(1, n):
            firm[k] = max(firm[self.parent[k]], self.rank[k])
        free = any(self.article[k] and holds[k] and last[k] and firm[k] < 2 for k in range(n))
        opens = 1 if free else 2  # the firmest name that does not remove an article

        def left(plain: int) -> str:
            """The text, where names up to ``plain`` do not count."""
            gone, shut = [False] * n, [False] * n
            for k in range(1, n):
                up = self.parent[k]
                menu = (not has_main[k] and self.tag[k] in CONTAINER and self.tag[k] != "body"
                        and links[k] >= MIN_LINKS and linked[k] >= LINK_SHARE * chars[k])
                named = self.rank[k] > plain
                shut[k] = shut[up] or menu or named and not (holds[k] and self.rank[k] <= opens)
                # of a named wrapper only the articles are left
                gone[k] = shut[k] or named or gone[up] and not self.article[k]
            blocks: dict[int, list[str]] = {}
            inside: dict[int, list[str]] = {}
            beside: dict[int, list[str]] = {}
            size: Counter = Counter()  # by article, and by container outside
            for block, node, text, _ in self.pieces:
                at = home[node]
                if not gone[node] and (self.article[at] or self.path[at] not in low):
                    blocks.setdefault(block, []).append(text)
                    (inside if self.main[node] else beside).setdefault(block, []).append(text)
                    size[top[node] or -1 - at] += len(text.strip())
            own = [c for k, c in size.items() if k > 0 and c]
            teasers = (len(own) > 1 and all(self.tag[k] == "article" for k in size if k > 0)
                       and max(own) < max((c for k, c in size.items() if k < 0), default=0))
            for some in ((beside,) if teasers else (inside, blocks)):
                lines = [x for x in (" ".join("".join(t).split()) for _, t in sorted(some.items())) if x]
                if lines:
                    return BLOCK_JOIN.join(lines)
            return ""

        # a page that is all in a form or a layout wrapper is not empty for that
        return left(0) or (left(1) if 1 in self.rank else "")


def host_of(url: str):
    """Lower-case host of a URL column; empty for null or none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def page_key(html: str = "html"):
    """A digest that stands for a page's html."""
    return F.sha2(F.coalesce(F.col(html), F.lit("")), 256)


def page_nodes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, page, path, unit, children, share, features) of each page's style nodes,
    written once; page is the page's key."""
    schema = ("host string, page string, path long, unit long, children long, share double, "
              "features array<long>")

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                rows = [(h, p, *s) for h, p, x in zip(*(part.column(k).to_pylist() for k in range(3)))
                        for s in Page(x).statistics()]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (
                            pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(),
                            pa.list_(pa.int64())))],
                        names=["host", "page", "path", "unit", "children", "share", "features"])

    return spill(pages.select(host_of(url).alias("host"), page_key(html).alias("page"), F.col(html))
                 .mapInArrow(run, schema), "nodes")


def style_tree(nodes: DataFrame) -> DataFrame:
    """(host, path, pages, styles, share, presentation, content, importance) of every
    style node over the nodes of all pages; path is a hash of the path."""
    by = ["host", "path"]
    # copies meet map-side and count once; no group holds a host's pages
    seen = spill(nodes.groupBy(*by, "unit").agg(F.min(F.struct("children", "share")).alias("one"))
                 .select(*by, "one.*").groupBy(*by, "children")
                 .agg(F.count("*").alias("n"), F.sum("share").alias("share")), "styles")
    n, c = F.col("n"), F.col("c")
    looks = (seen.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(n * F.log("n")).alias("s"),
                                   F.count("*").alias("styles"), (F.sum("share") / F.sum("n")).alias("share"))
             .select(*by, "n", "styles", "share",
                     F.when(n > 1, F.greatest(F.lit(0.0), (F.log("n") - F.col("s") / n) / F.log("n")))
                     .otherwise(F.lit(1.0)).alias("presentation")))
    # each feature of a node once a unit; feature 0 counts the units themselves
    feature = (nodes.where(F.size("features") > 0)
               .select(*by, "unit", F.explode(F.concat(F.array(F.lit(0).cast("long")), "features")).alias("f"))
               .distinct().groupBy(*by, "f").agg(F.count("*").alias("c")))
    shown = F.col("f") != 0
    content = (feature.groupBy(*by).agg(F.max(F.when(~shown, c)).alias("m"),
                                        F.sum(F.when(shown, c)).alias("all"),
                                        F.sum(F.when(shown, c * F.log("c"))).alias("s"))
               .select(*by, F.when(F.col("m") > 1, 1 - F.col("s") / (F.col("all") * F.log("m")))
                       .otherwise(F.lit(1.0)).alias("content")))
    damp = F.pow(F.lit(DAMPING), F.col("styles"))
    return (looks.join(content, by, "left")
            .select(*by, F.col("n").alias("pages"), "styles", "share", "presentation",
                    F.coalesce("content", F.lit(1.0)).alias("content"))
            .withColumn("importance", (1 - damp) * F.col("presentation") + damp * F.col("content")))


def low_paths(nodes: DataFrame, threshold: float = THRESHOLD, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, page, low): of each page that has any, its paths of low importance."""
    low = (style_tree(nodes)
           .where((F.col("importance") < threshold) & (F.col("pages") >= min_pages)
                  & (F.col("share") < PROTECTED_SHARE)).select("host", "path"))
    low = spill(low, "low")
    # a page's own paths only, however many its host has
    return spill(nodes.select("host", "page", "path").join(low, ["host", "path"])
                 .groupBy("host", "page").agg(F.collect_set("path").alias("low")), "low-pages")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            threshold: float = THRESHOLD, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Blocks of text have their references decoded and white space turned into
    single spaces and are joined by two line ends; a page without any has an empty
    text, as has null html.  Pages without a host form one host.  Repeated rows
    stay rows; other columns are ignored; an empty table gives an empty table.
    A ``threshold`` of 0 leaves out what the tree removes.
    """
    found = low_paths(page_nodes(pages, url, html), threshold, min_pages)

    def run(batches):
        for b in batches:
            text = [Page(x).text(set(low or ())) for x, low in
                    zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()),
                 pa.array(np.fromiter(map(len, text), np.int64, len(text)))],
                names=["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                         F.col(html).alias("__html"), host_of(url).alias("host"), page_key(html).alias("page"))
            .join(found, ["host", "page"], "left").select("page_id", "url", "__html", "low")
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
