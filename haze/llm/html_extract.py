"""Main text of web pages by consensus host paths.

1. Each page is parsed and its containers are scored: a container's share of the
   page's text outside links, raised by its depth, so that the deepest container
   that still holds nearly all of the text scores best. From there it is climbed
   to the article or main around it, or else over headings and texts beside it.
2. Each page votes for its best container's generalised path (tags with classes,
   digits removed); Spark counts votes and pages by host and path. A path wins if
   at least half of the host's pages that have it vote for it.
3. Pages are extracted again: the winning path with most votes that the page has,
   or a winning path inside it, gives the text; a page without any of them uses
   its own best container.

Menus, headers, footers, sidebars, notices, adverts, forms, comments and raw text
elements are left out wherever they stand, boxes by whole class names made of the
words for them. Boxes named for comments and notices go whatever their size, unless
they hold main, and so do adverts wherever there is text outside all such boxes. Of
the others an element that is or holds main stays, and so do one that is or holds an
article, and a form or a named box with more than half of the page's text outside
links if it holds the h1 or no text stands outside such boxes; an article or main
elsewhere that has the text rules them out. Blocks are the texts between block-level
tags; white space inside one becomes a single space.

Defined results: a null or empty page has the empty text and no votes; a null or
hostless url belongs to the host ""; broken and cut-off markup is closed as far
as it goes; repeated rows give repeated rows; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html as _html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haze.llm.common import written

PATHS = 5  # paths of a host that a page may use, by votes
_DEPTH = 1.08
_BESIDE_ARTICLE = 0.1  # a box that holds an article stays unless an article elsewhere has this share of its text

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>?|<[!?/][^>]*+>?""", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_IFRAME = re.compile(r"<(/?)iframe\b", re.I)
# HTML elements by their role.
_RAW = frozenset("script style noscript textarea title template iframe svg math object select canvas audio video".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINERS = frozenset("html body div section article main td form center table".split())
_BLOCKS = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote figure figcaption address hr tr th thead tbody "
                                  "tfoot caption header footer nav aside fieldset details summary dialog head menu".split())
_LEFT_OUT = frozenset("nav footer aside form head menu dialog button input label fieldset".split()) | _RAW
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}}
_NOISE_WORD = (
    r"(?:nav(?:bar|igation)?|menus?|topbar|breadcrumbs?|footer|sidebar|aside|rail|ads?|advert[a-z\d]*|adbox|adslot|banner|promo[a-z\d]*|"
    r"sponsor[a-z\d]*|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|subscribe|newsletter|signup|login|search|share|sharing|social|"
    r"comments?|disqus|replies|respond|related|recommend[a-z\d]*|pagination|pager|toolbar|widgets?|copyright|masthead|skip)")
# Words that stand beside them in names of boxes; a name with any other word (has, no, content, category, ...) tells nothing.
_BESIDE = (
    r"(?:site|page|main|primary|secondary|global|top|bottom|left|right|side|upper|lower|sticky|fixed|mobile|desktop|inner|outer|area|block|bar|box|"
    r"boxes|container|wrapper|wrap|holder|section|zone|slot|unit|panel|list|lists|item|items|group|row|col|column|links?|buttons?|btn|icons?|form|"
    r"field|input|media|post|posts|article|articles|entry|entries|story|stories|news|blog|recent|latest|popular|more|thread|reply|policy|message|"
    r"text|image|google|header|head|title|to|by|up|bottombar|js|c|l|\d+)")
_NOISE = re.compile(rf"(?<!\S)[-_]*+(?:{_BESIDE}[-_]+)*{_NOISE_WORD}\d*(?:[-_]+(?:{_BESIDE}|{_NOISE_WORD}))*[-_]*+(?!\S)", re.I)
# Boxes with these words are never the article, however long they are; adverts only where nothing else is there.
_NEVER = re.compile(r"(?<![a-z])(?:comments?|disqus|replies|respond|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|subscribe|"
                    r"newsletter)(?![a-z])", re.I)
_ADVERT = re.compile(r"(?<![a-z])(?:ads?|advert[a-z\d]*|adbox|adslot|promo[a-z\d]*|sponsor[a-z\d]*|related|recommend[a-z\d]*)(?![a-z])", re.I)
_SITE_HEADER = re.compile(r"(?<!\S)(?:(?:site|page|main|global|top|sticky|fixed|mobile|desktop)[-_]+)*header(?!\S)", re.I)


class Page:
    """Blocks of the kept text, and the containers around them.

    Containers and marked elements are numbered as they open and know the one around
    them; a container holds the blocks ``first[c]`` to ``last[c]``. Nothing is kept
    per level of a block's depth, so deep markup takes linear time and memory."""

    def __init__(self, source: str | None):
        self.names: list[str] = []  # of containers: tag and classes
        self.keys: list[bytes] = []  # digests of their paths
        self.depths: list[int] = []
        self.tags: list[str] = []
        self.above: list[int] = []  # the container around it, or -1
        self.below: list[list[int]] = []
        self.first: list[int] = []
        self.last: list[int] = []
        self.parsed: list[tuple[list, int, bool]] = []  # block: pieces (text, marked element or -1, linked), container or -1, in an h1
        self.mark_above: list[int] = []  # the marked element around it, or -1
        self.mark_in: list[int] = []  # the container around it, or -1
        self.mark_kind: list[str] = []  # "box": may hold the article, "advert", "never": comments and notices, "": a left-out tag
        self.with_main: set[int] = set()  # marked elements that are or hold a main
        self.with_article: set[int] = set()
        self.with_h1: set[int] = set()
        self._parse(source or "")
        shown = self._shown()
        self.all_kept = all(m < 0 or shown[m] for block, _, _ in self.parsed for _, m, _ in block)
        self.points = [0.0] * len(self.names)
        self.blocks: list[str] = []  # "": nothing kept
        self.unlinked: list[int] = []  # a block's characters outside links
        self.headed: set[int] = set()  # containers that hold an h1
        self.headings: set[int] = set()  # blocks that are one
        for i, (pieces, c, heading) in enumerate(self.parsed):
            pieces = [t for t in pieces if t[1] < 0 or shown[t[1]]]
            text = " ".join("".join(t[0] for t in pieces).split())
            self.blocks.append(text)
            self.unlinked.append(max(len(text) - sum(t[2] for t in pieces), 0))
            if text:
                if c >= 0:
                    self.points[c] += self.unlinked[-1] + 0.1
                if heading:
                    self.headings.add(i)
                    if c >= 0:
                        self.headed.add(c)
        for c in range(len(self.above) - 1, -1, -1):
            if (up := self.above[c]) >= 0:
                self.points[up] += self.points[c]
                if c in self.headed:
                    self.headed.add(up)
        whole = max(self.points, default=0.0)
        self.scores = [math.log(p / whole) + d * math.log(_DEPTH) if p else -math.inf for p, d in zip(self.points, self.depths)]

    def path(self, c: int) -> str:
        names = []
        while c >= 0:
            names.append(self.names[c])
            c = self.above[c]
        return "".join(f">{n}" for n in reversed(names))

    def _shown(self) -> list[bool]:
        """Whether text inside a marked element stays: the element and all around it hold the article."""
        marks = range(len(self.mark_above))
        for holding in (self.with_main, self.with_article, self.with_h1):
            for m in reversed(marks):
                if m in holding and self.mark_above[m] >= 0:
                    holding.add(self.mark_above[m])
        pieces = [(max(len(text.strip()) - linked, 0), m, c) for block, c, _ in self.parsed for text, m, linked in block]
        held = [0] * len(marks)
        free = 0  # text outside all marked elements
        for n, m, _ in pieces:
            if m >= 0:
                held[m] += n
            else:
                free += n
        direct = list(held)
        for m in reversed(marks):
            if self.mark_above[m] >= 0:
                held[self.mark_above[m]] += held[m]
        half = sum(n for n, _, _ in pieces) / 2

        def may_hold(m: int) -> bool:
            if m in self.with_main:
                return held[m] > 0
            kind = self.mark_kind[m]
            if kind == "never" or not held[m]:
                return False
            if kind != "advert" and m in self.with_article:
                return True
            return kind != "" and held[m] > half and (not free or kind == "box" and m in self.with_h1)
        shown = [False] * len(marks)
        open_ = [m for m in marks if self.mark_above[m] < 0 and may_hold(m)]
        inside: dict[int, list[int]] = {}
        for m in marks:
            if self.mark_above[m] >= 0 and may_hold(m):
                inside.setdefault(self.mark_above[m], []).append(m)
        largest: list[tuple[int, int]] | None = None
        while open_:  # outer elements first: what stands inside one that is left out is left out
            if largest is None:
                texts = [0] * len(self.above)
                for n, m, c in pieces:
                    if c >= 0 and (m < 0 or shown[m]):
                        texts[c] += n
                for c in range(len(texts) - 1, -1, -1):
                    if self.above[c] >= 0:
                        texts[self.above[c]] += texts[c]
                largest = sorted(((c, n) for c, n in enumerate(texts) if n and self.tags[c] in ("article", "main")), key=lambda t: -t[1])
            level = [m for m in open_ if m in self.with_main or self._rivals(m, largest, held[m])]
            for m in level:
                shown[m] = True
            if any(direct[m] for m in level):
                largest = None
            open_ = [k for m in level for k in inside.get(m, ())]
        return shown

    def _rivals(self, m: int, largest: list[tuple[int, int]], held: int) -> bool:
        """No article or main has the text instead of a marked element: neither one around it nor one beside it."""
        around = set()
        c = self.mark_in[m]
        while c >= 0 and largest:
            around.add(c)
            c = self.above[c]
        beside = next((n for c, n in largest if c not in around), 0)
        outside = next((n for c, n in largest if c in around), 0)
        return beside < _BESIDE_ARTICLE * held and outside <= held

    def _parse(self, source: str) -> None:
        stack: list[tuple[str, int, int, bool]] = []  # tag, container or -1, mark or -1, inside the article
        opened: Counter = Counter()  # open elements by tag
        here, now = -1, -1  # innermost container and marked element
        pieces: list[list] = []
        at = 0

        def add(text: str, linked: int = 0):
            if pieces and pieces[-1][1] == now:
                pieces[-1][0].append(text)
                pieces[-1][2] += linked
            else:
                pieces.append([[text], now, linked])

        def flush():
            if pieces:
                block = [("".join(t[0]), t[1], t[2]) for t in pieces]
                if any(not t[0].isspace() for t in block):
                    self.parsed.append((block, here, opened["h1"] > 0))
                    if opened["h1"]:
                        self.with_h1.update(t[1] for t in block if t[1] >= 0)
                pieces.clear()

        def pop_to(depth: int):
            nonlocal here, now
            while len(stack) > depth:
                name, container, mark, _ = stack.pop()
                opened[name] -= 1
                if container >= 0:
                    self.last[container] = len(self.parsed)
                    here = self.above[container]
                if mark >= 0:
                    now = self.mark_above[mark]

        def text_until(end: int):
            if end > at:
                text = _html.unescape(source[at:end])
                add(text, len(text.strip()) if opened["a"] else 0)

        while m := _TAG.search(source, at):
            text_until(m.start())
            at = m.end()
            tag = m[2].lower() if m[2] else None
            if tag is None:
                continue
            if m[1]:  # end tag
                if tag in _BLOCKS:
                    flush()
                if opened[tag]:
                    pop_to(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
                continue
            if tag == "br":
                add(" ")
                continue
            if m[3].endswith("/") and (tag in ("svg", "math") or tag == "iframe" and not ((e := _IFRAME.search(source, at)) and e[1])):
                continue
            if tag in _RAW:  # its content is no markup
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            if tag in _BLOCKS:
                flush()
                closes = _CLOSES.get(tag, set()) | {"p"}
                i = len(stack) - 1
                while i >= 0 and any(opened[t] for t in closes):
                    if stack[i][0] in closes:
                        pop_to(i)
                    elif stack[i][0] in _CONTAINERS or stack[i][0] in ("ul", "ol", "dl"):
                        break
                    i -= 1
            if tag in _VOID or m[3].endswith("/") and tag not in _BLOCKS:
                continue
            if tag == "a" and stack and stack[-1][0] == "a":  # links do not stand inside each other
                pop_to(len(stack) - 1)
            inside = bool(stack) and stack[-1][3]
            names = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in _ATTR.finditer(m[3])} if m[3] else {}
            named = " ".join(names[k] for k in ("class", "id", "role") if k in names)
            noise = [t[0] for t in _NOISE.finditer(named)] if named and tag not in ("html", "body") else []
            boxed = tag in ("form", "fieldset", "head") or bool(noise) or bool(
                named and tag not in ("html", "body") and not inside and _SITE_HEADER.search(named))
            container = mark = -1
            if (boxed or tag in _LEFT_OUT or "hidden" in names or names.get("aria-hidden") == "true" or tag == "header" and not inside):
                mark = len(self.mark_above)
                self.mark_above.append(now)
                self.mark_in.append(here)
                self.mark_kind.append("never" if any(_NEVER.search(t) for t in noise) else
                                      "advert" if any(_ADVERT.search(t) for t in noise) else "box" if boxed else "")
                now = mark
            if tag in _CONTAINERS:
                container = len(self.names)
                classes = sorted({re.sub(r"\d+", "", c) for c in names.get("class", "").split()} - {""})
                self.names.append(".".join([tag, *classes]))
                self.keys.append(hashlib.blake2b(self.names[-1].encode("utf-8", "replace"), digest_size=16,
                                                 key=self.keys[here] if here >= 0 else b"").digest())
                self.above.append(here)
                self.below.append([])
                if here >= 0:
                    self.below[here].append(container)
                self.depths.append(self.depths[here] + 1 if here >= 0 else 0)
                self.tags.append(tag)
                self.first.append(len(self.parsed))
                self.last.append(-1)
                here = container
            if now >= 0 and tag in ("article", "main"):
                (self.with_main if tag == "main" else self.with_article).add(now)
            stack.append((tag, container, mark, inside or tag in ("article", "main")))
            opened[tag] += 1
        text_until(len(source))
        flush()
        pop_to(0)

    def best(self) -> int | None:
        c = max(range(len(self.scores)), key=lambda c: (self.scores[c], c), default=None)
        return None if c is None else self._climbed(c)

    def _article(self, c: int) -> int | None:
        while c >= 0 and self.tags[c] not in ("article", "main"):
            c = self.above[c]
        return None if c < 0 else c

    def _climbed(self, c: int) -> int:
        """The article or main around a container; without one, the outermost container that only adds its own texts or the h1's box."""
        article = self._article(c)
        if article is not None:
            return article
        top, inner, up = c, c, self.above[c]
        while up >= 0:
            rest, others = self._around(up, inner)
            if others:
                break
            if rest:
                if self.tags[up] in ("html", "body") and not (up in self.headed or self.tags[top] == "table" or self.all_kept):
                    break
                top = up
            inner, up = up, self.above[up]
        return top

    def _around(self, up: int, inner: int) -> tuple[list[int], bool]:
        """Blocks of ``up`` beside its container ``inner`` that stand in ``up`` itself or in its box with the h1 (no link
        lists); whether it has others."""
        rest, others = [], False
        at = self.first[up]
        for child in [*self.below[up], -1]:
            start, end = (self.first[child], self.last[child]) if child >= 0 else (self.last[up], self.last[up])
            rest += [i for i in range(at, start) if self.blocks[i]]
            at = max(at, end)
            if child in (inner, -1):
                continue
            if child in self.headed:
                rest += [i for i in range(start, end) if self.blocks[i]]
            else:
                others = others or any(self.blocks[i] for i in range(start, end))
        if 2 * sum(self.unlinked[i] for i in rest) < sum(len(self.blocks[i]) for i in rest):
            return [], True
        return rest, others

    def _taken(self, own: set[int]) -> str:
        """Text of the containers; of a single one outside article and main, with the h1 beside it and what stands around that."""
        more: set[int] = set()
        if len(own) == 1 and self._article(inner := next(iter(own))) is None:
            up = self.above[inner]
            while up >= 0:
                rest, _ = self._around(up, inner)
                if not self.headings.isdisjoint(rest):
                    more.update(rest)
                inner, up = up, self.above[up]
        for c in own:
            more.update(range(self.first[c], self.last[c]))
        return "\n".join(self.blocks[i] for i in sorted(more) if self.blocks[i])

    def text(self, paths: list[bytes] | None = None) -> str:
        """Text of the first path (its key) that holds any here, a path inside it before itself, else of the best container
        (no containers: all)."""
        here: dict[bytes, list[int]] = {p: [] for p in paths or []}
        for c, p in enumerate(self.keys):
            if p in here and self.points[c] > 0:
                here[p].append(c)
        found = None
        for path, at in here.items():
            if at and (found is None or self._inside(at[0], found)):
                found = path
        if found is not None:
            at = here[found]
            return self._taken({self._climbed(at[0])} if len(at) == 1 else {c if (a := self._article(c)) is None else a for c in at})
        best = self.best()
        return "\n".join(t for t in self.blocks if t) if best is None else self._taken({best})

    def _inside(self, c: int, key: bytes) -> bool:
        while (c := self.above[c]) >= 0:
            if self.keys[c] == key:
                return True
        return False


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums: dict[tuple[str, bytes], list] = {}
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(source)
            best = page.best()
            for key in {key for key, points in zip(page.keys, page.points) if points > 0}:
                sums.setdefault((host, key), [None, 0, 0])[2] += 1
            if best is not None and page.points[best] > 0:
                cell = sums[host, page.keys[best]]
                cell[0] = cell[0] or page.path(best)
                cell[1] += 1
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
             pa.array([sums[k][0] for k in keys], pa.string()),
             *(pa.array([sums[k][i] for k in keys], pa.int64()) for i in (1, 2))], names=["host", "key", "path", "votes", "pages"])


def host_paths(pages: DataFrame, paths: int = PATHS) -> DataFrame:
    """(host, paths, keys): each host's generalised paths that half of the pages with them vote for, most votes first,
    and their 128-bit digests. Digests of all paths are shuffled, texts only of those voted for."""
    votes = (pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
             .mapInArrow(_votes, "host string, key binary, path string, votes long, pages long")
             .groupBy("host", "key").agg(F.min("path").alias("path"), F.sum("votes").alias("votes"), F.sum("pages").alias("pages"))
             .filter((F.col("votes") > 0) & (2 * F.col("votes") >= F.col("pages"))))
    order = Window.partitionBy("host").orderBy(F.col("votes").desc(), F.length("path").desc(), "path")
    top = votes.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= paths)
    ranked = F.array_sort(F.collect_list(F.struct("rank", "path", "key")))
    return (top.groupBy("host").agg(ranked.alias("top"))
            .select("host", F.col("top").getField("path").alias("paths"), F.col("top").getField("key").alias("keys")))


def extract(pages: DataFrame, paths: int = PATHS) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    winners = written(host_paths(pages, paths), "host-paths").select(F.col("host").alias("vote_host"), "keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(s).text(p) for s, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return (rows.join(winners, host_of(F.col("url")) == F.col("vote_host"), "left").select("page_id", "url", "html", "keys")
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
