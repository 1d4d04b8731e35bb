"""HTML extraction: site templates are removed by counting element subtrees per host.

Every block element's subtree is hashed, bottom up, over tag names and text. The hashes are counted per host, in Spark, over
pages with different main texts, and a subtree that recurs on many pages of its host is template and is deleted with all it
holds. Paragraphs, headings, list items and the like inside an article or the main element are text and never template,
however often they recur; outside, they are counted like other elements. Counting decides first, over the whole page. What
it can't tell, as on hosts with few pages, is left to names: elements whose tag, role, class or id says that they are menus,
headers, footers, sidebars, notices, adverts, forms or comments are deleted on any host. A class or id says so only as a
whole: all words of one of its names are such words or neutral ones, so "ad-box" does and "no-sidebar" doesn't. On a page
without another article or main element, what is named so stays if an article or main element stands in it, or else if more
than half of the page's text does and it isn't named as comments. Of what then is left, the text is that of the articles, or
else of the main element and the articles, if these hold at least half of it; otherwise it is all.

Character references are decoded, white space inside a block becomes one space, blocks are joined by an empty line. A page
is read in time in proportion to its length, whatever is nested or left open in it.

Nulls and ties: null html is an empty page with an empty text. A null url, or one without a host, is of the host "". Rows
that repeat get a result each and count once. Columns besides page_id, url and html are ignored. Broken markup is read as
browsers do: unclosed elements end with what they stand in, stray ends are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import html as entities
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, importable, join_small, lean, stored
from tidemark.llm.url_filter import host

#: A subtree is template if it recurs on so many pages of its host with different texts, and on this share of them or on
#: so many on a host of any size.
LEAST_PAGES, LEAST_SHARE, MANY_PAGES = 3, 0.05, 1000

# Elements and words of HTML.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "blockquote", "pre", "figcaption", "caption", "tr", "summary", "address"}
_CONTAINERS = {"html", "body", "article", "main", "section", "div", "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "figure", "details", "fieldset", "header", "footer", "nav", "aside", "form", "menu", "center", "hgroup", "search"}
_BLOCKS = _TEXT_BLOCKS | _CONTAINERS | {"hr"}
_SPACED = {"br", "td", "th"}
_DROPPED = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "template", "noscript", "button", "select", "option", "label", "input", "svg", "math", "canvas", "object", "audio", "video", "search"}
_DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar", "note"}
_DROPPED_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "sidebar", "aside", "widget",
    "header", "masthead", "topbar", "footer", "copyright", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay",
    "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations",
    "comment", "comments", "commentlist", "disqus", "respond", "replies", "reply", "form", "search",
}
_COMMENT_NAMES = {"comment", "comments", "commentlist", "disqus", "respond", "replies", "reply"}
_NEUTRAL = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "center", "col", "column", "container", "content", "fixed", "global", "group", "icon", "icons",
    "inner", "item", "items", "left", "link", "links", "list", "main", "mobile", "outer", "page", "panel", "post", "primary", "right", "row", "secondary", "section",
    "site", "slot", "small", "sticky", "title", "top", "unit", "wrap", "wrapper",
}
_KEPT = {"html", "body", "main", "h1"}
#: A start tag of one of these ends an open element of the set.
_ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}

_RAW = {"script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
_NAME = re.compile(r"[a-z][^\s/>]*", re.I)
_TO_END = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


def _dropped(tag: str, attrs: str, inside: bool) -> str:
    """Why an element is no main text: "sure" by its tag, role or style, "named" by its class or id, "comments" if these
    name it so, or "" if it may be; ``inside``: of an article, where a header holds the title."""
    if tag in _DROPPED or tag == "header" and not inside:
        return "sure"
    if not attrs or tag in _KEPT:
        return ""
    if _HIDDEN.search(attrs):
        return "sure"
    why = ""
    for name, *values in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name == "role" and _DROPPED_ROLES & {*value.lower().split()}:
            return "sure"
        if name not in ("class", "id"):
            continue
        for token in value.split():
            words = {*re.findall(r"[^\W\d_]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())}
            said = words & _DROPPED_NAMES - ({"header"} if inside or tag == "article" else set())
            if said and words <= _DROPPED_NAMES | _NEUTRAL:
                why = "comments" if said & _COMMENT_NAMES else why or "named"
    return why


def _digest(parts) -> int:
    return int.from_bytes(hashlib.blake2b("\x00".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


class _Tags:
    """The tags of a page, in one pass: (begin, end, kind, name, attributes); kind is "start", "end" or "" for what is no
    element. Nothing is searched for twice: a search that found nothing is remembered, and where a quote is left open the
    ends of all tags are worked out at once, from the last quote to the first."""

    def __init__(self, html: str):
        self.html = html
        self.gt = self.dash = -1
        self.closes: dict[str, int] = {}
        self.ends: tuple[list[int], list[int]] | None = None

    def _next(self, at: int) -> int:
        """The first > from ``at`` on, or the end."""
        if self.gt < at:
            found = self.html.find(">", at)
            self.gt = found if found >= 0 else len(self.html)
        return self.gt

    def _attributes_end(self, at: int) -> int:
        """The > that ends a tag, quotes respected; without one, the first."""
        first = self._next(at)
        if self.ends is None:
            if self.html.find('"', at, first) < 0 and self.html.find("'", at, first) < 0:
                return first
            m = _TO_END.match(self.html, at)
            if m:
                return m.end() - 1
            self.ends = self._all_ends()
        places, ends = self.ends
        i = bisect.bisect_left(places, at)
        return ends[i] if i < len(ends) and ends[i] >= 0 else first

    def _all_ends(self) -> tuple[list[int], list[int]]:
        """For each quote and >: where a tag ends that meets it outside of quotes, or -1."""
        places = [m.start() for m in re.finditer("[\"'>]", self.html)]
        ends = [-1] * (len(places) + 1)
        later = {'"': len(places), "'": len(places)}
        for i in range(len(places) - 1, -1, -1):
            c = self.html[places[i]]
            if c == ">":
                ends[i] = places[i]
            else:
                ends[i] = ends[later[c] + 1] if later[c] < len(places) else -1
                later[c] = i
        return places, ends

    def _close(self, name: str, at: int) -> int:
        """Where the end tag of a raw element begins, or the end."""
        if self.closes.get(name, -1) < at:
            m = re.compile(f"</{name}\\b", re.I).search(self.html, at)
            self.closes[name] = m.start() if m else len(self.html)
        return self.closes[name]

    def __iter__(self):
        html, size = self.html, len(self.html)
        at = html.find("<")
        while 0 <= at < size:
            end = -1
            c = html[at + 1 : at + 2]
            if html.startswith("<!--", at):
                if self.dash < at + 4:
                    found = html.find("-->", at + 4)
                    self.dash = found if found >= 0 else size
                end = min(self.dash + 3, size)
                yield at, end, "", "", ""
            elif c and c in "!?/" or c.isalpha() and c.isascii():
                gt = self._next(at)
                if gt == size:
                    return
                m = _NAME.match(html, at + 1 + (c == "/"), gt)
                if m is None:
                    end = gt + 1 if c != "/" else -1
                    if end > 0:
                        yield at, end, "", "", ""
                elif c == "/":
                    end = gt + 1
                    yield at, end, "end", m[0].lower(), ""
                else:
                    name = m[0].lower()
                    close = self._attributes_end(m.end())
                    end = close + 1
                    if name in _RAW:
                        begin = self._close(name, end)
                        end = min(self._next(begin) + 1, size) if begin < size else size
                        yield at, end, "", "", ""
                    else:
                        yield at, end, "start", name, html[m.end() : close]
            at = html.find("<", end if end > 0 else at + 1)


class _Open:
    """The open elements, and of each tag where it is open, so that no search walks through them."""

    def __init__(self):
        self.stack: list[tuple] = []
        self.places: dict[str, list[int]] = {}

    def push(self, tag: str, *rest) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, *rest))

    def pop(self) -> tuple:
        top = self.stack.pop()
        self.places[top[0]].pop()
        return top

    def last(self, tags) -> int:
        """The innermost place of any of the tags, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)


class Page:
    """One page, parsed: blocks of text with the element that holds them, and elements with their parents and hashes."""

    def __init__(self, html: str):
        spared: set[int] = set()
        for _ in range(3):  # again only if what is named as no text turns out to hold the page's text
            self._read(html, spared)
            more = self._wrongly_named()
            if not more:
                return
            spared |= more

    def _read(self, html: str, spared: set[int]) -> None:
        self.texts: list[str] = []
        self.owners: list[int] = []
        self.regions: list[int] = []  # 2 in an article, 1 in the main element, otherwise 0
        self.dropped: list[bool] = []  # whether names say that a block is no text
        self._spared = spared
        self._named: list[list] = []  # for each element deleted for its name: why, characters in it, whether of an article
        self._within: list[tuple[int, int, int]] = []  # those that are open, with the counts before them
        self._all = self._sure = self._articles = self._of_articles = 0
        self._outside = False  # whether an article or a main element isn't deleted
        self.parents: list[int] = []
        self.hashes: list[int] = []  # 0 where an element can't be template
        self._parts: list[list[str]] = []
        self._open = _Open()  # tag, element or -1, why dropped, text before it
        self._holders: list[int] = []
        self._drops = self._inline = 0
        self._buffer: list[str] = []
        self._places = {"article": 0, "main": 0}
        at = 0
        for begin, end, kind, name, attrs in _Tags(html):
            if begin > at:
                self._text(html[at:begin])
            at = end
            if kind == "end":
                self._end(name)
            elif kind == "start":
                self._start(name, attrs)
        if at < len(html):
            self._text(html[at:])
        self._pop(0)
        self._flush()

    def _text(self, text: str) -> None:
        self._buffer.append(entities.unescape(text) if "&" in text else text)

    def _wrongly_named(self) -> set[int]:
        """Of the elements deleted for their names, those that hold the page's only articles, or else most of its text."""
        if self._outside:
            return set()
        left = [(i, *x) for i, x in enumerate(self._named) if i not in self._spared]
        return {i for i, _, _, articles in left if articles} or {i for i, why, n, _ in left if why == "named" and 2 * n > self._all}

    def _flush(self) -> None:
        text = " ".join("".join(self._buffer).split())
        self._buffer.clear()
        if not text:
            return
        owner = self._holders[-1] if self._holders else -1
        if owner >= 0:
            self._parts[owner].append(text)
        if not self._sure:
            self._all += len(text)
            self._of_articles += len(text) * (self._articles > 0)
        self.texts.append(text)
        self.owners.append(owner)
        self.dropped.append(self._drops > 0)
        self.regions.append(2 if self._places["article"] else 1 if self._places["main"] else 0)

    def _start(self, tag: str, attrs: str) -> None:
        if tag in _SPACED:
            self._buffer.append(" ")
        if tag in _BLOCKS:
            self._flush()
            if tag in _TEXT_BLOCKS or tag in _CONTAINERS:
                self._close({"p"}, ("article", "main", "body", "td", "th", "button"))
            if tag in _ENDED_BY:
                self._close(_ENDED_BY[tag], ("ul", "ol", "dl", "table", "select", "body"))
        if tag in _VOID:
            return
        dropped = _dropped(tag, attrs, self._places["article"] > 0)
        if dropped and dropped != "sure":
            nth = len(self._named)
            self._named.append([dropped, 0, False])
            if nth in self._spared:
                dropped = ""
        if tag not in _BLOCKS and not dropped:
            return
        element, before = -1, None
        if tag in _BLOCKS or dropped:
            element = len(self.parents)
            self.parents.append(self._holders[-1] if self._holders else -1)
            self.hashes.append(0)
            self._parts.append([tag])
        if tag not in _BLOCKS:
            self._inline += 1  # what stands before a dropped inline element stays in its block
            before, self._buffer = self._buffer, []
        if element >= 0:
            self._holders.append(element)
        self._open.push(tag, element, dropped, before, tag in _CONTAINERS or not (self._places["article"] or self._places["main"]))
        if tag in self._places:
            self._articles += 1
        if dropped:
            self._drops += 1
            if dropped == "sure":
                self._sure += 1
            else:
                self._within.append((nth, self._all, self._of_articles))
        elif tag in self._places:
            self._places[tag] += 1
            self._outside |= not self._drops

    def _end(self, tag: str) -> None:
        if tag in _SPACED:
            self._buffer.append(" ")
        if tag in _BLOCKS:
            self._flush()
        elif not self._inline:
            return
        at = self._open.last((tag,))
        if at >= 0 and (tag in _CONTAINERS or at >= self._open.last(("article", "main", "body", "table"))):
            self._pop(at)

    def _close(self, tags, scope) -> None:
        at = self._open.last(tags)
        if at >= 0 and at > self._open.last(scope):
            self._pop(at)

    def _pop(self, to: int) -> None:
        while len(self._open.stack) > to:
            self._flush()
            tag, element, dropped, before, may_be_template = self._open.pop()
            if tag in self._places:
                self._articles -= 1
            if dropped:
                self._drops -= 1
                if dropped == "sure":
                    self._sure -= 1
                else:
                    nth, all_before, of_articles = self._within.pop()
                    self._named[nth][1:] = [self._all - all_before, self._of_articles > of_articles]
            elif tag in self._places:
                self._places[tag] -= 1
            if before is not None:
                self._inline -= 1
                self._buffer = before
            if element >= 0:
                self._holders.pop()
                digest = _digest(self._parts[element])
                self.hashes[element] = (digest or 1) if may_be_template else 0
                if self.parents[element] >= 0:
                    self._parts[self.parents[element]].append(str(digest))
                self._parts[element] = []

    def main_blocks(self) -> list[int]:
        """The blocks of the main text as names alone tell it."""
        return chosen(self.texts, self.regions, [not d for d in self.dropped])[0]


def chosen(texts: list[str], regions: list[int], kept: list[bool]) -> tuple[list[int], int]:
    """Of the blocks that are kept, those of the main text, and how many others there were."""
    left = [i for i, k in enumerate(kept) if k]
    found = main_blocks([texts[i] for i in left], [regions[i] for i in left])
    return [left[i] for i in found], len(left) - len(found)


def main_blocks(texts: list[str], regions: list[int]) -> list[int]:
    """The blocks of the articles, or of these and the main element, where they hold at least half of the text; or else all."""
    for least in (2, 1):
        found = [i for i, r in enumerate(regions) if r >= least]
        if found and 2 * sum(len(texts[i]) for i in found) >= sum(map(len, texts)):
            return found
    return list(range(len(texts)))


_PARSED = "page_id long, row_hash long, url string, texts array<string>, owners array<int>, regions array<int>, dropped array<boolean>, parents array<int>, hashes array<bigint>, page_text long"
_COLUMNS = [c.split()[0] for c in _PARSED.split(", ")]


def parse(pages: DataFrame) -> DataFrame:
    """A row for each page: its blocks of text, the elements with their subtree hashes, and a hash of the main text."""
    importable(pages.sparkSession)

    def run(batches):
        import pyarrow as pa

        many = lambda kind: pa.list_(kind)
        types = (many(pa.string()), many(pa.int32()), many(pa.int32()), many(pa.bool_()), many(pa.int32()), many(pa.int64()), pa.int64())
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                for html in part.column(3).to_pylist():
                    page = Page(html or "")
                    rows.append((page.texts, page.owners, page.regions, page.dropped, page.parents, page.hashes, _digest(page.texts[i] for i in page.main_blocks())))
                made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *made], _COLUMNS)

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.xxhash64(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))).alias("row_hash"), "url", "html")
    return rows.mapInArrow(lean(run), _PARSED)


def templates(parsed: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """Rows (site, subtree) of the subtrees that recur on many pages of their host; a page's main text counts once."""
    rows = parsed.select(F.xxhash64(host(F.col("url"))).alias("site"), "page_text", F.array_remove(F.array_distinct("hashes"), 0).alias("hashes"))
    n_pages = rows.select("site", "page_text").distinct().groupBy("site").agg(F.count("*").alias("n_pages"))
    counts = rows.select("site", "page_text", F.explode("hashes").alias("subtree")).distinct().groupBy("site", "subtree").agg(F.count("*").alias("n"))
    found = counts.filter(F.col("n") >= least_pages).join(n_pages, "site")
    return found.filter(F.col("n") >= F.least(F.col("n_pages") * least_share, F.lit(float(MANY_PAGES)))).select("site", "subtree")


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """One row for each row of ``pages``: page_id, url, text, and how many blocks each step removed: n_blocks in all,
    n_template by counting, n_named by names, n_outside the articles."""
    spark = pages.sparkSession
    bounded_batches(spark)
    parsed = stored(parse(pages), "parsed-pages")
    recurring = stored(templates(parsed, least_pages, least_share), "templates")
    held = parsed.select("page_id", "row_hash", F.xxhash64(host(F.col("url"))).alias("site"), F.explode("hashes").alias("subtree"))
    gone = join_small(held, recurring, ["site", "subtree"], "inner").groupBy("page_id", "row_hash").agg(F.collect_set("subtree").alias("gone"))
    gone = stored(gone.select(F.col("page_id").alias("_id"), F.col("row_hash").alias("_row"), "gone"), "template-subtrees")
    rows = join_small(parsed, gone, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("row_hash") == F.col("_row")), "left")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for texts, owners, regions, dropped, parents, hashes, gone in zip(*(batch.column(i).to_pylist() for i in range(2, 9)), strict=True):
                kept = [True] * len(texts)
                if gone:
                    gone, deleted = set(gone), []
                    for parent, subtree in zip(parents, hashes, strict=True):  # parents come before what they hold
                        deleted.append(subtree in gone or parent >= 0 and deleted[parent])
                    kept = [o < 0 or not deleted[o] for o in owners]
                n_template = len(kept) - sum(kept)
                kept = [k and not d for k, d in zip(kept, dropped, strict=True)]
                found, n_outside = chosen(texts, regions, kept)
                out.append(("\n\n".join(texts[i] for i in found), len(texts), n_template, len(kept) - sum(kept) - n_template, n_outside))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["page_id", "url", "text", "n_blocks", "n_template", "n_named", "n_outside"])

    schema = "page_id long, url string, text string, n_blocks long, n_template long, n_named long, n_outside long"
    return rows.select("page_id", "url", "texts", "owners", "regions", "dropped", "parents", "hashes", "gone").mapInArrow(lean(run), schema)
