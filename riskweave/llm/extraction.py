"""Main text of web pages by equivalence-class template deduction.

Every page is cut into tokens: tags with the path of elements they stand in, and
runs of text with their path. A token's occurrence vector says how often it
occurs on each page of the host; tokens of one vector form a class. Classes with
the support of a host's pages (`SUPPORT`) are candidates. Those that stand at
most once on a page make the root, in the order of their mean places; on each
page its longest part in this order is matched and cuts the page into gaps. The
other classes nest in the gaps: a class is valid in a gap where its tokens stand
in whole rounds of one order, on as many pages as the support asks for; in
several gaps its tokens have several roles. A root token is valid if it is
matched on as many pages. Pages without tokens (null and empty html) do not count.

Text of a valid token in its own gap is template; all other text fills slots, on
every page. Marks choose among the slots: article or main elements that hold a
slot, if their text is no small part beside the greatest other container, else
the slots outside them; never elements that are boilerplate by tag or role, and
those that are by name only if nothing else is left. A marked element that holds a slot is
kept whole: a heading that every article of a host has is part of each.

Vectors are never gathered: a vector is known by sums of hashes over pages, one
aggregation by (host, token), however many pages a host has. A host's template
is bounded by the tokens of its pages. Pages meet it in a join on the host.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import each_text, fresh, lower_ascii, stored, with_fields

#: Pages of a host from which a template is deduced.
MIN_PAGES = 3
#: Share of a host's pages with tokens on which template stands.
SUPPORT = 0.6
#: Text marked as the article is taken if it is this share of the greatest container beside it.
MARKED_SHARE = 1 / 3
#: The token that stands for the page itself.
PAGE = 0

#: HTML elements by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math canvas object video audio select option".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: What marks an element as no part of an article.
DROPPED_TAGS = frozenset("head nav header footer aside form menu button dialog fieldset".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar dialog alert "
                          "alertdialog".split())
DROPPED_NAMES = frozenset(
    "nav navbar navigation menu menubar header masthead footer sidebar aside ad ads adbox adslot adsense advert adverts "
    "advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login breadcrumb breadcrumbs comment comments commentlist "
    "reply replies respond disqus share sharing social related recommended widget toolbar pagination pager copyright form "
    "search skip".split())
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr tbody thead tfoot pre blockquote figcaption summary".split())
ARTICLE_NAMES = frozenset("article post entry story content".split())

#: Kinds of elements that a worker keeps, and the greatest size of a tag with attributes that is kept.
KINDS, KIND_SIZE = 4096, 512

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
# a whole tag without a further "<": none is read beyond the next one, so that a page is read once
PLAIN_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>"']*+)(?=[\s/>])((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+)>""")
RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}
SPECIAL = re.compile("[>\"']")
# an attribute begins where a word does, and no word is read twice
ATTRIBUTE = re.compile(r"(?<![^\s=/\"'])([^\s=/\"']++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
LONG_NUMBER = re.compile("&#([0-9]{8,});?")


class Kind:
    """What an element's tag and attributes say, wherever it stands."""

    __slots__ = ("tag", "key", "marks", "link", "part", "barred", "named", "clears")

    def __init__(self, tag: str, attributes: str):
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
        name = " ".join(sorted(given.get("class", "").split())) + "#" + given.get("id", "")
        self.tag, self.key = tag, f"<{tag} {name}".encode("utf-8", "replace")
        role = given.get("role", "").lower()
        self.marks = marks = tag in ("article", "main") or role in ("main", "article")
        self.link = tag == "a"
        #: a paragraph, item or part of a line
        self.part = tag in INLINE or tag in PARTS
        #: boilerplate by tag or role
        self.barred = not marks and (tag in DROPPED_TAGS or role in DROPPED_ROLES)
        words = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()))
        if words & ARTICLE_NAMES:
            words -= {"header"}
        by_name = not DROPPED_NAMES.isdisjoint(words)
        #: boilerplate by its own name
        self.named = by_name and not marks and tag not in ("html", "body")
        main = tag == "main" or role == "main"
        #: lifts the names around it: an article that is a comment by its name does not
        self.clears = marks and (main or not by_name or bool(words & ARTICLE_NAMES))


_kept_kind = lru_cache(KINDS)(Kind)


def _kind(tag: str, attributes: str) -> Kind:
    """The kind of an element. Elements that say the same share it; attributes
    that no kind looks at, as links' addresses, tell none apart."""
    if "=" in attributes:
        names = attributes.lower()
        if "class" not in names and "id" not in names and "role" not in names:
            attributes = ""
    else:
        attributes = ""
    return (_kept_kind if len(tag) + len(attributes) <= KIND_SIZE else Kind)(tag, attributes)


class Element:
    """An open element: its path so far and what it says about its text."""

    __slots__ = ("tag", "path", "parent", "article", "link", "box", "barred", "named", "clears", "state", "lifted")

    def __init__(self, kind: Kind, parent: Element | None):
        self.tag, self.parent = kind.tag, parent
        self.path = xxhash.xxh64_digest(parent.path + kind.key if parent else kind.key)
        #: the outermost article or main that it stands in
        self.article: Element | None = parent and parent.article or (self if kind.marks else None)
        self.link = kind.link or parent is not None and parent.link
        #: the container: the innermost element that is no paragraph, item or part of a line
        self.box = parent.box if parent and kind.part else self
        #: in an element that is boilerplate by tag or role
        self.barred = kind.barred or parent is not None and parent.barred
        self.named = kind.named
        self.clears = kind.clears and not self.barred
        self.state: int | None = None
        #: the names of the elements around it have been lifted already
        self.lifted = False

    def names(self) -> int:
        """2 in an element that is boilerplate by name, 1 if such an element
        holds an article or main, else 0. Known when the page has been read."""
        waiting, e = [], self
        while e is not None and e.state is None:
            waiting.append(e)
            e = e.parent
        up = e.state if e else 0
        for e in reversed(waiting):
            up = e.state = 2 if e.named else 1 if e.clears and up == 2 else up
        return up


class Run:
    """A run of text: its block, its place among the page's tokens, and its element."""

    __slots__ = ("block", "at", "token", "text", "size", "element")

    def __init__(self, block: int, at: int, token: int, text: str, size: int, element: Element | None):
        self.block, self.at, self.token, self.text, self.size, self.element = block, at, token, text, size, element


class Template:
    """The root's tokens in order, and the gaps in which tokens are template;
    a root token's own gap is its place in the root."""

    def __init__(self, root: list[int] = (), tokens: list[int] = (), gaps: list[int] = ()):
        self.root = {t: i for i, t in enumerate(root)}
        self.roles: dict[int, list[int]] = defaultdict(list)
        for t, g in zip(tokens, gaps):
            self.roles[t].append(g)

    def matched(self, order: list[int]) -> tuple[list[int], list[int]]:
        """(places on the page, root indexes) of the longest part of the root
        that the page has in the root's order."""
        found = [(at, self.root[t]) for at, t in enumerate(order) if t in self.root]
        if all(a[1] < b[1] for a, b in zip(found, found[1:])):
            return [f[0] for f in found], [f[1] for f in found]
        ends: list[int] = []
        last: list[int] = []
        before: list[int] = []
        for k, (_, i) in enumerate(found):
            n = bisect_left(ends, i)
            before.append(last[n - 1] if n else -1)
            if n == len(ends):
                ends.append(i)
                last.append(k)
            else:
                ends[n], last[n] = i, k
        chain, k = [], last[-1] if last else -1
        while k >= 0:
            chain.append(found[k])
            k = before[k]
        return [f[0] for f in reversed(chain)], [f[1] for f in reversed(chain)]

    def template_places(self, order: list[int]) -> set[int]:
        """Places of the page's tokens that are template where they stand."""
        places, indexes = self.matched(order)
        own = set(places)
        held = set()
        for at, t in enumerate(order):
            for gap in self.roles.get(t, ()):
                if t in self.root:
                    fits = at in own
                else:
                    # the gap ends between the matched root tokens around the place
                    k = bisect_right(places, at)
                    fits = (indexes[k - 1] + 1 if k else 0) <= gap and (k == len(places) or gap <= indexes[k])
                if fits:
                    held.add(at)
                    break
        return held


class Page:
    """Tokens and text runs of one page, read in one pass from left to right."""

    def __init__(self, source: str):
        #: tokens from left to right
        self.order: list[int] = []
        self.runs: list[Run] = []
        self._open: list[Element] = []
        self._count: dict[str, int] = defaultdict(int)  # open elements by tag
        self._block = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        ends, last = None, source.rfind(">")
        start = source.find("<")
        while start >= 0:
            plain = PLAIN_TAG.match(source, start) if start < last else None
            if plain:
                if start > at:
                    self._text(source[at:start])
                at = self._tag(source, plain[1], plain[2], plain[3], plain.end(), last)
                start = source.find("<", at)
                continue
            name = None
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                end = size if end < 0 else end + 3
            elif source.startswith(("<!", "<?"), start):
                end = source.find(">", start) + 1 if start < last else 0
            else:
                close = source.startswith("</", start)
                name = NAME.match(source, start + 1 + close) if start < last else None
                if name and ends is None:
                    ends = _TagEnds(source, start)
                end = ends.after(name.end()) if name else 0
            if not end:  # no markup: a sign in the text
                start = source.find("<", start + 1)
                continue
            if start > at:
                self._text(source[at:start])
            at = self._tag(source, close, name[0], source[name.end():end - 1], end, last) if name else end
            start = source.find("<", at)
        if at < size:
            rest = source[at:]
            cut = re.search(r"<[a-zA-Z/!?][^<]*\Z", rest)  # a tag that the page's end cuts off
            self._text(rest[:cut.start()] if cut else rest)

    def _tag(self, source: str, close: bool | str, name: str, attributes: str, end: int, last: int) -> int:
        """Takes the tag that ends at `end`; returns where reading goes on."""
        tag = name.lower()
        if close:
            self._close(tag)
        elif tag in RAW:
            over = RAW_END[tag].search(source, end) if end < last else None
            end = len(source) if over is None else over.end()
            self._boundary(tag)
        else:
            self._start(tag, attributes)
        return end

    def _boundary(self, tag: str) -> None:
        if tag not in INLINE:
            self._block += 1

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self._block += 1
        if tag in VOID:
            return
        if tag in CLOSES_P and self._count["p"] and any(e.tag == "p" for e in self._open[-8:]):
            self._close("p")
        for like in LIKE.get(tag, ()):
            if self._open and self._open[-1].tag == like:
                self._count[self._open.pop().tag] -= 1
        element = Element(_kind(tag, attributes), self._open[-1] if self._open else None)
        if element.clears:
            for e in reversed(self._open):
                if e.clears or e.lifted:
                    break
                e.lifted = True
                if e.named:
                    e.named, e.state = False, 1
        self._open.append(element)
        self._count[tag] += 1
        self.order.append(_number(element.path))

    def _close(self, tag: str) -> None:
        self._boundary(tag)
        if not self._count[tag]:
            return
        while True:  # an element closes all that is open in it
            e = self._open.pop()
            self._count[e.tag] -= 1
            if e.tag == tag:
                self.order.append(_number(e.path + b"/"))
                return

    def _text(self, raw: str) -> None:
        if not raw:
            return
        inner = self._open[-1] if self._open else None
        text = html.unescape(LONG_NUMBER.sub(_short_number, raw)) if "&" in raw else raw
        plain = " ".join(text.split())
        token = _number((inner.path if inner else b"") + plain.encode("utf-8", "replace"))
        self.runs.append(Run(self._block, len(self.order), token, text, len(plain), inner))
        if plain:
            self.order.append(token)

    def main_text(self, template: Template | set[int] | frozenset[int] = frozenset()) -> str:
        """Text of the slots that the marks choose; template text too if
        nothing else would be left."""
        fixed = template.template_places(self.order) if isinstance(template, Template) and template.roles else set()
        allowed = [r for r in self.runs if not (r.element and r.element.barred)]
        kept = [r for r in allowed if not r.element or r.element.names() < 2]
        marked = [r for r in kept if r.element and r.element.article]
        other = [r for r in kept if not (r.element and r.element.article)]
        slots = [r for r in other if r.at not in fixed or not r.size]
        boxes: Counter = Counter()
        for r in slots:
            if not (r.element and r.element.link):
                boxes[r.element and id(r.element.box)] += r.size
        most = max(boxes.values(), default=0)
        # articles under a name that was lifted, as related stories are, come after the others
        sure = [r for r in marked if r.element.names() == 0]
        for runs in (sure, marked):
            # marked elements without a slot are the same on the host's pages, as a promotion is; unless all are
            filled = {id(r.element.article) for r in runs if r.size and r.at not in fixed}
            in_slots = [r for r in runs if not filled or id(r.element.article) in filled]
            own = sum(r.size for r in runs if not r.element.link)
            beside = max(most, sum(r.size for r in marked if not r.element.link) if runs is sure else 0)
            if any(r.size for r in runs) and own >= MARKED_SHARE * beside:
                return self._joined(in_slots)
        return self._joined(next((c for c in (slots, kept, allowed) if any(r.size for r in c)), []))

    def _joined(self, runs: list[Run]) -> str:
        blocks: dict[int, list[str]] = {}
        for r in runs:
            blocks.setdefault(r.block, []).append(r.text)
        found = (" ".join("".join(b).split()) for b in blocks.values())
        return " ".join(b for b in found if b)


class _TagEnds:
    """Where the tag ends that is open at a place: at the first `>` outside
    quotes. Each quote's end is found once, from the last one backwards."""

    def __init__(self, source: str, start: int = 0):
        self.places = [m.start() for m in SPECIAL.finditer(source, start)]
        nearest: dict[str, int] = {}
        self.ends = [0] * (len(self.places) + 1)  # 0: a quote or the tag stays open
        for k in range(len(self.places) - 1, -1, -1):
            sign = source[self.places[k]]
            if sign == ">":
                self.ends[k] = self.places[k] + 1
            else:
                if sign in nearest:
                    self.ends[k] = self.ends[nearest[sign] + 1]
                nearest[sign] = k

    def after(self, at: int) -> int:
        return self.ends[bisect_left(self.places, at)]


def _short_number(m: re.Match) -> str:
    """A character number without the digits that make it too great anyway."""
    return f"&#{m[1].lstrip('0')[:8] or '0'};"


def _number(key: bytes) -> int:
    h = xxhash.xxh64_intdigest(key)
    return h - (1 << 64) if h >> 63 else h


def host_of(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1))


def _pages(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    return pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("host <> ''")


def _candidates(pages: DataFrame, min_pages: int) -> DataFrame:
    """(host, n_pages, tokens): the tokens with support, each with its class,
    whether it stands at most once on a page, in the order of their mean places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, counts, places = [], [], []
            for t in each_text(batch, "html"):
                order = Page(t).order
                count = Counter(order)
                first = dict(zip(reversed(order), range(len(order) - 1, -1, -1)))
                tokens.append([*count, PAGE] if count else [])
                counts.append([*count.values(), 1] if count else [])
                places.append([first[k] * 1_000_000 // len(order) for k in count] + [0] if count else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32())),
                 pa.array(places, pa.list_(pa.int32()))], names=["host", "tokens", "counts", "places"])

    read = pages.mapInArrow(run, "host string, tokens array<long>, counts array<int>, places array<int>")
    each = read.withColumn("page", F.monotonically_increasing_id())  # tells pages apart within this one aggregation
    each = each.select("host", "page", F.explode(F.arrays_zip("tokens", "counts", "places")).alias("t"))
    vector = F.xxhash64("page", "t.counts")
    by_token = each.groupBy("host", F.col("t.tokens").alias("token")).agg(
        F.count("*").alias("pages"), F.min("t.counts").alias("least"), F.max("t.counts").alias("most"),
        F.sum("t.places").alias("places"),
        F.sum(F.shiftright(vector, 32)).alias("v1"), F.sum(vector.bitwiseAND(F.lit((1 << 32) - 1))).alias("v2"))
    by_token = stored(by_token, "page-tokens")
    sizes = by_token.where(F.col("token") == PAGE).select("host", F.col("pages").alias("n_pages"))
    held = (by_token.where(F.col("token") != PAGE).join(sizes.where(F.col("n_pages") >= min_pages), "host")
            .where((F.col("pages") >= min_pages) & (F.col("pages") >= SUPPORT * F.col("n_pages"))))
    token = F.struct((F.col("places") / F.col("pages")).alias("place"), "token",
                     F.xxhash64("v1", "v2", "least", "most").alias("class"), (F.col("most") == 1).alias("once"))
    return held.groupBy("host", "n_pages").agg(F.sort_array(F.collect_list(token)).alias("tokens"))


class Skeleton:
    """A host's candidates: the root, and the other classes in their order."""

    def __init__(self, tokens: list[dict]):
        self.template = Template([t["token"] for t in tokens if t["once"]])
        self.classes = {t["token"]: t["class"] for t in tokens}
        self.rank = {t["token"]: i for i, t in enumerate(tokens)}

    def roles(self, order: list[int]) -> Iterator[tuple[int, int]]:
        """(token, gap) of each candidate that stands in order on the page."""
        places, indexes = self.template.matched(order)
        root = self.template.root
        yield from ((order[at], i) for at, i in zip(places, indexes))
        held: dict[tuple[int, int], list[int]] = defaultdict(list)
        k = 0
        for at, t in enumerate(order):
            while k < len(places) and places[k] <= at:
                k += 1
            if t in self.classes and t not in root:
                held[self.classes[t], indexes[k - 1] + 1 if k else 0].append(t)
        for (_, gap), found in held.items():
            whole = sorted(set(found), key=self.rank.__getitem__)
            if found == whole * (len(found) // len(whole)):
                yield from ((t, gap) for t in whole)


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, n_pages, n_classes, root, template, tokens, gaps): root are the
    tokens that stand at most once on a page, in order; tokens and gaps the
    valid places of root and classes; template the different tokens of these.

    Pages without tokens do not count. Hosts of fewer than `min_pages` others,
    and pages without a host, have none. Rows that repeat a page count as pages
    of their own.
    """
    own = _pages(pages, url_col, html_col)
    candidates = stored(_candidates(own, min_pages), "page-candidates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = batch.column(0).to_pylist()
            known = batch.column(batch.schema.get_field_index("tokens"))
            skeletons: dict[str, Skeleton] = {}
            found: Counter = Counter()
            for i, (host, source) in enumerate(zip(hosts, each_text(batch, "html"))):
                if host not in skeletons:
                    skeletons[host] = Skeleton(known[i].as_py())
                skeleton = skeletons[host]
                found.update((host, t, g, skeleton.classes[t]) for t, g in skeleton.roles(Page(source).order))
            columns = list(zip(*found)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.int64()), pa.array(list(found.values()), pa.int64())],
                names=["host", "token", "gap", "class", "n"])

    placed = (own.join(candidates.select("host", "tokens"), "host").select("host", "html", "tokens")
              .mapInArrow(run, "host string, token long, gap int, class long, n long")
              .groupBy("host", "token", "gap", "class").agg(F.sum("n").alias("n")))
    valid = (placed.join(candidates.select("host", "n_pages"), "host")
             .where((F.col("n") >= min_pages) & (F.col("n") >= SUPPORT * F.col("n_pages"))))
    roles = valid.groupBy("host").agg(F.count_distinct("class").alias("n_classes"),
                                      F.sort_array(F.collect_list(F.struct("gap", "token"))).alias("roles"))
    root = F.transform(F.filter("tokens", lambda t: t["once"]), lambda t: t["token"])
    return candidates.select("host", "n_pages", root.alias("root")).join(roles, "host").select(
        "host", "n_pages", "n_classes", "root", F.array_distinct("roles.token").alias("template"),
        F.col("roles.token").alias("tokens"), F.col("roles.gap").alias("gaps"))


def main_texts(pages: DataFrame, url_col: str = "url", html_col: str = "html", text_col: str = "text",
               min_pages: int = MIN_PAGES) -> DataFrame:
    """The rows of `pages` without the html column, with `text_col`: the main
    text, empty if there is none.

    Null and empty html have empty texts. Markup that is cut off or not closed
    is read as far as it goes. Repeated rows each have their text; other
    columns stay, one named `text_col` is replaced.
    """
    own, host, template = (fresh(c, pages) for c in ("own_host", "template_host", "template"))
    found = stored(templates(pages, url_col, html_col, min_pages).select(
        F.col("host").alias(host), F.struct("root", "tokens", "gaps").alias(template)), "page-templates")
    rows = pages.withColumn(own, host_of(F.col(url_col))).join(found, F.col(own) == F.col(host), "left").drop(own)
    rest = T.StructType([f for f in pages.schema.fields if f.name not in (html_col, text_col)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(batch.schema.get_field_index(template))
            hosts = batch.column(batch.schema.get_field_index(host)).to_pylist()
            held: dict[str | None, Template] = {None: Template()}
            out = []
            for i, source in enumerate(each_text(batch, html_col)):
                if hosts[i] not in held:
                    held[hosts[i]] = Template(**known[i].as_py())
                out.append(Page(source).main_text(held[hosts[i]]))
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in rest.fields]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.string())], names=[*rest.names, text_col])

    return rows.mapInArrow(run, with_fields(rest, **{text_col: T.StringType()}))
