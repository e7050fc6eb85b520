"""HTML extraction with wrappers inferred for each host as union-free regular expressions."""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.store import documents, small_batches, stored

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split())
RAW = "script|style|noscript|template|iframe|svg|math|object|canvas|select|textarea|title"
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NO_BLOCK = {"br", "hr"}

# Names of parts of a page, by tag, and by word of class, id and role.
SIDE_TAGS = set("nav header footer aside form button dialog menu".split())
SIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert alerts "
    "popup modal overlay newsletter subscribe subscription signup paywall sidebar side aside widget widgets related recommended recommendations "
    "more share sharing social comment comments disqus reply replies respond discussion feedback nav navbar navigation navi menu menus breadcrumb breadcrumbs "
    "pagination pager footer header masthead topbar toolbar login search copyright complementary contentinfo".split()
)
# Those that name something else even inside an article; the others may name a part of its text there.
INNER_TAGS = set("nav footer aside form button dialog menu".split())
INNER_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr popup modal overlay newsletter "
    "subscribe subscription signup paywall sidebar widget widgets related recommended recommendations share sharing social comment comments disqus "
    "replies respond feedback navbar navigation menu menus breadcrumb breadcrumbs pagination pager login".split()
)
# Words that say nothing of their own beside those: "comments-area" is named as comments, "has-sidebar" as a layout.
PLAIN_WORDS = set("area list box section block inner item items form title titles thread posts group 0".split())
MAIN_TAGS = {"article", "main"}
PAGE_TAGS = {"html", "body"}
LEAF_TAGS = set("h1 h2 h3 h4 h5 h6 p li dt dd figcaption caption".split())  # named as a part of the article, but never the whole of it
MAIN_WORDS = set("article main post entry story content body text articlebody maincontent".split())
KNOWN_WORDS = SIDE_WORDS | INNER_WORDS | PLAIN_WORDS | MAIN_WORDS


TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    rf"|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+|\d+")
SPACE = re.compile(r"\s+")


def _name(tag: str, rest: str) -> str:
    """A tag with those words of its class, id and role that name something; all others count as one, ``-``.

    So names made up for a page or a build differ in nothing, and tags are aligned by what they are. The page's own tags have no words: their classes name the kind of page. An article tag has
    those that begin a value, and a long id that begins like an article only its first: what
    comes after is the title.
    """
    if "=" not in rest or tag in PAGE_TAGS:
        return tag
    words: set[str] = set()
    for kind, a, b, c in ATTRIBUTE.findall(rest):
        for value in (a or b or c).lower().split():
            found = WORD.findall(value)
            if tag in MAIN_TAGS or (kind.lower() == "id" and len(found) > 2 and found[0] in MAIN_WORDS):
                found = [w for w in found[:1] if w in SIDE_WORDS or w in MAIN_WORDS]
            words.update(w if w in KNOWN_WORDS else "0" if w.isdigit() else "-" for w in found)
    return ".".join([tag, *sorted(words)])


@dataclass
class Part:
    """A part of a page or a wrapper: a tag with what it holds, or a run of text (``TEXT``).

    In a wrapper, ``n`` occurrences were aligned to one part, in ``held`` occurrences of the part around it and on
    ``pages`` pages. It is optional if the part around it occurs more often, and repeated if it occurs more often than it is
    held. ``page`` and ``text`` are the least and largest hash of the pages and texts: a text that is always the same is
    fixed, any other a slot. ``square`` is the number of parts, from this on, that are repeated together.
    """

    key: str
    n: int = 1
    held: int = 1
    pages: int = 1
    page: tuple[int, int] = (0, 0)
    text: tuple[int, int] = (0, 0)
    square: int = 0
    parts: list[Part] = field(default_factory=list)
    texts: list[tuple[int, str]] = field(default_factory=list)  # of a page only: place and text

    def packed(self) -> list:
        return [self.key, self.n, self.held, self.pages, *self.page, *self.text, self.square, [p.packed() for p in self.parts]]

    @classmethod
    def unpacked(cls, x: list) -> Part:
        return cls(x[0], x[1], x[2], x[3], (x[4], x[5]), (x[6], x[7]), x[8], [cls.unpacked(p) for p in x[9]])


TEXT = "#"


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def page_tree(page: str) -> Part:
    """A page as parts; text is the run between two block tags, without the markup inside."""
    whole = _hash(page)

    def new(key: str, text: str | None = None, at: int = 0) -> Part:
        h = 0 if text is None else _hash(text)
        return Part(key, page=(whole, whole), text=(h, h), texts=[] if text is None else [(at, text)])

    root = new("")
    stack: list[tuple[str, Part]] = [("", root)]
    run: list[str] = []
    count = 0

    def ended() -> None:
        nonlocal count
        text = SPACE.sub(" ", html.unescape("".join(run))).strip() if run else ""
        run.clear()
        if text:
            stack[-1][1].parts.append(new(TEXT, text, count))
            count += 1

    for token in TOKEN.finditer(page):
        text, tag = token["text"], token["tag"]
        if text is not None:
            run.append(text)
        elif tag is not None and (tag := tag.lower()) not in INLINE:
            if token["end"]:
                at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), None)
                if at is not None:
                    ended()
                    del stack[at:]
                continue
            ended()
            if tag in VOID:
                continue
            while len(stack) > 1 and (stack[-1][0] == "p" or stack[-1][0] in CLOSES.get(tag, ())):
                stack.pop()
            if not token["rest"].rstrip().endswith("/"):
                name = _name(tag, token["rest"])
                if stack[-1][1].key == name and len(stack) > 1 and not stack[-1][1].parts:
                    stack.append((tag, stack[-1][1]))  # nested tags of one name are one part
                else:
                    stack[-1][1].parts.append(new(name))
                    stack.append((tag, stack[-1][1].parts[-1]))
    ended()
    _fold(root)
    return root


def _merged(a: Part, b: Part, same_page: bool = False, same_holder: bool = False) -> Part:
    """Two parts of one name as one: their own parts are aligned."""
    return Part(
        a.key,
        a.n + b.n,
        max(a.held, b.held) if same_holder else a.held + b.held,
        max(a.pages, b.pages) if same_page else a.pages + b.pages,
        (min(a.page[0], b.page[0]), max(a.page[1], b.page[1])),
        (min(a.text[0], b.text[0]), max(a.text[1], b.text[1])),
        max(a.square, b.square),
        _aligned(a.parts, b.parts, same_page),
        a.texts + b.texts,
    )


def _fold(part: Part) -> None:
    """Make one group of what is repeated side by side: one part, or up to three that come again in the same order."""
    for p in part.parts:
        _fold(p)
    for width in (1, 2, 3):
        found: list[Part] = []
        for p in part.parts:
            found.append(p)
            if len(found) >= 2 * width and [x.key for x in found[-width:]] == [x.key for x in found[-2 * width : -width]]:
                again = found[-width:]
                del found[-width:]
                for k, x in enumerate(again):
                    found[k - width] = _merged(found[k - width], x, same_page=True, same_holder=True)
                if width > 1:
                    found[-width].square = width
        part.parts = found


def _runs(x: list[str], y: list[str]) -> list[tuple[int, int, int]]:
    """The longest common run, and so on before and after it: place in both and length. Of equal ones the first of ``x`` and then of ``y`` is taken.

    All runs of one length are found in one pass, from the longest on; the parts between them have shorter ones only. Whether there is a run of a
    length is told by numbers for equal stretches of 1, 2, 4, ... names, so a pass takes as long as the sequences and the passes are few.
    """
    names: dict[str, int] = {}
    grams = [([names.setdefault(name, len(names)) for name in x], [names.setdefault(name, len(names)) for name in y])]

    def stretches(size: int) -> tuple[list, list]:
        level = size.bit_length() - 1
        while len(grams) <= level:
            half, seen = 1 << len(grams) - 1, {}
            grams.append(tuple([seen.setdefault(pair, len(seen)) for pair in zip(side, side[half:])] for side in grams[-1]))
        whole = 1 << level
        return grams[level] if whole == size else tuple(list(zip(side, side[size - whole :])) for side in grams[level])

    found, left = [], [(0, len(x), 0, len(y), min(len(x), len(y)))]
    while left:
        i, i_end, j, j_end, most = left.pop()

        def common(size: int) -> bool:
            a, b = stretches(size)
            return not set(a[i : i_end - size + 1]).isdisjoint(b[j : j_end - size + 1])  # noqa: B023

        most = min(most, i_end - i, j_end - j)
        if most < 1 or not common(1):
            continue
        size, over = 1, 2  # there is a run of ``size``, and none of ``over`` once that was looked for
        while over <= most and common(over):
            size, over = over, 2 * over
        over = min(over, most + 1)
        while over - size > 1:
            middle = (size + over) // 2
            size, over = (middle, over) if common(middle) else (size, middle)
        a, b = stretches(size)
        places: dict = {}
        for k in range(j, j_end - size + 1):
            places.setdefault(b[k], []).append(k)
        k = i
        while k <= i_end - size:
            own = places.get(a[k], ())
            at = bisect_left(own, j)
            if at < len(own):
                found.append((k, own[at], size))
                left.append((i, k, j, own[at], size - 1))
                k = i = k + size
                j = own[at] + size
            else:
                k += 1
        left.append((i, i_end, j, j_end, size - 1))
    return sorted(found)


def _matches(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of equal names, in order on both sides: what both begin and end with, and between by longest common runs, however many parts there are."""
    n = min(len(a), len(b))
    head = next((k for k in range(n) if a[k] != b[k]), n)
    tail = next((k for k in range(n - head) if a[-1 - k] != b[-1 - k]), n - head)
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    between = [(i + k, j + k) for i, j, size in _runs(x, y) for k in range(size)] if x and y else []
    last = [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]
    return [(k, k) for k in range(head)] + [(head + i, head + j) for i, j in between] + last


def _aligned(a: list[Part], b: list[Part], same_page: bool = False) -> list[Part]:
    """Two sequences as one: parts of one name are aligned in order, what has no match on the other side is optional."""
    out: list[Part] = []
    i = j = 0
    for x, y in [*_matches([p.key for p in a], [p.key for p in b]), (len(a), len(b))]:
        out += a[i:x] + b[j:y]
        if x < len(a):
            out.append(_merged(a[x], b[y], same_page))
        i, j = x + 1, y + 1
    return out


def _bare(part: Part) -> Part:
    """A page's parts without its texts."""
    return Part(part.key, part.n, part.held, part.pages, part.page, part.text, part.square, [_bare(p) for p in part.parts])


def expression(part: Part) -> str:
    """A wrapper as a union-free regular expression: ``#`` is a text slot, ``=`` a fixed text, ``(...)+`` a repeated group, ``(...)?`` an optional one."""
    out: list[str] = []
    k = 0
    while k < len(part.parts):
        width = part.parts[k].square or 1
        group = part.parts[k : k + width]
        said = " ".join(("=" if p.text[0] == p.text[1] else TEXT) if p.key == TEXT else f"<{p.key}> {expression(p)} </>".replace("  ", " ") for p in group)
        mark = ("+" if any(p.n > p.held for p in group) else "") + ("?" if min(p.held for p in group) < part.n else "")
        out.append(f"({said}){mark}" if mark else said)
        k += width
    return " ".join(out)


def _words(name: str) -> tuple[str, set[str]]:
    tag, *words = name.split(".")
    return tag, set(words)


def _side(name: str) -> bool:
    tag, words = _words(name)
    return tag in SIDE_TAGS or bool(words & SIDE_WORDS)


def _inner_side(name: str) -> bool:
    tag, words = _words(name)
    return tag in INNER_TAGS or bool(words & INNER_WORDS)


def _main(name: str) -> bool:
    tag, words = _words(name)
    return tag in MAIN_TAGS or (tag not in SIDE_TAGS and bool(words & MAIN_WORDS) and not words & SIDE_WORDS)


SIDE, FIXED, NAMED_IN_SIDE, OTHER, NAMED_IN_LAYOUT, NAMED = range(6)
NO_WORD, LAYOUT_WORD, SIDE_WORD = range(3)


def _worded(name: str) -> int:
    _, words = _words(name)
    return NO_WORD if not words & SIDE_WORDS else LAYOUT_WORD if words - SIDE_WORDS - PLAIN_WORDS else SIDE_WORD


class Wrapper:
    """What the texts of a host's pages are, part by part of the host's wrapper.

    ``NAMED``: in an outermost part that is named as an article, and in none inside it that is named as something else.
    ``NAMED_IN_LAYOUT``: the same, but a part around it has a word of something else among others of its own (``has-sidebar``);
    such names are about the layout, so these articles count where a page has no others. ``NAMED_IN_SIDE``: a part around has no other
    word, so they count where a page has nothing else. ``FIXED``: a text that is the same on all pages that have
    it, at least two different ones and more than half of all; ``OTHER``: any other slot. ``SIDE``: named as something else.
    """

    def __init__(self, root: Part) -> None:
        self.root = root
        self.kinds: dict[int, tuple[int, int]] = {}
        self._judge(root, OTHER, NO_WORD, self.kinds)

    def _judge(self, part: Part, kind: int, worded: int, kinds: dict[int, tuple[int, int]]) -> None:
        """``kinds``: of each part below, what it is, and what words the parts around it have."""
        kinds[id(part)] = (kind, worded)
        for p in part.parts:
            if p.key == TEXT:
                same = p.text[0] == p.text[1] and p.page[0] != p.page[1] and 2 * p.pages > self.root.pages and p.n == p.pages
                kinds[id(p)] = (kind if kind != OTHER else SIDE if worded else FIXED if same else OTHER, worded)
            elif kind != OTHER:
                self._judge(p, SIDE if kind == SIDE or _inner_side(p.key) else kind, worded, kinds)
            elif _words(p.key)[0] in SIDE_TAGS:
                self._judge(p, SIDE, worded, kinds)
            elif _main(p.key):
                self._judge(p, (NAMED, NAMED_IN_LAYOUT, NAMED_IN_SIDE)[worded], worded, kinds)
            else:
                self._judge(p, OTHER, max(worded, _worded(p.key)), kinds)

    def read(self, page: Part) -> str:
        """The article of a page: its parts are aligned with the wrapper's, and the slots of the article are read."""
        found: list[tuple[int, int, str, bool]] = []

        def walk(own: Part, wrapper: Part, kinds: dict[int, tuple[int, int]], leaf: bool) -> None:
            if own is wrapper:
                pairs = [(k, k) for k in range(len(own.parts))]
            else:
                pairs = _matches([p.key for p in own.parts], [p.key for p in wrapper.parts])
            matched = {x: wrapper.parts[y] for x, y in pairs}
            for x, p in enumerate(own.parts):
                w, said = matched.get(x), kinds
                if w is None:  # aligned elsewhere while the wrapper grew: it is what its names say here
                    w, said = p, {}
                    self._judge(Part("", parts=[p]), *kinds[id(wrapper)], said)
                if p.key == TEXT:
                    found.extend((at, said[id(w)][0], text, leaf) for at, text in p.texts)
                else:
                    walk(p, w, said, leaf or (_words(p.key)[0] in LEAF_TAGS and kinds[id(wrapper)][0] == OTHER and _main(p.key)))

        walk(page, self.root, self.kinds, False)
        kinds = {kind for _, kind, _, leaf in found if not leaf}
        wanted = max(kinds & {FIXED, NAMED_IN_SIDE, OTHER, NAMED_IN_LAYOUT, NAMED}, default=SIDE)
        own = {wanted} - {SIDE} | {kind for _, kind, _, leaf in found if leaf and kind >= NAMED_IN_LAYOUT and wanted != NAMED}
        return "\n\n".join(text for _, kind, text, _ in sorted(found) if kind in own)


def _wrapper_rows(held: dict[str, Part]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), pa.array([p.pages for p in held.values()], pa.int64()), pa.array([json.dumps(p.packed()) for p in held.values()], pa.string())],
        names=["host", "pages", "wrapper"],
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host of rows that are in the order of hosts."""
    held: dict[str, Part] = {}
    for batch in batches:
        for host, packed in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
            part = Part.unpacked(json.loads(packed))
            if host in held:
                held[host] = _merged(held[host], part)
            else:
                if held:
                    yield _wrapper_rows(held)
                held = {host: part}
    if held:
        yield _wrapper_rows(held)


WRAPPER = "host string, pages long, wrapper string"
PART_PAGES = 5000  # of a hot host in one part, at most


def wrappers(pages: DataFrame, hosts_at_once: int = 4096) -> DataFrame:
    """``(host, pages, wrapper)``: the wrapper of every host, inferred from all of its pages ``(host, html)``.

    Pages are aligned one by one where they are read, and the wrappers of a host that different tasks have inferred are
    aligned in turn, in two rounds, so that a host may have a third of all pages: no page is moved for it.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Part] = {}
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                part = _bare(page_tree(page or ""))
                if host in held:
                    held[host] = _merged(held[host], part)
                else:
                    if len(held) >= hosts_at_once:
                        yield _wrapper_rows(held)
                        held = {}
                    held[host] = part
        if held:
            yield _wrapper_rows(held)

    found = pages.select("host", "html").mapInArrow(rows, WRAPPER)
    for keys in (["host", F.pmod(F.xxhash64("wrapper"), F.lit(16))], ["host"]):
        found = found.repartition(*keys).sortWithinPartitions("host").mapInArrow(_joined, WRAPPER)
    return found


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The article text of every page, by the wrapper of its host.

    Blocks are the runs of text between block tags or line breaks, in page order and joined by two line feeds; character
    references are decoded, white space is made one space. Inside an article nothing goes but what is named as a menu,
    advert, form, comment and the like. A page without a named article is read whole, but for what is named
    otherwise and what the alignment of the host's pages has found to be fixed; if nothing else is there, that is read.

    A null or empty page has an empty text; pages without a host (no or odd address) share a wrapper. Repeated rows come
    back as often, and copies of one page fix nothing. Returns ``(id_col, url_col, text, n_chars)``.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    named = small_batches(pages).select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    found = stored(wrappers(named.where("html is not null")), "wrappers")

    # Pages of a host that has more than 1/256 of all, so of at most 256 hosts, are dealt out over more tasks, the more the more there are.
    total = found.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]
    parts = {r["host"]: max(-(-r["pages"] * 256 // total), -(-r["pages"] // PART_PAGES)) for r in found.where(F.col("pages") * 256 > total).select("host", "pages").collect()}
    n_parts = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])[F.col("host")] if parts else F.lit(None).cast("int")
    n_parts = F.coalesce(n_parts, F.lit(1))
    none = lambda c: F.lit(None).cast(named.schema[c].dataType).alias(c)
    part = F.explode(F.sequence(F.lit(0), n_parts - 1)).alias("part")
    both = found.select("host", part, F.lit(False).alias("page"), none("id"), none("url"), F.col("wrapper").alias("html"))
    own = F.pmod(F.xxhash64("html", "id"), n_parts).cast("int").alias("part")
    both = both.unionByName(named.select("host", own, F.lit(True).alias("page"), "id", "url", "html"))
    both = both.repartition("host", "part").sortWithinPartitions("host", "part", "page")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrapper = Wrapper(Part(""))
        for batch in batches:
            at, texts = [], []
            for i, (is_page, page) in enumerate(zip(batch.column("page").to_pylist(), batch.column("html").to_pylist())):
                if is_page:
                    at.append(i)
                    texts.append(wrapper.read(page_tree(page)) if page else "")
                else:
                    wrapper = Wrapper(Part.unpacked(json.loads(page)))
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("url").take(at), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )

    kind, url_kind = (named.schema[c].dataType.simpleString() for c in ("id", "url"))
    out = both.mapInArrow(rows, f"id {kind}, url {url_kind}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})


def op4_html_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(documents(spark, sf_dir, "pages"))
