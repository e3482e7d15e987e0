"""Main text of pages by inferred wrappers: union-free regular expressions over a host's markup.

A page is a tree of elements and texts. Repeats within a page fold into repeated
items; pages of one host are aligned one after the other, level by level: what both
have is merged, what one lacks becomes optional, neighbours alike become repeated,
periodic neighbours a repeated group, and differing texts a slot. Wrappers of parts of
a host merge like pages, so no task ever sees a whole host. The values of text slots
are counted over a host's pages as rows. Extraction walks each page along its host's
wrapper and keeps the slots of the article whose values differ between pages.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
import zlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.stored import stored, work_folder

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
AWAY = frozenset("nav footer aside form script style noscript template svg iframe button select textarea menu dialog head title object canvas audio video noframes xmp".split())
CLOSES_P = BLOCK - {"option", "summary", "legend", "caption", "html", "body"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table tbody thead tfoot div section article main aside nav body html td th blockquote".split())
# Words in class and id that mark what is not the article, or the article.
AWAY_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus disclaimer footer gdpr masthead "
    "menu modal nav navbar navigation newsletter notice notification pagination pager popup promo promoted promotion reactions recommended related replies reply respond share sharing "
    "sidebar social sponsor sponsored subscribe subscription toolbar tracking widget widgets alert login signup search".split()
)
MAIN_WORDS = frozenset("article content entry post story articlebody maincontent main".split())

DEPTH = 150
MOST_ITEMS = 1500
#: A text that stands on this share of a host's different pages is the host's, not an article's.
CONSTANT_SHARE = 0.5
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop|hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_BLANK = re.compile(r"[\s ]+")


class Node:
    """An element: its key (name, classes and id without digits), children (nodes and texts), and what its names say."""

    __slots__ = ("name", "key", "children", "away", "main")

    def __init__(self, name: str, key: str, away: bool, main: bool):
        self.name, self.key, self.children, self.away, self.main = name, key, [], away, main


_kinds: dict[tuple[str, str], tuple[str, bool, bool]] = {}


def _kind(name: str, attrs: str) -> tuple[str, bool, bool]:
    """(key, away, main) of a start tag."""
    at = (name, attrs)
    if at not in _kinds:
        if len(_kinds) > 20_000:
            _kinds.clear()
        found = {k.lower(): a or b or c or "" for k, a, b, c in _ATTR.findall(attrs)}
        role, label = found.get("role", "").lower(), f"{found.get('class', '')} {found.get('id', '')}"
        words = {w.lower() for w in _WORDS.findall(label)}
        away = name in AWAY or bool(words & AWAY_WORDS) or "hidden" in found or role in ("navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog")
        main = name in ("article", "main") or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody"
        key = name + "".join("." + w for w in sorted(set(re.sub(r"\d+", "", label).split())))
        _kinds[at] = (key, away and not main, main)
    return _kinds[at]


def parse(page: str) -> Node:
    """The page's tree; end tags may lack, a cut-off tag at the end is dropped, nothing else of the text is.

    Every search that finds nothing to the end is remembered, so that broken pages
    take linear time too.
    """
    root = Node("", "", False, False)
    stack, at, n = [root], 0, len(page)
    open_names: dict[str, int] = {}
    gone: set[str] = set()

    def find(what: str, start: int) -> int:
        if what in gone:
            return -1
        i = page.find(what, start)
        if i < 0:
            gone.add(what)
        return i

    def text(value: str) -> None:
        if value:
            children = stack[-1].children
            if children and isinstance(children[-1], str):
                children[-1] += value
            else:
                children.append(value)

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            open_names[stack.pop().name] -= 1

    while at < n:
        lt = find("<", at)
        if lt < 0:
            text(page[at:])
            break
        text(page[at:lt])
        nxt = page[lt + 1:lt + 2]
        if page.startswith("<!--", lt):
            end = find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if nxt in ("!", "?"):
            end = find(">", lt)
            at = n if end < 0 else end + 1
            continue
        closing = nxt == "/"
        m = _NAME.match(page, lt + 1 + closing)
        if not m:
            if closing and page[lt + 2:lt + 3]:
                end = find(">", lt)
                at = n if end < 0 else end + 1
            elif closing or not nxt:
                at = n  # a cut-off tag
            else:
                text("<")
                at = lt + 1
            continue
        name, i = m.group().lower(), m.end()
        while True:  # to the tag's end, over quoted values
            stop = _STOP.search(page, i) if ">" not in gone else None
            if stop is None:
                i = -1
                break
            i = stop.end()
            if stop.group() == ">":
                break
            if page[max(lt, stop.start() - 8):stop.start()].rstrip().endswith("="):
                q = find(stop.group(), i)
                if q >= 0:
                    i = q + 1
        if i < 0:
            gone.add(">")
            at = n
            break
        attrs, at = page[m.end():i - 1], i
        if closing:
            if open_names.get(name):
                k = len(stack) - 1
                while stack[k].name != name:
                    k -= 1
                # An inline end tag does not close blocks around it.
                if name in BLOCK or not any(x.name in SCOPE for x in stack[k + 1:]):
                    close_to(k)
            continue
        if name in CLOSES_P and open_names.get("p"):
            k = len(stack) - 1
            while k > 0 and stack[k].name not in SCOPE and stack[k].name != "p":
                k -= 1
            if stack[k].name == "p":
                close_to(k)
        if name in CLOSED_BY:
            k = len(stack) - 1
            while k > 0 and stack[k].name not in CLOSED_BY[name] and stack[k].name not in ("ul", "ol", "dl", "table", "select", ""):
                k -= 1
            if stack[k].name in CLOSED_BY[name]:
                close_to(k)
        key, away, main = _kind(name, attrs)
        node = Node(name, key, away, main)
        stack[-1].children.append(node)
        if name in VOID or attrs.endswith("/") and name not in BLOCK:
            continue
        if name in RAW:
            end = re.compile(f"</{name}", re.I).search(page, at) if f"</{name}" not in gone else None
            if end is None:
                gone.add(f"</{name}")
                node.children.append(page[at:])
                at = n
            else:
                node.children.append(page[at:end.start()])
                stop = find(">", end.start())
                at = n if stop < 0 else stop + 1
            continue
        if len(stack) < DEPTH:  # what lies deeper belongs to the element at this depth
            stack.append(node)
            open_names[name] = open_names.get(name, 0) + 1
    return root


# A wrapper's item: [key, repeated, pages, characters, of them in links, constant text's hash or 0, items].
KEY, REP, PAGES, CHARS, LINKS, SAME, ITEMS = range(7)
SLOT, GROUP = "#", "()"
# What an element outside the wrapper is known to be.
CONSTANT, LINK_LIST = 1, 2


def _merge(a: list, b: list, page: bool) -> list:
    """One item for both; `page`: both stand in one page, so it repeats and its pages do not add up."""
    items = _align(a[ITEMS], b[ITEMS], page) if a[ITEMS] or b[ITEMS] else []
    return [a[KEY], int(page or a[REP] or b[REP]), max(a[PAGES], b[PAGES]) if page else a[PAGES] + b[PAGES], a[CHARS] + b[CHARS], a[LINKS] + b[LINKS],
            a[SAME] if a[SAME] == b[SAME] else 0, items]


def _align(a: list, b: list, page: bool) -> list:
    """Both lists of items as one: a longest common subsequence is merged, the rest is kept (optional by its page count)."""
    join = _same_page if page else (lambda x, y: _merge(x, y, False))
    first, second = [x[KEY] for x in a], [x[KEY] for x in b]
    if first == second:
        return [join(x, y) for x, y in zip(a, b)]
    out, i, j = [], 0, 0
    for of_a, of_b in _steps(first, second):
        out.append(join(a[i], b[j]) if of_a and of_b else a[i] if of_a else b[j])
        i, j = i + of_a, j + of_b
    return _fold(out + a[i:] + b[j:])


def _steps(a: list[str], b: list[str]) -> Iterator[tuple[bool, bool]]:
    """The way through two lists along a longest common subsequence, until one ends: on in `a`, in `b`, or in both.

    Row i of the table is one number with a bit for each place of `b`, counted from its end: 0 where what
    follows in both lists has more in common with that place than without it. So a row costs a few
    operations whatever its length, and no list is too long. One row in `block` is kept, those between are made again.
    """
    n, m = len(a), len(b)
    places: dict[str, list[int]] = {}
    for p, key in enumerate(reversed(b)):
        places.setdefault(key, []).append(p)
    masks: dict[str, int] = {}

    def mask(key: str) -> int:
        bits = masks.get(key)
        if bits is None:
            flags = bytearray(m // 8 + 1)
            for p in places[key]:
                flags[p >> 3] |= 1 << (p & 7)
            bits = int.from_bytes(flags, "little")
            if m < 5_000 or len(places[key]) > 50:  # a long list can have but few keys that often
                masks[key] = bits
        return bits

    every, block = (1 << m) - 1, isqrt(n) + 1

    def before(row: int, key: str) -> int:
        if key not in places:
            return row
        both = row & mask(key)
        return (row + both | row - both) & every

    row, kept = every, {n: every}
    for i in range(n - 1, -1, -1):
        row = before(row, a[i])
        if i % block == 0:
            kept[i] = row
    i = j = 0
    for start in range(0, n, block):
        end = min(start + block, n)
        rows = [kept[end]]
        for k in range(end - 1, start - 1, -1):
            rows.append(before(rows[-1], a[k]))
        while i < end and j < m:
            if a[i] == b[j]:
                i, j = i + 1, j + 1
                yield True, True
                continue
            here, below, left = rows[end - i], rows[end - i - 1], m - j
            # What is in common after (i + 1, j) and after (i, j + 1): a place has a 0 for each.
            low = (1 << left) - 1
            if left - (below & low).bit_count() >= left - 1 - (here & (low >> 1)).bit_count():
                i += 1
                yield True, False
            else:
                j += 1
                yield False, True


def _same_page(a: list, b: list) -> list:
    """Two occurrences of one place within a page: alike, but the place itself does not repeat for it."""
    out = _merge(a, b, True)
    out[REP] = int(a[REP] or b[REP])
    return out


def _fold(items: list) -> list:
    """Neighbours of one key become a repeated item, periods of two to four a repeated group."""
    out: list = []
    for x in items:
        if out and out[-1][KEY] == x[KEY] and x[KEY] != GROUP:
            out[-1] = _merge(out[-1], x, True)
        else:
            out.append(x)
    for q in (2, 3, 4):
        i = 0
        while i + 2 * q <= len(out):
            keys = [x[KEY] for x in out[i:i + q]]
            k = 1
            while GROUP not in keys and [x[KEY] for x in out[i + k * q:i + (k + 1) * q]] == keys:
                k += 1
            if k > 1:
                parts = out[i:i + q]
                for r in range(1, k):
                    parts = [_same_page(x, y) for x, y in zip(parts, out[i + r * q:i + (r + 1) * q])]
                out[i:i + k * q] = [[GROUP, 1, max(x[PAGES] for x in parts), 0, 0, 0, parts]]
            i += 1
    return out


def page_items(node: Node, linked: bool = False) -> list:
    out = []
    for child in node.children:
        if isinstance(child, str):
            value = _BLANK.sub(" ", child).strip()
            if value:
                out.append([SLOT, 0, 1, len(value), len(value) * linked, zlib.crc32(value.encode("utf-8", "replace")) + 1, []])
        elif child.name not in ("script", "style"):
            out.append([child.key, 0, 1, 0, 0, 0, page_items(child, linked or child.name == "a")])
    return _fold(out)


def _count(items: list) -> int:
    return sum(1 + _count(x[ITEMS]) for x in items)


def pruned(items: list, most: int = MOST_ITEMS) -> list:
    """At most `most` items, those of most pages, the list itself if it has no more; `element_counts` stand in for the others."""
    least = 2
    while _count(items) > most:
        def keep(xs: list, least: int = least) -> list:
            return [[*x[:ITEMS], keep(x[ITEMS])] for x in xs if x[PAGES] >= least]
        items, least = keep(items), least * 2
        if not items:
            break
    return items


def merged(parts: list[list]) -> list:
    return merged_or_cut(parts)[0]


def merged_or_cut(parts: list[list]) -> tuple[list, bool]:
    """The merged items, and whether some were too many to stay."""
    out, cut = parts[0], False
    for p in parts[1:]:
        whole = _align(out, p, False)
        out = pruned(whole)
        cut = cut or out is not whole
    return out, cut


def element_counts(root: Node) -> dict[int, list[int]]:
    """{path: [characters, of them in links, times, the texts' hash or 0]} of a page's block elements, without limit.

    A path is the hash of the keys from the page to the element. The hash is 0 for elements without text
    and for those that hold neighbours of one key, as in a wrapper repeated items have no constant text.
    """
    found: dict[int, list[int]] = {}

    def walk(node: Node, path: int, linked: bool) -> tuple[int, int, int, bool]:
        chars = links = crc = 0
        repeated, before = False, None
        for child in node.children:
            if isinstance(child, str):
                value = _BLANK.sub(" ", child).strip()
                if value:
                    before = None
                    chars, links, crc = chars + len(value), links + len(value) * linked, zlib.crc32(value.encode("utf-8", "replace") + b"\0", crc)
            elif child.name not in ("script", "style"):
                at = slot_hash(str(path), child.key)
                c, l, k, r = walk(child, at, linked or child.name == "a")
                repeated = repeated or r or child.key == before
                before = child.key
                chars, links, crc = chars + c, links + l, zlib.crc32(b"%d" % k, crc)
                if child.name in BLOCK:
                    old = found.get(at, [0, 0, 0, 0])
                    found[at] = [old[0] + c, old[1] + l, old[2] + 1, 0 if r or not c else k + 1]
        return chars, links, crc, repeated

    if not _has_main(root):
        walk(root, 0, False)
    return found


def expression(items: list, pages: int) -> str:
    """The wrapper as a regular expression over tags, for people to read."""
    out = []
    for x in items:
        inner = expression(x[ITEMS], x[PAGES])
        body = "#text" if x[KEY] == SLOT else f"({inner})" if x[KEY] == GROUP else f"<{x[KEY]}>{inner}</>"
        mark = "*" if x[REP] and x[PAGES] < pages else "+" if x[REP] else "?" if x[PAGES] < pages else ""
        out.append(f"({body}){mark}" if mark else body)
    return "".join(out)


def _has_main(node: Node) -> bool:
    stack = [node]
    while stack:
        x = stack.pop()
        if x.main and not x.away:
            return True
        stack += [c for c in x.children if not isinstance(c, str) and not c.away]
    return False


def _boilerplate(item: list | None) -> bool:
    """Whether a wrapper's element holds mostly links and short texts, over all pages of the host."""
    if item is None:
        return False
    chars = links = texts = 0
    stack = [item]
    while stack:
        x = stack.pop()
        chars, links, texts = chars + x[CHARS], links + x[LINKS], texts + (x[KEY] == SLOT) * x[PAGES]
        stack += x[ITEMS]
    return chars > 0 and links > 0.6 * chars


def _constant(item: list | None, pages: int) -> bool:
    """Whether an element stands with the same texts on a large share of the host's `pages` different pages, three at least."""
    if item is None or item[REP] or item[PAGES] < max(3, CONSTANT_SHARE * pages):
        return False
    stack, texts = [item], 0
    while stack:
        x = stack.pop()
        if x[REP] or x[KEY] == SLOT and not x[SAME]:
            return False
        texts += x[KEY] == SLOT
        stack += x[ITEMS]
    return texts > 0


def slot_hash(slot: str, value: str) -> int:
    """A text in the block element with key `slot`, as a number other than 0."""
    return int.from_bytes(hashlib.blake2b(f"{slot}\0{value}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True) or 1


def support(blocks: list[tuple[str, str]]) -> set[tuple[int, int]]:
    """(block, longest other block) of a page's blocks, and (0, the two longest) for the page itself.

    Pages with the same longest block are taken as copies of one article: what only
    they share is the article's, not the host's.
    """
    longest = sorted({(len(v), slot_hash(k, v)) for k, v in blocks})[:-3:-1]
    if not longest:
        return set()
    first, second = longest[0][1], longest[1][1] if len(longest) > 1 else 0
    return {(h, second if h == first else first) for h in (slot_hash(k, v) for k, v in blocks)} | {(0, slot_hash(str(first), str(second)))}


def extract(page: str, wrapper: list | None, pages: int | None = None, constant: frozenset[int] = frozenset(), rest: dict[int, int] | None = None) -> str:
    """The article's blocks, joined by empty lines; `pages` is the number of different pages in the wrapper.

    Blocks whose value in their slot is among the host's `constant` ones go, in an article too,
    unless they are at least half of the page's text: then the pages are copies.
    """
    blocks = page_blocks(parse(page), wrapper, pages, rest)
    ours = [v for k, v in blocks if not constant or slot_hash(k, v) not in constant]
    if 2 * sum(map(len, ours)) <= sum(len(v) for _, v in blocks):
        ours = [v for _, v in blocks]
    return "\n\n".join(ours)


def page_blocks(root: Node, wrapper: list | None, pages: int | None = None, rest: dict[int, int] | None = None) -> list[tuple[str, str]]:
    """(key of the block element, text) of the article's blocks, in page order.

    In a page with an article or main element, texts inside it count; else those
    that neither names nor the wrapper (link lists, blocks constant over a large share
    of the host's pages) mark as something else. Elements marked by name never count. Of elements that were too many
    for the wrapper, `rest` says by their path what they are (see `infer_rest`).
    """
    main_only = _has_main(root)
    pages = pages or max((x[PAGES] for x in wrapper or []), default=0)
    blocks: list[tuple[str, str]] = []
    run: list[str] = []

    def end_block(slot: str) -> None:
        value = _BLANK.sub(" ", entities.unescape("".join(run))).strip()
        run.clear()
        if value:
            blocks.append((slot, value))

    def walk(node: Node, items: list | None, inside: bool, slot: str, path: int) -> None:
        place, inner = 0, 0
        for child in node.children:
            key = SLOT if isinstance(child, str) else child.key
            item = None
            if items:
                for j in range(place, len(items)):
                    x = items[j]
                    if x[KEY] == key:
                        item, place = x, j
                        break
                    if x[KEY] == GROUP:
                        size = len(x[ITEMS])
                        hit = next((q % size for q in range(inner, inner + size) if x[ITEMS][q % size][KEY] == key), None)
                        if hit is not None:
                            item, place, inner = x[ITEMS][hit], j, hit
                            break
            if isinstance(child, str):
                if inside or not main_only:
                    run.append(child)
                continue
            if child.away or child.name == "header" and not inside and main_only or child.name == "header" and not main_only:
                end_block(slot)
                continue
            at = slot_hash(str(path), child.key) if rest else 0
            lists = child.name in ("ul", "ol", "table", "div", "section")
            if not main_only and child.name in BLOCK and (_constant(item, pages) or lists and _boilerplate(item)):
                end_block(slot)
                continue
            if not main_only and child.name in BLOCK and rest and item is None and rest.get(at, 0) & (CONSTANT | lists * LINK_LIST):
                end_block(slot)
                continue
            if child.name == "br":
                run.append(" ")
                continue
            is_block = child.name in BLOCK
            if is_block:
                end_block(slot)
            walk(child, item[ITEMS] if item else None, inside or child.main, child.key if is_block else slot, at)
            if is_block:
                end_block(child.key)

    walk(root, wrapper, False, "", 0)
    end_block("")
    if not blocks and (wrapper or rest) and not main_only:
        return page_blocks(root, None)  # copies of one page: all of it is constant
    return blocks


def host_of(url):
    """Lower-case host of a url column, '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def visible(html):
    """A page's text without tags, blanks made one, in linear time for broken pages too; only to tell copies."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"<[^<>]*+>", " "), r"\s++", " "))


def different(pages: DataFrame) -> DataFrame:
    """(host, html, copies): one page of those of a host with the same text."""
    given = pages.select(host_of(F.col("url").cast("string")).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return given.groupBy("host", F.xxhash64(visible(F.col("html"))).alias("said")).agg(F.min("html").alias("html"), F.count("*").alias("copies"))


def element_rows(pages: DataFrame, kept: str) -> DataFrame:
    """(`kept`, path, chars, links, times, same): `element_counts` of each page, as rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, page in enumerate(batch.column("html").to_pylist()):
                counts = element_counts(parse(page or ""))
                chars, links, times, same = zip(*counts.values()) if counts else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(pa.array([i] * len(counts), pa.int64())) for k in names], *[pa.array(v, pa.int64()) for v in (list(counts), chars, links, times, same)]],
                    names=[*names, "path", "chars", "links", "times", "same"])

    names = kept.split(", ")
    return pages.select(*names, "html").mapInArrow(run, f"{' string, '.join(names)} string, path long, chars long, links long, times long, same long")


def infer_rest(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, page, rest): what elements of the pages of `hosts` (host, texts) are, counted by their path as rows.

    The exact way for what a cut wrapper leaves out, by the wrapper's own rules: a path is a link list if
    most of its characters stand in links, and constant if it stands once, with the same texts, on a share of
    CONSTANT_SHARE of the host's different pages, three at least. `page` is the hash of a page's html; each
    page takes the judged paths that it has itself, so nothing grows with a host but rows.
    """
    counts = element_rows(different(pages).join(hosts.select("host"), "host", "left_semi"), "host").groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.max("times").alias("times"),
        F.min("same").alias("least"), F.max("same").alias("most"))
    many = F.col("n") >= F.greatest(F.lit(3), F.lit(CONSTANT_SHARE) * F.col("texts"))
    constant = (F.col("times") == 1) & many & (F.col("least") == F.col("most")) & (F.col("least") > 0)
    kind = F.when(constant, CONSTANT).otherwise(0) + F.when(F.col("links") > 0.6 * F.col("chars"), LINK_LIST).otherwise(0)
    judged = counts.join(hosts, "host").select("host", "path", kind.alias("kind")).where("kind > 0")
    each = pages.select(host_of(F.col("url").cast("string")).alias("host"), F.col("html").cast("string").alias("html"))
    each = each.join(hosts.select("host"), "host", "left_semi").groupBy("host", F.sha2("html", 256).alias("page")).agg(F.min("html").alias("html"))
    named = element_rows(each, "host, page").select("host", "page", "path").join(judged, ["host", "path"])
    return named.groupBy("host", "page").agg(F.collect_list(F.struct("path", "kind")).alias("rest"))


def infer(pages: DataFrame, fan_in: int = 48) -> DataFrame:
    """(host, wrapper, pages, texts, cut, constant): one wrapper a host, as JSON, of its `texts` pages that differ in text.

    `cut` says that the host had more items than a wrapper keeps; `infer_rest` judges the others.

    `constant` holds the slot values that stand on a share of CONSTANT_SHARE of the host's
    different articles, three at least. They are counted as rows, with no limit on
    blocks, and there are at most twice as many as an article has blocks on average.

    Pages of a host with the same text are one, so that copies of an article do not
    make its blocks look like the host's.
    Each batch of a task aligns its own pages first, so a host with a third of all
    pages sends one wrapper a batch. Wrappers of one host then merge in groups of
    about `fan_in`, in as many rounds as that takes.
    """
    spark = pages.sparkSession
    folder = work_folder(spark)
    schema = "host string, wrapper string, pages long, texts long, part long, cut boolean"
    # The first pass sends wrappers and, in rows without one, slot values with the article they stand in.
    both = pa.schema([("host", pa.string()), ("wrapper", pa.string()), ("pages", pa.int64()), ("texts", pa.int64()), ("part", pa.int64()), ("cut", pa.bool_()), ("block", pa.int64()), ("article", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {}
            count: dict[str, int] = {}
            texts: dict[str, int] = {}
            cut: set[str] = set()
            values: set[tuple[str, int, int]] = set()
            for host, page, copies in zip(*(c.to_pylist() for c in batch.columns)):
                tree = parse(page or "")
                whole = page_items(tree)
                items = pruned(whole)
                values.update((host, *pair) for pair in support(page_blocks(tree, None)))
                found[host], more = merged_or_cut([found[host], items]) if host in found else (items, False)
                if more or items is not whole:
                    cut.add(host)
                count[host] = count.get(host, 0) + copies
                texts[host] = texts.get(host, 0) + 1
            hosts = list(found)
            packed = [json.dumps(found[h], separators=(",", ":")) for h in hosts]
            n, m = len(hosts), len(values)
            yield pa.RecordBatch.from_pydict({
                "host": hosts + [v[0] for v in values], "wrapper": packed + [None] * m, "pages": [count[h] for h in hosts] + [None] * m,
                "texts": [texts[h] for h in hosts] + [None] * m, "part": [zlib.crc32(p.encode()) for p in packed] + [None] * m, "cut": [h in cut for h in hosts] + [None] * m,
                "block": [None] * n + [v[1] for v in values], "article": [None] * n + [v[2] for v in values],
            }, schema=both)

    def combine(rows):
        import pandas as pd

        rows = rows.sort_values(["part", "wrapper"])
        whole, more = merged_or_cut([json.loads(w) for w in rows.wrapper])
        packed = json.dumps(whole, separators=(",", ":"))
        return pd.DataFrame({"host": [rows.host.iloc[0]], "wrapper": [packed], "pages": [int(rows.pages.sum())], "texts": [int(rows.texts.sum())], "part": [zlib.crc32(packed.encode())], "cut": [bool(more or rows.cut.any())]})

    level = 0
    given = different(pages)
    found = stored(given.select("host", "html", "copies").mapInArrow(run, schema + ", block long, article long"), folder, "parts0")
    stands = found.where("block is not null").select("host", "block", "article").distinct().groupBy("host", "block").agg(F.count("*").alias("n"))
    stands = stored(stands.where("n > 2 or block = 0"), folder, "slot-values")
    articles = stands.where("block = 0").select("host", F.col("n").alias("articles"))
    constant = stands.where("block <> 0").join(articles, "host").where(F.col("n") >= F.lit(CONSTANT_SHARE) * F.col("articles"))
    constant = stored(constant.groupBy("host").agg(F.collect_list("block").alias("constant")), folder, "constant")
    parts = found.where("wrapper is not null").select("host", "wrapper", "pages", "texts", "part", "cut")
    while True:
        sizes = parts.groupBy("host").agg(F.count("*").alias("n")).where("n > 1")
        most = sizes.agg(F.max("n").alias("m")).first().m
        if not most:
            return parts.select("host", "wrapper", "pages", "texts", "cut").join(constant, "host", "left")
        level += 1
        groups = F.ceil(F.coalesce("n", F.lit(1)) / fan_in)
        salted = parts.join(sizes, "host", "left").withColumn("salt", F.pmod(F.xxhash64("part", "wrapper", F.lit(level)), groups))
        parts = stored(salted.drop("n").groupBy("host", "salt").applyInPandas(combine, schema), folder, f"parts{level}")


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row: its article's text, '' if there is none.

    Null html is an empty page; pages without a host share one wrapper; rows that
    repeat an id get a row each; other columns are not read.
    """
    found = infer(pages)
    wrappers = found.select("host", "wrapper", "texts", "constant", "cut")
    given = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url").cast("string")).alias("host"))
    joined = given.join(wrappers, "host", "left").withColumn("rest", F.lit(None).cast("array<struct<path:long,kind:int>>"))
    hosts = found.where("cut").select("host", "texts")
    if not hosts.isEmpty():
        rest = stored(infer_rest(pages, hosts), work_folder(pages.sparkSession), "rest")
        page = F.sha2(F.coalesce("html", F.lit("")), 256)
        judged = joined.drop("rest").where("cut").withColumn("page", page).join(rest, ["host", "page"], "left").drop("page")
        joined = joined.where("cut is null or not cut").unionByName(judged)
    joined = joined.select("page_id", "url", "html", "wrapper", "texts", "constant", "rest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parsed = None, None
        for batch in batches:
            texts = []
            for page, wrapper, different, constant, rest in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5, 6))):
                if wrapper != last:
                    last, parsed = wrapper, json.loads(wrapper) if wrapper else None
                texts.append(extract(page or "", parsed, different, frozenset(constant or ()), {r["path"]: r["kind"] for r in rest or ()}))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
