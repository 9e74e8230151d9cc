"""Main text of web pages by union-free wrapper inference (operator 5)."""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import pin

from . import blocks as B

BROADCAST_HOSTS = 100_000  # plans of hosts that may be broadcast, if they have BROADCAST_CHARS in sum at most
BROADCAST_CHARS = 64_000_000
LABELS = 32  # names that elements of one tag may have below one parent; more are one name
HEADS = 4  # first elements of a repeated group that are also compared one by one
WITNESSES = 3  # different pages of a host that must share a constant element before it counts
DEPTH = 150  # text of elements nested deeper is read as part of the element at this depth

# fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noscript noembed noframes xmp template svg select object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr nobr br input".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section table ul".split())
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": set(), "tbody": {"thead", "tbody", "tr", "td", "th"},
}
SCOPES = frozenset("ul ol dl table div section article main body td th".split())

# what is not the article, by element, role and words of class and id
OTHER_TAGS = frozenset("head nav footer aside form button dialog menu search".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notification alert popup modal overlay newsletter subscribe signup login share sharing social sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead topbar toolbar comment comments disqus respond replies related recommended widget search "
    "pagination pager skip copyright".split())
#: whole class names or ids that name adverts and reader comments even inside the article
PLAIN_OTHER = frozenset("ad ads advert adverts advertisement advertising adsense sponsored comment comments disqus respond replies".split())
LAYOUT_WORDS = frozenset("has with no without content wrap wrapper container layout main".split())
MAIN_TAGS = frozenset(("article", "main"))
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote td th dt dd figcaption tr table ul ol dl".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


#: kinds of elements: article text, named like another part inside or outside an article, another part
TEXT, NAMED_INSIDE, NAMED_OUTSIDE, OTHER = range(4)


class Node:
    """A block element; ``items`` holds nodes and texts [words, of which in links]."""

    __slots__ = ("tag", "label", "kind", "items")

    def __init__(self, tag: str, label: str, kind: int) -> None:
        self.tag, self.label, self.kind, self.items = tag, label, kind, []

    @property
    def other(self) -> bool:
        return self.kind in (NAMED_OUTSIDE, OTHER)


def _names_other(words: set[str], inside_main: bool) -> bool:
    if "header" in words and not inside_main:
        return True
    return bool(words & OTHER_WORDS) and not words & LAYOUT_WORDS


def _describe(tag: str, attributes: str, inside_main: bool) -> tuple[str, int]:
    """Label of an element, and its kind by element, role, style and names."""
    kind = OTHER if tag in OTHER_TAGS or (tag == "header" and not inside_main) else TEXT
    if not attributes.strip(" /"):
        return tag, kind
    found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    role = found.get("role", "").lower()
    names = f"{found.get('class', '')} {found.get('id', '')}"
    style = found.get("style", "").replace(" ", "").lower()
    if (
        role in OTHER_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
        or "display:none" in style or "visibility:hidden" in style
    ):
        kind = OTHER
    if kind == TEXT and tag not in ("html", "body"):
        if set(names.lower().split()) & PLAIN_OTHER:
            kind = OTHER
        elif _names_other({w.lower() for w in _WORD.findall(names)}, inside_main):
            kind = NAMED_INSIDE if inside_main else NAMED_OUTSIDE
    main = role == "main" or "articlebody" in found.get("itemprop", "").lower()
    name = re.sub(r"\d+", "#", (found.get("id") or found.get("class", "")).split(" ")[0])[:40]
    return ("main" if main else tag) + (f".{name}" if name else ""), kind


def read_page(page: str) -> Node:
    """Block tree of a page: inline elements are part of their text, missing end tags are implied."""
    root = Node("", "", TEXT)
    stack: list[Node] = [root]
    open_tags: Counter[str] = Counter()  # so that end tags of nothing open need no look down the stack
    text: list[str] = []
    links = in_link = in_main = 0

    def flush() -> None:
        nonlocal links
        if text:
            words = html.unescape("".join(text)).split()
            if words:
                stack[-1].items.append((" ".join(words), links))
            text.clear()
        links = 0

    def close(n: int) -> None:
        nonlocal in_main
        flush()
        while len(stack) > n:
            tag = stack.pop().tag
            open_tags[tag] -= 1
            in_main -= tag in MAIN_TAGS

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or len(piece) == 1:
                text.append(piece)
                if in_link:
                    links += len(piece)
            continue
        tag = tag.lower()
        if tag in RAW:
            if not m[1] and not m[3].endswith("/"):
                end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
                at = size if end is None else page.find(">", end.start()) + 1 or size
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if m[1] else 1
            elif tag == "br":
                text.append(" ")
            continue
        if m[1]:
            if tag == "p" and stack[-1].tag != "p":
                flush()
            for i in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
            else:
                flush()
            in_link = 0
            continue
        flush()
        if tag in CLOSES_P and stack[-1].tag == "p":
            close(len(stack) - 1)
        if tag in CLOSED_BY and any(open_tags[t] for t in CLOSED_BY[tag]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSED_BY[tag]:
                    close(i)
                    break
                if stack[i].tag in SCOPES:
                    break
        if tag in ("html", "body") and open_tags[tag]:
            continue
        label, kind = _describe(tag, m[3], in_main > 0)
        node = Node(tag, label, max(kind, OTHER if stack[-1].kind == OTHER else TEXT))
        if tag in VOID:
            continue
        if len(stack) >= DEPTH and node.kind in (TEXT, stack[-1].kind):
            node.kind = stack[-1].kind
            node.items = stack[-1].items  # open until its own end tag, but no level of the tree
        else:
            stack[-1].items.append(node)
        stack.append(node)
        open_tags[tag] += 1
        in_main += tag in MAIN_TAGS
    flush()
    return root


# -- wrappers ---------------------------------------------------------------------------------
#
# A wrapper is a union-free regular expression over the tokens of a host's pages.  Streams are aligned
# by the names of elements below one parent: what some parents lack is optional, what one parent has
# more than once is a repeated group, and differing text is a slot.  An element or text is
#
#     [label, chars, link chars, items, optional, repeated, parents, order, heads, count, pages]
#
# items in the mean order of their places; for a text, label "#", the digest of its constant text or
# None for a slot.  parents counts the parents that have it, order sums the places of its first
# occurrence, heads has [parents, digest or None, chars] of the first to fourth occurrence, count the
# occurrences, and pages the digests of a few different pages (of the whole only).  All of these are
# sums, minima and comparisons, so the wrapper of a host depends neither on the order of its pages
# nor on how they are dealt into batches.

LABEL, CHARS, LINKS, BODY, OPTIONAL, REPEATED, PARENTS, ORDER, HEAD, COUNT, PAGES = range(11)


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode(), digest_size=8).hexdigest()


def _mark(node: Node) -> str:
    return node.label + ("!" if node.other else "?" if node.kind == NAMED_INSIDE else "")


def _one(node: Node) -> tuple[list, str]:
    """The wrapper of one element, and the digest of its text without other parts."""
    items: dict[str, list] = {}
    chars, links, digests = 0, 0, []
    for place, part in enumerate(node.items):
        if isinstance(part, Node):
            own, digest = _one(part)
            counts = not part.other
        else:
            digest, counts = _digest(part[0]), True
            own = ["#", len(part[0]), part[1], digest, False, False, 1, 0, [], 1, []]
        if counts:
            chars, links = chars + own[CHARS], links + own[LINKS]
            digests.append(digest)
        own[ORDER], own[HEAD] = place, [[1, digest, own[CHARS]]]
        label = own[LABEL]
        items[label] = _follow(items[label], own) if label in items else own
    body = _settle(list(items.values()), 1)
    return [_mark(node), chars, links, body, False, False, 1, 0, [], 1, []], _digest(",".join(digests))


def wrapper_of(node: Node) -> list:
    """A page as the wrapper that matches it."""
    whole, digest = _one(node)
    whole[PAGES] = [digest]
    return whole


def _same(a: list, b: list, count: int):
    if a[LABEL] == "#":
        return a[BODY] if a[BODY] == b[BODY] else None  # differing text becomes a slot
    return _align(a[BODY], b[BODY], count)


def _follow(a: list, b: list) -> list:
    """Two occurrences below one parent: a repeated group."""
    count = a[COUNT] + b[COUNT]
    heads = a[HEAD] + b[HEAD] if len(a[HEAD]) < HEADS else a[HEAD]
    return [a[LABEL], a[CHARS] + b[CHARS], a[LINKS] + b[LINKS], _same(a, b, count), False, True, 1, a[ORDER], heads, count, []]


def merge(a: list, b: list) -> list:
    """The wrapper that matches what either of two wrappers of one label matches."""
    count = a[COUNT] + b[COUNT]
    heads = [
        x and y and [x[0] + y[0], x[1] if x[1] == y[1] else None, x[2] + y[2]] or x or y for x, y in zip_longest(a[HEAD], b[HEAD])]
    return [
        a[LABEL], a[CHARS] + b[CHARS], a[LINKS] + b[LINKS], _same(a, b, count), False, a[REPEATED] or b[REPEATED],
        a[PARENTS] + b[PARENTS], a[ORDER] + b[ORDER], heads, count, sorted({*a[PAGES], *b[PAGES]})[:WITNESSES],
    ]


def _align(a: list[list], b: list[list], count: int) -> list[list]:
    """Items of two wrappers side by side, those of one label merged."""
    known = {x[LABEL]: x for x in a}
    for x in b:
        known[x[LABEL]] = merge(known[x[LABEL]], x) if x[LABEL] in known else x
    return _settle(list(known.values()), count)


def _family(label: str) -> str:
    """The name that labels of a tag share when there are too many of them: "div.post" is of "div.*"."""
    mark = label[-1] if label[-1:] in ("!", "?") else ""
    return label.split(".")[0] + ".*" + mark if "." in label else ""


def _gather(items: list[list], families: set[str]) -> list[list]:
    """Items with the labels of the given families under their common name."""
    out: dict[str, list] = {}
    for x in items:
        label = _family(x[LABEL])
        if label in families:
            x = [label, *x[1:]]
        out[x[LABEL]] = merge(out[x[LABEL]], x) if x[LABEL] in out else x
    return list(out.values())


def _settle(items: list[list], count: int) -> list[list]:
    """Items in order, optional where a parent lacks them; names that vary without end are one name."""
    names = Counter(_family(x[LABEL]) for x in items)
    present = {x[LABEL] for x in items}
    many = {f for f, n in names.items() if f and (n > LABELS or f in present)}
    if many:
        items = _gather(items, many)
    items = [[*x[:OPTIONAL], x[PARENTS] < count, *x[REPEATED:]] for x in items]
    return sorted(items, key=lambda x: (x[ORDER] / x[PARENTS], x[LABEL]))


def _rare(items: list[list], count: int) -> list[list]:
    """Items with labels that no second parent has under the common name of their tag."""
    single = {_family(x[LABEL]) for x in items if x[PARENTS] < 2 and _family(x[LABEL])} if count > 1 else set()
    if single:
        kept = [x for x in items if _family(x[LABEL]) not in single or x[PARENTS] > 1]
        gone = [x for x in items if _family(x[LABEL]) in single and x[PARENTS] < 2]
        items = [[*x[:OPTIONAL], x[PARENTS] < count, *x[REPEATED:]] for x in _gather(kept + _gather(gone, single), set())]
        items.sort(key=lambda x: (x[ORDER] / x[PARENTS], x[LABEL]))
    return [[*x[:BODY], x[BODY] if x[LABEL] == "#" else _rare(x[BODY], x[COUNT]), *x[OPTIONAL:]] for x in items]


def _is_other(item: list) -> bool:
    return item[LABEL].endswith("!")


def _walk(items: list[list], path: tuple[str, ...]) -> Iterator[tuple[tuple[str, ...], list]]:
    for x in items:
        if x[LABEL] != "#" and not _is_other(x):
            yield (*path, x[LABEL]), x
            yield from _walk(x[BODY], (*path, x[LABEL]))


def _constant(item: list) -> bool:
    """Do all pages have this part with the same text, or with links only?"""
    if _is_other(item) or item[CHARS] <= item[LINKS]:
        return True
    return not item[OPTIONAL] and not item[REPEATED] and item[HEAD][0][1] is not None


def _only_other_outside(items: list[list], inner: list) -> bool:
    """Is all that lies beside ``inner`` marked as not article, links or constant text?"""
    return all(x is inner or _constant(x) for x in items)


def _no_text_outside(items: list[list], inner: list) -> bool:
    return all(x is inner or _is_other(x) or x[CHARS] <= x[LINKS] for x in items)


def plan_of(wrapper: list) -> list:
    """What tells the article of a host's pages: paths of the main regions, the labels known beside a
    step of a path that stands for labels without end, and the constant elements inside."""
    settled = [*wrapper[:BODY], _rare(wrapper[BODY], wrapper[COUNT]), *wrapper[OPTIONAL:]]
    paths = _main_paths(settled)
    known: dict[str, list[str]] = {}
    drops: dict[str, list[str]] = {}
    for path in paths:
        region = settled
        for depth, step in enumerate(path):
            if step.endswith(".*"):
                known[">".join(path[: depth + 1])] = sorted(
                    x[LABEL] for x in region[BODY] if _family(x[LABEL]) == step != x[LABEL])
            region = next(x for x in region[BODY] if x[LABEL] == step)
        if len(wrapper[PAGES]) > 1:
            found, chars = _constants(region, ">".join(path), len(wrapper[PAGES]))
            if 2 * chars < region[CHARS]:  # pages that are mostly alike are copies, not boilerplate
                drops.update(found)
    return [paths, known, drops]


def _constants(item: list, key: str, witnesses: int) -> tuple[dict[str, list[str]], int]:
    """Digests of elements below ``item`` that are the same on every page, by path and occurrence, and
    the characters that they take.

    These are elements with a class or id, and lists of links, that no parent lacks; an element that
    is named like another part may be optional.  Plain paragraphs and headings never count.
    """
    out: dict[str, list[str]] = {}
    chars = 0
    for x in item[BODY]:
        label = x[LABEL]
        if label == "#" or _is_other(x):
            continue
        list_of_links = label.split(".")[0] in ("ul", "ol") and x[LINKS] * 2 >= x[CHARS]
        named = label.endswith("?")
        enough = 2 if list_of_links or named else WITNESSES
        for k, (parents, digest, size) in enumerate(x[HEAD]):
            everywhere = parents == item[COUNT] or (named and parents > 1)
            if digest and everywhere and witnesses >= enough and (named or list_of_links or "." in label):
                out[f"{key}>{label}#{k}"] = digest
                chars += size
        more, below = _constants(x, f"{key}>{label}", witnesses)
        out.update(more)
        chars += below
    return out, chars


def _main_paths(wrapper: list) -> list[list[str]]:
    """Paths of the host's main regions: the article and main elements that are not inside another,
    else the innermost container that leaves nothing outside but other parts, links and constant text.
    Text is constant evidence only if the text inside differs from page to page."""
    mains: list[tuple[str, ...]] = []
    for path, x in _walk(wrapper[BODY], ()):
        if path[-1].split(".")[0] in MAIN_TAGS and x[CHARS] and not any(path[: len(m)] == m for m in mains):
            mains.append(path)
    if mains:
        return [list(m) for m in mains]
    path, node = (), wrapper
    while True:
        inner = [(p, x) for p, x in _walk(node[BODY], path) if len(p) == len(path) + 1 and x[LABEL].split(".")[0] not in LEAVES]
        best = max(inner, key=lambda m: m[1][CHARS] - m[1][LINKS], default=None)
        if best is None or best[1][CHARS] <= best[1][LINKS] or best[1][OPTIONAL]:
            return [list(path)]
        varies = not best[1][REPEATED] and not _constant(best[1])
        if not (_only_other_outside if varies else _no_text_outside)(node[BODY], best[1]):
            return [list(path)]
        path, node = best


# -- extraction -------------------------------------------------------------------------------


def _measure(node: Node) -> tuple[int, int]:
    """Characters of a part, and of these in links."""
    chars = links = 0
    for item in node.items:
        size, linked = (0, 0) if isinstance(item, Node) and item.other else _measure(item) if isinstance(item, Node) else (len(item[0]), item[1])
        chars, links = chars + size, links + linked
    return chars, links


def _texts(node: Node, key: str, drops: dict[str, str], deep: bool, out: list[str]) -> None:
    """Texts of a region in page order.

    Parts that are another by element, role or style go.  One that is only named like another goes if
    it is mostly links or if the host's wrapper holds it constant; outside an article element, unless
    ``deep`` inside a region that the wrapper found, its name is enough.
    """
    places: Counter[str] = Counter()
    for item in node.items:
        if not isinstance(item, Node):
            out.append(item[0])
            continue
        label = _mark(item).replace("!", "?") if item.kind == NAMED_OUTSIDE and deep else _mark(item)
        k = places[label]
        places[label] += 1
        if item.kind == OTHER or (item.kind == NAMED_OUTSIDE and not deep):
            continue
        digest = next((drops[d] for d in (f"{key}>{label}#{k}", f"{key}>{_family(label)}#{k}") if d in drops), None) if drops else None
        if digest is not None and digest == _one(item)[1]:
            continue
        if item.kind in (NAMED_INSIDE, NAMED_OUTSIDE):
            chars, links = _measure(item)
            if 2 * links >= chars:
                continue
        _texts(item, f"{key}>{label}", drops, deep, out)


def _regions(node: Node, paths: list[list[str]], known: dict[str, list[str]], key: str = "") -> list[tuple[Node, str]]:
    """The regions that any of the paths names, in page order, each with its path."""
    if not all(paths):
        return [(node, key)]
    out: list[tuple[Node, str]] = []
    for x in node.items:
        if isinstance(x, Node) and not x.other:
            label, family = _mark(x), _family(_mark(x))
            steps = {p[0] for p in paths}
            step = label if label in steps else family if family in steps else None
            if step is None:
                continue
            below = f"{key}>{step}" if key else step
            if step == family and label in known.get(below, ()):
                continue  # a label of its own beside those without end
            out += _regions(x, [p[1:] for p in paths if p[0] == step], known, below)
    return out


def extract(page: str, plan: list) -> str:
    """The main text of a page by the plan of its host (empty: by the page's own wrapper)."""
    root = read_page(page)
    paths, known, drops = plan or ([], {}, {})
    regions = _regions(root, paths, known) if paths else []
    if not regions:  # the page lacks the region of its host: its own wrapper decides
        regions, drops = _regions(root, _main_paths(wrapper_of(root)), {}), {}
    out: list[str] = []
    for region, key in regions:
        deep = region.tag not in ("", "html", "body")
        _texts(region, key, drops, deep, out)
    return " ".join(out)


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[str, list] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = wrapper_of(read_page(page or ""))
            known[host] = merge(known[host], own) if host in known else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(known), pa.string()), pa.array([json.dumps(w) for w in known.values()], pa.string())], ["host", "wrapper"])


def _join_wrappers(plan: bool):
    def step(table: pa.Table) -> pa.Table:
        whole = None
        for blob in table.column("wrapper").to_pylist():
            own = json.loads(blob)
            whole = own if whole is None else merge(whole, own)
        columns = {"host": table.column("host").slice(0, 1)}
        if not plan:
            columns["salt"] = table.column("salt").slice(0, 1)
        columns["wrapper"] = pa.array([json.dumps(plan_of(whole) if plan else whole)], pa.string())
        return pa.table(columns)

    return step


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        page_id, url, pages, plans = batch.columns
        texts = [extract(p or "", json.loads(w or "[]")) for p, w in zip(pages.to_pylist(), plans.to_pylist())]
        yield pa.RecordBatch.from_arrays([page_id, url, pa.array(texts, pa.string())], ["page_id", "url", "text"])


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) for (host, html) rows; the wrapper is the plan of the host's main regions."""
    partial = pages.mapInArrow(_infer, "host string, wrapper string")
    salts = B.parts(pages.sparkSession)  # a host of very many batches is merged by all tasks, then once
    salted = partial.withColumn("salt", (F.pmod(F.xxhash64("wrapper"), F.lit(salts))).cast("int"))
    halves = salted.groupBy("host", "salt").applyInArrow(_join_wrappers(False), "host string, salt int, wrapper string")
    return halves.groupBy("host").applyInArrow(_join_wrappers(True), "host string, wrapper string")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the article of every page.

    The pages of a host are read as token streams of block elements and texts and aligned one after
    the other, by the names of the elements below each parent: what a parent has more than once
    becomes a repeated group, what some parents lack becomes optional, and differing texts become
    slots.  Names that vary from page to page count as one, which bounds a wrapper; alignment takes
    time in proportion to the pages.  Each batch folds its pages into one wrapper per host, and
    wrappers are folded further by host and salt, then by host, with a result that depends neither on
    the batches nor on the order.  The evidence that a wrapper gathers, text and link lengths and
    constant texts of each of its elements over all pages, tells the host's main regions.  From these,
    each page gives its texts in page order, without

    * parts that are navigation, headers, footers, sidebars, forms and the like by element, role or
      style, and adverts and reader comments by the whole of a class name or id;
    * parts that are only named like one (a word of class or id), if they are mostly links or the
      wrapper holds them constant; outside of article and main elements the name is enough, unless
      the wrapper found the region itself;
    * elements with a class or id, and lists of links, that all pages of the host have with the same
      text, if at least three different pages do (lists: two) and most of the text differs.

    White space in a block becomes one space, and blocks are joined by one.  Null and empty pages
    give an empty text.  Pages without a host share one wrapper.  Repeated rows are treated alike;
    other columns are ignored.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(page).cast("string").alias("html"))
    plans = pin(infer_wrappers(rows.select("host", "html")))
    hosts, chars = plans.agg(F.count("*"), F.sum(F.length("wrapper"))).first()
    if hosts <= BROADCAST_HOSTS and (chars or 0) <= BROADCAST_CHARS:
        plans = F.broadcast(plans)
    kinds = dict(rows.dtypes)
    done = rows.join(plans, "host", "left").select("page_id", "url", "html", "wrapper").mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return done.withColumn("n_chars", F.length("text").cast("long"))
