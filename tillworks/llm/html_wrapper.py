"""Main text of web pages by union-free wrapper inference.

A page is a stream of block tags and texts. The wrapper of a host is a regular expression without
alternatives over such streams: elements, optional parts, repeated groups and text slots. Pages of a
host are aligned with it one after the other; where they differ, the wrapper is generalised: a text
mismatch becomes a slot, a tag mismatch an optional part, and a tag that recurs among its siblings
a repeated group. A wrapper holds each kind of child once per level, so its size follows the
template and not the number of pages.

Every task infers a wrapper per host from its own pages, and only these are shuffled and aligned
with each other. A page is then read along its host's wrapper, which says which slots are main text.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillworks.session import materialise

#: Names of the HTML standard, as they are.
_RAW = "script|style|textarea|title|noscript|template|iframe|xmp"
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead tr ul button".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSED_BY_BLOCK = frozenset({"p"})
_PARTS = _HEADINGS | {"p", "pre", "blockquote", "li", "dd", "dt", "figcaption", "caption"}
#: Elements that end an open one of the same list below the given parents.
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_NEVER = frozenset("head nav footer aside form button select option dialog menu fieldset legend search address".split())
_SCOPES = frozenset({"article", "main"})
_NOISE = re.compile(
    r"(?:^|[-_ ])(?:ad|ads|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|sidebar|side-?bar|side|"
    r"menu|nav|navbar|navigation|breadcrumbs?|footer|foot|header|masthead|topbar|comments?|comment-?list|discussion|respond|replies|disqus|"
    r"cookies?|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|"
    r"related|recommended|recommendations|widget|pagination|pager|toolbar|copyright|legal|disclaimer|skip-?link|tags|toc)(?:$|[-_ ])",
    re.I,
)
#: Names that parts of an article may have as well.
_WEAK = re.compile(r"(?:^|[-_ ])(?:legal|notices?|alert|share|sharing|tags|toc|side(?!-?bar)|promotion|search|social|disclaimer|related|subscribe|login)(?:$|[-_ ])", re.I)
_HEADER = re.compile(r"[.\-_]header(?:$|[.\-_])", re.I)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|$)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|$)|"
    # no "<" outside of quotes, so that tags which never end are given up at the next one
    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.S | re.I,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_HREF = re.compile(r"(?:^|[\s\"'/])href\s*=", re.I)
_DEEP = 120  # open elements; what is nested deeper becomes a part of the element there, with all its text
_DIGITS = re.compile(r"\d+")
_SPACES = re.compile(r"\s+")
_TEXT = "#text"
_GROUPS = 64  # in which a host's partial wrappers are merged first


class Linked(str):
    """A text that lies in links altogether."""


class Node:
    """An element of a page: its key (tag and names), children in order, texts as strings."""

    __slots__ = ("key", "tag", "children")

    def __init__(self, key: str, tag: str):
        self.key, self.tag, self.children = key, tag, []


def _key(tag: str, attributes: str) -> str:
    """Tag with its class, id and role; numbers in names don't tell elements apart."""
    if not attributes or not attributes.strip(" \t\r\n/"):
        return tag
    found = _NAMES.findall(attributes)
    names = sorted({_DIGITS.sub("0", n.lower()) for kind, *values in found for n in "".join(values).split() if kind.lower() != "hidden"})
    if any(kind.lower() == "hidden" for kind, *_ in found):
        names.append("~hidden")
    return f"{tag}.{'.'.join(names)}" if names else tag


def parse(page: str) -> Node:
    """The page's block elements as a tree; missing end tags are implied, inline tags join texts. A link
    has an address, and ends with the block that it began in."""
    root = Node("", "")
    stack = [root]
    held: list[str] = []
    deep: list[str] = []  # tags that are open below the deepest element
    link, plain = 0, False  # depth at which a link is open, or 0; whether some of the held text is outside of it

    def flush() -> None:
        nonlocal plain
        if held:
            text = _SPACES.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                stack[-1].children.append(text if plain else Linked(text))
        plain = False

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
            plain = plain or (not link and not held[-1].isspace())
        at = m.end()
        if m[3] is None:  # comments, declarations and raw elements
            continue
        tag, closing = m[3].lower(), m[2]
        if tag not in _BLOCKS:
            if tag == "br":
                held.append(" ")
            elif tag == "a" and (closing or _HREF.search(m[4])):
                link = 0 if closing else len(stack) + len(deep)
            continue
        if closing:
            if deep and tag in deep[-_DEEP:]:
                flush()
                while deep.pop() != tag:
                    pass
                link = link if link <= len(stack) + len(deep) else 0
            elif any(n.tag == tag for n in stack[1:]):
                flush()
                deep.clear()
                while stack.pop().tag != tag:
                    pass
                link = link if link <= len(stack) else 0  # no link goes on after the block that it began in
            elif tag == "p":
                flush()
            continue
        flush()
        # an open paragraph, or item of the same list, ends here
        while not deep and stack[-1].tag in _CLOSED_BY_BLOCK:
            stack.pop()
        if tag in _SIBLINGS and not deep:
            ends, parents = _SIBLINGS[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in parents:
                    break
                if stack[depth].tag in ends:
                    del stack[depth:]
                    break
        if tag in _HEADINGS and not deep and stack[-1].tag in _HEADINGS:
            stack.pop()
        if len(stack) > _DEEP:
            if tag not in _VOID and not m[4].endswith("/"):
                deep.append(tag)
            continue
        node = Node(_key(tag, m[4]), tag)
        stack[-1].children.append(node)
        if tag not in _VOID and not m[4].endswith("/"):
            stack.append(node)
    rest = re.match(r"[^<]*(?:<(?![a-zA-Z/!?])[^<]*)*", page[at:])[0]  # without a tag that is cut off
    held.append(rest)
    plain = plain or not link
    flush()
    return root


# A wrapper is a list of items. An item is a dictionary:
#   kind "tag": key, opt, rep, items (its content); kind "text": const (digest of its whole text, or None for a slot), opt, rep;
#   kind "group": items (each optional and repeated) that recur in any number. p counts pages, c a text's characters
#   over all pages, and l those of them that lie in links.


def digest_of(text: str) -> str:
    """Stands for the whole text, so that texts which differ anywhere make a slot."""
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def of_page(children: list) -> list[dict]:
    items = []
    for c in children:
        if isinstance(c, str):
            items.append({"kind": "text", "const": digest_of(c), "opt": 0, "rep": 0, "c": len(c), "l": len(c) * isinstance(c, Linked), "p": 1})
        else:
            items.append({"kind": "tag", "key": c.key, "opt": 0, "rep": 0, "items": of_page(c.children), "p": 1})
    return fold(items)


def _keys(item: dict) -> frozenset:
    if item["kind"] == "group":
        return frozenset(k for i in item["items"] for k in _keys(i))
    return frozenset((item["key"] if item["kind"] == "tag" else _TEXT,))


def _merge_item(a: dict, b: dict, same_page: bool = False) -> dict:
    """The item that matches what either matches."""
    pages = a["p"] if same_page else a["p"] + b["p"]
    if a["kind"] == "group" or b["kind"] == "group":
        members: dict = {}
        for i in (a["items"] if a["kind"] == "group" else [a]) + (b["items"] if b["kind"] == "group" else [b]):
            (k,) = _keys(i)
            members[k] = _merge_item(members[k], i, True) if k in members else {**i, "opt": 1, "rep": 1}
        return {"kind": "group", "items": list(members.values()), "opt": a["opt"] | b["opt"], "rep": 1, "p": pages}
    if a["kind"] == "text":
        const = a["const"] if a["const"] == b["const"] else None
        return {"kind": "text", "const": const, "opt": a["opt"] | b["opt"], "rep": a["rep"] | b["rep"], "c": a["c"] + b["c"], "l": a["l"] + b["l"], "p": pages}
    return {"kind": "tag", "key": a["key"], "opt": a["opt"] | b["opt"], "rep": a["rep"] | b["rep"], "items": align(a["items"], b["items"]), "p": pages}


def fold(items: list[dict]) -> list[dict]:
    """Adjacent equal items become one repeated item; items that recur apart, with what stands
    between them, one repeated group. No key stands twice in what is left."""
    out: list[dict] = []
    for item in items:
        if out and out[-1]["kind"] == item["kind"] != "group" and _keys(out[-1]) == _keys(item):
            out[-1] = {**_merge_item(out[-1], item, True), "rep": 1}
        else:
            out.append(item)
    while True:
        first: dict = {}
        span = None
        for i, item in enumerate(out):
            for k in _keys(item):
                if k in first and first[k] != i:
                    span = (first[k], i) if span is None or first[k] < span[0] else span
                first.setdefault(k, i)
            if span:
                break
        if not span:
            return out
        lo, hi = span
        group = {"kind": "group", "items": [], "opt": 0, "rep": 1, "p": max(i["p"] for i in out[lo : hi + 1])}
        for item in out[lo : hi + 1]:
            group = _merge_item(group, item, True)
        group["opt"] = 0
        out[lo : hi + 1] = [group]


def align(a: list[dict], b: list[dict]) -> list[dict]:
    """Two item lists as one: a longest common subsequence is merged, the rest becomes optional."""
    ka, kb = [_keys(i) for i in a], [_keys(i) for i in b]
    if len(ka) == len(kb) and all(x & y for x, y in zip(ka, kb, strict=True)):
        return fold([_merge_item(x, y) for x, y in zip(a, b, strict=True)])
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = 1 + best[i + 1][j + 1] if ka[i] & kb[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and ka[i] & kb[j]:
            out.append(_merge_item(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append({**a[i], "opt": 1})
            i += 1
        else:
            out.append({**b[j], "opt": 1})
            j += 1
    return fold(out)


def _members(items: list[dict]) -> dict[str, dict]:
    out = {}
    for i in items:
        for m in i["items"] if i["kind"] == "group" else [i]:
            out[m["key"] if m["kind"] == "tag" else _TEXT] = m
    return out


def _noisy(key: str, tag: str, weak: bool = True) -> bool:
    """Whether the tag or names call it no text; `weak` counts names that may also be an article's."""
    names = key[len(tag) + 1 :].split(".") if "." in key else []
    if tag in _NEVER or "~hidden" in names:
        return True
    if tag in ("article", "main", "body", "html"):
        return False
    return any(_NOISE.search(n if weak else _WEAK.sub("-", n)) for n in names)


def _size(item: dict, kind: str) -> int:
    """Characters of the item over all pages: `c` all, `l` in links."""
    return item[kind] if item["kind"] == "text" else sum(_size(i, kind) for i in item["items"])


class Wrapper:
    """Reads pages along the regular expression inferred for their host.

    The article slot is the host's article or main element; without one, the element that is not
    repeated and holds most of the host's text outside of links, as far down as one does. Template
    texts are outside of it, stand once on a page, and are the same on all pages, of which there are
    at least two that differ. The number of pages does not matter otherwise. Names alone drop an
    element unless it is a part of the article and the name is one that such parts may have: then
    it goes if it is a template text or if most of it, over all pages, lies in links."""

    def __init__(self, items: list[dict], pages: int):
        self.items, self.pages = items, pages
        self.scoped = self._has_scope(items)
        self.slot = self._article_slot(items)
        # pages without any difference may be one page that is there twice
        self.fixed = self._has_slot(items)

    def _has_scope(self, items: list[dict]) -> str:
        found = set()

        def look(items):
            for i in _members(items).values():
                if i["kind"] == "tag":
                    tag = i["key"].split(".")[0]
                    if not _noisy(i["key"], tag):
                        if tag in _SCOPES:
                            found.add(tag)
                        look(i["items"])

        look(items)
        return "article" if "article" in found else "main" if "main" in found else ""

    def _plain(self, item: dict) -> int:
        """Characters outside of links and of what names call no text."""
        if item["kind"] == "text":
            return item["c"] - item["l"]
        if item["kind"] == "tag" and _noisy(item["key"], item["key"].split(".")[0], False):
            return 0
        return sum(map(self._plain, item["items"]))

    def _article_slot(self, items: list[dict]) -> dict | None:
        """The item that holds most of the host's text; None if it is spread over the page."""
        slot, whole = None, sum(map(self._plain, items))
        while True:
            # a paragraph or heading that holds most of the text is a part of the article, not the whole
            inner = [i for i in items if i["kind"] == "tag" and not i["rep"] and i["key"].split(".")[0] not in _PARTS and 2 * self._plain(i) > whole]
            if not inner:
                return slot
            slot, items = inner[0], inner[0]["items"]

    def _has_slot(self, items: list[dict]) -> bool:
        for i in _members(items).values():
            if i["kind"] == "text":
                if i["const"] is None:
                    return True
            elif not _noisy(i["key"], i["key"].split(".")[0]) and self._has_slot(i["items"]):
                return True
        return False

    def _is_fixed(self, text: str, item: dict | None) -> bool:
        return self.fixed and item is not None and not item["rep"] and item["p"] > 1 and item["const"] is not None and digest_of(text) == item["const"]

    def _is_template(self, item: dict) -> bool:
        """Whether all texts of the item are the same on all pages, of which there are some."""
        if item["kind"] == "text":
            return self.fixed and item["const"] is not None and item["p"] > 1 and not item["rep"]
        return all(map(self._is_template, item["items"]))

    def _left_out(self, node: Node, item: dict | None, part: bool) -> bool:
        if not part or _noisy(node.key, node.tag, False):
            return _noisy(node.key, node.tag)
        if not _noisy(node.key, node.tag):
            return False
        # by its name no text: the expression decides
        return item is None or 2 * _size(item, "l") > _size(item, "c") or self._is_template(item)

    def extract(self, root: Node) -> str:
        blocks: list[str] = []
        scope = self.scoped if self._uses_scope(root) else ""
        self._walk(root, self.items, not scope, scope, blocks, False, not scope and self.slot is not None, False)
        return "\n".join(blocks)

    def _uses_scope(self, node: Node) -> bool:
        return any(not isinstance(c, str) and ((c.tag == self.scoped and not _noisy(c.key, c.tag)) or (not _noisy(c.key, c.tag) and self._uses_scope(c))) for c in node.children)

    def _walk(self, node: Node, items: list[dict], inside: bool, scope: str, blocks: list[str], heading_only: bool, outside: bool, part: bool) -> None:
        """Add the node's main text; `outside`: template texts may stand here, as no item around it
        is repeated or the article slot; `part`: it lies in the article."""
        known = _members(items)
        for c in node.children:
            if isinstance(c, str):
                item = known.get(_TEXT)
                # links alone are a menu, but for headings in the article and what is mostly no links on other pages
                menu = isinstance(c, Linked) and not scope and not (part and (node.tag in _HEADINGS or (item is not None and 2 * item["l"] <= item["c"])))
                if inside and not menu and not (heading_only and node.tag not in _HEADINGS) and not (outside and self._is_fixed(c, item)):
                    blocks.append(c)
                continue
            # a header outside the article is the page's; inside, its headings belong to the text
            header = c.tag == "header" or (_HEADER.search(c.key) is not None and c.tag not in _NEVER)
            item = known.get(c.key)
            within = inside or c.tag == scope
            of_article = part or (within if scope else item is not None and item is self.slot)
            if (header and not (inside and scope)) or (not header and self._left_out(c, item, of_article)):
                continue
            only = heading_only or header
            template = outside and item is not None and item is not self.slot and not item["rep"]
            self._walk(c, item["items"] if item else [], within, scope, blocks, only, template, of_article)


def host_of(url: str | None) -> str:
    found = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", (url or "").strip(), re.I)
    return found[1].lower() if found else ""


def _joined(held: dict[str, tuple[list, int]], host: str, items: list, pages: int) -> None:
    if host in held:
        other, n = held[host]
        held[host] = (align(other, items), n + pages)
    else:
        held[host] = (items, pages)


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:  # a batch is what a task holds at a time
        held: dict[str, tuple[list, int]] = {}
        for url, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            _joined(held, host_of(url), of_page(parse(page).children), 1)
        yield _listed(held)


def _listed(held: dict[str, tuple[list, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "host": pa.array(list(held), pa.string()),
            "wrapper": pa.array([json.dumps(w) for w, _ in held.values()], pa.string()),
            "pages": pa.array([n for _, n in held.values()], pa.int64()),
        }
    )


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by host: one wrapper is held at a time."""
    held: dict[str, tuple[list, int]] = {}
    for batch in batches:
        done = {}
        for host, wrapper, pages in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if held and host not in held:
                done |= held
                held = {}
            _joined(held, host, json.loads(wrapper), pages)
        if done:
            yield _listed(done)
    if held:
        yield _listed(held)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, pages): the regular expression of each host, as JSON."""
    shape = "host string, wrapper string, pages long"
    parts = pages.select("url", F.coalesce("html", F.lit("")).alias("html")).mapInArrow(_infer, shape)
    # as many rows of a host as there are batches: merged in groups first, so that no task has all of
    # them; in a fixed order each time
    group = F.pmod(F.xxhash64("wrapper"), F.lit(_GROUPS))
    some = parts.repartition("host", group).sortWithinPartitions("host", "pages", "wrapper").mapInArrow(_combine, shape)
    return some.repartition("host").sortWithinPartitions("host", "pages", "wrapper").mapInArrow(_combine, shape)


def _extract(kind: str) -> Callable:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            texts = []
            for page, wrapper, pages in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                root = parse(page)
                key = wrapper or ""
                if key not in known:
                    if len(known) > 200:
                        known.clear()
                    known[key] = Wrapper(json.loads(wrapper) if wrapper else of_page(root.children), pages or 1)
                texts.append(known[key].extract(root))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return extract


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per row of `pages`: page_id, url, text (blocks joined by \\n, empty if none), n_chars.

    Null html counts as empty; pages without a host share one wrapper. Repeated rows give the same
    text; an empty table gives an empty result; other columns are ignored."""
    host = F.coalesce(F.lower(F.regexp_extract(F.regexp_replace("url", r"^(?U)\s+", ""), r"^(?i)(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    known = materialise(wrappers(pages), "wrappers").withColumnRenamed("pages", "n")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("of"))
    kind = pages.schema["page_id"].dataType.simpleString()
    # a host with a large part of the pages is split by adaptive execution
    joined = rows.join(known, F.col("of") == F.col("host"), "left").select("page_id", "url", "html", "wrapper", "n")
    return joined.mapInArrow(_extract(kind), f"page_id {kind}, url string, text string, n_chars long")
