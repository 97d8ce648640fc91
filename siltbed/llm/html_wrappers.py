"""Main text of pages by wrappers: union-free expressions inferred for each host.

A page is a stream of tags and texts, nested by its tags. A wrapper is such a
nest of items, each of which may be optional or repeated: tags, groups and text
slots. Inference aligns streams one after the other: items with equal labels
match and their contents align in turn; neighbours with equal labels, and
neighbouring runs of labels that recur, fold into a repeated group; an item that
one side lacks becomes optional. There are no alternatives, so a wrapper stays a
sequence; one that would grow beyond `WIDEST` items in a row turns into a
repeated group of optional ones, which bounds it by the number of labels.

Each task folds the pages it reads into one wrapper a host, so that a host with a
third of all pages is pre-aggregated where its pages lie; the partial wrappers,
one a task and host at most, merge in rounds of `FAN_IN`. The merged wrapper
says for each slot whether it is main text: the slots within the article (or
main, or the like) of most pages, or else within the container with the most
text and what stands beside it and its ancestors (blocks with most of their text
in links excepted), without menus, headers, footers, sidebars, notices, adverts, forms and
comments. A class or id drops an element only if one of its names consists of words that say so
("site-footer", not "has-sidebar" or "sharing-economy"), header words only outside the main
place; whatever holds a page's only main place, or its heading and most of its text, stays. Where no
mark tells the main place, texts are compared as well: a whole block that most
pages of a host have word for word is template, the constant part of a slot, and goes,
but headings and what would cost a page half of its text; where texts differ they are data.
Within a told place nothing else goes. These counts are exact sums over all pages, whatever
partitions they lie in. A page's text is then read by aligning its own stream with its host's
wrapper; a page that leaves no main text this way decides by itself.

Defined results: null and empty html, and html without text, give the empty
text; pages without a host form a host of their own; character references are
decoded, white space in a block is one space, blocks are joined by an empty line;
a comment or script that never ends runs to the end of the page; repeated rows
repeat; very long pages are read whole, deep nests too: elements below 60 others
that no mark tells apart give their contents to the one above; an empty table gives an
empty table. Ties: of places that hold as many pages the first of PLACES is taken, of
items with equal labels the next in order. Columns of the caller may have any name: the
result has id, url, text and n_chars only.
"""

import html
import json
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import looked_up, stored

FAN_IN, WIDEST, MOST_HOSTS, DEEPEST, DEEPEST_MARKED = 64, 48, 500, 60, 160
MOST_TEXTS = 200_000
#: When a text is template, unless the caller says otherwise: share of pages, and pages at least.
CONSTANT_SHARE, LEAST_PAGES = 0.6, 5
PARTIAL = "host string, part long, wrapper string, key long, n long, chars long"
PARTIAL_ARROW = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in PARTIAL.split(", ")])
#: Elements of HTML by how they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"}}
SCOPES = frozenset("article aside body div footer form header html main nav ol section table td th ul dl blockquote figure".split())
DROPPED = frozenset("head script style noscript template iframe svg math canvas object audio video select textarea button form nav footer aside menu dialog search datalist fieldset".split())
PLACES = ("article", "main", "content")
#: Words of class, id and role that tell a place.
DROPPED_WORDS = frozenset(
    "ad ads advert advertisement advertising adsbygoogle sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar widget footer "
    "masthead topbar header cookie cookies consent gdpr notice notification banner alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended comment comments commentlist reply replies respond discussion disqus pagination pager toolbar copyright legal complementary contentinfo search hidden adverts notices banners menus sidebars footers headers popups widgets disclaimer offcanvas skiplink".split()
)
CONTENT_WORDS = frozenset("article articlebody post entry story content maincontent postcontent entrycontent articlecontent main bodytext".split())
#: Of these, words that drop a place only where it is not within the main one, unless a role says them.
OUTSIDE_WORDS = frozenset("header headers masthead topbar legal copyright search login complementary contentinfo".split())
LEXER = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
END, HEAD = "\n\n", "\n\n#"
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Words beside those that tell a dropped place in an id; an id with others is an anchor's name.
ID_WORDS = frozenset("site page the my main top bottom left right inner outer primary secondary global section box block container wrapper wrap area list bar panel column col row content body".split())
SPLIT = re.compile(r"[^a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("open" | "close" | "text", tag or text, attributes)."""
    at, n, ends = 0, len(page), True
    while at < n:
        m = LEXER.search(page, at)
        if not m:
            yield "text", page[at:], ""
            return
        if m.start() > at:
            yield "text", page[at : m.start()], ""
        at = m.end()
        close, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            if ends and m[0].startswith("<![CDATA["):
                end = page.find("]]>", m.start() + 9)
                ends = end >= 0  # one that never ends is a comment, and so are those after it
                if ends:
                    yield "text", html.escape(page[m.start() + 9 : end]), ""
                    at = end + 3
            continue
        name = name.lower()
        yield ("close" if close else "open"), name, rest
        if not close and name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            inner = page[at : end.start() if end else n]
            if name == "title":
                yield "text", inner, ""
            at = end.start() if end else n


def told(name: str) -> tuple[bool, str]:
    """Whether a name of a class, id or role tells main text, and what it drops: "" nothing, "^" outside the main place, "-" everywhere.

    It drops only if all its words say so, with words of position and of content.
    """
    words = {w for w in SPLIT.split(CAMEL.sub(" ", name).lower()) if w}
    bad = words & DROPPED_WORDS
    if not bad:
        return bool((words | {SPLIT.sub("", name.lower())}) & CONTENT_WORDS), ""
    if not words <= DROPPED_WORDS | ID_WORDS | CONTENT_WORDS:
        return False, ""
    if words & CONTENT_WORDS and bad <= {"header", "headers"}:
        return True, ""  # an article's own
    return False, "-" if bad - OUTSIDE_WORDS else "^"


def label(tag: str, attributes: str) -> str:
    """The tag, with what its class, id and role tell about the place, if anything: "+", "-" or "^".

    Headings tell nothing but that they are hidden, paragraphs nothing by their id.
    """
    if not attributes or tag in ("html", "body", "main"):
        return tag
    good, bad, unseen = False, "", False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "style" and UNSEEN.search(value) or name == "aria-hidden" and value.lower() == "true":
            unseen = True
        elif name in ("class", "role") or name == "id" and tag != "p":
            for own in value.split():
                is_good, drops = told(own)
                good = good or is_good
                bad = "-" if "-" in (bad, drops) or drops and name == "role" else bad or drops
    if unseen or tag in HEADINGS:
        return f"{tag}-" if unseen else tag
    return tag if good and bad else f"{tag}+" if good else f"{tag}{bad}"


class Node:
    """An element of a page: label and children, each a Node or a text."""

    __slots__ = ("label", "children")

    def __init__(self, name: str):
        self.label, self.children = name, []


def transparent(name: str) -> bool:
    """Whether a label says nothing of what is main text, so that a deep element may give its contents to its parent."""
    return not is_dropped(name, False) and not name.endswith("+") and tag_of(name) not in PLACES


def parse(page: str) -> Node:
    """The nest of a page; end tags that HTML lets one omit are implied.

    All open elements count. Below DEEPEST nodes, plain elements leave block ends
    only and give their contents to the node above, marked and dropped ones are
    nodes still; below DEEPEST_MARKED, dropped ones go and all others are plain.
    """
    root = Node("#")
    stack, names, depths = [root], ["#"], [1]
    # places of the open elements by name; of those that end tags are not implied across, all and without cells
    open_: defaultdict[str, list[int]] = defaultdict(list)
    scopes, tables = [0], [0]
    marked = False

    def shut(k: int) -> None:
        """Closes the elements from place k on."""
        for j in range(len(names) - 1, k - 1, -1):
            open_[names[j]].pop()
            for open_scopes in (scopes, tables):
                if open_scopes[-1] == j:
                    open_scopes.pop()
            if names[j] in BLOCK and depths[j] == depths[j - 1]:
                stack[j - 1].children.append(Node("div"))
        del stack[k:], names[k:], depths[k:]

    for kind, name, rest in tokens(page):
        if kind == "text":
            stack[-1].children.append(name)
        elif kind == "open":
            if name in BLOCK and open_["p"] and open_["p"][-1] > scopes[-1]:
                shut(open_["p"][-1])
            if name in CLOSES:
                k = max((open_[x][-1] for x in CLOSES[name] if open_[x]), default=0)
                if k and k >= (tables if name in ("tr", "tbody") else scopes)[-1]:
                    shut(k)
            node, depth = Node(label(name, rest)), depths[-1] + 1
            marked = marked or node.label[-1] in "-^" or name == "form"
            leaf = name in VOID or rest.rstrip().endswith("/")
            if not leaf and depth > DEEPEST and (transparent(node.label) or depth > DEEPEST_MARKED):
                depth -= 1
                if depth < DEEPEST_MARKED or not is_dropped(node.label, True):
                    node = stack[-1]
                    if name in BLOCK:
                        node.children.append(Node("div"))
            else:
                stack[-1].children.append(node)
            if not leaf:
                open_[name].append(len(names))
                if name in SCOPES:
                    scopes.append(len(names))
                    if name not in ("td", "th"):
                        tables.append(len(names))
                stack.append(node)
                names.append(name)
                depths.append(depth)
        elif open_[name]:
            shut(open_[name][-1])
    if marked:
        set_free(root)
    return root


class Held:
    """What an element holds that no mark drops: text, first headings and main places, and the marked elements below."""

    def __init__(self, node: Node, under: bool = False):
        self.node, self.chars, self.titles, self.places, self.free, self.marked = node, 0, 0, 0, 0, []
        for c in node.children:
            if isinstance(c, str):
                self.chars += len(c.strip())
                continue
            tag = tag_of(c.label)
            if tag in DROPPED - {"form"}:
                continue
            drops = is_dropped(c.label, False) and tag != "header"
            own = Held(c, under or drops)
            is_place = (tag in PLACES or c.label.endswith("+")) and not drops
            self.titles += own.titles + (tag == "h1" and not drops)
            self.chars += own.chars
            self.places += own.places + is_place
            self.free += own.free + (is_place and not (under or drops))
            self.marked += [own, *own.marked] if drops else own.marked


def set_free(root: Node) -> None:
    """A mark, or a form, around the only main place of a page drops nothing; where there is no such
    place, neither does one around its first headings and most of its text, or nearly all of its text."""
    page = Held(root)
    if page.free:
        return
    for x in page.marked:
        most = x.titles == page.titles and 2 * x.chars > page.chars if page.titles else 10 * x.chars > 9 * page.chars
        if not x.node.label.startswith("h") and (x.places or not page.places and most):
            x.node.label = "div" if x.node.label.startswith("form") else tag_of(x.node.label)


# An item of a wrapper: [label, optional, repeated, seen, chars, items]. The label of a
# text slot is "#text", of a group "()"; chars counts a slot's text in all pages.
LABEL, OPTIONAL, REPEATED, SEEN, CHARS, ITEMS = range(6)


def items_of(node: Node) -> list:
    """The items of a page's element, folded."""
    out = []
    for c in node.children:
        if isinstance(c, str):
            n = len(c.strip())
            if n:
                out.append(["#text", False, False, 1, n, []])
        else:
            out.append([c.label, False, False, 1, 0, items_of(c)])
    return fold(out)


def absorb(a: list, b: list) -> list:
    """Two items of one label as one."""
    return [a[LABEL], a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED], a[SEEN], a[CHARS] + b[CHARS], align(a[ITEMS], b[ITEMS])]


def fold(items: list) -> list:
    """Neighbours of one label, and runs of labels that recur, become repeated."""
    out: list = []
    for x in items:
        if out and out[-1][LABEL] == x[LABEL] and x[LABEL] != "()":
            out[-1] = absorb(out[-1], x)
            out[-1][REPEATED] = True
        else:
            out.append(x)
    for width in (2, 3, 4):
        k = 0
        while k + 2 * width <= len(out):
            names = [x[LABEL] for x in out[k : k + width]]
            end = k + width
            while [x[LABEL] for x in out[end : end + width]] == names:
                end += width
            if end > k + width and "()" not in names:
                body = out[k : k + width]
                for j in range(k + width, end, width):
                    body = [absorb(a, b) for a, b in zip(body, out[j : j + width])]
                out[k:end] = [["()", False, True, 1, 0, body]]
            k += 1
    if len(out) > WIDEST:
        by: dict[str, list] = {}
        for x in (y for g in out for y in (g[ITEMS] if g[LABEL] == "()" else [g])):
            by[x[LABEL]] = absorb(by[x[LABEL]], x) if x[LABEL] in by else x
        out = [["()", False, True, 1, 0, [[*x[:1], True, *x[2:]] for x in by.values()]]]
    return out


def pairs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence."""
    if a == b:
        return [(i, i) for i in range(len(a))]
    m, n = len(a), len(b)
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(m - 1, -1, -1):
        for j in range(n - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < m and j < n:
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def key(item: list) -> str:
    return "(" + " ".join(x[LABEL] for x in item[ITEMS]) + ")" if item[LABEL] == "()" else item[LABEL]


def align(a: list, b: list) -> list:
    """Items that both sides match, in order; what one side lacks is optional."""
    out, i, j = [], 0, 0
    for p, q in [*pairs([key(x) for x in a], [key(x) for x in b]), (len(a), len(b))]:
        out += [[x[LABEL], True, *x[REPEATED:]] for x in [*a[i:p], *b[j:q]]]
        if p < len(a):
            x = absorb(a[p], b[q])
            x[SEEN] = a[p][SEEN] + b[q][SEEN]
            out.append(x)
        i, j = p + 1, q + 1
    return fold_again(out)


def fold_again(items: list) -> list:
    names = [x[LABEL] for x in items]
    return fold(items) if len(items) > WIDEST or any(x == y and x != "()" for x, y in zip(names, names[1:])) else items


def wrapper_text(items: list) -> str:
    """The wrapper as an expression: ? for optional, + for repeated."""
    def one(x: list) -> str:
        mark = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[x[OPTIONAL], x[REPEATED]]
        inner = wrapper_text(x[ITEMS])
        return (f"({inner})" if x[LABEL] == "()" else f"{x[LABEL]}[{inner}]" if inner else x[LABEL]) + mark

    return " ".join(map(one, items))


def tag_of(name: str) -> str:
    return name.rstrip("+-^")


def is_dropped(name: str, inside: bool) -> bool:
    """Whether a label's element is no main text; inside: within the main place."""
    tag = tag_of(name)
    return tag in DROPPED or name.endswith("-") or (tag == "header" or name.endswith("^")) and not inside


def place(items: list, pages: int) -> str:
    """Which place holds the main text of most pages: a name of PLACES, or "densest"."""
    seen = dict.fromkeys(PLACES, 0)

    def look(items: list) -> None:
        for x in items:
            if is_dropped(x[LABEL], False):
                continue
            if x[LABEL].endswith("+"):
                seen["content"] += x[SEEN]
            if tag_of(x[LABEL]) in seen:
                seen[tag_of(x[LABEL])] += x[SEEN]
            look(x[ITEMS])

    look(items)
    return next((p for p in PLACES if 2 * seen[p] >= pages), "densest")


def holds(name: str, where: str) -> bool:
    return name.endswith("+") if where == "content" else tag_of(name) == where


def mass(items: list) -> int:
    return sum(0 if is_dropped(x[LABEL], False) else x[CHARS] + mass(x[ITEMS]) for x in items)


def linked(items: list) -> int:
    """Text within links."""
    return sum(0 if is_dropped(x[LABEL], False) else x[CHARS] + mass(x[ITEMS]) if tag_of(x[LABEL]) == "a" else linked(x[ITEMS]) for x in items)


def link_dense(item: list) -> bool:
    """Whether a block other than a heading or paragraph has most of its text in links."""
    return tag_of(item[LABEL]) in BLOCK - {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "p"} | {"()"} and 2 * linked(item[ITEMS]) > mass(item[ITEMS])


def mark(items: list, where: str, inside: bool = False) -> list:
    """A slim copy of a wrapper: [label, main, items]; main: texts below it are main text."""
    if where == "densest" and not inside:
        # go down while one container has most of the text
        own = [(mass(x[ITEMS]), k) for k, x in enumerate(items) if not is_dropped(x[LABEL], False)]
        text, total = max(own, default=(0, -1)), mass(items)
        into = text[1] if text[0] > 0.7 * total and tag_of(items[text[1]][LABEL]) in SCOPES | {"#", "()"} else -1
        if into < 0:
            inside = True
        else:
            # what stands beside it stays, but for what is dropped anyway and lists of links
            beside = [k != into and not is_dropped(x[LABEL], False) and not link_dense(x) for k, x in enumerate(items)]
            return [[x[LABEL], b, mark(x[ITEMS], where, b) if b or k == into else []] for k, (x, b) in enumerate(zip(items, beside))]
    out = []
    for x in items:
        now = inside or where in PLACES and holds(x[LABEL], where)
        keep = not is_dropped(x[LABEL], now)
        out.append([x[LABEL], now and keep, mark(x[ITEMS], where, now) if keep else []])
    return out


def edge(name: str) -> str:
    """What separates an element's text from what is beside it."""
    return (HEAD if tag_of(name) in HEADINGS else END) if tag_of(name) in BLOCK else " " if name == "br" else ""


def blocks(node: Node, marked: list) -> Iterator[str]:
    """Main texts of a page's element, aligned with marked items, and END or HEAD at the edges of blocks."""
    flat = [x for top in marked for x in (top[2] if top[0] == "()" else [top])]
    places: defaultdict[str, list[int]] = defaultdict(list)
    for k, x in enumerate(flat):
        places[x[0]].append(k)
    spaced = any(m for _, m, _ in flat)
    at = 0
    for c in node.children:
        name = "#text" if isinstance(c, str) else c.label
        if name == "#text" and not c.strip():
            if spaced:
                yield " "
            continue
        # the next item of this label from here on, or the first: groups and repeats begin again
        own = places.get(name)
        if own is None:
            continue
        k = bisect_left(own, at)
        at = k = own[k] if k < len(own) else own[0]
        _, main, inner = flat[k]
        if name == "#text":
            if main:
                yield c
            continue
        yield edge(name)
        yield from blocks(c, inner)
        if tag_of(name) in BLOCK:
            yield END


def unmarked_texts(node: Node) -> Iterator[str]:
    """Like blocks, but all texts of a page that no mark drops."""
    for c in node.children:
        if isinstance(c, str):
            yield c
        elif not is_dropped(c.label, True):
            yield edge(c.label)
            yield from unmarked_texts(c)
            if tag_of(c.label) in BLOCK:
                yield END


def divided(parts: Iterator[str]) -> Iterator[tuple[str, bool]]:
    """(text, whether it is a heading) of each block."""
    text, heading = [], False
    for p in chain(parts, [END]):
        if p is END or p is HEAD:
            block = " ".join(html.unescape("".join(text)).split())
            if block:
                yield block, heading
            text, heading = [], p is HEAD
        else:
            text.append(p)


def text_key(block: str) -> int:
    return xxhash.xxh64_intdigest(block.encode("utf-8", "surrogatepass")) - (1 << 63)


def text_keys(root: Node) -> dict[int, int]:
    """Keys and lengths of a page's blocks that no mark drops, headings apart."""
    return {text_key(b): len(b) for b, heading in divided(unmarked_texts(root)) if not heading}


def joined(parts: Iterator[str], constant: frozenset[int] = frozenset()) -> str:
    return "\n\n".join(b for b, heading in divided(parts) if heading or not constant or text_key(b) not in constant)


@lru_cache(maxsize=256)
def _loaded(wrapper: str) -> list:
    return json.loads(wrapper)


def main_text(page: str | None, wrapper: str | None, constant: list[int] | None = None) -> str:
    """The main text of a page, by its host's marked wrapper and constant texts."""
    if not page:
        return ""
    root = parse(page)
    text = joined(blocks(root, _loaded(wrapper))) if wrapper else ""
    if text and constant:
        left = joined(blocks(root, _loaded(wrapper)), frozenset(constant))
        # a page that is a template for the most part is a copy of others
        text = left if 2 * len(left) >= len(text) else text
    if not text:
        own = items_of(root)
        text = joined(blocks(root, mark(own, place(own, 1)))) or joined(blocks(root, mark(own, "densest")))
    return text


def merge(wrappers: list[str]) -> tuple[str, int]:
    """Partial wrappers, as [pages, items] in JSON, to one, and its pages."""
    pages, items = 0, None
    for w in sorted(wrappers):
        n, more = json.loads(w)
        pages, items = pages + n, more if items is None else align(items, more)
    return json.dumps([pages, items], separators=(",", ":")), pages


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, part, wrapper) and rows (host, key, pages, chars) of texts, summed up as far as memory is to go."""
    held: dict[str, list] = {}
    texts: dict[tuple[str, int], list[int]] = {}
    part = TaskContext.get().partitionId()

    def give(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PARTIAL_ARROW)], schema=PARTIAL_ARROW)

    def wrappers() -> list[tuple]:
        return [(h, part, json.dumps(w, separators=(",", ":")), None, None, None) for h, w in held.items()]

    def strings() -> list[tuple]:
        return [(h, None, None, k, n, chars) for (h, k), (n, chars) in texts.items()]

    for b in batches:
        for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if not page:
                continue
            root = parse(page)
            own = items_of(root)
            for k, size in text_keys(root).items():
                seen = texts.setdefault((host, k), [0, 0])
                seen[0] += 1
                seen[1] += size
            if host in held:
                held[host] = [held[host][0] + 1, align(held[host][1], own)]
            else:
                held[host] = [1, own]
            if len(held) > MOST_HOSTS:
                yield give(wrappers())
                held = {}
            if len(texts) > MOST_TEXTS:
                yield give(strings())
                texts = {}
    if held:
        yield give(wrappers())
    if texts:
        yield give(strings())


def constants(strings: DataFrame, hosts: DataFrame, share: float = CONSTANT_SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """(host, constant): keys of the texts that are template rather than data, of hosts whose main place no mark tells.

    A block's text is constant where a `share` of a host's pages, `least` pages at
    least, have it, headings apart. Counted over all pages; a host's list is no longer
    than a page or two, since each member stands in most of them.
    """
    counted = strings.groupBy("host", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    known = looked_up(counted, hosts.where("place = 'densest'").select("host", "pages", F.col("pages").alias("_pages")), "host", "pages", F.col("key"))
    often = known.where(F.col("n") >= F.col("_pages") * share)
    return often.groupBy("host").agg(F.array_sort(F.collect_list("key")).alias("constant"))


def host_of(url: str) -> "F.Column":
    """The host part of a URL column, lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))


def infer(pages: DataFrame, url_col: str = "url", html_col: str = "html", share: float = CONSTANT_SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """(host, pages, place, wrapper, marked, constant) of each host: what tells its main place, its expression,
    what is main text in it, what is template text (see constants() for share and least)."""
    rows = pages.select(host_of(f"`{url_col}`").alias("host"), F.col(f"`{html_col}`").alias("html"))
    partials = stored(rows.mapInArrow(_infer, PARTIAL), "wrappers")
    partial_ones = partials.where("wrapper is not null").select("host", "part", "wrapper")

    def merged(pdf):
        import pandas as pd

        return pd.DataFrame({"host": [pdf.host[0]], "part": [int(pdf.part.min())], "wrapper": [merge(list(pdf.wrapper))[0]]})

    def finished(pdf):
        import pandas as pd

        wrapper, n = merge(list(pdf.wrapper))
        items = json.loads(wrapper)[1]
        where = place(items, n)
        return pd.DataFrame({"host": [pdf.host[0]], "pages": [n], "place": [where], "wrapper": [wrapper_text(items)], "marked": [json.dumps(mark(items, where), separators=(",", ":"))]})

    while (partial_ones.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > FAN_IN:
        grouped = partial_ones.groupBy("host", F.floor(F.col("part") / FAN_IN).alias("group"))
        partial_ones = stored(grouped.applyInPandas(merged, "host string, part long, wrapper string").withColumn("part", F.floor(F.col("part") / FAN_IN)), "wrappers")
    found = stored(partial_ones.groupBy("host").applyInPandas(finished, "host string, pages long, place string, wrapper string, marked string"), "host-wrappers")
    same = constants(partials.where("key is not null").select("host", "key", "n"), found, share, least)
    return stored(found.join(same, "host", "left"), "host-templates")


def _extract(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = pa.array((main_text(*row) for row in zip(*(c.to_pylist() for c in b.columns[-3:]))), pa.string(), size=b.num_rows)
        yield pa.RecordBatch.from_arrays([*b.columns[:-3], text], names)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", share: float = CONSTANT_SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """(id, url, text, n_chars) of each page; share and least as for constants()."""
    wrappers = infer(pages, url_col, html_col, share, least).select("host", "pages", "marked", "constant")
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), host_of(f"`{url_col}`").alias("host"), F.col(f"`{html_col}`").alias("html"))
    rows = looked_up(rows, wrappers, "host", "pages", F.struct("page_id", "url")).select("page_id", "url", "html", "marked", "constant")
    kind = T.StructType([T.StructField(id_col, pages.schema[id_col].dataType), T.StructField(url_col, T.StringType()), T.StructField("text", T.StringType())])
    found = rows.mapInArrow(partial(_extract, names=kind.names), kind)
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
