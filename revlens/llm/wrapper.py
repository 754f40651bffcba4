"""Main-text extraction with wrappers inferred per host.

A page becomes a balanced token stream (inline markup dropped, implied end
tags added).  Streams of one host are aligned one after another into a
union-free regular expression: a mismatch of texts becomes a slot, siblings
that repeat become a repeated group, and what only one side has becomes an
optional group.  A slot remembers which texts every page showed so far and
how much text, and how much of it in links, it held.  From that the wrapper
tells the region with the host's varying text (``article`` and ``main`` are
the first candidates), the texts that every page shows, menus, and class
words that the text below them outvotes; extraction reads each page's blocks
through it.

Pages with the same folded stream are counted once per batch, streams are
aligned in ``CHUNKS`` parts of a host, then the parts, so a large host is
not one task's work.
"""

from __future__ import annotations

import html as htmllib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import slices, texts_of

# --- fixed values of HTML ---------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q ruby rb rt rp s "
                   "samp small span strike strong sub sup time tt u var wbr label output picture source".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dt dd "
                     "tr td th tbody thead tfoot body head html".split())
#: tag -> (tags it closes, tags that stop the search)
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
          "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
          "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "body": ({"head"}, set())}
# -----------------------------------------------------------------------------------
#: Elements that are never main text, and words of class, id or role that say so.
NOT_TEXT = frozenset("head nav footer aside form script style title textarea iframe noscript template select button "
                     "svg canvas object embed audio video dialog menu noembed noframes xmp input".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored promo promotion banner "
    "menu nav navbar navigation breadcrumb breadcrumbs pagination pager sidebar aside widget header masthead footer "
    "cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe signup login share sharing "
    "social related recommended comment comments disqus respond reply replies discussion "
    "contentinfo complementary search toolbar skip alert".split())
COMMENT_WORDS = frozenset("comment comments disqus respond reply replies discussion".split())
#: Article roots, the closest first.
ROOTS = ("article", "main")
#: A host needs so many pages before what they have in common counts.
MIN_PAGES = 5
#: Parts of a host's streams that are aligned apart.
CHUNKS = 64
#: Elements that may hold the main region, lists that may be menus.
HOLDERS = frozenset("html body div section center table tbody tr td main article form".split())
LISTS = frozenset("ul ol dl menu".split())
#: Share of the varying text that a holder needs to be the region in place of its parent.
REGION_SHARE = 0.9
#: Elements nested deeper count as part of their ancestor at this depth (wrapper only).
MAX_DEPTH = 120
#: Sibling groups of up to so many members are folded when they repeat.
MAX_GROUP = 6

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_MARK = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Za-z]+")


class Linked(str):
    """Text inside a link."""


class Node:
    """Element of a page: label (tag, tag.word if a class word speaks
    against it, tag.word~ if only a part of a class name does), children
    (nodes and texts), path of labels."""
    __slots__ = ("tag", "label", "kids", "skip", "inline", "path")

    def __init__(self, tag: str, label: str, skip: bool, inline: bool, path: str):
        self.tag, self.label, self.skip, self.inline, self.path, self.kids = tag, label, skip, inline, path, []


def _marks(attrs: str) -> tuple[set[str], bool]:
    """Words of class, id, role; whether the ones against main text are a
    whole name (``ad``, ``cookie-notice``) or of comments, so that text
    can't outvote them (``social-science``)."""
    words: set[str] = set()
    firm = False
    for _, a, b, c in _MARK.findall(attrs):
        for name in (a or b or c).split():
            parts = {w.lower() for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name))}
            words |= parts
            firm |= bool(parts) and parts <= NOT_TEXT_WORDS or bool(parts & COMMENT_WORDS)
    return words, firm


def parse(page: str) -> Node:
    """Tree of a page, whatever its markup: unknown end tags are ignored,
    open elements end with the page."""
    root = Node("#root", "#root", False, False, "")
    stack = [root]
    at, n = 0, len(page)
    link = None  # the element that an open link is in
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            tail = page[at:]
            cut = re.search(r"<[a-zA-Z/!?]", tail)  # an unfinished tag at the end
            stack[-1].kids.append(htmllib.unescape(tail[:cut.start()] if cut else tail))
            break
        if m.start() > at:
            text = htmllib.unescape(page[at:m.start()])
            stack[-1].kids.append(Linked(text) if link is stack[-1] else text)
        at = m.end()
        close, tag, attrs = (m.group(1), m.group(2), m.group(3)) if m.group(2) else m.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            link = None if close else stack[-1]
        if close:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("article", "main", "table", "body") and tag in ("p", "li", "span", "div", "td"):
                    break
            if tag == "br":
                stack[-1].kids.append(" ")
            continue
        words, firm = _marks(attrs) if "=" in attrs else (set(), False)
        bad = tag in NOT_TEXT or bool(words & NOT_TEXT_WORDS) and tag not in ("html", "body", "article", "main")
        if tag in INLINE and not bad:
            continue
        if tag == "br":
            stack[-1].kids.append(" ")
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if not stack[i].inline:
                    break
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    del stack[i:]
                elif stack[i].tag in stops:
                    break
        mark = min(words & NOT_TEXT_WORDS, default="")
        if "main" in words and tag in ("div", "section"):
            mark = "main"
        weak = bad and not firm and tag not in NOT_TEXT and mark != "main"
        label = f"{tag}.{mark}{'~' if weak else ''}" if mark else tag
        node = Node(tag, label, bad, tag in INLINE, f"{stack[-1].path}/{label}" if len(stack) <= MAX_DEPTH else "")
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(f"</{tag}", re.I).search(page, at)
            at = end.start() if end else n
            if end:
                gt = page.find(">", at)
                at = n if gt < 0 else gt + 1
        elif tag not in VOID and not attrs.endswith("/"):
            stack.append(node)
    return root


# --- wrappers: [label, flags, children or text] -------------------------------------
# flags: 1 optional, 2 repeated.  A group is ["(", flags, children], a text
# ["#", flags, text or None for a slot, {hash of a text: [pages, length]} of the
# texts that every page with the slot shows, characters, characters in links].

def _key(node) -> str:
    return "(" + ",".join(map(_key, node[2])) if node[0] == "(" else node[0]


def _merge_text(a, b, within: bool) -> list:
    """Text, hashes, characters of two text nodes: of one page (or two
    places of a wrapper) either's texts, of two pages the common ones."""
    if within:
        shown = {**a[1], **b[1]}
        for h in a[1].keys() & b[1].keys():
            shown[h] = max(a[1][h], b[1][h])
    else:
        shown = {h: [v[0] + b[1][h][0], v[1]] for h, v in a[1].items() if h in b[1]}
    return [a[0] if a[0] == b[0] else None, shown, a[2] + b[2], a[3] + b[3]]


def merge(a, b, within: bool = False):
    """Alignment of two nodes with the same key."""
    if a[0] == "#":
        return ["#", a[1] | b[1], *_merge_text(a[2:], b[2:], within)]
    return [a[0], a[1] | b[1], merge_lists(a[2], b[2], within)]


def _row(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of a and b's beginnings."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return row


def common(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, in linear space at any length
    (halves of ``a`` against the best cut of ``b``)."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, x, y = todo.pop()
        while i < j and x < y and a[i] == b[x]:
            out.append((i, x))
            i, x = i + 1, x + 1
        while i < j and x < y and a[j - 1] == b[y - 1]:
            j, y = j - 1, y - 1
            out.append((j, y))
        if i == j or x == y:
            continue
        if j - i == 1:
            hit = np.flatnonzero(b[x:y] == a[i])
            if len(hit):
                out.append((i, x + int(hit[0])))
            continue
        mid = (i + j) // 2
        cut = x + int(np.argmax(_row(a[i:mid], b[x:y]) + _row(a[mid:j][::-1], b[x:y][::-1])[::-1]))
        todo += [(i, mid, x, cut), (mid, j, cut, y)]
    return sorted(out)


def merge_lists(a: list, b: list, within: bool = False) -> list:
    """Alignment of sibling streams: longest common subsequence of keys;
    siblings that only one side has become optional."""
    ka, kb = list(map(_key, a)), list(map(_key, b))
    if ka == kb:
        return [merge(x, y, within) for x, y in zip(a, b)]
    number: dict[str, int] = {}
    codes = [np.array([number.setdefault(k, len(number)) for k in keys], np.int32) for keys in (ka, kb)]
    out, i, j = [], 0, 0
    for x, y in [*common(*codes), (len(a), len(b))]:
        out += [[n[0], n[1] | 1, *n[2:]] for n in a[i:x]] + [[n[0], n[1] | 1, *n[2:]] for n in b[j:y]]
        if x < len(a):
            out.append(merge(a[x], b[y], within))
        i, j = x + 1, y + 1
    return fold(out)


def fold(nodes: list) -> list:
    """Siblings, or groups of siblings, that repeat side by side become one
    repeated node."""
    for period in range(1, MAX_GROUP + 1):
        keys, out, i = list(map(_key, nodes)), [], 0
        while i < len(nodes):
            j = i + period
            while j + period <= len(nodes) and keys[j:j + period] == keys[i:i + period]:
                j += period
            if j > i + period and (period == 1 or len(set(keys[i:i + period])) > 1):
                group = nodes[i:i + period]
                for k in range(i + period, j, period):
                    group = [merge(x, y, True) for x, y in zip(group, nodes[k:k + period])]
                out.append([group[0][0], group[0][1] | 2, *group[0][2:]] if period == 1 else ["(", 2, group])
                i = j
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def _hash(text: str) -> str:
    return xxhash.xxh64_hexdigest(text.encode("utf-8", "surrogatepass"))


def stream(node: Node, depth: int = 0) -> list:
    """Wrapper children of one page's element."""
    out: list = []
    pending: list[str] = []

    def flush() -> None:
        text = " ".join("".join(pending).split())
        linked = sum(len(t.strip()) for t in pending if isinstance(t, Linked))
        pending.clear()
        if text:
            out.append(["#", 0, text, {_hash(text): [1, len(text)]}, len(text), min(linked, len(text))])

    todo = list(reversed(node.kids))
    while todo:
        kid = todo.pop()
        if isinstance(kid, str):
            pending.append(kid)
        elif depth >= MAX_DEPTH and not kid.skip:
            todo.extend(reversed(kid.kids))
        elif kid.tag not in ("script", "style", "template", "meta", "link"):
            flush()
            out.append([kid.label, 0, stream(kid, depth + 1)])
    flush()
    return fold(out)


def split_texts(nodes: list, texts: list) -> list:
    """The stream without its texts (which go to ``texts`` in order)."""
    out = []
    for label, flags, kids, *rest in nodes:
        if label == "#":
            texts.append([kids, *rest])
            out.append([label, flags, None])
        else:
            out.append([label, flags, split_texts(kids, texts)])
    return out


def put_texts(nodes: list, texts: Iterator) -> list:
    return [[label, flags, *next(texts)] if label == "#" else [label, flags, put_texts(kids, texts)]
            for label, flags, kids in nodes]


def describe(nodes: list) -> str:
    """The wrapper as a regular expression over tags and text slots."""
    out = []
    for label, flags, kids, *_ in nodes:
        inner = ("#" if kids is None else repr(kids)) if label == "#" else \
            describe(kids) if label == "(" else f"<{label}>{describe(kids)}</{label}>"
        out.append(f"({inner}){' ?+*'[flags]}" if flags else inner)
    return "".join(out)


class Survey:
    """What a host's wrapper says: ``paths`` of the main region (none: the
    whole page), ``same`` (path and hash) texts that every page shows,
    ``drop`` paths of menus, ``keep`` paths whose class words are outvoted."""

    def __init__(self, nodes: list, pages: int):
        self.pages = pages
        self.sure = pages >= MIN_PAGES
        self.keep: set[str] = set()
        while True:  # an outvoted element can hold another: at most as many rounds as paths
            self._measure(nodes)
            rich = {p for p, w in self.weak.items() if w > self.weight.get("", 0)}
            if not rich:
                break
            self.keep |= rich
        self.paths = self._region()
        held = tuple(f"{p}/" for p in self.paths)
        self.drop = sorted(
            p for p, (chars, link, const) in self.size.items()
            if p and p not in self.paths and not any(h.startswith(f"{p}/") for h in held)
            and (2 * (const + (0 if self.rooted else link)) >= chars > 0 and self._tag(p) in LISTS
                 or not self.rooted and 2 * link >= chars > 0 and self._tag(p) in ("div", "section")))

    @staticmethod
    def _tag(path: str) -> str:
        return path.rpartition("/")[2].partition(".")[0]

    def _measure(self, nodes: list) -> None:
        self.same: set[str] = set()
        self.size: dict[str, list[int]] = {}     # path -> characters, in links, on every page
        self.weight: dict[str, int] = {}         # path -> characters of varying text outside links
        self.weak: dict[str, int] = {}           # the same below a weak class word
        self.repeated: set[str] = set()
        self.loose: set[str] = set()             # paths with varying text of their own
        todo = [(nodes, ("",), None)]
        while todo:
            kids, above, weak = todo.pop()
            for label, flags, inner, *rest in kids:
                if label == "(":
                    self.repeated.update(f"{above[-1]}/{k[0]}" for k in inner)
                    todo.append((inner, above, weak))
                elif label == "#":
                    shown, chars, link = rest
                    always = {h: n for h, (k, n) in shown.items() if self.sure and k == self.pages}
                    const = min(chars, self.pages * sum(always.values()))
                    mine = max(0, chars - link - const)
                    self.same.update(f"{above[-1]}#{h}" for h in always)
                    if weak is not None:
                        self.weak[weak] = self.weak.get(weak, 0) + mine
                        continue
                    if mine:
                        self.loose.add(above[-1])
                    for p in above:
                        self.weight[p] = self.weight.get(p, 0) + mine
                        size = self.size.setdefault(p, [0, 0, 0])
                        for i, v in enumerate((chars, link, const)):
                            size[i] += v
                else:
                    tag, _, word = label.partition(".")
                    here = f"{above[-1]}/{label}"
                    if tag in NOT_TEXT or word and word != "main" and not word.endswith("~"):
                        continue
                    if flags & 2:
                        self.repeated.add(here)
                    under = weak or (here if word.endswith("~") and here not in self.keep else None)
                    todo.append((inner, (*above, here), under))
                    self.size.setdefault(here, [0, 0, 0])

    def _region(self) -> list[str]:
        """Article paths (else main) unless most varying text is elsewhere;
        else the deepest holder of nearly all varying text, with the
        headings and paragraphs beside it."""
        total = self.weight.get("", 0)
        for root in ROOTS:
            hits = [p for p in self.size if self._tag(p) == root or root == "main" and p.endswith(".main")]
            top = [p for p in hits if not any(p.startswith(f"{q}/") for q in hits)]
            if hits and (not self.sure or 2 * sum(self.weight.get(p, 0) for p in top) >= total):
                self.rooted = True
                return sorted(hits)
        self.rooted = False
        at, beside = "", []
        while self.sure and total:
            kids = [p for p in self.size if p.rpartition("/")[0] == at and p]
            best = max(kids, key=lambda p: self.weight.get(p, 0), default=None)
            if (best is None or at in self.loose or best in self.repeated or self._tag(best) not in HOLDERS
                    or self.weight.get(best, 0) < REGION_SHARE * self.weight.get(at, 0)):
                break
            beside += [p for p in kids if self._tag(p) not in HOLDERS]
            at = best
        return [at, *sorted(beside)] if at else []


def summarize(nodes: list, pages: int) -> tuple[list[str], list[str]]:
    """(paths of the main region, texts that every page shows)."""
    found = Survey(nodes, pages)
    return found.paths, sorted(found.same)


# --- extraction ------------------------------------------------------------------------

def blocks_of(nodes: list[Node], same: frozenset[str] = frozenset(), drop: frozenset[str] = frozenset(),
              keep: frozenset[str] = frozenset()) -> list[tuple[str, bool]]:
    """Text blocks below ``nodes`` in page order without boilerplate
    elements, each with whether every page of the host shows it."""
    out: list[tuple[str, bool]] = []
    for node in nodes:
        _blocks(node, same, drop, keep, out)
    return out


def _blocks(node: Node, same: frozenset[str], drop: frozenset[str], keep: frozenset[str],
            out: list[tuple[str, bool]]) -> None:
    pending: list[str] = []
    where = [node.path]

    def flush() -> None:
        text = " ".join("".join(pending).split())
        pending.clear()
        if text:
            out.append((text, bool(same) and f"{where[-1]}#{_hash(text)}" in same))

    end = object()
    todo: list = list(reversed(node.kids))
    heading = 0  # inside an article's own header only headings are text
    marks: list = []
    while todo:
        kid = todo.pop()
        if kid is end:
            flush()
            where.pop()
            if marks and marks[-1] == len(todo):
                marks.pop()
                heading -= 1
        elif isinstance(kid, str):
            if not heading:
                pending.append(kid)
        elif kid.skip and kid.path not in keep or kid.path in drop:
            if not kid.inline:
                flush()
        elif kid.inline:
            todo.extend(reversed(kid.kids))
        elif heading and kid.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            flush()
            inner: list[tuple[str, bool]] = []
            _blocks(kid, same, drop, keep, inner)
            if inner:
                out.append((" ".join(t for t, _ in inner), all(c for _, c in inner)))
        else:
            flush()
            where.append(kid.path)
            todo.append(end)
            if kid.tag == "header":
                marks.append(len(todo) - 1)
                heading += 1
            todo.extend(reversed(kid.kids))
    flush()


def _size(blocks: list[tuple[str, bool]]) -> int:
    return sum(len(t) for t, _ in blocks)


def _varying(blocks: list[tuple[str, bool]], rooted: bool) -> list[tuple[str, bool]]:
    """Blocks that not every page shows.  Pages that have most of an article
    in common are copies of it: their article stays whole, as does a page
    with nothing else."""
    rest = [b for b in blocks if not b[1]]
    return rest if (2 * _size(rest) >= _size(blocks) if rooted else rest) else blocks


def extract(page: str, paths: list[str], same: list[str], drop: list[str] = (), keep: list[str] = ()) -> str:
    """Main text of a page through its host's wrapper.  Of several articles
    those at least half as long as the longest count.  A page without the
    host's article gives its own, one whose region holds less than half of
    its text gives all blocks outside boilerplate."""
    root = parse(page)
    same, drop, keep, want = frozenset(same), frozenset(drop), frozenset(keep), set(paths)
    found: dict[str, list[Node]] = {r: [] for r in ROOTS}
    exact: list[Node] = []
    walk = [(iter(root.kids), False)]  # page order; of nested hits the outermost
    while walk:
        kids, inside = walk[-1]
        kid = next((k for k in kids if not isinstance(k, str) and (not k.skip or k.path in keep)), None)
        if kid is None:
            walk.pop()
            continue
        kind = "main" if kid.label.endswith(".main") else kid.tag
        hit = kid.path in want
        if hit and not inside:
            exact.append(kid)
        if kind in found:
            found[kind].append(kid)
        walk.append((iter(kid.kids), inside or hit))

    def read(nodes: list[Node]) -> list[tuple[str, bool]]:
        return blocks_of(nodes, same, drop, keep)

    def joined(blocks: list[tuple[str, bool]]) -> str:
        return "\n\n".join(t for t, _ in blocks)

    if exact:
        if any(n.tag in ROOTS or n.label.endswith(".main") for n in exact):
            each = [read([n]) for n in exact]
            longest = max(map(_size, each))
            return joined(_varying([b for e in each if 2 * _size(e) >= longest for b in e], True))
        region, whole = _varying(read(exact), False), _varying(read([root]), False)
        return joined(region if 2 * _size(region) >= _size(whole) else whole)
    for r in ROOTS:
        if found[r] and not (want and not any(Survey._tag(p) in ROOTS for p in want)):
            return joined(read(found[r][:1]))
    lost = buried(root)
    return joined(_varying(read([lost]), True) if lost else _varying(read([root]), False) or blocks_of([root], same))


def buried(root: Node) -> Node | None:
    """The first article element inside boilerplate that was never closed
    (an advert's missing end tag swallows what follows); reader comments
    are not searched."""
    todo: list = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, str) or node.tag in RAW or node.label.partition(".")[2].rstrip("~") in COMMENT_WORDS:
            continue
        if node.tag in ROOTS:
            return node
        todo.extend(reversed(node.kids))
    return None


# --- Spark -----------------------------------------------------------------------------

def host_of(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")),
                                    r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, pages, wrapper, paths, same, drop, keep``: one row per host,
    from all its pages.  A task holds one wrapper at a time; a host's last
    task aligns at most ``CHUNKS`` of them."""
    src = pages.select(host_of(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))

    def layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            seen: dict[tuple[str, str], list] = {}
            for host, page in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                texts: list = []
                shape = json.dumps(split_texts(stream(parse(page)), texts))
                old = seen.get((host, shape))
                if old is None:
                    seen[(host, shape)] = [1, texts]
                else:
                    old[0] += 1
                    old[1] = [_merge_text(x, y, False) for x, y in zip(old[1], texts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in seen], pa.string()), pa.array([s for _, s in seen], pa.string()),
                 pa.array([n for n, _ in seen.values()], pa.int64()),
                 pa.array([json.dumps(t) for _, t in seen.values()], pa.string())], names=["host", "shape", "n", "texts"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(host, part, pages, wrapper) of rows sorted by host, part, shape."""
        last, wrapper, n = None, None, 0
        for b in batches:
            for h, part, shape, k, texts in zip(*(c.to_pylist() for c in b.columns)):
                nodes = put_texts(json.loads(shape), iter(json.loads(texts)))
                if (h, part) != last and wrapper is not None:
                    yield (*last, n, wrapper)
                    wrapper, n = None, 0
                last, n = (h, part), n + k
                wrapper = nodes if wrapper is None else merge_lists(wrapper, nodes)
        if wrapper is not None:
            yield (*last, n, wrapper)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for host, part, n, wrapper in align(batches):
            texts: list = []
            shape = json.dumps(split_texts(wrapper, texts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([host], pa.string()), pa.array([part], pa.int32()), pa.array([shape]),
                 pa.array([n], pa.int64()), pa.array([json.dumps(texts)])], names=["host", "part", "shape", "n", "texts"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.string())
        for host, _, n, wrapper in align(batches):
            found = Survey(wrapper, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([host], pa.string()), pa.array([n], pa.int64()), pa.array([describe(wrapper)]),
                 pa.array([found.paths], kind), pa.array([sorted(found.same)], kind), pa.array([found.drop], kind),
                 pa.array([sorted(found.keep)], kind)],
                names=["host", "pages", "wrapper", "paths", "same", "drop", "keep"])

    part = F.pmod(F.xxhash64("shape"), F.lit(CHUNKS)).cast("int")
    rows = (src.mapInArrow(layouts, "host string, shape string, n bigint, texts string")
               .select("host", part.alias("part"), "shape", "n", "texts")
               .repartition("host", "part").sortWithinPartitions("host", "part", "shape")
               .mapInArrow(partial, "host string, part int, shape string, n bigint, texts string"))
    return (rows.repartition("host").sortWithinPartitions("host", "part")
                .select("host", F.lit(0).alias("part"), "shape", "n", "texts")
                .mapInArrow(whole, "host string, pages bigint, wrapper string, paths array<string>, "
                                   "same array<string>, drop array<string>, keep array<string>"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars``: one row per page row.

    Null and empty pages give the empty text; pages without a host share a
    wrapper; repeated rows give repeated rows.  The wrappers are stored
    first, so that the planner sees their size when it joins them."""
    wrappers = materialize(infer_wrappers(pages, url_col, html_col).select("host", "paths", "same", "drop", "keep"), "wrappers")
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                       F.col(html_col).cast("string").alias("html"), host_of(url_col).alias("of"))
    rows = (src.join(wrappers, src["of"] == wrappers["host"], "left")
               .select("page_id", "url", "html", "paths", "same", "drop", "keep"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = [extract(h, *(x or [] for x in found)) for h, *found in
                   zip(texts_of(b.column(2)), *(b.column(i).to_pylist() for i in range(3, 7)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()),
                                              pa.array(list(map(len, out)), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
