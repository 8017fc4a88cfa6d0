"""Main text of web pages by wrapper induction.

Pages of one host are grouped by layout (the set of their container elements and classes); layouts with
fewer than MIN_PAGES different pages join the most common one of their host. Each group's pages are aligned
with a reference page (the one of the group's layout with the smallest id) by simple tree matching of their
DOM trees, once each. The text that a node may always hold is found from all different pages of the group: where more than half of them
have one text, each bit of its hash is the bit that most of their hashes have, so 64 sums give it. Then all pages are compared with
it. Where at least SHARE of those that have the node and MIN_PAGES agree, a node of the reference is constant; the others vary. From the root down, the container that holds SLOT or more of the varying running text (links aside) is
entered again and again, until one is marked as article or main part, or holds such text in a heading,
paragraph or list of its own: that node is the group's slot. What lies in the slot is content, with all its headings,
paragraphs, lists and links, whether or not they are alike on all pages. Outside it, blocks in which anything varies (menus,
adverts, dates, copyright lines) go as a whole, and constant nodes go where a page has their text; what the wrapper does not
explain stays. A page that has no node in the slot's place, or a group without slot, loses the texts of the constant nodes only.

Structure cannot tell an advert, a notice or a reader's comment inside the slot from the article, so elements, classes, ids and roles that name menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments go (parameter names), and where a page marks its
article or main part, only that part counts.

A group needs MIN_PAGES pages with different markup before anything counts as template, so
copies of one page keep their text, and pages without markup do not count. References and wrappers are joined to the
pages by host and group, heavy groups in parts (see common.attach).

Edge cases: null or empty html: empty text; broken markup is closed as browsers do; text
without markup is one block; repeated rows repeat; pages without a host form a group of
their own; an empty table gives an empty result; only id, url and html are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.common import attach, cut, small_batches, table

MIN_PAGES, SHARE, KEPT_REFERENCES, SLOT = 3, 0.9, 64, 0.6
#: Matching: cells of a table that is held at once (above that, equally good matchings of a list may differ), scores and shapes that are kept, length of a
#: list that is matched without numpy.
CELLS, MEMO, SHAPES, SHORT = 50_000, 1 << 20, 1 << 17, 40

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S
)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed".split())
_RAW_END = {name: re.compile(f"</{name}", re.I | re.A) for name in _RAW}
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that show no text of the page, and those that name what is no article.
_NEVER = frozenset("head title script style noscript template textarea input iframe object embed svg canvas audio video".split())
_SKIPPED = frozenset("nav header footer aside form button select option optgroup menu dialog".split())
#: Elements that an opening tag closes if one is open.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_BARRIER = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
_NOT_TEXT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adsense|banner|sponsor(?:ed|s)?|promos?|promotions?|cookies?|consent|notices?|sidebars?|"
    r"menus?|nav|navbar|navigation|masthead|header|footer|comments?|commentlist|disqus|replies|share|sharing|social|related|"
    r"breadcrumbs?|newsletter|subscribe|popup|modal|widgets?|pagination|pager|complementary|contentinfo|search)(?=$|[\s_-])",
    re.I,
)
#: Elements that the search for the slot enters.
_ENTERED = frozenset("html body main article section div center table tbody tr td form".split())
#: Elements that make a page's layout (Java regular expression).
_CONTAINERS = "<(body|main|article|section|nav|header|footer|aside|div|table|form)"
_MAIN = re.compile(r"(?:^|\s)main(?:$|\s)", re.I)


class Node:
    __slots__ = ("tag", "label", "skip", "named", "main", "parts", "children", "shape")

    def __init__(self, tag: str, attributes: str = ""):
        named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(attributes)} if attributes else {}
        said = " ".join(named.values())
        self.tag, self.label = tag, (tag, named.get("class", ""))
        self.main = tag in ("article", "main") or bool(_MAIN.search(named.get("role", "")))
        self.skip = tag in _NEVER
        self.named = tag in _SKIPPED or (tag not in ("html", "body") and bool(said) and bool(_NOT_TEXT.search(said)))
        self.parts: list = []  # text and child nodes in page order
        self.children: list[Node] = []

    def own_text(self) -> str:
        return " ".join("".join(x if isinstance(x, str) else " " for x in self.parts).split())


def parse(markup: str) -> Node:
    """DOM tree of a page, forgiving as browsers are where tags are missing."""
    root = Node("#root")
    stack, at = [root], 0

    def text(raw: str) -> None:
        if raw:
            stack[-1].parts.append(html.unescape(raw))

    m = _TAG.search(markup)
    while m:
        text(markup[at : m.start()])
        at = m.end()
        closing, name = m[1], (m[2] or "").lower()
        if name and closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    del stack[i:]
                    break
        elif name:
            if name not in _INLINE:  # a block ends an open paragraph
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        del stack[i:]
                        break
            if name in _CLOSES:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in _BARRIER[name]:
                        break
                    if stack[i].tag in _CLOSES[name]:
                        del stack[i:]
                        break
            node = Node(name, m[3])
            stack[-1].parts.append(node)
            stack[-1].children.append(node)
            if name in _RAW:
                end = _RAW_END[name].search(markup, at)
                at = end.start() if end else len(markup)
            elif name not in _VOID and not (m[3] or "").endswith("/"):
                stack.append(node)
        m = _TAG.search(markup, at)
    text(markup[at:])
    return root


def nodes_of(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        out.append(x := stack.pop())
        stack.extend(reversed(x.children))
    return out


class _Matcher:
    """Simple tree matching of pages with a reference: labels equal, order of siblings kept, as many nodes as possible.

    Scores depend on the shape of a subtree only (its labels), so equal shapes share them, also from page to
    page. Child lists are matched in memory linear in their length; at most MEMO scores are kept, others are computed
    again.
    """

    def __init__(self, reference: Node):
        self.reference = reference
        self.forget()

    def forget(self) -> None:
        self.labels, self.kids, self.sizes = [], [], []
        self.memo: dict[tuple[int, int], int] = {}
        self.known: dict = {}
        self.learn(self.reference)

    def learn(self, tree: Node) -> None:
        """Give each node the number of its shape."""
        known, labels = self.known, self.labels
        for x in reversed(nodes_of(tree)):  # children before their parents
            kids = tuple([c.shape for c in x.children])
            k = x.shape = known.setdefault((x.label, kids), len(known))
            if k == len(labels):
                labels.append(x.label)
                self.kids.append(kids)
                self.sizes.append(1 + sum([self.sizes[c] for c in kids]))

    def align(self, page: Node) -> list[tuple[Node, Node]]:
        """Pairs of aligned nodes of a page and the reference."""
        if len(self.labels) > SHAPES:
            self.forget()
        self.learn(page)
        pairs, stack = [], [(page, self.reference)]
        while stack:
            x, y = stack.pop()
            pairs.append((x, y))
            if x.children and y.children:
                stack.extend(self.children(x, y))
        return pairs

    def _pair(self, x: int, y: int) -> Iterator:
        """Score of two shapes; yields itself as a question where it needs another matching."""
        if x == y:
            return self.sizes[x]
        if self.labels[x] != self.labels[y]:
            return 0
        if not self.kids[x] or not self.kids[y]:
            return 1
        known = self.memo.get((x, y))
        return (yield x, y) if known is None else known

    def _rows(self, xs, ys) -> Iterator:
        """All rows but the first of the matching table of two lists of shapes, one after another."""
        kinds = {k: i for i, k in enumerate(dict.fromkeys(ys))}
        where = np.array([kinds[k] for k in ys]) if len(ys) > SHORT else [kinds[k] for k in ys]
        last, scores = ([0] * (len(ys) + 1) if len(ys) <= SHORT else np.zeros(len(ys) + 1, np.int64)), {}
        for c in xs:
            if c not in scores:
                scores.clear()  # one row of scores at a time
                scores[c] = []
                for d in kinds:
                    scores[c].append((yield from self._pair(c, d)))
            s = scores[c]
            if len(ys) > SHORT:
                row = np.zeros(len(ys) + 1, np.int64)
                np.maximum.accumulate(np.maximum(last[1:], last[:-1] + np.array(s)[where]), out=row[1:])
            else:
                row, at = [0], 0
                for j, k in enumerate(where):
                    at = max(last[j + 1], at, last[j] + s[k])
                    row.append(at)
            last = row
            yield row

    def _last(self, xs, ys) -> Iterator:
        """The last row of the matching table."""
        row, steps, answer = [0] * (len(ys) + 1), self._rows(xs, ys), None
        while True:
            try:
                step = steps.send(answer)
            except StopIteration:
                return row
            if isinstance(step, tuple):
                answer = yield step
            else:
                row, answer = step, None

    def _table(self, xs, ys) -> Iterator:
        rows, steps, answer = [[0] * (len(ys) + 1)], self._rows(xs, ys), None
        while True:
            try:
                step = steps.send(answer)
            except StopIteration:
                return rows
            if isinstance(step, tuple):
                answer = yield step
            else:
                rows.append(step)
                answer = None

    @staticmethod
    def _ends(xs, ys) -> tuple[int, int]:
        """Lengths of the common prefix and of the common suffix behind it; some best matching pairs both in order."""
        n, i, j = min(len(xs), len(ys)), 0, 0
        while i < n and xs[i] == ys[i]:
            i += 1
        while j < n - i and xs[-1 - j] == ys[-1 - j]:
            j += 1
        return i, j

    def _score(self, x: int, y: int) -> Iterator:
        xs, ys = self.kids[x], self.kids[y]
        i, j = self._ends(xs, ys)
        same = sum([self.sizes[k] for k in xs[:i]]) + sum([self.sizes[k] for k in xs[len(xs) - j :]])
        xs, ys = xs[i : len(xs) - j], ys[i : len(ys) - j]
        return 1 + same + (int((yield from self._last(xs, ys))[-1]) if xs and ys else 0)

    def _answer(self, question: Iterator):
        """Result of a matching whose questions are answered from a stack, not by recursion."""
        stack, answer = [(None, question)], None
        while True:
            try:
                asked = stack[-1][1].send(answer)
                stack.append((asked, self._score(*asked)))
                answer = None
            except StopIteration as end:
                key, answer = stack.pop()[0], end.value
                if not stack:
                    return answer
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[key] = answer

    def children(self, x: Node, y: Node) -> list[tuple[Node, Node]]:
        """Pairs of aligned children, by Hirschberg's division where the table has more than CELLS cells."""
        if x.shape == y.shape:
            return list(zip(x.children, y.children, strict=True))
        xs, ys = self.kids[x.shape], self.kids[y.shape]
        i, j = self._ends(xs, ys)
        pairs = [(k, k) for k in range(i)] + [(len(xs) - 1 - k, len(ys) - 1 - k) for k in range(j)]
        parts = [(i, len(xs) - j, i, len(ys) - j)]
        while parts:
            a, b, c, d = parts.pop()
            if a == b or c == d:
                continue
            if b - a == 1 or (b - a) * (d - c) <= CELLS:
                rows, i, j = self._answer(self._table(xs[a:b], ys[c:d])), b - a, d - c
                while i and j:
                    if rows[i][j] == rows[i - 1][j]:
                        i -= 1
                    elif rows[i][j] == rows[i][j - 1]:
                        j -= 1
                    else:
                        i, j = i - 1, j - 1
                        pairs.append((a + i, c + j))
                continue
            half = (a + b) // 2
            head = np.array(self._answer(self._last(xs[a:half], ys[c:d])))
            tail = np.array(self._answer(self._last(xs[half:b][::-1], ys[c:d][::-1])))[::-1]
            cut_at = c + int(np.argmax(head + tail))
            parts += [(a, half, c, cut_at), (half, b, cut_at, d)]
        return [(x.children[i], y.children[j]) for i, j in pairs]


def align(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Pairs of aligned nodes of two trees, by simple tree matching: labels equal, order of siblings kept."""
    return _Matcher(b).align(a)


def main_text(root: Node, texts: set[int] = frozenset(), blocks_out: set[int] = frozenset(), names: bool = True, slot: Node | None = None) -> str:
    """Text blocks of a page in page order, without the own texts and the whole blocks of the nodes whose id() is given.

    The slot is no part that names leave out, and marks of the article count in it alone.
    """
    blocks: list[str] = []
    run: list[str] = []
    out = lambda x: x.skip or id(x) in blocks_out or (names and x.named and x is not slot)

    def flush() -> None:
        if block := " ".join("".join(run).split()):
            blocks.append(block)
        run.clear()

    def walk(node: Node) -> None:
        stack: list = [node]
        while stack:
            x = stack.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                run.append(x)
            elif out(x):
                flush() if x.tag not in _INLINE else run.append(" ")
            elif x.tag == "br":
                run.append(" ")
            else:
                parts = [p for p in x.parts if not isinstance(p, str)] if id(x) in texts else x.parts
                if x.tag in _INLINE:
                    stack.extend(reversed(parts))
                else:
                    flush()
                    stack.append(None)
                    stack.extend(reversed(parts))
        flush()

    inner, stack = [], [root if slot is None else slot]
    while stack:  # outermost article or main parts that are not themselves left out
        x = stack.pop()
        if out(x):
            continue
        if names and x.main:
            inner.append(x)
        else:
            stack.extend(reversed(x.children))
    for x in inner or [root]:
        walk(x)
    return "\n\n".join(blocks)


def _host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _marked(pages: DataFrame, url: str, markup: str) -> DataFrame:
    return pages.withColumn("_host", _host(F.col(url))).withColumn("_html", F.coalesce(F.col(markup), F.lit("")))


def _layout(markup: str) -> Column:
    """Signature of a page's labels: the set of its container elements and of their classes, order and number aside."""
    lower = F.lower(markup)
    tags = F.regexp_extract_all(lower, F.lit(_CONTAINERS + r"\b"), F.lit(1))
    classes = F.regexp_extract_all(lower, F.lit(_CONTAINERS + r"\b[^>]*?\sclass\s*=\s*[\"']?([^\"'>]*)"), F.lit(2))
    return F.xxhash64(F.array_sort(F.array_distinct(tags)), F.array_sort(F.array_distinct(classes)))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


class _Wrapped:
    """A reference page: its matcher and its nodes' numbers. A few are kept, as pages of many hosts alternate."""

    def __init__(self, markup: str):
        root = parse(markup)
        self.matcher, self.number = _Matcher(root), {id(n): i for i, n in enumerate(nodes_of(root))}

    @classmethod
    def of(cls, cache: dict, markup: str) -> _Wrapped:
        if markup not in cache:
            if len(cache) >= KEPT_REFERENCES:
                cache.clear()
            cache[markup] = cls(markup)
        return cache[markup]

    def align(self, page: Node) -> Iterator[tuple[int, Node]]:
        return ((self.number[id(y)], x) for x, y in self.matcher.align(page))


def _measures(root: Node) -> dict[int, tuple[int, int]]:
    """For each node of a page: characters of its subtree's text, and those in links."""
    found: dict[int, tuple[int, int]] = {}
    for x in reversed(nodes_of(root)):
        chars = linked = 0
        if not x.skip:
            for p in x.parts:
                if isinstance(p, str):
                    chars += len(p)
                else:
                    c, k = found[id(p)]
                    chars, linked = chars + c, linked + k
            if x.tag == "a":
                linked = chars
        found[id(x)] = chars, linked
    return found


_SEEN = ("node", "text", "chars", "linked")
_SEEN_TYPES = "node array<int>, text array<long>, chars array<int>, linked array<int>"


def _seen(reference: pd.Series, page: pd.Series) -> pd.DataFrame:
    """The nodes of the reference that a page has, with hashes of its own text there, and how much text and linked text lies below."""
    out, cache = [], {}
    for r, p in zip(reference, page, strict=True):
        root = parse(p)
        measured = _measures(root)
        rows = [(i, _hash(x.own_text()), *measured[id(x)]) for i, x in _Wrapped.of(cache, r).align(root)]
        out.append([np.array(c, t) for c, t in zip(zip(*rows, strict=True), (np.int32, np.int64, np.int32, np.int32), strict=True)])
    return pd.DataFrame(out, columns=list(_SEEN))


def _bit_sums(text: str) -> list[Column]:
    """For each bit of a hash, how many rows have it."""
    return [F.sum(F.shiftrightunsigned(text, i).bitwiseAND(F.lit(1).cast("long"))).alias(f"_bit{i}") for i in range(64)]


def _majority(n: str) -> Column:
    """The hash that more than half of n rows have, from their _bit_sums; any number where there is none."""
    bit = lambda i: F.when(F.col(f"_bit{i}") * 2 > F.col(n), F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long")).otherwise(F.lit(0).cast("long"))
    return F.aggregate(F.array(*map(bit, range(64))), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def slot_of(root: Node, chars: dict[int, int], linked: dict[int, int], constant: set[int]) -> tuple[int, int, list[int]] | None:
    """(slot, end, others): the node that holds the varying running text, the number behind its last descendant, and the outermost other blocks that vary.

    chars and linked: characters below each node, and those of links, over all pages; constant: nodes with one text. None where
    nothing varies, or where the text lies in no container but the page itself.
    """
    order = nodes_of(root)  # a node's descendants follow it
    number = {id(x): i for i, x in enumerate(order)}
    kids = [[number[id(c)] for c in x.children] for x in order]
    ends, running, any_ = [0] * len(order), [0] * len(order), [0] * len(order)
    for i in reversed(range(len(order))):
        ends[i] = ends[kids[i][-1]] if kids[i] else i + 1
        if i not in constant:
            own = chars.get(i, 0) - sum(chars.get(c, 0) for c in kids[i])
            plain = own - linked.get(i, 0) + sum(linked.get(c, 0) for c in kids[i])
            any_[i], running[i] = max(0, own), max(0, plain)
        any_[i] += sum(any_[c] for c in kids[i])
        running[i] += sum(running[c] for c in kids[i])
    at, entered = 0, False
    while running[at] and not order[at].main:
        apart = [c for c in kids[at] if running[c] and not (order[c].tag in _ENTERED or order[c].named or order[c].tag in _INLINE or order[c].tag == "head")]
        best = max(kids[at], key=lambda c: running[c], default=None)
        if apart or best is None or order[best].tag not in _ENTERED or running[best] < SLOT * running[at]:
            break
        at, entered = best, entered or order[best].tag not in ("html", "body")
    if not running[at] or not (entered or order[at].main):
        return None
    others, stack = [], [0]
    while stack:
        i = stack.pop()
        if i <= at < ends[i]:
            if i != at:
                stack.extend(kids[i])
        elif any_[i]:
            others.append(i)
    return at, ends[at], sorted(others)


def _slots(reference: pd.Series, nodes: pd.Series, chars: pd.Series, linked: pd.Series, constant: pd.Series) -> pd.DataFrame:
    out = []
    for r, n, c, k, f in zip(reference, nodes, chars, linked, constant, strict=True):
        n = [int(i) for i in n]
        found = slot_of(parse(r), dict(zip(n, map(int, c), strict=True)), dict(zip(n, map(int, k), strict=True)), {i for i, y in zip(n, f, strict=True) if y})
        out.append(found or (-1, -1, []))
    return pd.DataFrame(out, columns=["slot", "end", "others"])


def _prepared(pages: DataFrame, key: str, url: str, markup: str) -> DataFrame:
    rows = _marked(pages.select(key, url, markup), url, markup)
    return rows.withColumn("_layout", _layout("_html")).withColumn("_hash", F.xxhash64("_html"))


def _with_group(rows: DataFrame, layouts: DataFrame) -> DataFrame:
    on = ["_host", "_layout"]
    return attach(rows, layouts.select(*on, "_group"), on, layouts.select(*on, "n"), F.col("_hash"), size=F.octet_length("_host") + 60)


def _bytes(*arrays: str, page: bool = True) -> Column:
    """Bytes of a row with a reference page (unless it has none) and arrays of nodes."""
    own = F.octet_length("_host") + F.octet_length("reference") if page else F.octet_length("_host")
    return own + sum((F.size(a) * 40 for a in arrays), F.lit(100))


def induce(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Two tables: the group of each layout (host, layout, group, n) and the wrappers (host, group, reference, template, n)."""
    small_batches(rows.sparkSession)
    seen_of, slots = F.pandas_udf(_seen, _SEEN_TYPES), F.pandas_udf(_slots, "slot int, end int, others array<int>")
    filled = rows.filter(F.col("_html").rlike(r"\S"))
    by_page = filled.groupBy("_host", "_layout", "_hash").agg(F.count("*").alias("n"))
    layouts = cut(by_page.groupBy("_host", "_layout").agg(F.count("*").alias("kinds"), F.sum("n").alias("n")))
    hosts = layouts.groupBy("_host").agg(F.max_by("_layout", F.struct("kinds", "_layout")).alias("main"))
    group = F.when(F.col("kinds") >= MIN_PAGES, F.col("_layout")).otherwise(F.col("main"))
    layouts = cut(layouts.join(hosts, "_host").select("_host", "_layout", group.alias("_group"), "kinds", "n"))
    groups = layouts.groupBy("_host", "_group").agg(F.sum("kinds").alias("kinds"), F.sum("n").alias("n")).filter(F.col("kinds") >= MIN_PAGES)

    filled = _with_group(filled, layouts)
    references = filled.filter(F.col("_layout") == F.col("_group")).groupBy("_host", "_group").agg(
        F.min_by("_html", F.struct(F.col(key), F.col("_hash"))).alias("reference")
    )
    on = ["_host", "_group"]
    references = cut(references.join(groups, on))
    near = attach(filled, references.drop("n"), on, references.select(*on, "n"), F.col("_hash"), "inner", _bytes())
    seen = near.select(*on, "_hash", seen_of("reference", "_html").alias("a"))
    seen = cut(seen.groupBy(*on, "_hash").agg(F.first("a").alias("a")))  # copies of a page count as one
    at = seen.select(*on, F.inline(F.arrays_zip(*[F.col(f"a.{c}").alias(c) for c in _SEEN])))
    nodes = cut(at.groupBy(*on, "node").agg(F.count("*").alias("k"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), *_bit_sums("text")).select(
        *on, "node", "k", "chars", "linked", F.nullif(_majority("k"), F.lit(_hash(""))).alias("text")))
    # the reference is one of the pages and has all of its nodes, so a node's number is its place
    texts = nodes.groupBy(*on).agg(F.array_sort(F.collect_list(F.struct("node", "text"))).alias("u")).select(*on, F.col("u.node").alias("nodes"), F.col("u.text").alias("texts"))
    known = cut(references.drop("kinds").join(texts, on))
    asked = attach(seen, known.select(*on, "texts"), on, known.select(*on, "n"), F.col("_hash"), "inner", _bytes("texts", page=False))
    agreed = F.filter(F.arrays_zip(F.col("a.node").alias("node"), F.col("a.text").alias("text")), lambda x: F.get("texts", x["node"]) == x["text"])
    same = asked.select(*on, F.inline(agreed)).groupBy(*on, "node").agg(F.count("*").alias("same_text"))
    constant = (F.col("same_text") >= MIN_PAGES) & (F.col("same_text") >= F.col("k") * SHARE)
    judged = nodes.join(same, [*on, "node"], "left").withColumn("constant", F.coalesce(constant, F.lit(False)))
    found = judged.groupBy(*on).agg(F.collect_list(F.struct("node", "chars", "linked", "constant")).alias("f"))
    made = cut(known.join(found, on).withColumn("s", slots("reference", "f.node", "f.chars", "f.linked", "f.constant")))
    # the constant nodes outside the slot, with their texts
    pairs = F.filter("f", lambda x: x["constant"] & ((x["node"] < F.col("s.slot")) | (x["node"] >= F.col("s.end"))))
    said = F.transform(pairs, lambda x: F.struct(x["node"].alias("node"), F.element_at("texts", F.array_position("nodes", x["node"]).cast("int")).alias("text")))
    return layouts, cut(made.select(*on, "n", "reference", "s.slot", "s.others", said.alias("template")))


def _wrapped_text(wrapped: _Wrapped, slot: int, others: set[int], template: list, root: Node, names: bool) -> str:
    """Main text of a page without what its wrapper says is no content."""
    wanted = {t["node"]: t["text"] for t in template}
    here, texts, blocks = None, set(), set()
    for i, x in wrapped.align(root):
        if i == slot:
            here = x
        elif i in others:
            blocks.add(id(x))
        if i in wanted and _hash(x.own_text()) == wanted[i]:
            texts.add(id(x))
    return main_text(root, texts, blocks if here else frozenset(), names, here)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", markup: str = "html", names: bool = True) -> DataFrame:
    """(key, url, text) of every page; without names, only the wrappers decide what is left out."""

    @F.pandas_udf("string")
    def texts_of(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        cache: dict = {}
        for reference, slot, others, template, page in batches:
            out = []
            for r, s, o, t, p in zip(reference, slot, others, template, page, strict=True):
                root = parse(p)
                out.append(main_text(root, names=names) if t is None else _wrapped_text(_Wrapped.of(cache, r), int(s), set(map(int, o)), t, root, names))
            yield pd.Series(out, dtype=object)

    rows = _prepared(pages, key, url, markup)
    layouts, wrappers = induce(rows, key)
    small_batches(pages.sparkSession)
    joined = attach(_with_group(rows, layouts), wrappers.drop("n"), ["_host", "_group"], wrappers.select("_host", "_group", "n"), F.col("_hash"), size=_bytes("template"))
    return joined.select(key, url, texts_of("reference", "slot", "others", "template", "_html").alias("text"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
