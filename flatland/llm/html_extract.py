"""Main text of web pages by minimum-cut labelling.

A page is read into text blocks and the elements that hold them. A linear classifier gives every
block and every telling element (``nav``, ``article``, a class like ``sidebar``) a cost: what it costs to call it
content if it looks like boilerplate, and the reverse. The costs are the capacities from the source (content)
and to the sink (boilerplate). Smoothness edges join neighbouring blocks, the stronger the nearer they are
in the DOM, and every element with what it holds. The minimum cut is the cheapest labelling; blocks on the source's side are the main text.

An element that tells of boilerplate does so for all it holds: its cost grows with the prose below it, and the edges below it are
as strong as what they have to hold, so a footer of ten paragraphs goes like one of a single line. Names in class and id count by whole
tokens (``sidebar``, ``site-footer``; not ``has-sidebar`` or ``hidden-gems``), and not at all on an element that holds the article or most of the page.

Each page is a graph of its own, solved inside the task that read the page: no shuffle.

Defined cases: a null or empty page, or one without content, gives the empty text; broken
markup is read as browsers read it as far as block structure goes (unclosed elements end with
their parent, stray end tags are passed over, an unclosed comment or script runs to the end);
repeated rows give repeated results; text is taken whole at any length.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Element names by their role in HTML (fixed values).
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
_UNSEEN = frozenset("template svg canvas object noscript select datalist audio video head annotation annotation-xml".split())
_HEAD = frozenset("title meta link style script base noscript template".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img".split())
_CLOSES_P = frozenset(
    "address article aside blockquote body center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
_P_SCOPE = frozenset("table caption td th button object template html body #page".split())
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}}

#: Classifier weights (log odds of content) of elements and of words in class, id and role.
TAG_COST = {"nav": -9.0, "footer": -9.0, "aside": -8.0, "form": -8.0, "menu": -7.0, "dialog": -8.0, "button": -8.0, "fieldset": -6.0,
            "header": -6.0, "address": -2.0, "article": 7.0, "main": 4.0}
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner sponsor sponsored promo promotion promoted "
    "sidebar aside nav navbar navigation menu submenu breadcrumb breadcrumbs topbar toolbar footer foot masthead header "
    "cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations comment comments commentlist disqus respond "
    "reply replies reader discussion widget widgets pagination pager copyright legal disclaimer skip search searchbox "
    "tags tagcloud complementary contentinfo dialog hidden sr teaser outbrain taboola".split())
GOOD_WORDS = frozenset("article articlebody post story entry main content body text prose".split())
#: Words that say of a token's others that they are a state or a relation of the element, not what it is.
STATES = frozenset("has have with without no not is show shows hide hides on off enabled disabled supports allow allows".split())
#: Words that leave the others what they are.
NEUTRAL = frozenset("site page main top bottom left right box block bar area section wrapper container inner outer list item items links link button buttons "
                    "icon icons text form field content header footer the my js u c l m".split())
#: Words that tell of boilerplate only as a whole token.
ALONE = frozenset("hidden legal search reader tags foot alert teaser promo promoted recommended discussion dialog skip reply replies".split())
COMMENTS = frozenset("comment comments commentlist disqus respond".split())
BAD_COST, COMMENT_COST, GOOD_COST, HIDDEN_COST = -7.0, -7.5, 1.5, -12.0
#: Share of a page's text beyond which a name or a form says nothing about an element.
MOST_TEXT = 0.7
#: Smoothness of neighbouring blocks in one element; of an element with its parts; of a telling one
#: with its parts and of all below one that tells of boilerplate; of an element with its only block.
ADJACENT, PART, TELLING, ONLY = 0.8, 0.6, 5.0, 50.0


def _tells_bad(token: str) -> bool:
    """Whether a token of class or id names boilerplate: as a whole, or by its first or last word unless another one turns that round."""
    words = _WORD.findall(_CAMEL.sub(" ", token).lower())
    if not words or not BAD_WORDS.intersection(words):
        return False
    if len(words) == 1:
        return True
    if STATES.intersection(words):
        return False
    ends = [w for w in (words[0], words[-1]) if w in BAD_WORDS]
    return bool(ends) and (not ALONE.issuperset(ends) or all(w in BAD_WORDS or w in NEUTRAL for w in words))


def _attribute_costs(name: str, attrs: str, inside: bool) -> tuple[float, float, float]:
    """Costs of an element from its tag, from names that tell of boilerplate, and from the rest; ``inside``: within article or main."""
    tag = TAG_COST.get(name, 0.0)
    if name == "header" and inside:
        tag = 0.0               # an article's own heading
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return tag, 0.0, 0.0
    bad = good = 0.0
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role", "aria-label", "data-role", "itemprop"):
            if any(map(_tells_bad, value.split())):
                if not (name in ("body", "html", "article", "main") or name == "header" and inside):
                    bad = min(bad, COMMENT_COST if COMMENTS.intersection(_WORD.findall(value.lower())) else BAD_COST)
            elif GOOD_WORDS.intersection(_WORD.findall(_CAMEL.sub(" ", value).lower())):
                good += GOOD_COST
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or (
                key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            good += HIDDEN_COST
    return tag, bad, good


class _Page:
    """Blocks of a page and the elements above them."""

    def __init__(self, markup: str):
        self.parent: list[int] = [-1]
        self.names: list[str] = ["#page"]
        self.costs: list[tuple[float, float, float]] = [(0.0, 0.0, 0.0)]
        self.depth: list[int] = [0]
        self.blocks: list[tuple[str, int, int, str]] = []       # text, characters in links, element, name of element
        self._open: list[tuple[str, int, bool]] = [("#page", 0, False)]
        self._count = Counter({"#page": 1})         # open elements by name
        self._parts: list[str] = []
        self._linked, self._in_link = 0, False
        self._read(markup)

    def _end_block(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                name, node, _ = self._open[-1]
                self.blocks.append((text, self._linked, node, name))
            self._parts = []
        self._linked, self._in_link = 0, False

    def _text(self, s: str) -> None:
        if "&" in s:
            s = html.unescape(s)
        self._parts.append(s)
        if self._in_link:
            self._linked += len(s)

    def _read(self, markup: str) -> None:
        at, unseen, nested, math = 0, "", 0, 0      # unseen: the element whose inside is passed over
        for m in iter(_Matches(markup)):
            if not unseen and m.start() > at:
                self._text(markup[at:m.start()])
            at = m.end()
            name = m["name"]
            if name is None:
                continue
            name, closing = name.lower(), bool(m["end"])
            whole = m["attrs"].endswith("/")
            if unseen == "head":
                # The end tag may be left out: the head ends with the first tag that is none of its own.
                if closing and name != "head" or not closing and name in _HEAD:
                    continue
                unseen = ""
                if closing:
                    continue
            elif unseen:
                if name == unseen and not whole:
                    nested += -1 if closing else 1
                if nested:
                    continue
                unseen = ""
                continue
            if not closing and name in _UNSEEN:
                if not whole:
                    unseen, nested = name, 1
                continue
            if name == "math":
                math = max(0, math + (-1 if closing else 0 if whole else 1))
                continue
            if name in _INLINE or math:
                if name == "a":
                    self._in_link = not closing
                continue
            self._end_block()
            if name in _VOID or name in _RAW:
                continue
            if closing:
                self._close(name)
            else:
                self._start(name, m["attrs"])
        if not unseen and at < len(markup):
            self._text(markup[at:])
        self._end_block()

    def _cut(self, i: int) -> None:
        """Close the open elements from place i on."""
        self._count.subtract(o[0] for o in self._open[i:])
        del self._open[i:]

    def _close(self, name: str) -> None:
        if self._count[name] > 0:
            i = len(self._open) - 1
            while self._open[i][0] != name:
                i -= 1
            self._cut(i)

    def _start(self, name: str, attrs: str) -> None:
        if name in _CLOSES_P and self._count["p"] > 0:
            i = len(self._open) - 1
            while self._open[i][0] != "p" and self._open[i][0] not in _P_SCOPE:
                i -= 1
            if self._open[i][0] == "p":
                self._cut(i)
        siblings = _SIBLINGS.get(name, ())
        if any(self._count[x] > 0 for x in siblings):
            for i in range(len(self._open) - 1, 0, -1):
                if self._open[i][0] in _SCOPE.get(name, ()):
                    break
                if self._open[i][0] in siblings:
                    self._cut(i)
                    break
        _, up, inside = self._open[-1]
        self.parent.append(up)
        self.depth.append(self.depth[up] + 1)
        self.names.append(name)
        self.costs.append(_attribute_costs(name, attrs, inside))
        if not attrs.endswith("/"):
            self._open.append((name, len(self.parent) - 1, inside or name in ("article", "main")))
            self._count[name] += 1


class _Matches:
    """Tags of a page; after the start tag of a raw-text element the next one is its end."""

    def __init__(self, markup: str):
        self.markup = markup

    def __iter__(self) -> Iterator[re.Match]:
        at, find = 0, _TAG.search
        while m := find(self.markup, at):
            at = m.end()
            name = m["name"]
            if name is not None and not m["end"] and name.lower() in _RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)|\Z", re.I).search(self.markup, at)
                whole = re.compile(r"(?s).*").match(self.markup, m.start(), end.end())
                yield _Skipped(whole.start(), whole.end())
                at = max(end.end(), at)
            else:
                yield m
            if at >= len(self.markup):
                return


class _Skipped:
    """A stretch of markup that holds no text."""

    def __init__(self, start: int, end: int):
        self._span = start, end

    def start(self) -> int:
        return self._span[0]

    def end(self) -> int:
        return self._span[1]

    def __getitem__(self, _: str) -> None:
        return None


def block_cost(text: str, linked: int, name: str) -> float:
    """Log odds that a block is content, from its own text."""
    words = text.count(" ") + 1
    share = min(1.0, linked / len(text))
    cost = -0.6 + min(words, 40) * 0.05 - 3.0 * share
    if text[-1] in ".!?…。！？\"'”»)" and words > 3:
        cost += 0.5
    if name in ("p", "blockquote", "pre"):
        cost += 0.6
    elif name in ("h1", "h2", "h3", "figcaption", "td", "dd"):
        cost += 0.5
    elif name == "li" and share > 0.5:
        cost -= 1.0
    if text[0] == "©" or text[:9].lower() == "copyright":
        cost -= 4.0
    return cost


def min_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source's side of the minimum cut (Dinic's algorithm without recursion)."""
    n = len(costs)
    source, sink = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(u: int, v: int, there: float, back: float) -> None:
        out[u].append(len(to))
        to.append(v)
        cap.append(there)
        out[v].append(len(to))
        to.append(u)
        cap.append(back)

    for v, c in enumerate(costs):
        if c > 0:
            join(source, v, c, 0.0)
        elif c < 0:
            join(v, sink, -c, 0.0)
    for u, v, w in edges:
        join(u, v, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        place = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(cap[e] for e in path)
                cut = 0
                for i, e in enumerate(path):
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                    if cap[e] <= tiny and not cut:
                        cut = i + 1
                u = to[path[cut - 1] ^ 1]
                del path[cut - 1:]
                continue
            while place[u] < len(out[u]):
                e = out[u][place[u]]
                if cap[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                place[u] += 1
            if place[u] < len(out[u]):
                path.append(out[u][place[u]])
                u = to[path[-1]]
            elif path:
                u = to[path.pop() ^ 1]
                place[u] += 1
            else:
                break


def _element_costs(page: _Page, costs: list[float]) -> list[float]:
    """Cost of each element; one that tells of boilerplate outweighs the prose it holds."""
    n = len(page.parent)
    chars, prose, holds = [0] * n, [0.0] * n, [False] * n       # text below; its costs above 0; whether an article is below
    for (text, _, element, _), cost in zip(page.blocks, costs):
        chars[element] += len(text)
        prose[element] += max(0.0, cost)
    for x in range(n - 1, 0, -1):                               # children come after their parents
        up = page.parent[x]
        chars[up] += chars[x]
        prose[up] += prose[x]
        holds[up] |= holds[x] or page.names[x] in ("article", "main")
    out = []
    for x in range(n):
        tag, bad, rest = page.costs[x]
        if holds[x] or chars[x] > MOST_TEXT * chars[0]:
            # The article's own frame: a name says nothing here, nor do a form or menu around the whole page. Comments may be longer than their article.
            bad = bad if bad <= COMMENT_COST and not holds[x] else 0.0
            tag = 0.0 if page.names[x] in ("form", "fieldset", "menu", "dialog") else tag
        cost = tag + bad + rest
        out.append(cost - prose[x] if cost <= TELLS and not holds[x] else cost)
    return out


#: From this cost on an element speaks for all that it holds.
TELLS = -5.0


def page_graph(markup: str) -> tuple[list[str], list[float], list[tuple[int, int, float]]]:
    """Texts of the blocks; costs of all nodes (the blocks first, then the elements above them); edges."""
    page = _Page(markup)
    blocks = page.blocks
    costs = [block_cost(text, linked, name) for text, linked, _, name in blocks]
    if not blocks:
        return [], [], []
    element_costs = _element_costs(page, costs)
    number: dict[int, int] = {}
    edges: list[tuple[int, int, float]] = []
    holds = Counter(b[2] for b in blocks)
    parts = Counter(page.parent)            # elements directly within
    n = len(page.parent)
    below = [False] * n                     # within an element that tells of boilerplate
    mass = [0.0] * n                        # what the elements' edges upwards have to hold
    for i, (_, _, element, _) in enumerate(blocks):
        mass[element] += abs(costs[i])
    for x in range(n - 1, 0, -1):
        mass[page.parent[x]] += mass[x] + abs(element_costs[x])
    for x in range(1, n):
        below[x] = element_costs[x] < -PART or below[page.parent[x]]

    def weight_to(element: int, held: float) -> float:
        if below[element]:
            return max(TELLING, held + 1.0)
        return TELLING if element_costs[element] else PART

    def node_of(element: int) -> int:
        if element not in number:
            number[element] = len(costs)
            costs.append(element_costs[element])
            up = page.parent[element]
            if up >= 0:
                # What tells of boilerplate is no part of a parent that does not.
                apart = element_costs[element] < -PART and not below[up]
                edges.append((number[element], node_of(up), PART if apart else weight_to(up, mass[element])))
        return number[element]

    for i, (_, _, element, _) in enumerate(blocks):
        chain = []
        while element not in number and element >= 0:
            chain.append(element)
            element = page.parent[element]
        for x in reversed(chain):
            node_of(x)
        element = blocks[i][2]
        if holds[element] == 1 and not parts[element]:
            weight = ONLY
        else:
            weight = weight_to(element, abs(costs[i]))
        edges.append((i, number[element], weight))
        if i:
            a, b, apart = blocks[i - 1][2], element, 0
            while a != b:
                if page.depth[a] >= page.depth[b]:
                    a = page.parent[a]
                else:
                    b = page.parent[b]
                apart += 1
            edges.append((i - 1, i, ADJACENT / (1 + apart)))
    return [b[0] for b in blocks], costs, edges


def main_text(markup: str | None) -> tuple[str, int, int]:
    """Main text of a page, its blocks and how many of them are content."""
    texts, costs, edges = page_graph(markup) if markup else ([], [], [])
    if not texts:
        return "", 0, 0
    side = min_cut(costs, edges)
    kept = [t for t, s in zip(texts, side) if s]
    return " ".join(kept), len(texts), len(kept)


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points), n_blocks and n_content of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([t for t, _, _ in found], pa.string()),
                pa.array([len(t) for t, _, _ in found], pa.int64()), pa.array([b for _, b, _ in found], pa.int32()),
                pa.array([k for _, _, k in found], pa.int32())], names=["page_id", "url", "text", "n_chars", "n_blocks", "n_content"])

    cols = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{markup}`").cast("string").alias("html"))
    kind = cols.schema["page_id"].dataType.simpleString()
    return cols.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, n_blocks int, n_content int")
