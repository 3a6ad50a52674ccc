"""Main text of pages by minimum-cut labelling of their blocks.

A page becomes a row of text blocks with their places in the element tree.  A classifier, fitted on
a bounded sample of pages whose elements and class names label their own blocks plainly, weighs the
features of a block: its words, links and marks, and what the elements, roles and class names around
it hint at.  Its log-odds, held to a bound, are the capacities to the two terminals.  Neighbours on
the page and blocks that hang near each other in the tree are joined by smoothness edges, which
outvote a block that the classifier is not sure of.  The minimum cut, found by maximum flow, is the
labelling of least total cost; content blocks are the text.
"""

from __future__ import annotations

import html
import re
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import map_rows

#: Pages that the classifier is fitted on at most.
SAMPLE = 1000
#: Their blocks that it is fitted on at most.
SAMPLE_BLOCKS = 50_000
#: Bound of the log-odds, and weights of smoothness edges.
CLIP, NEXT, SIBLING = 4.0, 0.8, 0.5

# Comments, tags and attributes as the HTML standard reads them: an unquoted value goes up to a blank or
# ``>`` whatever it holds, and a slash closes nothing.
_VALUE = r"\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))"
_ATTRIBUTES = rf"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE.replace('([', '(?:[')})?+)*+"
_TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|</[^a-zA-Z][^>]*>|</>"
    rf"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>{_ATTRIBUTES})>",
    re.S,
)
_ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:{_VALUE})?+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Element names of HTML by how they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary "
    "table caption tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - {"body", "html", "head", "td", "th", "tr", "caption"}
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SILENT = frozenset("head script style template noscript textarea select button option iframe svg math canvas object "
                   "audio video datalist noembed noframes title xmp input".split())
# Elements and roles that hold content or something else (1: plainly), words of class and id.
CONTENT = frozenset("article main".split())
ELSE = {"nav": 1.0, "footer": 1.0, "aside": 1.0, "form": 1.0, "dialog": 1.0, "menu": 1.0, "header": 0.3}
ROLES = {"navigation": 1.0, "banner": 1.0, "contentinfo": 1.0, "complementary": 1.0, "search": 1.0, "form": 1.0,
         "dialog": 1.0, "alert": 1.0, "alertdialog": 1.0, "menu": 1.0, "menubar": 1.0, "toolbar": 1.0}
AGAINST = frozenset(
    "comment comments respond disqus reply replies ad ads advert adverts advertisement advertising sponsor sponsored "
    "promo promotion nav navbar navigation menu sidebar widget breadcrumb breadcrumbs cookie cookies consent gdpr "
    "notice notification popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations pagination pager footer copyright legal disclaimer toolbar tags tagcloud "
    "skip banner masthead".split()
)
DOUBTFUL = frozenset("header meta top bottom byline author date info topbar".split())
FOR = frozenset("article post content entry story main body text".split())


#: Elements that leave an open head open; its end tag is optional, and any other element ends it.
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())


@dataclass(frozen=True)
class Hints:
    """What the elements around a block say, each from 0 to 1."""

    content: float = 0.0
    other: float = 0.0
    against: float = 0.0
    doubtful: float = 0.0
    favour: float = 0.0

    @property
    def plain(self) -> bool:
        """Whether they speak plainly against content."""
        return max(self.other, self.against) >= 1

    def inside(self, inner: Hints) -> Hints:
        """The hints for what lies in an element within: evidence against content stays, and nothing
        inside of what is plainly something else counts as content."""
        other, against = max(self.other, inner.other), max(self.against, inner.against)
        content = 0.0 if max(other, against) >= 1 else max(self.content, inner.content)
        return Hints(content, other, against, max(self.doubtful, inner.doubtful), max(self.favour, inner.favour))


NO_HINTS = Hints()


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    #: Innermost block element, and the hints of all elements around.
    node: int = 0
    hints: Hints = NO_HINTS
    tag: str = ""
    text: str = ""


def _share(names: list[list[str]], known: frozenset[str]) -> float:
    """How far class names or ids consist of known words: 1 for a name of nothing else."""
    most = 0.0
    for words in names:
        hits = sum(w in known for w in words)
        most = max(most, 1.0 if hits == len(words) else 0.4 if hits else 0.0)
    return most


def _hints(name: str, attributes: str) -> tuple[Hints, bool]:
    """(hints, hidden) of one element."""
    content, other = float(name in CONTENT), ELSE.get(name, 0.0)
    if not attributes or attributes.isspace():
        return (Hints(content, other) if content or other else NO_HINTS), False
    hidden, names, seen = False, [], set()
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key in seen:
            continue
        seen.add(key)
        if key in ("class", "id"):
            names += [w for w in ([x.lower() for x in _WORD.findall(token)] for token in value.split()) if w]
        elif key == "role":
            role = value.strip().lower()
            content, other = max(content, float(role in CONTENT)), max(other, ROLES.get(role, 0.0))
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
    if name in ("html", "body"):
        names = []
    favour = _share(names, FOR)
    doubtful = 0.0 if favour >= 1 else _share(names, DOUBTFUL)
    return Hints(0.0 if other >= 1 else content, other, _share(names, AGAINST), doubtful, favour), hidden


def blocks_of(page: str) -> tuple[list[Block], list[int], list[int]]:
    """Blocks in page order, and parent and depth of each element of the tree."""
    parent, depth = [0], [0]
    # open elements: name, node, hints of all around, silent, inside a link
    stack: list[tuple[str, int, Hints, bool, bool]] = [("", 0, NO_HINTS, False, False)]
    opened: dict[str, int] = {}
    blocks: list[Block] = []
    current: Block | None = None

    def text(raw: str) -> None:
        nonlocal current
        if stack[-1][0] == "head" and not raw.isspace():
            close("head")
        _, _, hints, silent, link = stack[-1]
        if silent or not raw:
            return
        if current is None:
            if raw.isspace():
                return
            owner = next((e for e in reversed(stack) if e[0] in BLOCK), stack[0])
            current = Block(node=owner[1], hints=hints, tag=owner[0])
            blocks.append(current)
        value = html.unescape(raw) if "&" in raw else raw
        current.parts.append(value)
        if link:
            current.linked += len(value)

    def close(name: str) -> None:
        while stack[-1][0] != name:
            opened[stack.pop()[0]] -= 1
        opened[stack.pop()[0]] -= 1

    place, length = 0, len(page)
    while place < length:
        match = _TOKEN.search(page, place)
        if match is None:
            text(page[place:])
            break
        if match.start() > place:
            text(page[place : match.start()])
        place = match.end()
        name = match["name"]
        if name is None:
            continue
        name = name.lower()
        rest = match["rest"]
        if match["close"]:
            if name in BLOCK:
                current = None
            if opened.get(name):
                close(name)
            continue
        if opened.get("head") and (name == "body" or stack[-1][0] == "head" and name not in IN_HEAD):
            close("head")
        if name == "br":
            text(" ")
            continue
        if name in BLOCK:
            current = None
            if name in ENDS_P and opened.get("p"):
                close("p")
        for ended in SAME_ENDS.get(name, ()):
            # a list item ends the one before it, not the one around its list
            if opened.get(ended):
                for other in reversed(stack):
                    if other[0] == ended:
                        close(ended)
                        break
                    if other[0] in ("ul", "ol", "dl", "table", "select", "menu"):
                        break
        if name in VOID:
            continue
        inner, hidden = _hints(name, rest)
        _, above, around, silent, link = stack[-1]
        parent.append(above)
        depth.append(depth[above] + 1)
        total = around if inner is NO_HINTS else around.inside(inner)
        entry = (name, len(parent) - 1, total, silent or hidden or name in SILENT, link or name == "a")
        stack.append(entry)
        opened[name] = opened.get(name, 0) + 1
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, place)
            if end is None:
                break
            place = end.end()
            close(name)
    out = []
    for block in blocks:
        block.text = " ".join("".join(block.parts).split())
        if block.text:
            out.append(block)
    return out, parent, depth


#: What the weights are held to where the sample says nothing: hints count, the words of a block do not; last
#: the constant.
BEFORE = np.array([0.0] * 10 + [2.0, -4.0, -4.0, -1.0, 1.0, 0.0])


def features_of(blocks: list[Block]) -> np.ndarray:
    rows = []
    n = len(blocks)
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        size = len(b.text)
        marks = sum(b.text.count(c) for c in ".,;:!?")
        rows.append(
            (
                np.log1p(words), min(1.0, b.linked / size), marks / words, b.text[-1] in ".!?…”\"", b.tag == "p",
                b.tag in HEADINGS, b.tag in ("li", "td", "th", "dd", "dt"), size / words / 10, i / n, (n - 1 - i) / n,
                b.hints.content, b.hints.other, b.hints.against, b.hints.doubtful, b.hints.favour,
            )
        )
    return np.array(rows, dtype=float).reshape(n, len(BEFORE) - 1)


def minimum_cut(costs: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """True where a node is on the source side (content): least sum of capacities cut.

    A positive cost is the capacity from the source, a negative one that to the sink; an edge's
    capacity holds both ways.  A node whose own capacity exceeds all its edges keeps its side in
    some minimum cut, so it joins its terminal first; the rest is solved by maximum flow along
    shortest augmenting paths, in levels."""
    n = len(costs)
    own = costs.astype(float).copy()
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    side = np.zeros(n, dtype=np.int8)
    queue = deque(range(n))
    while queue:
        v = queue.popleft()
        if side[v] or abs(own[v]) < sum(near[v].values()):
            continue
        side[v] = 1 if own[v] > 0 else -1
        for u, w in near[v].items():
            del near[u][v]
            own[u] += w * side[v]
            queue.append(u)
        near[v] = {}
    free = [v for v in range(n) if not side[v]]
    if not free:
        return side > 0
    source, sink = n, n + 1
    left: dict[int, dict[int, float]] = {v: dict(near[v]) for v in free}
    left[source], left[sink] = {}, {}
    for v in free:
        if own[v] > 0:
            left[source][v], left[v][source] = own[v], 0.0
        else:
            left[v][sink], left[sink][v] = -own[v], 0.0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            v = queue.popleft()
            for u, w in left[v].items():
                if w > 1e-12 and u not in level:
                    level[u] = level[v] + 1
                    queue.append(u)
        if sink not in level:
            break
        ways = {v: list(left[v]) for v in level}
        turn = dict.fromkeys(level, 0)
        path = [source]
        while path:
            v = path[-1]
            if v == sink:
                flow = min(left[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    left[a][b] -= flow
                    left[b][a] = left[b].get(a, 0.0) + flow
                path = [source]
            elif turn[v] == len(ways[v]):
                path.pop()
                if path:
                    turn[path[-1]] += 1
            else:
                u = ways[v][turn[v]]
                if left[v][u] > 1e-12 and level.get(u, -1) == level[v] + 1:
                    path.append(u)
                else:
                    turn[v] += 1
    for v in free:
        side[v] = 1 if v in level else -1
    return side > 0


def _edges(blocks: list[Block], parent: list[int], depth: list[int]) -> list[tuple[int, int, float]]:
    out, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            a, b, steps = blocks[i - 1].node, block.node, 0
            while a != b and steps < 8:
                if depth[a] >= depth[b]:
                    a = parent[a]
                else:
                    b = parent[b]
                steps += 1
            out.append((i - 1, i, NEXT * 0.6 ** max(0, steps - 2)))
        above = parent[block.node]
        if above in last and last[above] != i - 1:
            out.append((last[above], i, SIBLING))
        last[above] = i
    return out


def main_text(page: str | None, weights: np.ndarray) -> str:
    """Content blocks of a page, joined by an empty line; '' where there are none."""
    blocks, parent, depth = blocks_of(page or "")
    if not blocks:
        return ""
    content = minimum_cut(odds_of(blocks, weights), _edges(blocks, parent, depth))
    return "\n\n".join(b.text for b, keep in zip(blocks, content) if keep)


def odds_of(blocks: list[Block], weights: np.ndarray) -> np.ndarray:
    """Log-odds that each block is content, held to the bound."""
    return np.clip(features_of(blocks) @ weights[:-1] + weights[-1], -CLIP, CLIP)


def fit(raw: np.ndarray, labels: np.ndarray, steps: int = 50) -> np.ndarray:
    """Logistic regression with classes weighted alike, by Newton steps, held to ``BEFORE``; one class
    alone gives that."""
    x = np.concatenate([raw, np.ones((len(raw), 1))], axis=1)
    weights = BEFORE.copy()
    if not len(labels) or labels.min() == labels.max():
        return weights
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / len(labels)
    ridge = 1e-3 * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (balance * (labels - p)) - ridge @ (weights - BEFORE)
        curve = (x * (balance * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train(df: DataFrame, id_col: str, html_col: str = "html", sample: int = SAMPLE) -> np.ndarray:
    """Weights fitted to at most ``SAMPLE_BLOCKS`` blocks of at most ``sample`` pages, those with the
    least hashes.  A block in what is plainly something else is labelled so, one in an article without
    any hint against it is content, and the others are passed over."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{html_col}`").alias("html")).dropna()
    picked = rows.select("id").orderBy(F.xxhash64("id"), "id").limit(sample)
    some = rows.join(F.broadcast(picked.distinct()), "id").select("html")

    def label(hints: Hints) -> int | None:
        if hints.plain:
            return 0
        return 1 if hints.content >= 1 and not max(hints.other, hints.against, hints.doubtful) else None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raws, labels = [np.empty((0, len(BEFORE) - 1))], []
        for page in batch.column(0).to_pylist():
            blocks, _, _ = blocks_of(page)
            known = [label(b.hints) for b in blocks]
            if blocks:
                raws.append(features_of(blocks)[[k is not None for k in known]])
                labels += [k for k in known if k is not None]
        whole = np.concatenate(raws)
        return pa.RecordBatch.from_arrays(
            [pa.array([r.tobytes() for r in whole], pa.binary()), pa.array(labels, pa.int32())], names=["raw", "label"]
        )

    found = map_rows(some, run, "raw binary, label int", "html")
    found = found.orderBy(F.xxhash64("raw"), "raw", "label").limit(SAMPLE_BLOCKS).collect()
    raw = np.array([np.frombuffer(r["raw"]) for r in found]).reshape(-1, len(BEFORE) - 1)
    return fit(raw, np.array([r["label"] for r in found], dtype=float))


def extract(df: DataFrame, weights: np.ndarray, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """The columns of ``df`` but the page itself, with ``text_col``.

    A null or empty page gives ''; a very long one is read whole; pages that repeat give equal texts;
    an empty table gives an empty one.  Other columns stay, whatever their names; one named
    ``text_col`` is replaced."""
    names = [c for c in df.columns if c not in (html_col, text_col)]
    rows = df.select(*(F.col(f"`{c}`") for c in names), F.col(f"`{html_col}`"))
    place = len(names)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page, weights) for page in batch.column(place).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(texts, pa.string())], names=[*names, text_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:place])
    return map_rows(rows, run, f"{schema}, `{text_col}` string" if schema else f"`{text_col}` string", html_col)
