"""Operator 5: main text of web pages by a tree-structured graphical model.

A page becomes a tree: block elements, and under them the runs of text between block
boundaries. Each node has a hidden label, article or not. The model has a potential per
node (its tag, the words of its class and id, text and link lengths) and one per
parent-child pair; sum-product messages go up the tree and down again, which gives
each run its exact marginal. Potentials are smoothed log frequencies counted over labelled
pages. Runs with a marginal of at least one half are the text, in page order.

Scripts, styles, comments, the head and other parts that are not rendered never enter
the tree. Defined results: null and empty html, and pages without an article, give an
empty text; broken, unclosed or deeply nested markup is read as far as it goes; pages of
any length are read whole; rows are judged one by one, so repeated rows agree; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayload.llm.chunked import text_slices
from quayload.llm.html_training import labelled_pages
from quayload.llm.registry import llm_query
from quayload.plans.registry import table

# Element names by their role in the HTML standard.
BLOCKS = frozenset(
    "html body div section article main aside header footer nav p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody "
    "tfoot tr td th caption form fieldset legend label button select option textarea figure figcaption blockquote pre "
    "address details summary dialog hr menu center".split()
)
HIDDEN = frozenset("script style head title noscript template iframe svg math object canvas audio video textarea select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag on the left ends an open element on the right, up to the nearest boundary.
ENDS = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "option": {"option"},
    "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
LISTS = frozenset("ul ol dl table menu".split())
NO_PARAGRAPH = BLOCKS - frozenset("label button option legend td th tr tbody tfoot thead caption html body".split())

MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
LABEL = re.compile(r"""\bdata-y="([01])\"""")
NAME_PART = re.compile(r"[a-z]+")


@dataclass
class Tree:
    """Nodes in page order, parents before children; a run has its text, an element has none."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    size: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, attributes: str = "", text: str | None = None, linked: int = 0) -> int:
        for column, value in (
            (self.parent, parent), (self.tag, tag), (self.attributes, attributes), (self.text, text),
            (self.size, len(text or "")), (self.linked, linked),
        ):
            column.append(value)
        return len(self.parent) - 1


def _kind(name: str) -> str:
    """What an end tag closes: a heading of any level, else an element of its own name."""
    return "h" if re.fullmatch("h[1-6]", name) else name


def parse(page: str) -> Tree:
    """The tree of one page, in time that follows its length whatever is left open or closed twice."""
    tree = Tree()
    open_nodes = [tree.add(-1, "html")]
    # How many elements of a kind are open below the root, and hidden elements that nothing closes any more.
    open_kinds: Counter[str] = Counter()
    unclosed: set[str] = set()
    last_end = page.rfind(">")
    pieces: list[str] = []
    linked = in_link = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            tree.add(open_nodes[-1], "#text", "", text, linked)
        pieces.clear()
        linked = 0

    while at < end:
        found = page.find("<", at)
        if found < 0:
            found = end
        if found > at:
            text = html.unescape(page[at:found])
            pieces.append(text)
            linked += len(text) if in_link else 0
            at = found
            continue
        match = MARKUP.match(page, at) if at < last_end or page.startswith("<!--", at) else None
        if match is None:
            if at > last_end and re.match(r"</?[a-zA-Z]", page[at : at + 3]):
                break  # cut off inside a tag
            pieces.append("<")
            at += 1
            continue
        at = match.end()
        closing, name, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if name is None:
            continue
        name = name.lower()
        if name in HIDDEN:
            if not closing and not attributes.endswith("/"):
                close = None if name in unclosed else re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                if close:
                    at = close.end()
                    continue
                unclosed.add(name)
                if name not in ("head", "noscript", "object"):
                    break
            continue
        if name == "a":
            in_link = not closing
        elif name in ("br", "img", "input"):
            pieces.append(" ")
        if name not in BLOCKS:
            continue
        flush()
        in_link = 0
        if name in VOID or name == "html":
            continue
        if closing:
            # Without an open one there is nothing to look for; else all above it are closed with it.
            while open_kinds[_kind(name)]:
                closed = _kind(tree.tag[open_nodes.pop()])
                open_kinds[closed] -= 1
                if closed == _kind(name):
                    break
            continue
        ended = ENDS.get(name, {"p"} if name in NO_PARAGRAPH else set())
        while len(open_nodes) > 1 and tree.tag[open_nodes[-1]] in ended and tree.tag[open_nodes[-1]] not in LISTS:
            open_kinds[_kind(tree.tag[open_nodes.pop()])] -= 1
        open_nodes.append(tree.add(open_nodes[-1], name, attributes))
        open_kinds[_kind(name)] += 1
    flush()
    for i in range(len(tree.parent) - 1, 0, -1):
        tree.size[tree.parent[i]] += tree.size[i]
        tree.linked[tree.parent[i]] += tree.linked[i]
    return tree


def _bucket(value: float, bounds: tuple[float, ...]) -> int:
    return sum(value >= b for b in bounds)


def features(tree: Tree, i: int) -> list[str]:
    """Discrete observations of one node."""
    size, tag = tree.size[i], tree.tag[i]
    out = [f"size:{_bucket(size, (1, 12, 40, 120, 400, 1500))}:{tag == '#text'}"]
    if size:
        out.append(f"link:{_bucket(tree.linked[i] / size, (0.01, 0.3, 0.7, 0.95))}")
    if tree.text[i] is not None:
        text = tree.text[i]
        out.append(f"ends:{text[-1] in '.!?…'}")
        if "©" in text:
            out.append("copyright")
        return out
    out.append(f"tag:{tag}")
    names: set[str] = set()
    if tree.attributes[i]:
        for _, value in ATTRIBUTE.findall(tree.attributes[i]):
            names |= set(NAME_PART.findall(value.lower()))
    out += [f"name:{n}" for n in sorted(names)]
    return out


@dataclass(frozen=True)
class Model:
    """Log potentials: per observation (article minus other), per edge kind and label pair, and of the root."""

    node: dict[str, float]
    edge: dict[str, tuple[tuple[float, float], tuple[float, float]]]
    root: tuple[float, float]


def _labels(tree: Tree) -> list[int]:
    """Labels of a training page: data-y is inherited; other elements are article if all their text is."""
    n = len(tree.parent)
    given = [-1] * n
    for i in range(n):
        mark = LABEL.search(tree.attributes[i]) if tree.attributes[i] else None
        given[i] = int(mark[1]) if mark else (given[tree.parent[i]] if i else -1)
    inside = [0] * n
    for i in range(n - 1, -1, -1):
        inside[i] += tree.size[i] if tree.text[i] is not None and given[i] == 1 else 0
        if i:
            inside[tree.parent[i]] += inside[i]
    return [g if g >= 0 else int(0 < tree.size[i] == inside[i]) for i, g in enumerate(given)]


#: Elements whose label depends on the parent's in a way of their own.
EDGES = frozenset("#text p li div section aside nav form header footer ul ol".split())


def _edge(tree: Tree, i: int) -> str:
    return tree.tag[i] if tree.tag[i] in EDGES else "other"


def train(pages: list[str], smoothing: float = 0.5) -> Model:
    """Counts over labelled pages as potentials."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    edges: Counter = Counter()
    roots, nodes = [smoothing, smoothing], [0, 0]
    for page in pages:
        tree = parse(page)
        labels = _labels(tree)
        roots[labels[0]] += 1
        for i, label in enumerate(labels):
            nodes[label] += 1
            seen[label].update(features(tree, i))
            if i:
                edges[_edge(tree, i), labels[tree.parent[i]], label] += 1
    total = lambda y: nodes[y] + 2 * smoothing
    node = {
        f: math.log((seen[1][f] + smoothing) / total(1)) - math.log((seen[0][f] + smoothing) / total(0))
        for f in seen[0] | seen[1]
    }
    edge = {}
    for kind in {k for k, _, _ in edges}:
        rows = []
        for above in (0, 1):
            counts = [edges[kind, above, y] + smoothing for y in (0, 1)]
            rows.append((math.log(counts[0] / sum(counts)), math.log(counts[1] / sum(counts))))
        edge[kind] = tuple(rows)
    return Model(node, edge, (math.log(roots[0] / sum(roots)), math.log(roots[1] / sum(roots))))


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    high = a if a > b else b
    return high + math.log1p(math.exp(-abs(a - b)))


#: Known class names and tags say more than lengths do, but no single node may outweigh the tree.
NODE_LIMIT = 8.0


def marginals(tree: Tree, model: Model) -> list[float]:
    """The probability of every node to be article, by messages up and down the tree."""
    n = len(tree.parent)
    flat = ((math.log(0.5),) * 2,) * 2
    up = [[0.0, 0.0] for _ in range(n)]
    message = [(0.0, 0.0)] * n
    tables = [model.edge.get(_edge(tree, i), model.edge.get("other", flat)) for i in range(n)]
    for i in range(n - 1, -1, -1):
        score = sum(model.node.get(f, 0.0) for f in features(tree, i))
        own = up[i]
        own[1] += max(-NODE_LIMIT, min(NODE_LIMIT, score))
        if i:
            t = tables[i]
            message[i] = (_add(t[0][0] + own[0], t[0][1] + own[1]), _add(t[1][0] + own[0], t[1][1] + own[1]))
            above = up[tree.parent[i]]
            above[0] += message[i][0]
            above[1] += message[i][1]
    belief = [[0.0, 0.0] for _ in range(n)]
    out = [0.0] * n
    for i in range(n):
        if i == 0:
            down = model.root
        else:
            # What the parent believes without this child.
            rest = (belief[tree.parent[i]][0] - message[i][0], belief[tree.parent[i]][1] - message[i][1])
            t = tables[i]
            down = (_add(rest[0] + t[0][0], rest[1] + t[1][0]), _add(rest[0] + t[0][1], rest[1] + t[1][1]))
        b0, b1 = up[i][0] + down[0], up[i][1] + down[1]
        level = max(b0, b1)
        belief[i] = [b0 - level, b1 - level]
        out[i] = 1 / (1 + math.exp(min(700.0, b0 - b1)))
    return out


def main_text(page: str, model: Model) -> str:
    """The article's blocks, joined by an empty line."""
    tree = parse(page)
    return "\n\n".join(t for t, p in zip(tree.text, marginals(tree, model), strict=True) if t is not None and p >= 0.5)


def extract(df: DataFrame, model: Model, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` and ``text`` of every page."""
    rows = df.select(*keep, F.coalesce(F.col(html_column), F.lit("")).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_html"):
                texts = [main_text(page, model) for page in part.column("_html").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(texts, pa.string())], [*keep, "text"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{kinds}, text string")


@llm_query("op5_html_extract")
def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages"), train(labelled_pages()))
    return out.withColumn("n_chars", F.length("text").cast("long"))
