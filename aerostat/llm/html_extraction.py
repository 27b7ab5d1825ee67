"""Main text of web pages by gradient-boosted trees over DOM nodes.

Every block element is a row of features (attribute words, kind, text and link density of its
subtree, depth, siblings); boosted trees give its chance of being article text, and a hierarchical
decoder picks the best choice of nodes in which ancestors and descendants agree.

The trees are learned here, by Spark's own learner, from a bounded set (``COMPOSED`` pages that are
put together from common parts of web pages with known roles, in sound and in broken markup, and
``SAMPLE`` pages of the table whose semantic elements tell the roles). Extraction reads every page
as a whole.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostat.llm import dom

COMPOSED = 800  # pages
SAMPLE = 200  # pages of the table, those whose hashed text is smallest
TREES = 15
DEPTH = 5
NODES = 20_000  # scored at a time

_MAIN, _REST = "mnou", "aeir"  # letters of composed words: what a word belongs to

# Common class words of page parts, for composed pages.
_PARTS = {
    "menu": "nav menu navbar main-menu breadcrumbs site-nav tabs",
    "head": "header site-header masthead top-bar page-header",
    "foot": "footer site-footer bottom copyright page-footer",
    "side": "sidebar widget-area related trending right-rail recommended side",
    "advert": "ad ads advert advertisement banner sponsored promo ad-slot",
    "notice": "notice cookie-banner consent alert newsletter subscribe popup disclaimer",
    "comment": "comments comment-list disqus replies discussion responses",
    "share": "share social tags byline share-buttons meta",
    "body": "content post entry article-body story post-content main-content text",
}


def compose(seed: int) -> str:
    """A page whose words tell by their letters whether they are article text."""
    rng = random.Random(seed)

    def chance(p: float) -> bool:
        return rng.random() < p

    def pick(options: list[str]) -> str:
        return rng.choice(options)

    def words(letters: str, n: int) -> str:
        out = ["".join(rng.choices(letters, k=rng.randrange(2, 9))) for _ in range(n)]
        for i in range(0, n, rng.randrange(5, 14)):
            out[i] += pick([".", ",", "."])
        return " ".join(out) + ("." if chance(0.7) else "")

    def mark(part: str, p: float = 0.85) -> str:
        name = pick(_PARTS[part].split())
        return f' {pick(["class", "class", "id"])}="{name}"' if chance(p) else ""

    def links(n: int) -> str:
        items = [f'<a href="/{i}">{words(_REST, rng.randrange(1, 4))}</a>' for i in range(n)]
        return f"<ul>{''.join(f'<li>{x}</li>' for x in items)}</ul>" if chance(0.7) else " ".join(items)

    def paragraphs(letters: str, n: int, broken: float = 0.0) -> str:
        out = []
        for _ in range(n):
            text = words(letters, rng.randrange(1, 90) if chance(0.8) else rng.randrange(1, 6))
            if chance(broken):
                out.append(f"<p><b>{text}<br>")
            elif chance(0.1):
                out.append(f'<p>{text} <a href="/x">{words(letters, 2)}</a> {words(letters, 3)}</p>')
            else:
                out.append(f"<p>{text}" + ("" if chance(broken) else "</p>"))
        return "".join(out)

    def block(tag: str, part: str, inside: str) -> str:
        bare = tag in ("nav", "header", "footer", "aside", "form")
        return f"<{tag}{mark(part, 0.4 if bare else 1.0)}>{inside}</{tag}>"

    def short() -> str:
        text = words(_REST, rng.randrange(3, 25))
        return text if chance(0.5) else f"<p>{text}</p>"

    def advert() -> str:
        return block(pick(["div", "div", "section", "aside"]), "advert", short())

    def notice() -> str:
        return block("div", "notice", short() + (f"<button>{words(_REST, 1)}</button>" if chance(0.4) else ""))

    def form() -> str:
        return f"<form>{words(_REST, 3)}<input><button>{words(_REST, 1)}</button></form>"

    def share() -> str:
        return block("div", "share", links(3) if chance(0.6) else words(_REST, 4))

    def comments() -> str:
        one = [block("div", "comment", paragraphs(_REST, rng.randrange(1, 3))) for _ in range(rng.randrange(1, 6))]
        if chance(0.5):
            one = [f"<li>{paragraphs(_REST, 1)}</li>" for _ in one]
        return block(pick(["div", "section", "ul", "aside"]), "comment", (f"<h3>{words(_REST, 2)}</h3>" if chance(0.5) else "") + "".join(one))

    def side() -> str:
        inside = f"<h3>{words(_REST, 2)}</h3>" + (links(rng.randrange(2, 8)) if chance(0.7) else paragraphs(_REST, 2))
        return block(pick(["aside", "div", "section"]), "side", inside)

    extras = [advert, notice, form, share, side]
    broken = pick([0.0, 0.0, 0.2])
    inner = [f"<h1>{words(_MAIN, rng.randrange(2, 10))}</h1>"] if chance(0.8) else []
    for _ in range(rng.randrange(1, 7)):
        inner.append(paragraphs(_MAIN, rng.randrange(1, 5), broken))
        more = rng.random()
        if more < 0.12:
            inner.append(f"<h2>{words(_MAIN, 3)}</h2>")
        elif more < 0.2:
            inner.append("<ul>" + "".join(f"<li>{words(_MAIN, rng.randrange(2, 20))}</li>" for _ in range(rng.randrange(2, 6))) + "</ul>")
        elif more < 0.25:
            inner.append(f"<blockquote>{paragraphs(_MAIN, 1)}</blockquote>")
        elif more < 0.29:
            inner.append("<table>" + "".join(f"<tr><td>{words(_MAIN, 2)}</td><td>{words(_MAIN, 3)}</td></tr>" for _ in range(3)) + "</table>")
        elif more < 0.33:
            inner.append(f"<figure><img src=x><figcaption>{words(_MAIN, 6)}</figcaption></figure>")
        elif more < 0.42:
            inner.append(rng.choice(extras)())
    if chance(0.15):
        inner.append(comments())
    text = "".join(inner)
    if chance(0.3):
        text = f"<div{mark('body', 0.6)}>{text}</div>"
    tag = pick(["article", "article", "main", "div", "div", "section"])
    article = f"<{tag}{mark('body', 0.3 if tag in ('article', 'main') else 0.9)}>{text}</{tag}>"
    menu = block(pick(["nav", "div", "ul"]), "menu", links(rng.randrange(2, 9)))
    top = [block(pick(["header", "div"]), "head", words(_REST, 3) + (menu if chance(0.5) else ""))] if chance(0.6) else []
    top += [menu] if chance(0.7) else []
    top += [rng.choice(extras)() for _ in range(rng.randrange(0, 3))]
    low = [comments()] if chance(0.35) else []
    low += [rng.choice(extras)() for _ in range(rng.randrange(0, 3))]
    foot = [block(pick(["footer", "footer", "div"]), "foot", (links(3) if chance(0.5) else "") + short())] if chance(0.85) else []
    middle = article + "".join(low)
    if chance(0.4):
        middle = f'<div class="{pick(["container", "wrapper", "row", "page", "layout"])}">{middle}</div>'
    end = "" if chance(0.1) else "</body></html>"
    return f"<!DOCTYPE html><html><head><title>{words(_MAIN, 3)}</title></head><body>{''.join(top)}{middle}{''.join(foot)}{end}"


def _roles(page: dom.Page, of_block) -> list[float | None]:
    """Per node 1 or 0 if all text below it has that role, else none."""
    seen: list[set[float]] = [set() for _ in page.tag]
    for b in page.blocks:
        seen[b[0]].add(of_block(b))
    for i in range(len(page.tag) - 1, 0, -1):
        seen[page.parent[i]] |= seen[i]
    return [next(iter(s)) if len(s) == 1 else None for s in seen]


def _composed_role(block: tuple[int, str, int]) -> float:
    return float(any(c in _MAIN for c in block[1]))


def _semantic_role(page: dom.Page):
    """Roles from elements that state them; none for pages without an article."""
    inside = ("article",)
    outside = ("nav", "header", "footer", "aside", "form")
    if page.tag.count("article") != 1:
        return None
    role = []
    negative = {i for i, name in enumerate(dom.TOKENS) if name != "body"}
    for tag, parent, groups in zip(page.tag, page.parent, page.groups):
        above = role[parent] if parent >= 0 else 0.0
        role.append(1.0 if tag in inside else 0.0 if tag in outside or groups & negative else above)
    return lambda block: role[block[0]]


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, roles = [], []
        for seed, html in zip(batch["seed"].to_pylist(), batch["html"].to_pylist()):
            page = dom.read(compose(seed) if html is None else html)
            of_block = _composed_role if html is None else _semantic_role(page)
            if of_block is None:
                continue
            known = _roles(page, of_block)
            for row, role in zip(dom.features(page), known):
                if role is not None:
                    rows.append(row)
                    roles.append(role)
        yield pa.RecordBatch.from_pydict({"features": pa.array(rows, pa.list_(pa.float64())), "label": pa.array(roles, pa.float64())})


class Trees:
    """A boosted model as arrays, scored for many rows at once."""

    def __init__(self, trees: list[list[tuple[int, float, int, int, float]]], weights: list[float]):
        self.trees = [[np.array(c) for c in zip(*t)] for t in trees]
        self.weights = weights

    def chance(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for (feature, limit, left, right, value), weight in zip(self.trees, self.weights):
            at = np.zeros(len(x), np.int64)
            while (inner := left[at] >= 0).any():
                go = np.where(x[rows, feature[at]] <= limit[at], left[at], right[at])
                at = np.where(inner, go, at)
            total += weight * value[at]
        return 1 / (1 + np.exp(-2 * total))


def _flat(node, out: list) -> int:
    """Append a fitted tree's node and what is below it; its place."""
    place = len(out)
    out.append(None)
    if node.subtreeDepth() == 0:
        out[place] = (0, 0.0, -1, -1, float(node.prediction()))
    else:
        split = node.split()
        left, right = _flat(node.leftChild(), out), _flat(node.rightChild(), out)
        out[place] = (int(split.featureIndex()), float(split.threshold()), left, right, 0.0)
    return place


def learn_trees(pages: DataFrame, html_col: str = "html", composed: int = COMPOSED, sample: int = SAMPLE) -> Trees:
    """Fit on composed pages and on a bounded sample of the table; null pages are left out."""
    spark = pages.sparkSession
    html = F.col(html_col)
    some = pages.select(html.alias("html")).filter(html.isNotNull()).orderBy(F.xxhash64("html"), "html").limit(sample)
    made = spark.range(composed, numPartitions=4).select(F.col("id").alias("seed"), F.lit(None).cast("string").alias("html"))
    pages = made.unionByName(some.select(F.lit(None).cast("long").alias("seed"), "html"))
    rows = pages.mapInArrow(_examples, "features array<double>, label double")
    rows = rows.select(array_to_vector("features").alias("features"), "label").coalesce(4)
    learner = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=64, seed=1, subsamplingRate=1.0)
    fitted = learner.fit(rows)
    trees = []
    for tree in fitted.trees:
        trees.append([])
        _flat(tree._java_obj.rootNode(), trees[-1])
    return Trees(trees, list(fitted.treeWeights))


def main_text(html: Column, trees: Trees) -> Column:
    """The article's text of a page, one line per block; null and empty pages have none."""

    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        out: list[str] = []
        held, size = [], 0

        def flush() -> None:
            nonlocal size
            if held:
                chance = trees.chance(np.concatenate([x for _, x in held]))
                ends = np.cumsum([len(x) for _, x in held])
                for (page, _), part in zip(held, np.split(chance, ends[:-1])):
                    out.append(dom.decode(page, part))
                held.clear()
                size = 0

        for html in pages.to_pylist():
            page = dom.read(html)
            held.append((page, dom.features(page)))
            size += len(page.tag)
            if size >= NODES:
                flush()
        flush()
        return pa.array(out, pa.string())

    return extract.asNondeterministic()(html)  # so that its columns are not computed twice
