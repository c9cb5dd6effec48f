"""Main text of HTML pages by a tree-structured graphical model.

A page is a tree of elements, each content or not. Potentials join an element with its parent (how
often content stands in content, and so on) and with what is seen of it: its tag, the words of its
class and id, how much of its text is in links, how long its text is. Messages are passed from the
leaves to the root and back (sum-product), which gives every element's exact marginal probability of
being content. The text of elements with a marginal above one half is kept.

Training: the parent-child and observation tables are counted over labelled pages, at most
``most_pages`` of them, chosen by a hash of their key. A page is labelled by its own ``article`` or
``main`` element: what is in it is content, but for the elements that never are. Tags and class words
that a page may use although no labelled page did have prior counts (``BOILERPLATE``).

Text inside a block has its white space made one space; blocks are joined by one space in page order;
character references are decoded; scripts, styles and comments are no text.

Cases: null and empty html gives an empty text; so does a page without content. Markup that is not
closed, or closed twice, is read as browsers do in the simple cases (a new paragraph closes the last).
Pages of any length and depth are read whole, without recursion. Repeated rows are extracted each.
Without labelled pages only the prior counts speak. Extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.arrays import column_of, gathered

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
SILENT = frozenset("script style noscript template head title iframe object svg canvas textarea select option button".split())
CLOSES = {"p": frozenset({"p"}), "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}), "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}), "option": frozenset({"option"})}
#: Blocks that end a paragraph left open.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())
#: Tags and class words of what is not main text, and of what is, with prior weight.
BOILERPLATE = frozenset("nav header footer aside form menu dialog".split())
BAD_WORDS = frozenset("ad ads advert advertisement banner breadcrumb comment comments consent cookie disqus footer header login menu modal nav navbar newsletter notice pagination popup promo related reply share sidebar social sponsor sponsored subscribe widget".split())
GOOD_WORDS = frozenset("article body content entry main post story text".split())
_WEIGHT = 400.0


class Tree(HTMLParser):
    """Elements of a page as arrays: parents stand before their children."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.marks = ["#root"], [-1], [()]
        self.texts: list[tuple[int, int, str]] = []  # (element, block, text)
        self.open, self.block, self.blocks = [0], 0, 0
        self.silent = 0
        self.feed(html)
        self.close()

    def _shut(self, depth: int) -> None:
        while len(self.open) > depth:
            if self.tag[self.open.pop()] in SILENT:
                self.silent -= 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.blocks += tag != "br"
            closed = CLOSES.get(tag, frozenset({"p"}) if tag in ENDS_P else frozenset())
            for depth in range(len(self.open) - 1, 0, -1) if closed else ():
                name = self.tag[self.open[depth]]
                if name in closed:
                    self._shut(depth)
                elif name not in INLINE:
                    break
        if tag == "br":
            self.texts.append((self.open[-1], self.blocks, " "))
            return
        marks = " ".join(value or "" for name, value in attrs if name in ("class", "id", "role")).lower()
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.marks.append(tuple(set(re.findall(r"[a-z]+", marks))) if marks else ())
        if tag not in VOID:
            self.open.append(len(self.tag) - 1)
            self.silent += tag in SILENT

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.blocks += 1
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[depth]] == tag:
                self._shut(depth)
                return
            if tag in INLINE and self.tag[self.open[depth]] not in INLINE:
                return  # closes nothing in this block

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.texts.append((self.open[-1], self.blocks, data))

    def observed(self) -> list[list[str]]:
        """What is seen of each element, as keys of the observation table."""
        n = len(self.tag)
        length, linked = [0] * n, [0] * n
        for element, _, text in self.texts:
            length[element] += len(text.strip())
        for i in range(n - 1, 0, -1):
            if self.tag[i] == "a":
                linked[i] = length[i]
            length[self.parent[i]] += length[i]
            linked[self.parent[i]] += linked[i]
        return [
            [f"tag:{self.tag[i]}", *(f"mark:{x}" for x in self.marks[i]),
             f"links:{linked[i] * 4 // length[i] if length[i] else 'none'}", f"length:{min(10, int(length[i]).bit_length())}"]
            for i in range(n)
        ]

    def labels(self) -> list[int] | None:
        """1 for elements of the article, by the page's own markup; None for a page without one."""
        if "article" not in self.tag and "main" not in self.tag:
            return None
        wanted = "article" if "article" in self.tag else "main"
        out = [0] * len(self.tag)
        for i in range(1, len(self.tag)):
            bad = self.tag[i] in BOILERPLATE or self.tag[i] in SILENT or any(x in BAD_WORDS for x in self.marks[i])
            out[i] = int((self.tag[i] == wanted or out[self.parent[i]] == 1) and not bad)
        return out


class Potentials:
    """Log potentials from counts; an observation never counted says nothing."""

    def __init__(self, counts: dict[str, tuple[float, float]]) -> None:
        self.pair = [[math.log((counts.get(f"child:{a}", (0, 0))[b] + 5) / (sum(counts.get(f"child:{a}", (0, 0))) + 10)) for b in (0, 1)] for a in (0, 1)]
        total = [sum(n[s] for key, n in counts.items() if key.startswith("tag:")) + 1 for s in (0, 1)]
        self.seen = {}
        keys = {*counts, *(f"tag:{x}" for x in BOILERPLATE), *(f"mark:{x}" for x in BAD_WORDS | GOOD_WORDS)}
        for key in keys:
            if key.startswith("child:"):
                continue
            bad, good = counts.get(key, (0, 0))
            kind, _, name = key.partition(":")
            share = [(bad + 0.5) / total[0], (good + 0.5) / total[1]]
            odds = math.log(share[1] / share[0]) if bad + good else 0.0
            if (kind == "tag" and name in BOILERPLATE) or (kind == "mark" and name in BAD_WORDS):
                odds = min(odds, -math.log(_WEIGHT))
            elif kind == "mark" and name in GOOD_WORDS and not bad + good:
                odds = 1.0
            self.seen[key] = odds / 2 if kind in ("links", "length") else odds  # these two depend on each other

    def marginals(self, tree: Tree) -> list[float]:
        """P(content) of each element, by messages up to the root and down again."""
        n = len(tree.tag)
        own = [[0.0, sum(self.seen.get(key, 0.0) for key in keys)] for keys in tree.observed()]
        own[0][1] -= 20.0  # the root is no content
        up = [[0.0, 0.0] for _ in range(n)]  # what a child tells its parent
        heard = [list(x) for x in own]
        pair = self.pair
        for i in range(n - 1, 0, -1):
            a, b = heard[i]
            for s in (0, 1):
                x, y = pair[s][0] + a, pair[s][1] + b
                high = max(x, y)
                up[i][s] = high + math.log1p(math.exp(min(x, y) - high))
            parent = heard[tree.parent[i]]
            parent[0] += up[i][0]
            parent[1] += up[i][1]
        belief = heard  # becomes own + all messages, parents first
        out = [0.0] * n
        for i in range(n):
            if i:
                parent = belief[tree.parent[i]]
                c, d = parent[0] - up[i][0], parent[1] - up[i][1]
                for s in (0, 1):
                    x, y = pair[0][s] + c, pair[1][s] + d
                    high = max(x, y)
                    belief[i][s] += high + math.log1p(math.exp(min(x, y) - high))
            out[i] = 1 / (1 + math.exp(max(-700.0, min(700.0, belief[i][0] - belief[i][1]))))
        return out


def main_text(html: str | None, model: Potentials) -> str:
    tree = Tree(html or "")
    marginal = model.marginals(tree)
    blocks: dict[int, list[str]] = {}
    for element, block, text in tree.texts:
        if marginal[element] > 0.5:
            blocks.setdefault(block, []).append(text)
    return " ".join(x for x in (" ".join("".join(parts).split()) for parts in blocks.values()) if x)


def train(pages: DataFrame, most_pages: int = 2_000) -> Potentials:
    """Counts over labelled pages; the sample is chosen by the hash of page_id."""
    parts = max(1, math.ceil(pages.count() / most_pages))
    sample = pages.where(F.pmod(F.xxhash64("page_id"), F.lit(parts)) == 0).select(F.col("html").cast("string").alias("html"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: Counter[tuple[str, int]] = Counter()
        for rows in gathered(batches, "html", 1 << 22):
            for html in column_of(rows, "html").to_pylist():
                tree = Tree(html or "")
                labels = tree.labels()
                for i, keys in enumerate(tree.observed() if labels else ()):
                    out.update((key, labels[i]) for key in keys)
                    if i:
                        out[f"child:{labels[tree.parent[i]]}", labels[i]] += 1
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.string()), pa.array([s for _, s in out], pa.int32()), pa.array(out.values(), pa.int64())], names=["seen", "state", "n"])

    # Keys of a bounded sample: tags and class words of at most most_pages pages.
    rows = sample.mapInArrow(counted, "seen string, state int, n long").groupBy("seen").agg(
        F.sum(F.when(F.col("state") == 0, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("state") == 1, F.col("n")).otherwise(0)).alias("good")
    ).collect()
    return Potentials({row["seen"]: (row["bad"], row["good"]) for row in rows})


def extract(pages: DataFrame, model: Potentials) -> DataFrame:
    """page_id, url, text and n_chars of every page; one pass, no shuffle."""
    shipped = pages.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, "html", 1 << 22):
            texts = [main_text(x, shipped.value) for x in column_of(rows, "html").to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column("page_id").combine_chunks(), rows.column("url").combine_chunks(), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kinds = {x: pages.schema[x].dataType.simpleString() for x in ("page_id", "url")}
    return (
        pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
        .mapInArrow(read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
        .withColumn("n_chars", F.length("text").cast("long"))
    )
