"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: a node is the chain of tags and classes that leads to it. A node is
important if its pages show different things there. For content that is one minus the mean entropy of its text blocks
over the host's pages (a block on every page has entropy one, a block on one page has none), for presentation it is the
entropy of the sets of children it is given; a branch combines its own presentation with the importance of what is
below. Branches of low importance are cut from every page of the host, as are elements whose tag, role or class names
them as menus, adverts and the like. What is left inside the article is the main text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.arrays import slices
from tidegauge.session import cut_lineage

#: A branch below this importance is cut; so many pages of full importance are added to what a host shows.
LEAST, PRIOR_PAGES, DAMPING = 0.4, 4, 0.9

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*(?:>|\Z))", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW = frozenset("script style noscript template textarea title iframe svg math object canvas xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
_ENDS_P = _BLOCK - frozenset("body head html td th tr tbody thead tfoot caption option optgroup legend summary".split())
_ENDS = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
    "th": ("td th", "tr table"), "option": ("option", "select"), "body": ("head", "html"), "tbody": ("tbody thead tfoot tr td th", "table"),
}
_ENDS = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in _ENDS.items()}
_CONTENT = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table tbody thead tr td th figure figcaption hgroup".split())
_AWAY_TAGS = frozenset("nav footer aside form dialog menu button select head input".split())
_AWAY_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
_AWAY_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar "
    "sidebar footer masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notices popup overlay modal newsletter subscribe "
    "share sharing social comment comments disqus reply replies respond related recommended widget toolbar pagination pager copyright "
    "login signin signup search skip topbar bottombar legal disclaimer".split()
)
_HEAD_NAMES = frozenset(("header", "head"))
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Outline:
    """One pass over a page: its text in blocks, and the nodes that the site's tree takes from it."""

    def __init__(self, source: str, cut: frozenset[int] = frozenset(), nodes: bool = False):
        self.blocks: list[list] = []  # [path, inside the article, cut, pieces]
        self.children: dict[int, tuple[int, set[str]]] = {}
        self.fresh = True
        self.cut, self.nodes = cut, nodes
        # tag, path, inside the article, away
        self.stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
        at, lower = 0, None
        while (m := _TAG.search(source, at)) is not None:
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(tag)
                continue
            self._open(tag, m[3])
            if tag in _RAW:  # nothing inside is markup
                if lower is None:
                    lower = source.lower() if len(source.lower()) == len(source) else re.sub("[A-Z]", lambda x: x[0].lower(), source)
                end = lower.find(f"</{tag}", at)
                at = len(source) if end < 0 else end
        if at < len(source):
            self._text(source[at:])

    def _text(self, raw: str) -> None:
        tag, path, main, away = self.stack[-1]
        if tag in _RAW:
            return
        if self.fresh or self.blocks[-1][2] != away:
            if not raw.strip():
                return
            self.blocks.append([path, main, away, []])
            self.fresh = False
        self.blocks[-1][3].append(raw)

    def _close(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break
        if tag in _BLOCK:
            self.fresh = True

    def _open(self, tag: str, attributes: str) -> None:
        stack = self.stack
        if tag in _BLOCK:
            self.fresh = True
            if tag in _ENDS_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        del stack[i:]
                        break
                    if stack[i][0] in _BLOCK:
                        break
            if tag in _ENDS:
                ended, walls = _ENDS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in walls:
                        break
                    if stack[i][0] in ended:
                        del stack[i:]
                        if tag not in ("tr", "tbody"):
                            break
        elif tag == "br":
            if not self.fresh:
                self.blocks[-1][3].append(" ")
            return
        if tag in _VOID:
            return
        _, parent, main, away = stack[-1]
        names, role, hidden = (), "", False
        if "=" in attributes or "hidden" in attributes:
            names, role, hidden = _described(attributes)
        path = parent
        if tag in _BLOCK or names:
            label = ".".join((tag, *names))
            path = xxhash.xxh64_intdigest(label, parent & 0x7FFFFFFFFFFFFFFF) >> 1
            if self.nodes:
                self.children.setdefault(parent, (-1, set()))[1].add(label)
                if path not in self.children:
                    # the article's own plain content is never judged by how often it recurs
                    self.children[path] = (-1 if main and tag in _CONTENT and not names else parent, set())
        if not away:
            parts = {p.lower() for n in names for p in _NAME.findall(n)}
            away = (
                tag in _AWAY_TAGS
                or tag in _RAW
                or hidden
                or role in _AWAY_ROLES
                or not parts.isdisjoint(_AWAY_NAMES)
                or (not main and (tag == "header" or not parts.isdisjoint(_HEAD_NAMES)))
                or path in self.cut
            )
        stack.append((tag, path, main or tag in ("article", "main") or role in ("main", "article"), away))

    def text(self) -> str:
        """The blocks of the article that are not cut, or of the page where it marks no article."""
        kept = [(main, tidy(pieces)) for _, main, away, pieces in self.blocks if not away]
        kept = [(main, t) for main, t in kept if t]
        marked = any(main for main, _ in kept)
        return "\n".join(t for main, t in kept if main or not marked)


def _described(attributes: str) -> tuple[tuple[str, ...], str, bool]:
    names, role, hidden = [], "", False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id"):
            names += re.sub(r"\d+", "0", value).split()
        elif key == "role":
            role = value.strip().lower()
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
    return tuple(names), role, hidden


def tidy(pieces: list[str]) -> str:
    return " ".join(html.unescape("".join(pieces)).split())


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def node_counts(pages: DataFrame) -> DataFrame:
    """``host, path, parent, kind, feature, pages`` from ``host, html``: on how many pages a node shows a feature.

    ``kind`` 0 is presentation, one feature per page and node; 1 is content, one feature per distinct text block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                rows: list[tuple] = []
                for host, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    outline = Outline(source or "", nodes=True)
                    for path, (parent, labels) in outline.children.items():
                        if parent >= 0:
                            rows.append((host, path, parent, 0, xxhash.xxh64_intdigest(" ".join(sorted(labels))) >> 1))
                    seen = {(b[0], tidy(b[3])) for b in outline.blocks}
                    for path, text in seen:
                        parent = outline.children.get(path, (-1,))[0]
                        if text and parent >= 0:
                            rows.append((host, path, parent, 1, xxhash.xxh64_intdigest(text) >> 1))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 5
                types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["host", "path", "parent", "kind", "feature"]
                )

    found = pages.select("host", "html").mapInArrow(run, "host string, path long, parent long, kind int, feature long")
    return found.groupBy("host", "path", "parent", "kind", "feature").agg(F.count(F.lit(1)).alias("pages"))


def importances(counts: DataFrame) -> DataFrame:
    """``host, path, parent, pages, presentation, content, weight`` of each node of each host's tree."""
    n, of = F.col("pages"), lambda kind, x: F.sum(F.when(F.col("kind") == kind, x).otherwise(F.lit(0)))
    sums = counts.groupBy("host", "path", "parent").agg(
        of(0, n).alias("m"), of(0, n * F.log(n)).alias("styles"), of(1, n).alias("weight"), of(1, n * F.log(n)).alias("texts")
    )
    log_m = F.log("m")
    return sums.select(
        "host", "path", "parent", F.col("m").alias("pages"),
        F.when(F.col("m") > 1, (log_m - F.col("styles") / F.col("m")) / log_m).otherwise(1.0).alias("presentation"),
        F.when((F.col("m") > 1) & (F.col("weight") > 0), F.greatest(1 - F.col("texts") / F.col("weight") / log_m, F.lit(0.0)))
        .otherwise(1.0).alias("content"),
        F.col("weight").cast("double").alias("weight"),
    )


def noise(nodes: DataFrame) -> DataFrame:
    """``host, cut``: the topmost branches of low importance in each host's tree.

    A tree has one row per node, however many pages the host has.
    """

    def judge(tree: pd.DataFrame) -> pd.DataFrame:
        tree = tree.sort_values("path")
        own = {p: i for i, p in enumerate(tree["path"])}
        below: dict[int, list[int]] = {}
        for i, parent in enumerate(tree["parent"]):
            below.setdefault(own.get(parent, -1), []).append(i)
        order, seen = [], set()
        todo = list(below.get(-1, []))
        while todo:
            i = todo.pop()
            if i in seen:
                continue
            seen.add(i)
            order.append(i)
            todo += below.get(i, [])
        pages, show = tree["pages"].to_numpy(float), tree["presentation"].to_numpy(float)
        content, weight = tree["content"].to_numpy(float), tree["weight"].to_numpy(float).copy()
        value = np.ones(len(tree))
        for i in reversed(order):
            under = below.get(i, [])
            total = weight[i] + sum(weight[j] for j in under)
            mean = (weight[i] * content[i] + sum(weight[j] * value[j] for j in under)) / total if total else 1.0
            keep = DAMPING ** len(under) if under else 1.0
            value[i] = (1 - keep) * max(show[i], mean) + keep * mean
            weight[i] = total
        value = (pages * value + PRIOR_PAGES) / (pages + PRIOR_PAGES)
        cut, todo = [], list(below.get(-1, []))
        visited = set()
        while todo:
            i = todo.pop()
            if i in visited:
                continue
            visited.add(i)
            if value[i] < LEAST and weight[i]:
                cut.append(int(tree["path"].iloc[i]))
            else:
                todo += below.get(i, [])
        return pd.DataFrame({"host": [tree["host"].iloc[0]], "cut": [sorted(cut)]})

    return nodes.groupBy("host").applyInPandas(judge, "host string, cut array<long>").filter(F.size("cut") > 0)


def extract(pages: DataFrame, url: str = "url", source: str = "html", key: str = "page_id") -> DataFrame:
    """``key, url, text, n_chars`` per row of ``pages``, whole pages.

    A null or empty page, or one without text, gives an empty text. Broken and truncated markup is read as far as it goes;
    rows without a host form one site. Repeated rows are pages of their own and get the same text. Other columns are not
    read.
    """
    own = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(source).alias("html"), host_of(F.col(url)).alias("host"))
    cuts = cut_lineage(noise(importances(node_counts(own))).coalesce(1))
    joined = own.join(cuts, "host", "left").select("key", "url", "html", "cut")
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                texts = [
                    Outline(h or "", frozenset(c or ())).text()
                    for h, c in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["key", "url", "text"])

    out = joined.mapInArrow(run, f"key {kind}, url string, text string")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", F.char_length("text").cast("long").alias("n_chars"))
