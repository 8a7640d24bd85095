"""Main text of web pages with a site style tree.

All visible elements of a host's pages are merged by element path (tags with their class, id and role). A path's
presentation nodes are the shapes (child paths) it has, its content nodes the texts it holds; the importance of a path
is the entropy of both over the host's distinct pages, normalised by the number of pages: what says the same on every
page is not the article. Paths of hosts with few pages take what the pages of several other hosts say about the same
path. Names (navigation, forms, ``class=sidebar``, ...) and a place outside the page's <article> or <main> lower the
importance of a branch unless it holds much of the site's text. A path of low importance is removed from each page with
all that lies under it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import discard, materialize, small_or_plain
from .html_tree import Node, Page, parse

#: Distinct pages of a host from which entropy says something, the importance below which a path is removed, and
#: the weight of presentation against content.
MIN_PAGES = 8
MIN_IMPORTANCE = 0.3
PRESENTATION = 0.2
#: Hosts that must have a path before it tells something about other hosts, and the pages that this counts as there.
MIN_HOSTS = 3
PRIOR_PAGES = 3.0
#: A path on at least one of so many pages of its host belongs to the host's template: a host has at most so many times
#: the paths of a mean page of these. Other paths are looked up page by page.
TEMPLATE_PAGES = 64
#: Weight of a marked or outside branch, and the share of the site's text from which it isn't lowered: outside the
#: article, marked by name, and both.
LOWERED = 0.2
OUTSIDE_SHARE, MARKED_SHARE, BOTH_SHARE = 0.2, 0.5, 0.75

# Elements, names (class, id) and roles that mark what is not the article.
OTHER_TAGS = set("nav footer aside form button dialog menu head input label fieldset datalist".split())
OTHER_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
OTHER_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted promotion related reply replies respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget widgets".split())
_NUMBER = re.compile(r"[-_]?\d+$")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)

NODE_SCHEMA = ("host string, copy long, page long, path long, content long, shape long, chars long, total long, marked int, "
               "outside int")


def is_marked(node: Node, inside_article: bool) -> bool:
    """Whether an element's tag, role or one of its whole names says that it is no part of the article."""
    if node.tag in OTHER_TAGS or node.tag == "header" and not inside_article:
        return True
    if node.names and node.tag not in ("html", "body", "article", "main") or "comment" in node.names:
        return any(x in OTHER_ROLES or _NUMBER.sub("", x) in OTHER_NAMES for x in node.names)
    return False


def _inner_text(blocks: list[tuple[str, tuple[Node, ...]]], marks: list[int]) -> set[int]:
    """The paths of the unmarked articles (else of the main parts) and of all elements around them."""
    for wanted in (lambda x: x.tag == "article", lambda x: x.tag == "main" or "main" in x.names):
        found: set[int] = set()
        for (_, nodes), mark in zip(blocks, marks):
            k = next((k for k, x in enumerate(nodes[:mark]) if wanted(x)), None)
            if k is not None:
                found.update(x.path for x in nodes[:k + 1])
        if found:
            return found
    return set()


def page_blocks(page: Page) -> tuple[list[tuple[str, tuple[int, ...]]], set[int], set[int], str]:
    """The visible blocks with their paths, the paths that are marked, the topmost paths outside the article, and the
    text by which a page is known: the unmarked blocks if they are half of it, so that copies with other
    navigation are one page. Text directly in an element around the article gets a path of its own."""
    blocks = [b for b in page.blocks if not any(x.attributes and _HIDDEN.search(x.attributes) for x in b[1])]
    marks, marked = [], set()
    for _, nodes in blocks:
        inside, at = False, len(nodes)
        for k, node in enumerate(nodes):
            if is_marked(node, inside):
                marked.add(node.path)
                at = min(at, k)
            inside = inside or node.tag in ("article", "main")
        marks.append(at)
    around, outside, kept = _inner_text(blocks, marks), set(), []
    inner = {p for p in around}
    for _, nodes in blocks:
        inner.difference_update(x.path for x, y in zip(nodes, nodes[1:]) if y.path in around)
    for text, nodes in blocks:
        paths = tuple(x.path for x in nodes)
        if around and inner.isdisjoint(paths):
            if (first := next((p for p in paths if p not in around), None)) is None:
                first = xxh64_intdigest("#text", paths[-1]) >> 1
                paths += (first,)
            outside.add(first)
        kept.append((text, paths))
    plain = [text for (text, nodes), k in zip(blocks, marks) if k == len(nodes)]
    if 2 * sum(map(len, plain)) < sum(len(t) for t, _ in blocks):
        plain = [t for t, _ in blocks]
    return kept, marked, outside, "\n".join(plain)


def style_nodes(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages (host, copy, html)`` and path: digests of the text under the path and of its shape, the
    characters under it and of the whole page. ``page`` is the digest of the page's own text, so copies of a page count
    once; ``copy`` is passed on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, copy, html in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2))):
                page = parse(html or "")
                blocks, marked, outside, own = page_blocks(page)
                under: dict[int, list[str]] = {}
                for text, paths in blocks:
                    for path in set(paths):
                        under.setdefault(path, []).append(text)
                own = xxh64_intdigest(own) >> 1
                total = sum(len(t) for t, _ in blocks)
                for path, texts in under.items():
                    shape = xxh64_intdigest(repr(page.shapes.get(path, []))) >> 1
                    rows.append((host, copy, own, path, xxh64_intdigest("\n".join(texts)) >> 1, shape, sum(map(len, texts)),
                                 total, path in marked, path in outside))
            cols = list(zip(*rows)) or [()] * 10
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:8]),
                 *(pa.array(map(int, c), pa.int32()) for c in cols[8:])],
                [c.split()[0] for c in NODE_SCHEMA.split(", ")])

    return pages.select("host", "copy", "html").mapInArrow(run, NODE_SCHEMA)


def path_importance(nodes: DataFrame) -> DataFrame:
    """Per host and path: ``pages``, ``importance`` (null of a single page), ``chars``, ``total`` and the shares
    ``marked`` and ``outside`` of its pages, by two levels of map-side combined counts."""
    distinct = nodes.groupBy("host", "page", "path").agg(
        *(F.min(c).alias(c) for c in ("content", "shape", "chars", "total", "marked", "outside")))
    distinct = materialize(distinct, "nodes")

    def entropy(feature: str, *sums: str) -> DataFrame:
        each = distinct.groupBy("host", "path", feature).agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in sums))
        return each.groupBy("host", "path").agg(
            F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("nlogn"),
            *(F.sum(c).alias(c) for c in sums)).withColumn(f"{feature}_entropy", F.try_divide(
                F.log("pages") - F.col("nlogn") / F.col("pages"), F.log("pages"))).drop("nlogn")

    both = entropy("content", "chars", "total", "marked", "outside").join(
        entropy("shape").drop("pages"), ["host", "path"])
    return both.select(
        "host", "path", "pages", "chars", "total", (F.col("marked") / F.col("pages")).alias("marked"),
        (F.col("outside") / F.col("pages")).alias("outside"),
        ((1 - PRESENTATION) * F.col("content_entropy") + PRESENTATION * F.col("shape_entropy")).alias("importance"))


def low_paths(nodes: DataFrame, min_pages: int, min_importance: float) -> DataFrame:
    """``host, path, pages`` of the branches of low weighted importance; ``pages`` have the path.

    A host with fewer than ``min_pages`` distinct pages mixes its own entropy with that of the hosts that have the
    path, unless the path holds most of its text; a path that too few hosts know is taken as important there.
    """
    known = materialize(path_importance(nodes), "importance")
    evidence = F.col("pages") - 1
    prior = known.where("pages > 1").groupBy("path").agg(
        F.count("*").alias("hosts"), F.sum(evidence).alias("evidence"),
        (F.sum(evidence * F.col("importance")) / F.sum(evidence)).alias("pooled"),
        (F.sum("chars") / F.sum("total")).alias("pooled_share")).where(
            (F.col("hosts") >= MIN_HOSTS) & (F.col("evidence") >= min_pages)).select("path", "pooled", "pooled_share")
    all_of = known.join(small_or_plain(materialize(prior, "prior")), "path", "left")
    own_share, few = F.col("chars") / F.col("total"), F.col("pages") < min_pages
    mixed = (evidence * F.coalesce("importance", F.lit(0.0)) + PRIOR_PAGES * F.col("pooled")) / (evidence + PRIOR_PAGES)
    importance = F.when(~few, F.col("importance")).when(
        F.col("pooled").isNotNull() & (own_share < MARKED_SHARE), mixed).otherwise(1.0)
    share = F.when(few, F.coalesce("pooled_share", own_share)).otherwise(own_share)
    marked, outside = F.col("marked") >= 0.5, F.col("outside") >= 0.5
    enough = F.when(marked & outside, BOTH_SHARE).when(marked, MARKED_SHARE).when(outside, OUTSIDE_SHARE).otherwise(0.0)
    weight = F.when(share < enough, LOWERED).otherwise(1.0)
    return all_of.where(importance * weight < min_importance).select("host", "path", "pages")


def removed_paths(nodes: DataFrame, low: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The low paths of each host's template as one list a host (``host, template``), and those of the other low paths
    that a page has as one list a page (``host, copy, rare``). The first is bounded by ``TEMPLATE_PAGES``, the second
    by the page's own paths; both are marked for broadcast by the number of paths in them."""
    pages = nodes.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    low = materialize(low.join(pages, "host").select(
        "host", "path", (F.col("pages") * TEMPLATE_PAGES >= F.col("host_pages")).alias("common")), "low")
    rare = materialize(nodes.select("host", "copy", "path").join(
        small_or_plain(low.where(~F.col("common")).select("host", "path")), ["host", "path"], "left_semi").distinct(), "rare")
    common = low.where("common")
    return (small_or_plain(common.groupBy("host").agg(F.collect_list("path").alias("template")), common.count()),
            small_or_plain(rare.groupBy("host", "copy").agg(F.collect_list("path").alias("rare")), rare.count()))


def host_of(url: str) -> F.Column:
    """The host of a url in lower case; null where there is none."""
    host = F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              min_pages: int = MIN_PAGES, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    Null or empty html, and html without text, give an empty text. Pages whose url is null or has no host are sites of
    their own. Repeated rows give equal results; rows that share an id are
    told apart by their host. Very long pages are read whole; other columns are not read.
    """
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(host_of(url_col), F.concat(F.lit("#"), F.xxhash64(html_col))).alias("host"),
                        F.xxhash64(html_col).alias("copy"), F.col(html_col).alias("html"))
    nodes = materialize(style_nodes(base), "page-nodes")
    template, rare = removed_paths(nodes, low_paths(nodes, min_pages, min_importance))
    discard(nodes)
    joined = base.join(template, "host", "left").join(rare, ["host", "copy"], "left").select(
        "page_id", "url", "html", "template", "rare")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, template, rare in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                gone = {*(template or ()), *(rare or ())}
                texts.append("\n".join(t for t, paths in page_blocks(parse(html or ""))[0] if gone.isdisjoint(paths)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
