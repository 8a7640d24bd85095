"""Edge rows and brute-force twins of the operators on vectors and pages."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from fareweave.llm import metric_range_join, pivot_topk, site_style_tree
from fareweave.llm.metric_range_join import range_join
from fareweave.llm.pivot_topk import top_inner_products
from fareweave.llm.site_style_tree import main_text, path_importance, removed_paths, style_nodes

NAN, INF = float("nan"), float("inf")
EDGES = [(900, None), (901, []), (902, [0.0] * 6), (903, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (904, [NAN] * 6),
         (905, [INF, 1.0, 0.0, 0.0, 0.0, 0.0]), (906, [1.0, 2.0]), (None, [1.0] * 6)]


def _vectors(seed, n=300, d=6):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((25, d))
    x = np.concatenate([centres[rng.integers(0, 25, n)] + 0.15 * rng.standard_normal((n, d)), centres[:3], centres[:3]])
    return [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(x)]


@pytest.mark.parametrize("cell,block", [(4096, 2048), (40, 16)])
def test_range_join_matches_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(metric_range_join, "BLOCK_ROWS", block)
    rows = _vectors(1)
    x = np.array([v for _, v in rows])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= 0.9
    np.fill_diagonal(hit, False)
    label = np.arange(len(rows))
    for _ in rows:
        label = np.array([min([label[i], *label[hit[i]]]) for i in range(len(rows))])
    df = spark.createDataFrame(rows + EDGES, "vec_id long, embedding array<float>").selectExpr("*", "1 as n_links", "2 as id")
    got = {r.vec_id: tuple(r)[1:] for r in range_join(df, cell_rows=cell).collect()}
    assert {k: got[k] for k, _ in rows} == {
        k: (int(hit[k].sum()), int(label[k]), bool(label[k] == k)) for k, _ in rows}
    assert all(got[k] == (0, k, True) for k, _ in EDGES if k is not None) and got[None] == (0, None, False)


def _links(rows, c=0.9):
    """Links and component of each row by loops; a row is a vertex, whatever its id."""
    u = [[x / max(map(abs, v)) for x in v] for _, v in rows]
    u = [np.array(v) / np.linalg.norm(v) for v in u]
    to = [[j for j in range(len(rows)) if j != i and u[i] @ u[j] >= c] for i in range(len(rows))]
    label = [k for k, _ in rows]
    for _ in rows:
        label = [min([label[i], *(label[j] for j in to[i])]) for i in range(len(rows))]
    return sorted((k, len(to[i]), label[i], label[i] == k) for i, (k, _) in enumerate(rows))


def test_range_join_ids_that_repeat_with_other_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [1.0, 0.02]), (4, [0.01, 1.0]), (5, [1.0, 0.0]),
            (5, [-1.0, 0.5]), (6, [-1.0, 0.5]), (0, [-1.0, 0.51]), (7, [-1.0, -1.0]), (7, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in range_join(df).collect()) == _links(rows)


def test_range_join_very_large_and_small_components(spark):
    rows = [(1, [1e200, 0.4843e200]), (2, [1e200, 0.0]), (3, [1e-200, 0.0]), (4, [5e-324, 0.0]), (5, [0.0, 1e300]),
            (6, [1.7e308, 1.7e308])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in range_join(df).collect()) == _links(rows)


def test_spanning_links_connect_what_a_block_connects():
    rng = np.random.default_rng(5)
    for share in (0.02, 0.1, 0.9):
        hit = rng.random((40, 30)) < share
        left, right = np.arange(40), np.arange(100, 130)
        a, b = metric_range_join._spanning(hit, left, right)
        assert len(a) < 70 and all(hit[i, j - 100] for i, j in zip(a, b))

        def groups(pairs):
            name = {x: x for x in [*left, *right]}
            for _ in name:
                for i, j in pairs:
                    name[i] = name[j] = min(name[i], name[j])
            return name

        assert groups(list(zip(a, b))) == groups([(i, j + 100) for i, j in zip(*np.nonzero(hit))])


def test_range_join_empty(spark):
    assert range_join(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("pivots,cell,part,share", [(256, 4096, 4096, 4096), (256, 20, 8, 3), (2, 20, 8, 4096)])
def test_top_inner_products_match_brute_force(spark, monkeypatch, pivots, cell, part, share):
    monkeypatch.setattr(pivot_topk, "STEP", 8)
    monkeypatch.setattr(pivot_topk, "VISIT_ROWS", share)
    rows = _vectors(2)
    df = spark.createDataFrame(rows + EDGES, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as rank")
    got = {}
    for r in top_inner_products(df, df.where("vec_id % 20 = 0"), max_pivots=pivots, cell_rows=cell, part_rows=part).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    z = {k: np.floor(1024 * np.array(v)) for k, v in rows}
    for q in range(0, len(rows), 20):
        best = sorted(((-int(z[q] @ z[k]), k) for k in z if k != q))[:10]
        assert sorted(got[q]) == [(n + 1, k, -s) for n, (s, k) in enumerate(best)]
    assert set(got) == set(range(0, len(rows), 20))


def _counted(monkeypatch):
    """The numbers of visits of each round."""
    counts, plan = [], pivot_topk._plan

    def counting(*args):
        out = plan(*args)
        counts.append(out.count())
        return out

    monkeypatch.setattr(pivot_topk, "_plan", counting)
    return counts


def test_rings_that_the_bound_excludes_are_not_visited(spark, monkeypatch):
    counts = _counted(monkeypatch)
    rng = np.random.default_rng(3)
    angle = rng.random(2000) * 3.1
    rows = [(k, [float(np.cos(a)), float(np.sin(a))]) for k, a in enumerate(angle)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_inner_products(df, df.where("vec_id % 20 = 0"), max_pivots=1, part_rows=50).count()
    assert got == 1000 and counts[0] == 100 and sum(counts) < 100 * 40 / 4  # 40 rings of one pivot


def test_ties_at_one_distance_are_cut_by_hash(spark, monkeypatch):
    counts = _counted(monkeypatch)
    rows = [(k, [1.0, 0.0]) for k in range(300)] + [(k, [0.0, 0.5]) for k in range(300, 340)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in top_inner_products(df, df.where("vec_id % 20 = 0"), part_rows=10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q in range(0, 300, 20):
        assert sorted(got[q]) == list(enumerate([k for k in range(12) if k != q][:10], 1))
    assert sorted(got[300]) == list(enumerate(range(301, 311), 1)) and counts[1] > 17


def test_top_inner_products_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0]), (20, [1.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in top_inner_products(df, df.where("vec_id % 20 = 0")).collect())
    assert got == [(0, 1, 1, 524288), (0, 2, 2, 524288)]
    assert top_inner_products(df.limit(0), df.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/x">x</a></ul></nav><!-- <p>no</p> -->
<div class="box">{notice}</div><article><h1>Title {k}</h1><p>First &amp; <b>bold</b>
 text {k}<p>Second<br>line {k}</p><div class="comments"><p>reader {k}</p></div>
<form><input value="a>b"><label>mail</label></form></article><aside>side {k}</aside><div class="ad-box">buy {k}</div>
<footer>&copy; x</footer></body></html>"""


def test_main_text(spark):
    rows = [(k, f"https://a.example/{k}", PAGE.format(k=k, notice="Same on all")) for k in range(12)]
    rows += [(100, None, "<p>plain &lt;p&gt;</p>tail &am"), (101, "https://b.example/", None), (102, "x", ""),
             (None, "https://b.example/", "<div hidden>no</div><div>yes</div><p"), (103, "http://c.example", "no markup <  at all"),
             (104, "http://c.example", "<div>" * 3000 + "deep" + "</p>" * 10), (0, "https://a.example/0", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text", "1 as host")
    got = [(r.page_id, r.text, r.n_chars) for r in main_text(df).collect()]
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    text = dict((k, t) for k, t, _ in got)
    assert text[3] == "Title 3\nFirst & bold text 3\nSecond line 3"
    assert text[100] == "plain <p>\ntail &am" and text[101] == "" and text[102] == "" and text[None] == "yes"
    assert text[103] == "no markup < at all" and text[104] == "deep"
    assert sum(k == 0 for k, _, _ in got) == 2
    assert main_text(df.limit(0)).count() == 0


def test_low_importance_branches_go(spark):
    page = "<body><div class=x><p>{a}</p></div><div class=y><p>{b}</p></div></body>"
    rows = [(k, "http://s.example/p", page.format(a="the same on every page", b=f"story number {k}")) for k in range(20)]
    rows.append((50, "http://other.example/p", page.format(a="kept: one page tells nothing", b="story")))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r.page_id: r.text for r in main_text(df).collect()}
    assert text[7] == "story number 7" and text[50] == "kept: one page tells nothing\nstory"


def test_main_text_from_the_whole_page(spark):
    shell = "<body><div class='page has-sidebar'><div id='content' class='with-comments'>{}</div></div><div class=y>same</div></body>"
    inner = "<div class='entry-header'>head {k}</div><p>the long story with number {k}</p>"
    teaser = "<body><article>see also {k}</article><div class=story><p>a long story of many words, number {k}, told outside of it</p></div></body>"
    wrapped = "<body><form><div class=sidebar><p>all that this page has to say is in here {k}</p></div><nav>go {k}</nav></form></body>"
    rows = [(k, "http://a.example/p", shell.format(inner.format(k=k))) for k in range(12)]
    rows += [(100 + k, "http://b.example/p", teaser.format(k=k)) for k in range(12)]
    rows += [(200 + k, "http://c.example/p", wrapped.format(k=k)) for k in range(12)]
    # three sites of two pages each know the notice; a fourth has one page only
    small = "<body><div class=note>accept our terms {h}</div><section><p>what page {k} says at some length</p></section></body>"
    rows += [(300 + k, f"http://s{k // 2}.example/p", small.format(k=k, h=k // 2)) for k in range(17)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r.page_id: r.text for r in main_text(df).collect()}
    assert text[5] == "head 5\nthe long story with number 5"
    assert "a long story of many words, number 5, told outside of it" in text[105]
    assert text[205] == "all that this page has to say is in here 5"
    assert text[316] == "what page 16 says at some length" and text[303] == "what page 3 says at some length"


def test_path_importance_equals_a_plain_count(spark):
    rng = random.Random(3)
    rows = [(f"h{rng.randrange(3)}", rng.randrange(5), rng.randrange(12), rng.randrange(4), rng.randrange(3),
             rng.randrange(2), 10, 40, 0, 0) for _ in range(300)]
    first = {}
    for host, _, page, path, content, shape, *_ in rows:  # of the copies of a page the smallest digest counts
        held = first.setdefault((host, page, path), [content, shape])
        held[:] = min(held[0], content), min(held[1], shape)
    want = {}
    for host, path in {(h, p) for h, _, p in first}:
        values = [v for (h, _, p), v in first.items() if (h, p) == (host, path)]
        n = len(values)
        entropies = [-sum(c / n * math.log(c / n) for c in Counter(v[k] for v in values).values()) / math.log(n)
                     if n > 1 else None for k in (0, 1)]
        mixed = None if n == 1 else (1 - site_style_tree.PRESENTATION) * entropies[0] + site_style_tree.PRESENTATION * entropies[1]
        want[host, path] = (n, mixed)
    got = {(r.host, r.path): (r.pages, r.importance) for r in path_importance(spark.createDataFrame(rows, site_style_tree.NODE_SCHEMA)).collect()}
    assert got.keys() == want.keys()
    for key, (n, mixed) in want.items():
        assert got[key][0] == n and got[key][1] == (mixed if mixed is None else pytest.approx(mixed, abs=1e-9))


def test_removed_paths_that_few_pages_have(spark):
    page = ("<body class='post-{n}'><nav><a>menu</a></nav><article><p>what page {k} says at some length</p></article>"
            "<aside class='w-{n}'><p>buy {k}</p></aside><div class='ad a{n}'>also {k}</div></body>")
    plain = page.replace(" class='post-{n}'", "")
    names = ["".join(chr(97 + int(d)) for d in str(k)) for k in range(300)]  # digits are no part of a path
    rows = [(k, "http://own.example/p", page.format(k=k, n=names[k])) for k in range(300)]
    rows += [(1000 + k, "http://tpl.example/p", plain.format(k=k, n=names[k])) for k in range(300)]
    rows += [(2000, "http://tpl.example/p", plain.format(k=7, n=names[7]))] * 5
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for found in main_text(df).collect():
        k = 7 if found.page_id == 2000 else found.page_id % 1000
        assert found.text == f"what page {k} says at some length"
    nodes = style_nodes(df.selectExpr("url as host", "xxhash64(html) as copy", "html"))
    template, rare = removed_paths(nodes, site_style_tree.low_paths(nodes, 8, 0.3))
    per_page = nodes.groupBy("host").count().collect()
    assert all(len(r.template) <= site_style_tree.TEMPLATE_PAGES * r["count"] / 300 for r in template.join(
        spark.createDataFrame(per_page), "host").collect())
    assert rare.count() == 600 and max(len(r.rare) for r in rare.collect()) < 20
