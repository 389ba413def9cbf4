"""Main text of pages, nearest neighbours."""

from __future__ import annotations

import collections
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripspark.llm import multiprobe_lsh, site_style_tree

from edge import with_clashes

PAGES = "page_id bigint, url string, html string"


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"), ("a < b <c", "a < b <c"),
    ("<article><h1>T</h1><p>a<p>b<br>c</article><footer>f</footer>", "T a b c"),
    ("<nav><a href='x'>n</a></nav><main><p>One <b>t</b>wo</p><aside>s</aside></main>", "One two"),
    ("<body><header><h1>Site</h1></header><div id=content><header>Title</header><p>x&nbsp; y</p></div></body>", "Title x y"),
    ("<article>x<div class='user-comments'><p>no</p></div><form>f</form><script>var t='</p><p>';</script>y</article>", "x y"),
    ("<div class='cookie-notice'>c</div><p>keep</p><div class=\"ad\">a</div><!-- <p>no</p> --><p hidden>h</p>", "keep"),
    ("<article><p>unclosed <b>bold</article><p>after", "unclosed bold"),
    ("<p>a</div></p></span>b<style>p{}</style>", "a b"),
    ("<ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table>", "one two 1 2 3"),
])
def test_main_text(html, text):
    assert site_style_tree.main_text(html) == text


@pytest.mark.parametrize("wrapper", ["div class='content-sidebar-wrap'", "div class='has-sidebar'", "div id='page-with-nav'", "form",
                                     "div class='page comments-open'"])
def test_named_wrappers_keep_the_article(wrapper):
    end, side = f"</{wrapper.split()[0]}>", "<div class=sidebar><p>Links</p></div><div class=comments><article class=comment>no</article></div>"
    for inner in ("<article><h1>T</h1><p>The text of it</p></article>", "<main><h1>T</h1><p>The text of it</p></main>",
                  "<div class=x><h1>T</h1><p>The text of it</p></div>"):
        assert site_style_tree.main_text(f"<body><nav>n</nav><{wrapper}>{inner}{side}{end}<footer>f</footer></body>") == "T The text of it"
    assert site_style_tree.main_text(f"<article><{wrapper}><p>The text of it</p>{side}{end}</article>") == "The text of it"


LONG_TEXT = "A long text that goes on for a while and says what the page is about in many words"


@pytest.mark.parametrize("html, text", [
    (f"<main><h1>Title</h1><p>{LONG_TEXT}</p><div class=grid><article>Card one</article><article>Card two</article></div></main>",
     f"Title {LONG_TEXT}"),
    (f"<p>{LONG_TEXT}</p><article>Card</article>", LONG_TEXT),
    (f"<ul><li class=entry>e1</li></ul><p>{LONG_TEXT}</p>", f"e1 {LONG_TEXT}"),
    (f"<p>lead</p><article>{LONG_TEXT}</article><article>Card</article>", LONG_TEXT),
    ("<main><h1>All</h1><article>First post here</article><article>Second post here</article></main>", "First post here Second post here"),
])
def test_a_mark_counts_only_where_most_of_the_text_is(html, text):
    assert site_style_tree.main_text(html) == text


@pytest.mark.parametrize("html, blocks", [
    ("<div>x" * 100_000, 100_000), ("<form>x" * 30_000, 30_000), ("<a>x" * 50_000 + "</q>" * 50_000, 1),
    ("<article>x" * 30_000, 30_000), ("<b>" * 50_000 + "<div>y</div>" * 2_000, 2_000)])
def test_unclosed_elements_take_linear_time_and_memory(html, blocks):
    began = time.perf_counter()
    page = site_style_tree.parse(html)
    text = site_style_tree.main_text(html)
    assert len(page.blocks) == blocks and len(page.parents) <= blocks + 1
    assert set(text) <= set("xy ") and len(text.split()) <= blocks
    assert max(len(page.chain(b.path)) for b in page.blocks[-50:]) <= site_style_tree.DEEPEST + 1
    assert time.perf_counter() - began < 60


def test_importances_equal_plain_entropies(spark):
    """Style and content entropies over the pages of a host, computed from the definition."""
    rows = [("h", f"<div class=alpha><p>Own {i}</p><p>Own {i * i % 7}</p></div><div class=beta>"
             + ("<p>Same line</p>" if i % 3 else "<p>Same line</p><ul><li><a href=x>Link</a> text</ul>") + "</div>") for i in range(12)]
    rows += [("g", "<div class=beta><p>Same line</p></div>")]
    trees = [(h, site_style_tree.parse(x)) for h, x in rows]
    own, chains = {}, {}
    for host in ("h", "g"):
        pages = [t for h, t in trees if h == host]
        for path in {b.path for t in pages for b in t.blocks}:
            having = [t for t in pages if any(b.path == path for b in t.blocks)]
            chains[host, path] = having[0].chain(path)
            n = len(having)
            varies = 1.0
            if n > 1:
                entropy = lambda counts: -sum(c / sum(counts) * math.log(c / sum(counts)) for c in counts) / math.log(n)
                per_text = collections.defaultdict(list)
                for t in having:
                    for words, c in collections.Counter(b.words for b in t.blocks if b.path == path).items():
                        per_text[words].append(c)
                styles = collections.Counter(tuple(t.styles[path]) for t in having)
                varies = max(1 - np.mean([entropy(c) for c in per_text.values()]), 0.5 * entropy(list(styles.values())))
            blocks = [b for t in having for b in t.blocks if b.path == path]
            links = sum(b.link_chars for b in blocks) / sum(len(b.words) for b in blocks)
            own[host, path] = (varies * (1 - links), varies)
    want = {}
    for key, chain in chains.items():
        for above in chain:
            old = want.get((key[0], above), (0, 0))
            want[key[0], above] = tuple(map(max, old, own[key]))
    table = spark.createDataFrame([(h, i, x) for i, (h, x) in enumerate(rows)], "host string, page bigint, html string")
    got = {(r["host"], r["path"]): (r["importance"], r["variety"]) for r in site_style_tree.branch_importance(table.repartition(4)).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_a_lifted_part_that_a_host_repeats_goes(spark):
    line = "A long line that stands below every page of this site and says nothing about it"
    rows = [(i, "http://a.b/", f"<p>Own {i * i}</p><div class=legal><p>{line}</p></div>") for i in range(20)]
    got = {r["page_id"]: r["text"] for r in site_style_tree.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"Own {i * i}" for i in range(20)}


def test_repeated_branches_of_a_host_go(spark):
    pages = [(i, "http://Site.example:80/p", f"<div class=alpha><p>Own words of page number {i} and {i * i}</p></div>"
                 "<div class=beta><p>The same line on every page</p></div>") for i in range(20)]
    pages += [(100, "http://other.example/", "<div class=beta><p>The same line on every page</p></div>")]
    got = {r["page_id"]: r["text"] for r in site_style_tree.extract(spark.createDataFrame(pages, PAGES)).collect()}
    assert got[3] == "Own words of page number 3 and 9"
    assert got[100] == "The same line on every page"
    shuffled = site_style_tree.extract(spark.createDataFrame(pages, PAGES), broadcast_rows=0)
    assert {r["page_id"]: r["text"] for r in shuffled.collect()} == got


def test_copies_of_an_article_stay(spark):
    html = "<nav>n</nav><article><h1>T</h1><p>The article</p></article>"
    got = site_style_tree.extract(spark.createDataFrame([(i, "http://a.b/", html) for i in range(9)], PAGES)).collect()
    assert {(r["text"], r["n_chars"]) for r in got} == {("T The article", 13)} and len(got) == 9


def test_copies_of_an_unmarked_page_stay(spark):
    html = "<div class=alpha><p>The words of a page</p></div><div class=beta><p>More of them</p></div>"
    rows = [(1, "http://a.b/", html), (2, "https://a.b/", html), (2, "https://a.b/", html)]
    got = site_style_tree.extract(spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    assert [r["text"] for r in got] == ["The words of a page More of them"] * 3


@pytest.mark.parametrize("opening, closing", [("<main>", "</main>"), ("<div class=content>", "</div>"), ("<article>", "</article>")])
def test_repeated_blocks_within_a_marked_part_go(spark, opening, closing):
    rows = [(i, "http://a.b/", f"{opening}<h1>Title {i}</h1><p>Own words of page number {i} and {i * i}</p>"
             f"<ul><li><a href=x>Source {i}</a></ul><div class=alpha><p>The same line here</p></div>{closing}") for i in range(20)]
    got = {r["page_id"]: r["text"] for r in site_style_tree.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"Title {i} Own words of page number {i} and {i * i} Source {i}" for i in range(20)}


def test_page_edge_rows(spark):
    long = "<article>" + "<p>word " * 20_000 + "</article>"
    rows = [(1, None, None), (1, None, None), (None, "::bad url", ""), (2, "http://h/", long), (3, "http://h/", "<" * 3000)]
    table = with_clashes(spark.createDataFrame(rows, PAGES))
    got = site_style_tree.extract(table)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    by_id = {r["page_id"]: r["text"] for r in got.collect()}
    assert got.count() == 5 and by_id[1] == by_id[None] == "" and by_id[2] == " ".join(["word"] * 20_000)
    assert site_style_tree.extract(spark.createDataFrame([], PAGES)).count() == 0


# --- vectors ------------------------------------------------------------------------------

def _brute(rows, queries, k):
    usable = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in queries:
        if q in usable:
            d = sorted((float(np.sqrt(((usable[q] - v) ** 2).sum())), i) for i, v in usable.items() if i != q and len(v) == len(usable[q]))
            out[q] = d[:k]
    return out


VECTORS = "vec_id bigint, embedding array<float>"


def _answers(df):
    got = {}
    for r in df.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {q: [(s, v) for _, s, v in sorted(x)] for q, x in got.items()}


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(5, 16))
    rows = [(i, (centres[i % 5] + rng.normal(size=16)).astype(np.float32).tolist()) for i in range(600)]
    table = spark.createDataFrame(rows, VECTORS)
    got = _answers(multiprobe_lsh.neighbours(table.where(F.col("vec_id") % 20 == 0), with_clashes(table), 10))
    want = _brute(rows, range(0, 600, 20), 10)
    assert got.keys() == want.keys()
    recall = np.mean([len({v for _, v in got[q]} & {v for _, v in want[q]}) / 10 for q in want])
    assert recall >= 0.9
    exact = {q: dict((v, s) for s, v in _brute(rows, [q], 600)[q]) for q in want}
    assert all(s == pytest.approx(exact[q][v], rel=1e-12) for q in got for s, v in got[q])
    assert all(x == sorted(x) for x in got.values())


def test_a_dense_third_beside_sparse_rows(spark):
    rng = np.random.default_rng(3)
    dense = rng.normal(size=16) + rng.normal(size=(300, 16)) * 0.01 / np.sqrt(32)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([dense, rng.normal(size=(600, 16)) / np.sqrt(32)]))]
    rows += [(2000 + i, [float(i), 1.0]) for i in range(5)]  # fewer candidates than asked for
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = _answers(multiprobe_lsh.neighbours(table.where(F.col("vec_id") % 20 == 0), table, 10))
    want = _brute(rows, [*range(0, 900, 20), 2000], 10)
    assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in want.items()}
    for part in (range(0, 300, 20), range(300, 900, 20), [2000]):
        assert np.mean([len({v for _, v in got[q]} & {v for _, v in want[q]}) / len(want[q]) for q in part]) >= 0.9


def test_copies_ties_and_unusable_vectors(spark, monkeypatch):
    rows = [(i, [1.0, 0.0]) for i in range(100, 160)] + [(i, [0.0, 1.0]) for i in range(40)] + [
        (200, None), (201, [0.0, 0.0]), (202, [None, 1.0]), (203, [float("nan"), 1.0]), (204, []), (205, [1.0, 2.0, 3.0]),
        (100, [1.0, 0.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, VECTORS)
    monkeypatch.setattr(multiprobe_lsh, "_GROUP", 3)  # every bucket is split on both sides
    got = _answers(multiprobe_lsh.neighbours(table, table, 10))
    assert got.pop(205, []) == []
    want = _brute(rows, [*range(100, 160), *range(40)], 10)
    assert got == want


def test_more_ties_than_answers_go_to_the_smallest_ids(spark):
    """Sixty distinct vectors at one distance from the query, dealt out of order."""
    rows = [(900, [1.0] + [0.0] * 60)] + [(59 - i, [0.0] * (1 + i) + [1.0] + [0.0] * (59 - i)) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    got = _answers(multiprobe_lsh.neighbours(table.where("vec_id = 900"), table, 10))
    assert [v for _, v in got[900]] == list(range(10))


def test_empty_vectors(spark):
    none = spark.createDataFrame([], VECTORS)
    one = spark.createDataFrame([(7, [1.0])], VECTORS)
    assert multiprobe_lsh.neighbours(none, none).count() == 0
    assert multiprobe_lsh.neighbours(one, one).count() == 0
