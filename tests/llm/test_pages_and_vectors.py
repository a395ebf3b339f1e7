import html
import math
import re

import numpy as np
import pytest

from dropgate.llm import htmltext, topk
from llm.conftest import shape


@pytest.mark.parametrize("page,marked,text", [
    ("", False, ""),
    ("<p>a<b>b</b>c</p>d &amp; e&nbsp;f<script>var a='</p>'</script>g", False, "abc d & e f g"),
    ("<div class='comments'><p>x</p></div><main><nav>m</nav><p>hi<!-- c --> there</main>", True, "hi there"),
    ("<article><p>1<div class=share>s</div>2<form>f<input></form>3</article><article class='comment'>c</article>", True, "1 2 3"),
    ("<p>unclosed <a href='x>y'>l", False, "unclosed l"),
    ("< 3 <4 > text", False, "< 3 <4 > text"),
    ("<!-- open", False, ""),
    ("<article></article><p>z", False, "z"),
    ("<ARTICLE><P>Up<BR>per  \n case</ARTICLE>", True, "Up per case"),
    ("<body class='has-sidebar'><div id='sidebar'>s</div><p>t&#233;&lt;b&gt;", False, "té<b>"),
    ("<aside>a</aside><div role='banner'>b</div><div hidden>c</div><div style='display: none'>d</div>e", False, "e"),
    ("<nav>open<article>in</article>", False, ""),
])
def test_blocks(page, marked, text):
    has, parts = htmltext.blocks(page)
    assert (has, " ".join(parts)) == (marked, text)


def make_pages():
    rng = np.random.default_rng(8)
    word = lambda: f"w{rng.integers(0, 10**6)}"
    menu = " ".join(word() for _ in range(12))
    notice = " ".join(word() for _ in range(20))
    rows = []
    for i in range(60):
        own = " ".join(word() for _ in range(40))
        body = f"<div><span>{menu}</span></div><p>{own}</p>" + (f"<div>{notice}</div>" if i % 3 == 0 else "")
        rows.append((i, f"http://host{i % 2}.example/{i}", f"<html><body>{body}</body></html>", own))
    rows.append((60, "http://host0.example/same", rows[0][2], rows[0][3]))       # an identical page
    rows.append((61, "http://host0.example/a", f"<article>{menu} kept</article>", f"{menu} kept"))
    rows.append((62, "http://single.example", f"<p>{menu}</p>", menu))            # no other page of the host
    rows += [(63, None, None, ""), (None, "x", "", ""), (64, "http://host1.example/64", f"<p>{menu}</p>", menu)]
    return rows


@pytest.mark.parametrize("shard", [400_000, 100])
def test_host_boilerplate(spark, shard):
    rows = make_pages()
    df = spark.createDataFrame([r[:3] + (9, 1) for r in rows], "page_id long, url string, html string, uid int, n_chars int").repartition(4)
    got = htmltext.main_text(df, shard_tokens=shard)
    assert got.columns == ["page_id", "url", "uid", "text", "n_chars"]
    assert shape(got.select("page_id", "text", "n_chars")) == sorted(((i, t, len(t)) for i, _, _, t in rows), key=repr)


@pytest.mark.parametrize("shard", [400_000, 100])
def test_what_articles_share_stays(spark, shard):
    rng = np.random.default_rng(9)
    text = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    menu, wire, quote, often, links = text(15), text(60), text(15), text(30), text(14)
    rows = []
    for i in range(40):
        parts = [("div", text(30))]
        if i in (3, 8, 9, 20):       # a body without paragraphs on 4 of 40 pages
            parts.append(("div", wire))
        if i % 2:                    # a quotation in a paragraph of half the pages
            parts += [("blockquote", quote), ("p", often)]
        body = f"<div>{menu}</div><p><a href=x>{links}</a></p>" + "".join(f"<{t}>{x}</{t}>" for t, x in parts)
        rows.append((i, f"http://big.example/{i}", body, " ".join(x for _, x in parts)))
    for i in (100, 101):             # two pages say nothing about what is boilerplate
        own = f"{text(20)} {wire}"
        rows.append((i, f"http://small.example/{i}", f"<div>{own}</div>", own))
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(4)
    got = htmltext.main_text(df, shard_tokens=shard)
    assert shape(got.select("page_id", "text")) == sorted(((i, t) for i, _, _, t in rows), key=repr)


def test_ranks_group_equal_stretches():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 3, 300).astype(np.uint64)
    rank = htmltext.truncated_ranks(tokens, 5)
    whole = {}
    for i in range(296):
        assert whole.setdefault(tuple(tokens[i:i + 5]), rank[i]) == rank[i]
    assert len(set(whole.values())) == len(whole)
    assert [k for k, _ in sorted(whole.items(), key=lambda x: x[1])] == sorted(whole)


def test_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in htmltext.op9(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:h1|p|br)>", article))
        assert got[r.page_id].text == " ".join(want.split())
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_no_pages(spark):
    assert htmltext.op9(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def brute_top(rows, k, every):
    usable = [(i, [max(-2**63, min(2**63 - 1, math.floor(256 * x))) for x in v]) for i, v in rows
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for m, (i, v) in enumerate(usable):
        if i is not None and i % every == 0:
            hits = [(-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j is None, j or 0)
                    for n, (j, w) in enumerate(usable) if len(w) == len(v) and n != m]
            out += [(i, n + 1, None if nul else j, -s) for n, (s, nul, j) in enumerate(sorted(hits)[:k])]
    return sorted(out, key=repr)


def vector_rows():
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 8)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)]                      # one vector in many rows: ties
    rows += [(3, rows[3][1]), (3, rows[3][1]), (10, rows[4][1])]            # repeated rows, an id with two vectors
    rows += [(20, rows[20][1])] * 7                                         # a repeated query: its copies are candidates
    rows += [(300, None), (310, [1.0, None]), (320, [float("nan")] * 8), (330, [float("inf")] * 8), (None, rows[7][1])]
    return rows + [(340, [1.0, 2.0]), (341, [0.5, 0.5]), (350, []), (351, [])]


@pytest.mark.parametrize("sizes", [{}, {"pivots": 5, "block_rows": 7, "query_block": 3}, {"block_rows": 20}, {"pivots": 150, "block_rows": 40}])
def test_top_k_matches_brute_force(spark, sizes):
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score string").repartition(3)
    vectors = topk.quantised(df, df["vec_id"], df["embedding"])
    got = topk.top_k(vectors, vectors.filter("id % 10 = 0"), 5, **sizes)
    assert shape(got.select("query_id", "rank", "vec_id", "score")) == brute_top(rows, 5, 10)


@pytest.mark.parametrize("sizes", [{}, {"pivots": 6, "block_rows": 9}])
def test_top_k_of_large_components(spark, sizes):
    """Sums beyond what doubles hold are exact, those beyond a long are the nearest long."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 4e5, 6)]) for i in range(60)]
    rows += [(60 + i, [float(x + i % 3) for x in rows[0][1]]) for i in range(40)]     # differ in the last digits
    rows += [(100 + i, [float(x) for x in rng.normal(0, 1e12, 6)]) for i in range(20)]
    rows += [(120, [1e300] * 6), (130, [-1e300] * 6), (140, [1e-300] * 6), (150, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    vectors = topk.quantised(df, df["vec_id"], df["embedding"])
    got = topk.top_k(vectors, vectors.filter("id % 10 = 0"), 5, **sizes)
    assert shape(got.select("query_id", "rank", "vec_id", "score")) == brute_top(rows, 5, 10)


def test_bins_hold_neighbouring_cells():
    cells = topk.Cells(np.zeros((6, 2)))
    cells.members = np.array([3, 4, 25, 1, 9, 2])
    cells.fill(10)
    assert cells.first.tolist() == [0, 2, 3, 5] and cells.blocks.tolist() == [1, 3, 1, 1]
    assert cells.bin_of().tolist() == [0, 0, 1, 2, 2, 3]


def test_top_k_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.op5(none).count() == 0
    one = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")
    assert topk.op5(one).count() == 0


@pytest.mark.parametrize("shard", [400_000, 60])
def test_boilerplate_inside_marked_articles(spark, shard):
    rng = np.random.default_rng(10)
    text = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    share, wire, steps, title = text(18), text(40), text(14), text(8)
    rows = []
    for i in range(20):
        own = text(30)
        parts = [("h1", title), ("p", own), ("h2", title), ("p", wire), ("ul", f"<li>{steps}</li>")]
        body = "".join(f"<{t}>{x}</{t}>" for t, x in parts) + f"<div>{share}</div>"
        rows.append((i, f"http://marked.example/{i}", f"<article>{body}</article>", f"{title} {own} {title} {wire} {steps}"))
    rows.append((50, "http://other.example/", f"<article><div>{share}</div></article>", share))
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(4)
    got = htmltext.main_text(df, shard_tokens=shard)
    assert shape(got.select("page_id", "text")) == sorted(((i, t) for i, _, _, t in rows), key=repr)


@pytest.mark.parametrize("page,marked,text,rest", [
    ("<html><head><title>t</title><body><p>all <b>text", False, "all text", ""),         # </head> may be left out
    ("<head><meta charset=x><style>p{}</style><article><p>x</article>y", True, "x", "y"),
    ("<head><script>s</script>loose", False, "loose", ""),
    ("<p class=ad>buy<h2>Title</h2><div>body</div>", False, "Title body", "buy"),         # and </p>, </li>, </dt>, </td>
    ("<ul><li class=ad>a<li>b</ul><dl><dt class=promo>c<dd>d</dl>", False, "b d", "a c"),
    ("<table><tr><td class=ad>a<td>b<tr class=ad><td>c<tbody><tr><td>d</table>e", False, "b d e", "a c"),
    ("<article><svg class=icon/><p>a</p><svg><path d=x><p>b</p></article>", True, "a b", ""),
    ("<span><article><p>a</span>b</p><p>c</article></span>", True, "ab c", ""),           # a stray end tag ends no block
    ("<b><article><p>a</b>b</p><p>c</article>", True, "ab c", ""),
    ("<article><table><tr><td>a</table></td></tr></div><p>c</article>", True, "a c", ""),
    ("<div class=ad><table><tr><td>a</div><article><p>b</article>", True, "b", "a"),
    ("<!-->a<!--->b<!-- c --!>d", False, "abd", ""),
    ("<p title=it's>hello don't stop</p><nav class=it's>n</nav>", False, "hello don't stop", "n"),
    ("<article><p>a</p><xmp><b>c&amp;</xmp><p>d</article>", True, "a <b>c&amp; d", ""),
    ("<div class='comments'><p>x</p></div><main><nav>m</nav><p>hi</main><div>out</div>", True, "hi", "x m out"),
])
def test_all_text_is_read(page, marked, text, rest):
    has, parts, other = htmltext._judged_blocks(page)
    assert (has, " ".join(t for t, _ in parts), other) == (marked, text, rest)


@pytest.mark.parametrize("shard", [400_000, 600, 60])
def test_whole_pages_are_judged(spark, shard):
    rng = np.random.default_rng(12)
    text = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    menu, notice, quote, title, few = text(16), text(20), text(20), text(14), text(18)
    rows = []
    for i in range(60):
        own = text(40)
        parts = [("div" if i in (5, 17, 40, 58) else "nav", menu)]     # the menu of most pages is left out by markup
        parts += [("aside", title), ("p", notice), ("p", own)]         # every sidebar lists the headline of page 7
        if i % 2:
            parts.append(("blockquote", quote))
        if i in (2, 9, 33):
            parts.append(("div", few))
        if i == 7:
            parts.insert(0, ("h1", title))
        want = ([title] if i == 7 else []) + [own] + ([quote] if i % 2 else []) + ([few] if i in (2, 9, 33) else [])
        body = "".join(f"<{t}>{x}</{t}>" for t, x in parts)
        for host, marked in (("plain", False), ("marked", True)):
            rows.append((i, f"http://{host}.example/{i}", f"<article>{body}</article>" if marked else body, " ".join(want)))
    for i in range(20):                                                # too few pages to tell a notice from an article
        own = text(30)
        rows.append((i, f"http://small.example/{i}", f"<p>{notice}</p><p>{own}</p>", f"{notice} {own}"))
    for i in range(40):                                                # most of each page is what all of them have
        own = text(8)
        rows.append((i, f"http://series.example/{i}", f"<p>{notice}</p><p>{own}</p>", f"{notice} {own}"))
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(4)
    got = htmltext.main_text(df, shard_tokens=shard)
    assert shape(got.select("url", "text")) == sorted(((u, t) for _, u, _, t in rows), key=repr)


def brute_boilerplate(pages, run):
    """Of distinct pages (words, whether loose, other words): the stretches to cut from loose text."""
    grams = lambda ws: {tuple(ws[i:i + run]) for i in range(len(ws) - run + 1)}
    inside, found, judged = [grams(ws) for ws, _, _ in pages], [], set()
    for (ws, loose, rest), mine in zip(pages, inside, strict=True):
        found.append(mine | grams(rest))
        judged |= {tuple(ws[i:i + run]) for i in range(len(ws) - run + 1) if all(loose[i:i + run])}
    return {g for g in judged if sum(g in x for x in found) >= max(3, -(-len(pages) // 5)) and sum(g in x for x in inside) >= 3}


def test_shares_do_not_depend_on_the_cut(spark):
    """Stretches that about a fifth of a host's pages have: some shards have them on fewer of theirs."""
    rng = np.random.default_rng(14)
    text = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    shared, pages = [text(13) for _ in range(60)], []
    for _ in range(120):
        has = rng.random(60) < 0.2
        beside = rng.random(60) < 0.3
        ws, loose, rest = [], [], []
        for s in (s for s, x, b in zip(shared, has, beside, strict=True) if x and not b):
            own = text(3)
            ws += s + own
            loose += [True] * 13 + [False] * 3
        for s in (s for s, x, b in zip(shared, has, beside, strict=True) if x and b):
            rest += [*text(1), *s]
        pages.append((ws + text(5), loose + [False] * 5, rest))
    cut = brute_boilerplate(pages, 12)
    assert 0 < len({tuple(s) for s in shared if tuple(s[:12]) in cut}) < 60
    rows, want = [], []
    for i, (ws, loose, rest) in enumerate(pages):
        gone = [False] * len(ws)
        for j in range(len(ws) - 11):
            if tuple(ws[j:j + 12]) in cut and all(loose[j:j + 12]):
                gone[j:j + 12] = [True] * 12
        html_ = "".join(f"<div>{w}</div>" if x else f"<p>{w}</p>" for w, x in zip(ws, loose, strict=True)) + f"<nav>{' '.join(rest)}</nav>"
        rows.append((i, "http://a.example", f"<article>{html_}</article>"))
        want.append((i, " ".join(w for w, g in zip(ws, gone, strict=True) if not g)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    for shard in (400_000, 2000, 1000, 60):
        assert shape(htmltext.main_text(df, shard_tokens=shard).select("page_id", "text")) == sorted(want, key=repr)
