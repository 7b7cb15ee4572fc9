"""Main text against the articles of whole tables, and pages without an article against brute force."""

import re
import time
from html import unescape

import numpy as np
import pytest

from shelfpair.llm import queries
from shelfpair.llm.html import INSIDE, blocks, common_prefixes, main_text, suffix_array
from tests.conftest import SMALL

DEPTH = 16


def article_of(html):
    """The article of the given pages, whose parts are simple."""
    inner = re.search(r"<article>(.*?)</article>", html, re.DOTALL)[1]
    return " ".join(unescape(re.sub(r"</?b>", "", re.sub(r"<br>|</?(?:p|h1)>", " ", inner))).split())


def test_query_on_a_whole_table(spark, duck):
    want = {(p, u, article_of(h)) for p, u, h in duck.execute("select page_id, url, html from pages").fetchall()}
    rows = queries.op7_html(spark, SMALL).collect()
    assert {(r.page_id, r.url, r.text) for r in rows} == want and len(rows) == len(want)
    assert all(r.n_chars == len(r.text) for r in rows)


def main(html):
    return " ".join(t for t, z in blocks(html) if z in INSIDE)


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<article>a<b>b</b> &amp;&lt;&#233;&nbsp;c<br>d<p>e\n\n f<p>g</article>tail", "ab &<é c d e f g"),
        ("<body class='has-sidebar'><div class=menu>m</div><main><h1>T</h1><p>x</main><footer>f</footer>", "T x"),
        ("<main>a<aside>no</aside><div class='site-comments'>no</div><form>no</form>b<script>if(a<b)'</p>'</script></main>", "a b"),
        ("<article>one<nav><ul><li>no</ul></nav>two</div></p>three</article>", "one two three"),
        ("<div class='with-menu'><article>kept</article><article class=comment>no</article></div>", "kept"),
        ("<head><title>t</title><body><article>1 < 2 <!-- no <p> --> 3", "1 < 2 3"),
        ("<article><p title='a>b'>x<a href=\"u>v\">y</a><span class=ad>no</span>z</article>", "xyz"),
        ("<article><p>a<div hidden>no</div><div style='display: none'>no</div><div role=alert>no</div>b", "a b"),
        ("<article>a<style>p{}", "a"),
        ("", ""),
        ("<a href='open>text", ""),
        ("<article><p class='share-price'>Share prices rose</p><div class='social-science'>x</div><p id='notice-period'>y", "Share prices rose x y"),
        ("<article class='article-header'>a<div class='content has-comment'>b</div><div class='article-header'>c</div>", "a b c"),
        ("<article><header><h1>Title</h1><p>by</header>text<footer>no</footer></article>", "Title by text"),
        ("<main><div id=comments><article>c</article></div><p>k</main>", "k"),
        ("<article>a<span class=ad>x<span>y</span>z</span>b<span class=ad>open", "abopen"),
        ("<main><header><h1>T</h1></header><p>x", "T x"),
    ],
)
def test_structure(html, want):
    assert main(html) == want


def test_suffixes_and_their_common_prefixes():
    rng = np.random.default_rng(6)
    for n in [0, 1, 2, 5, 17, 200]:
        tokens = rng.integers(0, 3, n)
        order, ranks = suffix_array(tokens, 3)
        prefixes = [tuple(tokens[i : i + 8]) for i in range(n)]
        assert [prefixes[i] for i in order] == sorted(prefixes)
        common = common_prefixes(order, ranks)
        for k in range(1, n):
            a, b = tokens[order[k - 1] :], tokens[order[k] :]
            plain = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[k] == min(7, plain)


def brute_text(pages):
    """The kept blocks of pages (page, host, blocks) without an article, by plain counting."""
    seen, runs = {}, {}
    for _, host, parts in pages:
        for block in parts:
            other = sorted((p for p in set(parts) if p != block), key=lambda p: (p.count(" "), p))
            longest = max(parts, key=lambda p: (p.count(" "), p)) == block
            anchor = None if longest and block.count(" ") >= 8 else other[-1] if other else ""
            words = block.split(" ")
            for key in [block, *((block, *words[k : k + DEPTH]) [1:] for k in range(len(words) - DEPTH + 1) if len(words) > DEPTH)]:
                contents, anchors = (seen if key is block else runs).setdefault((host, key), (set(), set()))
                contents.add("\n".join(parts))
                anchors |= {anchor} - {None}
    out = {}
    for page, host, parts in pages:
        keep = []
        for block in parts:
            words = block.split(" ")
            contents, anchors = seen[host, block]
            enough = 10 if len(words) > 50 else 2
            whole = len(contents) >= 2 and (len(words) <= 8 or len(anchors) >= enough)
            covered = set()
            for k in range(len(words) - DEPTH + 1 if len(words) > DEPTH else 0):
                c, a = runs[host, tuple(words[k : k + DEPTH])]
                covered |= set(range(k, k + DEPTH)) if len(a) >= enough and len(c) >= 2 else set()
            if not whole and 5 * len(covered) < 4 * len(words):
                keep.append(block)
        out[page] = " ".join(keep)
    return out


def test_pages_without_an_article(spark):
    rng = np.random.default_rng(8)
    stock = [" ".join(f"s{k}x{j}" for j in range(n)) for k, n in enumerate([2, 4, 8, 9, 20, 30, 49, 50, 51, 60])]
    bodies = [" ".join(f"b{k}x{j}" for j in range(n)) for k, n in enumerate([70, 70, 200, 30])]
    rows, plain = [], []
    for page in range(120):
        host = f"h{page % 3 if page % 2 else 0}.example.com"  # one host has most pages
        own = " ".join(f"w{page}x{k}" for k in range(rng.integers(1, 120)))
        parts = [*rng.choice(stock, 3, replace=False), own if page % 4 else bodies[page // 4 % 4], f"head {page}", stock[4] + f" page {page}"]
        rows.append((page, f"http://{host}/{page}", "".join(f"<div>{p}</div>" for p in parts) + "<script>no</script>", "x"))
        plain.append((page, host, [str(p) for p in parts]))
    rows += [(page + 1000, *rest) for page, *rest in rows[:5]]  # copies count as one page
    want = brute_text(plain)
    want |= {page + 1000: want[page] for page in range(5)}
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    for parts in (1, 7):
        got = main_text(frame.repartition(parts), DEPTH).collect()
        assert {r.page_id: r.text for r in got} == want and len(got) == len(rows)
    assert all(bodies[2] in want[p] for p, _, parts in plain if bodies[2] in parts)


def test_what_other_pages_decide(spark):
    body = " ".join(f"w{k}" for k in range(200))
    text = lambda rows: [r.text for r in sorted(main_text(spark.createDataFrame([(k, "http://h/", h) for k, h in enumerate(rows)], "page_id long, url string, html string")).collect(), key=lambda r: r.page_id)]
    assert text([f"<p>Head one<p>{body}", f"<p>Other title<p>{body}"]) == [f"Head one {body}", f"Other title {body}"]
    assert text([f"<p>Home News Shop About<p>{body} {k}" for k in "ab"]) == [f"{body} a", f"{body} b"]
    notice = "<div class=notice>We use cookies here</div>"
    assert text([f"<article>{notice}<p>{k} {body}</article>" for k in "ab"]) == [f"a {body}", f"b {body}"]
    assert text([f"<article>{notice}<p>a {body}</article>", "<article>other</article>"]) == [f"We use cookies here a {body}", "other"]
    share = "<div>Share this page with friends</div>"
    assert text([f"<main>{share}<p>{k} {body}</main>" for k in "ab"]) == [f"a {body}", f"b {body}"]
    assert text([f"<article>{share}<p>{k} {body}</article>" for k in "ab"]) == [f"Share this page with friends {k} {body}" for k in "ab"]


@pytest.mark.parametrize("html", ["<div>" * 60_000 + "</x>" * 60_000, "<x><article>" + "<div>" * 60_000 + "</x>" * 60_000, "<span class=ad>" * 40_000, "<p><b>" * 60_000, "<span class=ad><span>" * 20_000 + "</span>" * 20_000, "<nav>" * 40_000 + "</article>" * 40_000])
def test_malformed_pages_take_time_in_proportion(html):
    began = time.perf_counter()
    blocks(html)
    assert time.perf_counter() - began < 2


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, row int"
    rows = [(1, None, None, "t", 1), (None, "http://[bad", "<p>a", "t", 1), (2, "u", "", "t", 1), (3, "u", "<article>" + "w " * 200_000, "t", 1), (3, "u", "<p>x", "t", 1)]
    got = main_text(spark.createDataFrame(rows * 2, schema)).collect()
    assert sorted((r.page_id or -1, r.n_chars) for r in got) == sorted([(1, 0), (-1, 1), (2, 0), (3, 399_999), (3, 1)] * 2)
    assert main_text(spark.createDataFrame([], schema)).count() == 0
