"""HTML extraction, URL filters and embeddings."""

import html as references
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelscope.llm import html, urls, vectors

LONG = "This is a real paragraph, with commas, and enough length to count as content for the scoring."


def test_article_without_what_is_around_it():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{x:1}}</style><script>var t="</p>";</script></head><body>
      <header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies, many of them, all the time.</div>
      <div class="ad">Buy, this, now, and, again, and, again, and, again</div>
      <article><header><h1>Title &amp; more</h1></header><p>{LONG}<br>line   two<p>Caf&eacute; &#8212; &lt;b&gt;<!-- c --><ul><li>one<li>two</ul></article>
      <aside><p>{LONG}</p></aside><form><p>{LONG}</p><input></form><section id="comments"><p>{LONG}{LONG}</p></section>
      <footer>&copy; site</footer></body></html>"""
    assert html.extract(page) == f"Title & more\n{LONG} line two\nCafé — <b>\none\ntwo"


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain   text", "plain text"), ("<p>only a short text</p>", "only a short text"), ("<article></article>", ""),
    ("<div>unclosed <b>bold <i>it</b> rest", "unclosed bold it rest"), ('<p title="a>b">x</p><p>y', "x\ny"), ("<p>a \"b' c < d</p>", "a \"b' c < d"),
    ("<script>if (a<b) x='</p>'</script><p>real</p>", "real"), ("<![CDATA[a & b]]>", "a & b"), ("<style>never closed", ""), ("<p>&nbsp;x&#160; y</p>", "x y"),
    (f'<div id="sidebar"><p>{LONG}</p></div><div class="content"><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></div>', f"Head\n{LONG}\n{LONG}"),
])
def test_extract(page, text):
    assert html.extract(page) == text


def test_names_of_wrappers_headers_and_comments():
    body = f"<h1>Head</h1><p>{LONG}</p><p>{LONG}</p>"
    text = f"Head\n{LONG}\n{LONG}"
    assert html.extract(f'<div class="page has-sidebar">{body}</div>') == text
    assert html.extract(f'<div id="sidebar-layout"><article>{body}</article><div class="sidebar2"><p>{LONG}</p></div></div>') == text
    assert html.extract(f'<article>{body}</article><ol class="commentlist"><li><article><p>{LONG}</p></article></li></ol>') == text
    assert html.extract(f'<article><div class="entry-header"><h1>Head</h1></div><p>{LONG}</p><p>{LONG}</p><div class="share-box">Share, this</div></article>') == text
    assert html.extract(f'<div class="site-header"><h1>Site</h1></div><article>{body}</article><div class="post-footer">x</div>') == text


def test_links_are_discounted():
    links = "".join(f'<li><a href="/{i}">A link text that is long, with commas, number {i}, in a list</a></li>' for i in range(30))
    assert html.extract(f"<body><div><ul>{links}</ul></div><div><p>{LONG}</p><p>{LONG}</p></div></body>") == f"{LONG}\n{LONG}"


def test_deep_and_broken_pages_end():
    for page in ("<div>" * 50000 + "x", "<p>" * 50000, '<a href="' * 20000, "<" * 50000, "<b>" * 30000 + "y"):
        html.extract(page)


def test_given_pages_match_a_pattern_on_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in html.extract_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)
        blocks = re.split(r"</?(?:p|h1)>", article[1]) if article else []
        plain = [re.sub(r"\s+", " ", references.unescape(re.sub(r"<b>", "", b.replace("<br>", " ")))).strip() for b in blocks]
        assert got[r.page_id].text == "\n".join(b for b in plain if b) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_awkward_pages(spark):
    rows = [(1, "u", None, "z"), (None, None, "<p>x</p>", "z"), (1, "u", "", None), (2, "u", "<p>" + "long " * 100000, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").withColumn("n_chars", F.lit("q"))
    out = html.extract_text(df).collect()
    assert Counter((r.page_id, r.n_chars) for r in out) == Counter([(1, 0), (None, 1), (1, 0), (2, 499999)])
    assert html.extract_text(df.limit(0)).collect() == []


# ------------------------------------------------------------------ URLs

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def brute_url(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    key = lambda u: re.sub(r"^www\.", "", u[0]) + u[1].rstrip("/")
    return host, path, best and best[1], best[0] if best else "block" if host and key((host, path)) in listed else "allow"


@pytest.mark.parametrize("blocks", [1, 64, 1 << 20])
def test_urls_match_brute_force(spark, blocks):
    rnd = random.Random(1)
    hosts = ["example.net", "a.Example.NET", "net", "xnet", "example.com", "b.example.com", "org", "z.org", "WWW.spam.io", "spam.io", "ÄÖ.io", "ok.io:80"]
    make = lambda: rnd.choice(["http://", "HTTPS://", "x", "://", ""]) + rnd.choice(hosts) + rnd.choice(["", "/", "/en/1", "/en", "/de/2/", "/fr/", "/p/%20", "?q=/en/", "#/de/", "/a?b#c"])
    data = [(i, make()) for i in range(600)] + [(None, None), (7, ""), (7, "://"), (8, "a://b://c/d")]
    listed = ["http://spam.io/p/%20", "https://www.spam.io", "ftp://ok.io:80/a?x", "nothing", None, "http://spam.io/p/%20"]
    names = {re.sub(r"^www\.", "", brute_url(u, ())[0]) + brute_url(u, ())[1].rstrip("/") for u in listed if u and "://" in u}
    pages = spark.createDataFrame(data, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("_block", F.lit(2))
    got = urls.judge(pages, RULES, spark.createDataFrame([(u,) for u in listed], "url string"), blocks=blocks).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *brute_url(u, names)) for i, u in data)
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}
    empty = spark.createDataFrame([], "url string")
    assert all(r.verdict == "allow" for r in urls.judge(pages, [], empty).collect())
    assert urls.judge(pages.limit(0), RULES, empty).collect() == []


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    listed = spark.range(2000).select(F.concat(F.lit("in"), F.col("id").cast("string")).alias("k"))
    table = urls.bloom_blocks(listed, "k", 128)
    assert table.count() <= 128
    assert urls.possible_hits(listed, "k", table, 128).count() == 2000
    others = spark.range(20000).select(F.concat(F.lit("out"), F.col("id").cast("string")).alias("k"))
    assert urls.possible_hits(others, "k", table, 128).count() < 600


# ------------------------------------------------------------------ embeddings

def brute_vectors(rows, threshold=0.98):
    n = len(rows)
    unit = []
    for _, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if ok else None)
    top, links = list(range(n)), [0] * n

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {(rows[i][0], links[i], rows[find(i)][0], find(i) == i) for i in range(n)}


@pytest.mark.parametrize("block", [7, 1024])
def test_near_vectors_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    rnd = np.random.default_rng(2)
    rows = []
    for c in range(8):
        centre = rnd.normal(size=24)
        for _ in range(14):
            v = (centre + rnd.normal(size=24) * rnd.choice([0.0, 0.05, 0.12, 0.16])).astype(np.float32)
            rows.append([float(x) for x in v])
    rows = [(i, v, int(rnd.integers(0, 2))) for i, v in enumerate(rows)]
    odd = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] * 24, [1.0, 2.0], [1.0, 2.0]]
    rows += [(1000 + k, v, 0) for k, v in enumerate(odd)] + [(2000, rows[0][1], None), (2001, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("x") for c in ("item", "n", "u", "vector", "root")})
    assert {tuple(r) for r in vectors.near_vectors(df).collect()} == brute_vectors(rows)
    assert vectors.near_vectors(df.limit(0)).collect() == []


def test_bounds_are_rigorous():
    rnd = np.random.default_rng(5)
    for scale in (1e-3, 0.02, 0.2, 1.0):
        a = vectors.unit(rnd.normal(size=(200, 48)) ** 3)
        b = vectors.unit(np.concatenate([a[:100] + scale * rnd.normal(size=(100, 48)) / 7, rnd.normal(size=(100, 48))]))
        exact = a @ b.T
        for threshold in (0.5, 0.9, 0.98):
            assert not np.any((exact >= threshold) & ~vectors.possible(vectors.quantise(a), vectors.quantise(b), threshold))
        assert np.array_equal(vectors.linked(a, b, 0.9), exact >= 0.9) or np.abs(exact - 0.9).min() < 1e-12


def test_null_and_repeated_vector_ids(spark):
    rows = [(None, [1.0, 0.0], 1), (None, [1.0, 0.01], 1), (5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (None, [0.0, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    got = Counter(tuple(r) for r in vectors.near_vectors(df).collect())
    assert got == Counter([(None, 2, 5, False), (None, 2, 5, False), (5, 2, 5, True), (5, 0, 5, True), (None, 0, None, True)])
