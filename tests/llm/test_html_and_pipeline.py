"""HTML extraction on small pages; the registered queries and the pipeline on a small table."""

import collections
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from skyloom.llm import bpe, html_text
from skyloom.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body><header>Site</header>
<nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- note --><div class="ad">buy</div><div id="cookie-notice">cookies</div>
<article><h1>Head &amp; line</h1><p>One  <b>two</b>three&nbsp;four<br>five<p>six &lt;tag&gt; &#233; &copy<div class="share">tweet</div>
<form><input value="a>b"><button>go</button></form><section class="comments"><p>first!</p></section></article>
<aside>side</aside><footer>&copy; foot</footer></body></html>"""
TEXT = "Head & line One twothree four five six <tag> é ©"


def test_article_text():
    assert " ".join(t for t, where in html_text.page_lines(PAGE.format()) if where == 0) == TEXT


@pytest.mark.parametrize("inner", [
    '<div class="related-work">', '<section class="share-price-analysis">', '<div id="login-guide">', '<div class="widget-review">', '<div class="hidden-gems">', '<div class="alert-article">',
    '<section aria-label="Related laws">', '<p class="related">', '<header class="page-header"><h1>', '<span class="share">'])
def test_article_text_stays_whatever_its_class(inner):
    page = f"<body><nav>menu</nav><article><p>before</p>{inner}words that stay</article></body>"
    assert [t for t, where in html_text.page_lines(page) if where == 0][-1].endswith("words that stay")


@pytest.mark.parametrize("inner", ['<div class="share-buttons">', '<section id="commentList">', '<div class="box ad-slot-3">', '<ul class="related_posts">', '<div role="search">', '<div class="cookie-notice">', "<aside>", "<nav>"])
def test_boilerplate_in_the_article_goes(inner):
    page = f"<article><p>before</p>{inner}goes</article>"
    assert [t for t, where in html_text.page_lines(page) if where == 0] == ["before"]


def test_stray_end_tags_take_linear_time():
    import time

    def took(n):
        start = time.perf_counter()
        html_text.page_lines("<div>" * n + "</section>" * (3 * n) + "text")
        return time.perf_counter() - start

    took(1000)
    assert took(80_000) < 5


@pytest.mark.parametrize("own", [1, 3, 4, 30])
def test_few_own_lines_among_many_shared(spark, own):
    """The lines that a page has for itself are its text, however few they are."""
    def page(k):
        mine = "".join(f"<div>line {j} of the story of page {k}</div>" for j in range(own))
        return "<body>" + "".join(f"<div>menu entry {j}</div>" for j in range(35)) + mine + "".join(f"<div>footer entry {j}</div>" for j in range(35)) + "</body>"

    rows = [(k, f"http://h.example/a/{k}", page(k)) for k in range(2)]
    out = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {k: " ".join(f"line {j} of the story of page {k}" for j in range(own)) for k in range(2)}
    same = [(k, f"http://h.example/a/{k}", page(0).replace("</body>", f"<div>Updated 12:0{k}</div></body>")) for k in range(2)]
    out = html_text.extract(spark.createDataFrame(same, "page_id long, url string, html string")).collect()
    assert all("menu entry 3" in r.text and "line 0" in r.text for r in out)


def test_extract_with_extra_columns_and_long_pages(spark):
    long = "<body><article>" + "<p>x y</p>" * 60_000 + "</article></body>"
    rows = [(1, "http://h.example/1", long, "k", "c", 1, "t"), (2, "http://h.example/2", None, "k", "c", 2, "t"), (2, "http://h.example/2", None, "k", "c", 2, "t"), (None, None, PAGE.format(), None, None, None, None)]
    schema = "page_id long, url string, html string, key string, check string, n_lines int, text string"
    out = sorted((r.page_id or 0, r.n_chars, r.n_lines) for r in html_text.extract(spark.createDataFrame(rows, schema)).collect())
    assert [x[:2] for x in out] == [(0, len(TEXT)), (1, 4 * 60_000 - 1), (2, 0), (2, 0)]
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("cut", range(0, 700, 23))
def test_truncated_pages_do_not_crash(cut):
    html_text.page_lines(PAGE[:cut])


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


@pytest.mark.parametrize("bits", [html_text.TABLE_BITS, 50])
def test_lcs_mask(monkeypatch, bits):
    monkeypatch.setattr(html_text, "TABLE_BITS", bits)
    assert html_text.lcs_mask([1, 2, 3, 4, 5], [9, 2, 8, 4, 5]) == [False, True, False, True, True]
    assert html_text.lcs_mask([], [1]) == [] and html_text.lcs_mask([1], []) == [False]
    rng = random.Random(5)
    for kinds in (2, 3, 10, 50):
        for _ in range(40):
            a, b = ([rng.randrange(kinds) for _ in range(rng.randrange(1, 40))] for _ in "ab")
            mask = html_text.lcs_mask(a, b)
            on = [x for x, m in zip(a, mask, strict=True) if m]
            rest = iter(b)
            assert len(mask) == len(a) and all(x in rest for x in on) and len(on) == lcs_length(a, b)


def test_lcs_of_many_matches():
    rng = random.Random(6)
    a, b = ([rng.randrange(2) for _ in range(1500)] for _ in "ab")
    assert sum(html_text.lcs_mask(a, b)) == lcs_length(a, b)
    big = html_text.lcs_mask([7] * 30000 + [1], [7] * 20000 + [1])
    assert sum(big) == 20001 and big[-1]


def test_partner_decides_about_other_article_elements(spark):
    page = "<body><p>Daily news</p><article><h2>{}</h2><p>teaser</p></article><article><h1>{}</h1><p>{}</p></article></body>"
    story = "the whole story, long enough to be the page's main text"
    rows = [(1, "http://h.example/a/1", page.format("Most read", "One", story)), (2, "http://h.example/a/2", page.format("Most read", "Two", story))]
    other = [rows[0], (2, "http://h.example/a/2", page.format("Own box", "Two", story))]
    texts = lambda r: {x.page_id: x.text for x in html_text.extract(spark.createDataFrame(r, "page_id long, url string, html string")).collect()}
    assert texts(rows) == {1: f"One {story}", 2: f"Two {story}"}  # the story is shared too, but it is the page's main text
    assert texts(other) == {1: f"Most read One {story}", 2: f"Own box Two {story}"}
    assert texts(rows[:1]) == {1: f"Most read teaser One {story}"}


def test_extract(spark):
    plain = "<html><body><p>Welcome to us</p><p>{}</p><p>All rights reserved</p></body></html>"
    long = [f"story number {i} " + f"word{i} " * 20 for i in range(3)]
    rows = [(i, f"http://h.example/a/{i}?q=1", plain.format(long[i])) for i in range(3)]
    rows += [(3, "http://other.example/a/1", plain.format(long[0])), (4, None, PAGE.format()), (5, "http://h.example/zz", None),
             (6, "", ""), (7, "http://copy.example/1", plain.format(long[1])), (8, "http://copy.example/1", plain.format(long[1]))]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    got = collections.defaultdict(list)
    for r in out:
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    tidy = lambda s: " ".join(s.split())
    whole = lambda i: f"Welcome to us {tidy(long[i])} All rights reserved"
    assert [got[i] for i in range(3)] == [[tidy(x)] for x in long]  # shared lines are gone
    assert got[3] == [whole(0)]  # no other page of its host
    assert got[4] == [TEXT] and got[5] == [""] and got[6] == [""]
    assert got[7] == got[8] == [whole(1)]  # copies delete nothing
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_of_the_table(spark, sf_dir):
    out = QUERIES["op1_html_text"](spark, sf_dir).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(out) == len(pages)
    for r in out:
        body = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        import html
        import re

        want = " ".join(html.unescape(re.sub(r"<(?!/?b>)[^>]*>", " ", body).replace("<b>", "").replace("</b>", "")).split())
        assert r.text == want


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        sizes.append(docs.count())
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] and sizes[4] == sizes[5]
    final = {}
    for r in docs.collect():
        final.setdefault(r.doc_id, r)
    enc = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for i, r in final.items():  # brute force: the texts that are left encode as the library does it
        ids = enc.encode_ordinary(texts[i])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[i].encode()).hexdigest()
