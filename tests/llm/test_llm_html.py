"""Wrapper induction: tables against their articles, sites of many shapes, simple tree matching, merges, edge tables."""

import html
import itertools
import random
import re

import pytest

from broadloom.llm import html_text as H

PAGES = "page_id long, url string, html string"
WORDS = "amber basin candle drift ember fjord glade harbor island jumble kettle lantern meadow nectar orchard pebble quarry ripple summit thicket".split()


def sentence(rng, n=12):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def wrapper_of(pages):
    held = None
    for page in pages:
        top, title = H.parse(page)
        part = H.part_of([top], H.xxhash.xxh3_64_intdigest(title) >> 1)
        if held is None:
            held = part
        else:
            H.merge(held, part)
    return H.load_wrapper(H.compile_wrapper(H.load(H.json.loads(H.json.dumps(H.dump(held))))))


def texts(pages):
    wrapper = wrapper_of(pages)
    return [H.main_text(p, wrapper) for p in pages]


def article_of(page):
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", found.group(1)) if found else []
    blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", b).replace("<b>", "")).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_query_against_articles(spark, sf_dir):
    from broadloom.llm.registry import QUERIES

    want = {r.page_id: article_of(r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op12_html_extraction"](spark, sf_dir).collect()
    assert {r.page_id: r.text for r in got} == want and len(got) == len(want) and all(r.n_chars == len(r.text) for r in got)


def divs(rng, k):
    """A site without semantic elements: only the slot that varies tells the content."""
    blocks = [sentence(rng) for _ in range(rng.randrange(2, 6))]
    page = f"""<html><head><title>{blocks[0]}</title></head><body><div id=top><div>Garden News</div><div>Home | About | Contact us today</div></div>
<div class=wrap><div class=c1><h1>{blocks[0]}</h1><p>{"</p><p>".join(blocks[1:])}</p><div class=tip>Press the bell to hear from us again</div></div>
<div class=c2><div>Most read this week and every week</div></div></div><div id=bottom>All rights reserved by the gardeners</div></body></html>"""
    return page, "\n".join(blocks)


def blog(rng, k):
    """Sidebar, adverts, share bars, forms, cookie notices, comments and scripts around and inside an article."""
    blocks = [sentence(rng) for _ in range(rng.randrange(2, 7))]
    body = "".join(f"<p>{b}</p>" + (f"<div class='ad-slot ads'>Buy {sentence(rng, 4)}</div>" if i == 1 else "") for i, b in enumerate(blocks[1:]))
    page = f"""<!DOCTYPE html><html><head><title>{blocks[0]} - Blog</title><script>if (a < b) document.write("<article><p>no</p></article>")</script><style>p > a {{x: y}}</style></head>
<body class="has-sidebar menu-open"><header class="site"><h1>The Blog</h1><nav>Home {sentence(rng, 3)}</nav></header><div class="cookie-notice">We use {sentence(rng, 3)}</div>
<div class="layout with-sidebar"><main><article class=post><header><h1>{blocks[0]}</h1></header>{body}<div class="shareButtons">Share {k}</div>
<form action=x><p>Your mail {k}</p><input name=q><button>Send {k}</button></form></article>
<section id="comments"><article class=comment><h1>{sentence(rng, 2)}</h1><p>{sentence(rng)}</p></article></section></main>
<aside><ul><li><a href=a>{sentence(rng, 3)}</a></ul></aside></div><footer><p>Footer {sentence(rng, 3)}</footer><noscript><p>no script</p></noscript></body></html>"""
    return page, "\n".join(blocks)


def lists(rng, k):
    """Unclosed elements, lists, tables, references, comments, quotes with angle brackets and white space."""
    page = f"""<html><body><nav><ul><li>One<li>Two</ul></nav><article title="a > b"><h1>Fish &amp; chips &lt;{k}&gt;</h1><!-- <p>not this</p> -->
<p>First   line<br>second&nbsp;line <em>in</em>line <a href='x>y'>link</a>ed<ul><li>alpha {k}<li>beta</ul><p>After
<table><tr><td>a<td>b<tr><td>c</table><blockquote>Quote &eacute;&#233;&#x20AC; 5 < 6 and a<b</blockquote></article><div class=ad>ad</div></body></html>"""
    return page, f"Fish & chips <{k}>\nFirst line second line inline linked\nalpha {k}\nbeta\nAfter\na\nb\nc\nQuote éé€ 5 < 6 and a"


@pytest.mark.parametrize("site", [divs, blog, lists])
def test_sites(site):
    rng = random.Random(7)
    made = [site(rng, k) for k in range(12)]
    assert texts([p for p, _ in made]) == [t for _, t in made]


def test_constant_nodes_become_template_only_beside_different_titles():
    rng = random.Random(1)
    made = [divs(rng, k) for k in range(2)]
    # two pages are no evidence: nothing that could be content is dropped
    for page, (_, want) in zip(texts([p for p, _ in made]), made):
        assert set(want.split("\n")) <= set(page.split("\n"))
    copies = [blog(random.Random(3), k) for k in range(20)]
    assert texts([p for p, _ in copies]) == [t for _, t in copies]


def tree(rng, depth=3):
    out = H.Part(rng.choice("abc"), False)
    if depth:
        out.kids = [tree(rng, depth - 1) for _ in range(rng.randrange(4))]
    return out


def plain_similarity(a, b):
    """All order-kept pairings of two child lists."""
    if a.label != b.label:
        return 0
    best = 0
    for n in range(min(len(a.kids), len(b.kids)) + 1):
        for x in itertools.combinations(a.kids, n):
            for y in itertools.combinations(b.kids, n):
                sims = [plain_similarity(p, q) for p, q in zip(x, y)]
                if all(sims):
                    best = max(best, sum(sims))
    return 1 + best


def test_simple_tree_matching_equals_all_pairings():
    rng = random.Random(11)
    for _ in range(150):
        a, b = tree(rng), tree(rng)
        assert H.similarity(a, b) == plain_similarity(a, b)
        pairs = H.matched(a.kids, b.kids)
        assert all(p < q and r < s for (p, r), (q, s) in itertools.pairwise(pairs))
        assert all(a.kids[i].label == b.kids[j].label for i, j in pairs)
        if a.label == b.label and [x.label for x in a.kids] != [y.label for y in b.kids]:
            total = sum(H.similarity(a.kids[i], b.kids[j]) for i, j in pairs)
            # lists of which one only adds at one place to the other are matched end to end
            assert total <= H.similarity(a, b) - 1


def test_partial_templates_merge_to_the_same_wrapper(spark):
    rng = random.Random(5)
    rows = [(k, f"http://{'hot' if k % 3 else f'h{k % 5}'}.example.com/{k}", blog(rng, k)[0]) for k in range(90)]
    df = spark.createDataFrame(rows, PAGES)
    one = {r.host: r.template for r in H.induce_wrappers(df.coalesce(1)).collect()}
    many = {r.host: r.template for r in H.induce_wrappers(df.repartition(16)).collect()}
    assert one.keys() == many.keys() and len(one) == 6
    got = {r.page_id: r.text for r in H.html_extraction(df.repartition(16)).collect()}
    assert got == {r.page_id: r.text for r in H.html_extraction(df.coalesce(1)).collect()}


def test_wide_and_deep_pages():
    wide = "<body><article>" + "".join(f"<p>t{k}</p><div class=x{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10 % 10]}>u{k}</div>" for k in range(3000)) + "</article>"
    deep = "<div>" * 5000 + "<p>bottom</p>" + "</div>" * 5000
    wrapper = wrapper_of([wide, deep, wide])
    assert H.main_text(wide, wrapper) == "\n".join(f"{c}{k}" for k in range(3000) for c in "tu")
    assert texts([deep]) == ["bottom"]
    assert texts(["<p>" + "word " * 200_000]) == [" ".join(["word"] * 200_000)]
    assert texts(['<a href="' * 2000 + "text"])  # quotes without an end


def test_edges(spark):
    page = "<title>t</title><article><h1>A</h1><p>b</article>"
    rows = [(1, "http://a.example.com/x", page), (1, "http://a.example.com/x", page), (None, None, page), (2, "no address", None), (3, "HTTP://u:p@A.example.com:80/y", ""), (4, "http://a.example.com", "plain & simple"), (5, "http://b.example.com", "<br>")]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS host", "2 AS template", "3 AS text", "4 AS n_chars")
    got = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in H.html_extraction(df).collect()), key=repr)
    want = [(r[0] or 0, r[1], t, len(t)) for r, t in zip(rows, ["A\nb", "A\nb", "A\nb", "", "", "plain & simple", ""])]
    assert got == sorted(want, key=repr)
    assert H.html_extraction(spark.createDataFrame([], PAGES)).collect() == []
    hosts = spark.createDataFrame(rows, PAGES).select(H.host_of("url")).collect()
    assert [h[0] for h in hosts] == ["a.example.com", "a.example.com", "", "", "a.example.com", "a.example.com", "b.example.com"]
