import html
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from gapweave.llm import extract, markup

SCHEMA = "page_id bigint, url string, html string, site string, region bigint, text string"
WORDS = "ab cd ef gh éa öu naïve 語 x1 y2 z3 &lt; &amp; &eacute; it&#39;s".split()


def sentence(rng, most=30):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, most))) + "."


def plain(text):
    return " ".join(html.unescape(text).split())


def classic(rng, n):
    """Everything the text is not, around an article; tags left open, and names as sites use them."""
    blocks = [sentence(rng, 8)] + [sentence(rng) for _ in range(rng.randrange(1, 6))]
    body = "".join(f"<p>{'<b>' * (k % 2)}{b}\n<br>  {b}" + "</p>" * (k % 3 > 0) for k, b in enumerate(blocks[1:]))
    page = f"""<!DOCTYPE html><html><head><title>{blocks[0]}</title><style>p{{}}</style>
    <script>if (a<b) document.write("<p>no</p>");</script></head><body class="home page-{n}">
    <header><a href="/">Site</a><p>{sentence(rng)}</header><ul class="main-menu"><li>One<li>Two {n}</ul>
    <div class="cookieNotice" id=x{n}>{sentence(rng)}</div><!-- <p>no -->
    <div class="page with-sidebar"><article class="post"><header><h1>{blocks[0]}</h1><p>By {sentence(rng, 3)}</header>{body}
    <div class=ad-slot>{sentence(rng)}</div><form action="?"><label>Name</label><input></form>
    <aside>{sentence(rng)}</aside><footer>{sentence(rng)}</footer></article>
    <div id="sidebar-2">{sentence(rng, 90)}</div>
    <section id="comments"><article class="comment"><p>{sentence(rng, 90)}</article></section></div>
    <footer>&copy; x</footer></body></html>"""
    doubled = [blocks[0]] + [f"{b} {b}" for b in blocks[1:]]
    return page, " ".join(plain(b) for b in doubled)


def bare(rng, n):
    """No element says what it is; the region is known by what the pages of the host share."""
    blocks = [sentence(rng, 60) for _ in range(rng.randrange(2, 6))]
    links = "".join(f"<li><a href=/{k}>{rng.choice(WORDS)}</a></li>" for k in range(4))
    body = "".join(f"<p>{b}</p>" for b in blocks)
    page = f"""<html><body><div class="k1"><ul><li>Start</li>{links}</ul></div><div class="k2">{body}<p>Licensed to all.</p></div>
    <div class="k3">Top {sentence(rng, 3)}</div></body></html>"""
    return page, " ".join([*map(plain, blocks), "Licensed to all."])


def planted():
    rng = random.Random(1)
    rows = []
    for n in range(24):
        page, text = classic(rng, n)
        rows.append((n, f"https://Classic.example.org/{n}", page, text))
        page, text = bare(rng, n)
        rows.append((100 + n, f"http://bare.example.org:80/{n}?a", page, text))
        if n < 2:
            page, text = classic(rng, n)
            rows.append((200 + n, f"http://few{n}.example.org", page, text))
    return rows


def test_planted_pages(spark):
    rows = planted()
    pages = spark.createDataFrame([(i, u, h, "clash", 1, "clash") for i, u, h, _ in rows], SCHEMA).repartition(5)
    got = {r.page_id: r for r in extract.extract_text(pages).collect()}
    assert len(got) == len(rows)
    for page_id, url, _, text in rows:
        assert (got[page_id].url, got[page_id].text, got[page_id].n_chars) == (url, text, len(text)), page_id


def test_odd_pages(spark):
    long = "<p>" + "ab &amp; " * 200_000
    odd = [
        (None, None), ("", ""), ("no markup &lt; at\n all", "no markup < at all"), ("<p", ""), ("a < b <3 </> c", "a < b <3 c"),
        ("<article>x<script>y", "x"), ("<article>&am</article>", "&am"), ("<nav>a</nav>", ""), ("</p></div>t", "t"),
        ("<div>" * 5_000 + "deep", "deep"), (long, " ".join(["ab &"] * 200_000)), ('<article><a title="a>b">q</a>r</article>', "qr"),
        ("<article><a title='x>y</article>", "y"), ("<article>a<span hidden>b</span>c<p>d</article>", "ac d"),
    ]
    rows = [(n % 3 or None, "http://h/" if n % 2 else None, h, "s", 1, "t") for n, (h, _) in enumerate(odd)]
    rows += rows[:3]
    pages = spark.createDataFrame(rows, SCHEMA)
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in extract.extract_text(pages).collect())
    want = Counter((i, u, t, len(t)) for (i, u, *_), t in zip(rows, [t or "" for _, t in odd + odd[:3]]))
    assert got == want
    assert extract.extract_text(pages.limit(0)).collect() == []


def test_classes_equal_brute_force(spark):
    """Occurrence vectors written out, over the pages of one host."""
    pages = [(i, h) for i, u, h, _ in planted() if "bare" in u] + [(999, "<html><body><div class=k2><p>odd</div></body></html>")]
    spark_pages = spark.createDataFrame([("s", i * 7_919_000_003 + 5, h) for i, h in pages], "site string, seed bigint, html string")
    skeletons = spark_pages.mapInArrow(extract._skeletons, extract._SKELETON_DDL)
    sizes = spark.createDataFrame([("s", len(pages))], "site string, pages bigint")
    got = {frozenset(r.tokens) for r in extract.equivalence_classes(skeletons, sizes).collect()}
    counts = [Counter(extract.tokens_of(markup.read_page(h))[0]) for _, h in pages]
    vectors = defaultdict(set)
    for token in set().union(*counts):
        vector = tuple(c[token] for c in counts)
        if sum(map(bool, vector)) * 2 >= len(pages):
            vectors[vector].add(token)
    assert got == {frozenset(tokens) for tokens in vectors.values() if len(tokens) > 1}
    assert len(got) > 1


def test_order_of_a_class():
    assert extract.order_of([1, 9, 2, 1, 2], {1, 2}) == (1, 2)
    assert extract.order_of([2, 1, 2, 1], {1, 2}) == (2, 1)
    assert extract.order_of([1, 1, 2, 2], {1, 2}) is None
    assert extract.order_of([1, 2, 1], {1, 2}) is None


def test_article_without_its_sites_region(spark):
    """A page of another layout is judged by itself."""
    rng = random.Random(3)
    rows = [(n, "http://x.org/", bare(rng, n)[0]) for n in range(9)] + [(50, "http://x.org/", classic(random.Random(4), 1)[0])]
    got = extract.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert got.where(F.col("page_id") == 50).first().text == classic(random.Random(4), 1)[1]
