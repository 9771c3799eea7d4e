"""Main text of web pages, by deducing the template that pages of a host share.

A token is the start or the end of a block element, known by the path of tags and names to it, or a block of text at its
path. Tokens of a host that occur equally often in every one of its pages (equal occurrence vectors) form an equivalence
class. A vector is never built: every page has two random numbers, and a token carries the sums of count times number over
all pages, which are equal where the vectors are. Classes whose tokens are in half of the pages at least are candidates;
a class is valid if its tokens come in one order, repeated as a whole, in every page that has them. Valid classes nest:
between two tokens of one lies a slot, which holds other classes or text that the template does not have.

The text of slots is weighed by the region (article, main, section, div, table cell or body) that stands around it in the
template; regions of menus, headers, footers, sidebars, notices, adverts, forms and comments weigh nothing. The heaviest
region of a host is where its articles are, and all blocks in it are the text of a page. Text of the template is not
taken out of that region: a license line that all articles of a host end with is part of them.

Hosts with fewer than three pages are taken together. A page without the region of its host is judged by itself: its
article, or main, or else its heaviest region.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.llm.markup import CLOSE, OPEN, REGIONS, TEXT, Page, read_page
from gapweave.llm.streams import batches_of, rows_of
from gapweave.storage import materialize

LEAST_PAGES = 3
#: The site of hosts with fewer; no host has this name.
FEW = "/"
#: A character in an article or main element weighs so much.
IN_ARTICLE = 8
_LANES = (1 << 31) - 1
_SKELETON = pa.schema([
    ("site", pa.string()), ("seed", pa.int64()), ("tokens", pa.list_(pa.int64())), ("weights", pa.list_(pa.int32())),
    ("counts", pa.list_(pa.struct([("token", pa.int64()), ("times", pa.int64())]))),
])
_SKELETON_DDL = (
    "site string, seed bigint, tokens array<bigint>, weights array<int>, counts array<struct<token: bigint, times: bigint>>"
)


def site_of(url: Column) -> Column:
    """The host in lower case; empty without one."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[^/?#]*?://([^/?#]*)", 1)), F.lit(""))


def tokens_of(page: Page) -> tuple[list[int], list[int]]:
    """Tokens of a page (hash of a path or text times 4, plus kind), and what each weighs as text of an article."""
    left_out, in_article = page.left_out()
    tokens, weights = [], []
    for kind, element, text in page.events:
        mark = page.elements[element].mark if element >= 0 else 0
        if kind == TEXT:
            mark = xxhash.xxh64_intdigest(text, mark & 0xFFFFFFFF) >> 3
        tokens.append(mark << 2 | kind)
        counts = kind == TEXT and not (element >= 0 and left_out[element])
        weights.append(counts * len(text) * (IN_ARTICLE if element >= 0 and in_article[element] else 1))
    return tokens, weights


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for site, seed, text in rows_of(batches):
            tokens, weights = tokens_of(read_page(text))
            yield site, seed, tokens, weights, [{"token": t, "times": n} for t, n in Counter(tokens).items()]

    return batches_of(rows(), _SKELETON)


def equivalence_classes(skeletons: DataFrame, sizes: DataFrame) -> DataFrame:
    """(site, class, tokens): tokens in half of a site's pages or more, by equal occurrence vectors; two tokens at least.

    `skeletons` has site, seed and counts, `sizes` has site and pages. There are no more such tokens than twice what a
    page holds on average, so the row of a class does not grow with the number of pages.
    """
    lanes = [F.shiftright("seed", 32).bitwiseAND(_LANES), F.col("seed").bitwiseAND(_LANES)]
    vectors = (
        skeletons.select("site", *(lane.alias(f"r{n}") for n, lane in enumerate(lanes)), F.explode("counts").alias("c"))
        .groupBy("site", F.col("c.token").alias("token"))
        .agg(
            F.count("*").alias("pages"), F.sum("c.times").alias("times"),
            *(F.sum(F.col("c.times") * F.col(f"r{n}")).alias(f"v{n}") for n in range(2)),
        )
        .where("pages > 1")
    )
    return (
        vectors.join(sizes.withColumnRenamed("pages", "all"), "site")
        .where("pages * 2 >= all")
        .groupBy("site", "pages", "times", "v0", "v1")
        .agg(F.sort_array(F.collect_list("token")).alias("tokens"))
        .where("size(tokens) > 1")
        .select("site", F.element_at("tokens", 1).alias("class"), "tokens")
    )


def order_of(tokens: list[int], members: set[int]) -> tuple[int, ...] | None:
    """The order in which the members of a class follow each other in a page, if it repeats as a whole; else None."""
    found = [t for t in tokens if t in members]
    period = found[: len(members)]
    if len(found) % max(1, len(period)) or len(set(period)) != len(members) or period * (len(found) // len(period)) != found:
        return None
    return tuple(period)


_ORDERS = pa.schema([("site", pa.string()), ("class", pa.int64()), ("least", pa.binary()), ("most", pa.binary())])


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (site, tokens, classes): least and greatest hash of the order of each class; empty for a page without one."""
    found: dict[tuple[str, int], list[bytes]] = {}
    for site, tokens, classes in rows_of(batches):
        of_class = {t: c["class"] for c in classes for t in c["tokens"]}
        present: dict[int, list[int]] = defaultdict(list)
        for t in tokens:
            if t in of_class:
                present[of_class[t]].append(t)
        for c in classes:
            if own := present.get(c["class"]):
                order = order_of(own, set(c["tokens"]))
                digest = b"" if order is None else xxhash.xxh128_digest(repr(order))
                span = found.setdefault((site, c["class"]), [digest, digest])
                span[0], span[1] = min(span[0], digest), max(span[1], digest)
        if len(found) > 50_000:
            yield from batches_of(((*k, *v) for k, v in found.items()), _ORDERS)
            found = {}
    yield from batches_of(((*k, *v) for k, v in found.items()), _ORDERS)


def weigh(page: list[tuple[int, int]], template: set[int]) -> Counter:
    """Characters of slot text by the region token around it in the template, from (token, weight) of a page."""
    mass: Counter = Counter()
    regions: list[int] = []
    for token, weight in page:
        kind = token & 3
        if kind == TEXT:
            if weight and token not in template and regions:
                mass[regions[-1]] += weight
        elif token in template:
            if kind == OPEN:
                regions.append(token)
            elif token - CLOSE in regions:
                while regions.pop() != token - CLOSE:
                    pass
    return mass


_MASS = pa.schema([("site", pa.string()), ("region", pa.int64()), ("mass", pa.int64())])


def _masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (site, tokens, weights, template): slot text by region."""
    found: Counter = Counter()
    for site, tokens, weights, template in rows_of(batches):
        for region, mass in weigh(list(zip(tokens, weights)), set(template)).items():
            found[site, region] += mass
        if len(found) > 50_000:
            yield from batches_of(((*k, n) for k, n in found.items()), _MASS)
            found = Counter()
    yield from batches_of(((*k, n) for k, n in found.items()), _MASS)


def deduce(skeletons: DataFrame) -> DataFrame:
    """(site, region): the start token of the region that holds the articles of a site, if the template has one."""
    sizes = skeletons.groupBy("site").agg(F.count("*").alias("pages"))
    classes = equivalence_classes(skeletons, sizes)
    by_site = classes.groupBy("site").agg(F.collect_list(F.struct("class", "tokens")).alias("classes"))
    by_site = materialize(by_site, "classes")
    orders = (
        skeletons.join(by_site, "site").select("site", "tokens", "classes")
        .mapInArrow(_orders, "site string, class bigint, least binary, most binary")
        .groupBy("site", "class").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    )
    valid = orders.where("least = most AND length(least) > 0").select("site", "class")
    template = (
        by_site.select("site", F.explode("classes").alias("c")).select("site", "c.class", "c.tokens").join(valid, ["site", "class"])
        .groupBy("site").agg(F.flatten(F.collect_list("tokens")).alias("template"))
    )
    return (
        skeletons.join(template, "site").select("site", "tokens", "weights", "template")
        .mapInArrow(_masses, "site string, region bigint, mass bigint")
        .groupBy("site", "region").agg(F.sum("mass").alias("mass"))
        .groupBy("site").agg(F.max_by("region", F.struct("mass", "region")).alias("region"))
    )


def _region_of(page: Page, left_out: list[bool], start: int) -> set[int]:
    """The elements whose subtrees are the article."""
    elements = page.elements

    def around(e: int, tags: frozenset[str] | set[str]) -> int:
        while e >= 0 and elements[e].tag not in tags:
            e = elements[e].parent
        return e

    found = {e for e, x in enumerate(elements) if x.mark << 2 == start and not left_out[e]} if start else set()
    if not found:
        for tag in ("article", "main"):
            if found := {e for e, x in enumerate(elements) if x.tag == tag and not left_out[e]}:
                return found
        mass: Counter = Counter()
        for kind, e, text in page.events:
            if kind == TEXT and not (e >= 0 and left_out[e]):
                mass[around(e, REGIONS)] += len(text)
        if not mass:
            return set()
        found = {max(mass, key=lambda e: (mass[e], -e))}
    wider = set()
    for e in found:
        if e >= 0:
            e = next((a for tag in ("article", "main") if (a := around(e, {tag})) >= 0), around(e, REGIONS))
        wider.add(e)
    return wider


def main_text(text: str | None, start: int) -> str:
    """Blocks of the article of a page, joined by spaces; `start` is the region of its site, or 0."""
    page = read_page(text)
    left_out, _ = page.left_out()
    chosen = _region_of(page, left_out, start)
    inside: list[bool] = []
    for e, x in enumerate(page.elements):
        inside.append(e in chosen or (x.parent >= 0 and inside[x.parent]))
    whole = -1 in chosen
    blocks = [
        block for kind, e, block in page.events
        if kind == TEXT and (whole or (e >= 0 and inside[e])) and not (e >= 0 and left_out[e])
    ]
    return " ".join(blocks)


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        rows = zip(*(batch.column(names.index(n)).to_pylist() for n in ("page_id", "url", "html", "region")))
        yield from batches_of(((i, u, main_text(h, start or 0)) for i, u, h, start in rows), _TEXTS)


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages` (page_id, url, html); other columns are ignored.

    Character references are decoded, white space within a block is one space, blocks are joined by one space in page
    order. A null or empty page has an empty text; one without any markup is its own text. Nulls and repeats of page_id
    and url stay as they are; pages without a host are a site of their own. Pages of any length are read as a whole, an
    empty table gives no rows. Nothing of a host meets in one task but its tokens, summed by host and token.
    """
    rows = pages.select("page_id", "url", "html", site_of(F.col("url")).alias("site"))
    hosts = rows.groupBy("site").agg(F.count("*").alias("pages")).select(
        "site", F.when(F.col("pages") < LEAST_PAGES, FEW).otherwise(F.col("site")).alias("pool")
    )
    hosts = materialize(hosts, "hosts")
    seed = F.xxhash64("page_id", "html", "url")
    read = rows.select("site", seed.alias("seed"), "html").mapInArrow(_skeletons, _SKELETON_DDL)
    pooled = read.join(hosts, "site").withColumn("site", F.col("pool")).drop("pool")
    regions = materialize(deduce(materialize(pooled, "skeletons")), "regions").withColumnRenamed("site", "pool")
    of_host = hosts.join(regions, "pool").select("site", "region")
    texts = (
        rows.join(of_host, "site", "left").select("page_id", "url", "html", "region")
        .mapInArrow(_texts, "page_id bigint, url string, text string")
    )
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
