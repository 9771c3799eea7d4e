"""Joins of documents by the Jaccard similarity of their word n-grams.

Documents with equal sets are one class. A pair of classes is verified only if it shares prefix tokens under
several global token orders: the first order generates candidates by a join on the prefix tokens, under the bound
that the places of the token set; the others are filters that a candidate must pass as well. All orders put tokens
by their frequency, to a power of two, and differ in how they break ties. Each is a total order of all tokens, so
no link is lost.

Links are only needed to connect. So classes are first compared with one pivot per token and band of sizes, which is
linear in the size of a group of copies; afterwards only pairs from different components are candidates. The pivot is the
class with the least share of rarer tokens before that one: it has the least of its own, so most of its group link with it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.text import mix, shingles, text_chunks
from gapweave.storage import materialize

#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Counters of the frequency sketch. More tokens than counters only make the orders less telling.
COUNTERS = 1 << 20
ORDERS = 3
#: Tokens that one task counts at once, and classes whose counts one task adds up.
PART_TOKENS, HOME_CLASSES = 3_000_000, 100_000
#: Words of 64 bits in the mask of a set.
MASK_WORDS = 32
_SLICES = 64


def doc_sets(texts: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, tokens, offsets, class) for parts of the rows; tokens of a row are distinct and sorted.

    The class is a hash of the set, 0 for an empty one.
    """
    for first, last, data, rows in text_chunks(texts):
        row, token = shingles(data, rows, words)
        order = np.lexsort((token, row))
        row, token = row[order], token[order]
        if len(row):
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (token[1:] != token[:-1])])
            row, token = row[new], token[new]
        sizes = np.bincount(row, minlength=last - first)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(token + np.uint64(0x51ED)), dtype=np.uint64)])
        of_set = mix((sums[offsets[1:]] - sums[offsets[:-1]]) + sizes.astype(np.uint64))
        yield first, last, token, offsets, np.where(sizes > 0, of_set, np.uint64(0)).view(np.int64)


def needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The least intersection of linked sets of sizes n and m."""
    return -((-PERCENT * (n + m)) // (100 + PERCENT))


def prefix_size(n: np.ndarray) -> np.ndarray:
    """How many tokens of a set must be looked at: linked sets share at least PERCENT % of either."""
    return n + (-PERCENT * n) // 100 + 1


def _ordered(tokens: np.ndarray, sketch: np.ndarray, order: int) -> np.ndarray:
    """Places of the tokens in a global order: rarer ones first, ties by a hash that differs by order."""
    level = np.ceil(np.log2(sketch[tokens % np.uint64(COUNTERS)] + 1.0)).astype(np.uint64)
    tie = mix(tokens + np.uint64(order * 0x2545F491))
    return np.lexsort((tokens, tie, level))


def _classes(docs: DataFrame, words: int, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, _, offsets, of_set in doc_sets(batch.column(1), words):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(np.diff(offsets)), pa.array(of_set)],
                    ["id", "n", "class"],
                )

    return docs.mapInArrow(run, f"id {kind}, n bigint, class bigint")


def _shared_counts(docs: DataFrame, words: int, parts: int, homes: int) -> DataFrame:
    """(class, shared): how many tokens of a class are in other classes too.

    Tokens go to `parts` stretches of their hash as packed arrays; a class counts once per task. The counts of
    the parts are added up in `homes` groups of classes.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, token, offsets, of_set in doc_sets(batch.column(0), words):
                sizes = np.diff(offsets)
                once = np.zeros(len(of_set), bool)
                once[np.unique(of_set, return_index=True)[1]] = True
                keep = np.repeat(once & (of_set != 0), sizes)
                tokens, owner = token[keep], np.repeat(of_set, sizes)[keep]
                part = (tokens >> np.uint64(40)) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                bounds = np.searchsorted(part[order], np.arange(parts + 1))
                # 40 bits of a token besides its part: what falls together only counts a token as shared.
                short, owner = (tokens & np.uint64(0xFFFFFFFF)).astype(np.uint32)[order], owner[order]
                used = np.flatnonzero(np.diff(bounds))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used),
                        pa.array([short[bounds[p] : bounds[p + 1]].tobytes() for p in used], pa.binary()),
                        pa.array([owner[bounds[p] : bounds[p + 1]].tobytes() for p in used], pa.binary()),
                    ],
                    ["part", "tokens", "classes"],
                )

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        token = np.frombuffer(b"".join(frame["tokens"]), np.uint32)
        owners, owner = np.unique(np.frombuffer(b"".join(frame["classes"]), np.int64), return_inverse=True)
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])])
        token, owner = token[new], owner[new]
        shared = np.zeros(len(token), bool)
        shared[1:] |= token[1:] == token[:-1]
        shared[:-1] |= token[1:] == token[:-1]
        counts = np.bincount(owner[shared], minlength=len(owners))
        owners, counts = owners[counts > 0], counts[counts > 0]
        home = (owners.view(np.uint64) % np.uint64(homes)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        bounds = np.searchsorted(home[order], np.arange(homes + 1))
        used = np.flatnonzero(np.diff(bounds))
        pack = lambda values, p: values[order][bounds[p] : bounds[p + 1]].astype(np.int64).tobytes()
        return pd.DataFrame(
            {"home": used, "classes": [pack(owners, p) for p in used], "counts": [pack(counts, p) for p in used]}
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        owner, count = (np.frombuffer(b"".join(frame[name]), np.int64) for name in ("classes", "counts"))
        owners, at = np.unique(owner, return_inverse=True)
        return pd.DataFrame({"class": owners, "shared": np.bincount(at, weights=count).astype(np.int64)})

    packed = docs.select("text").mapInArrow(spread, "part bigint, tokens binary, classes binary")
    counted = packed.groupBy("part").applyInPandas(count, "home bigint, classes binary, counts binary")
    return counted.groupBy("home").applyInPandas(add, "class bigint, shared bigint")


def _stored_sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, token, offsets, of_set in doc_sets(batch.column(0), words):
                tokens = [token[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of_set), pa.array(np.diff(offsets)), pa.array(tokens, pa.binary())], ["class", "n", "tokens"]
                )

    return docs.select("text").mapInArrow(run, "class bigint, n bigint, tokens binary")


def _sketch(sets: DataFrame) -> np.ndarray:
    """How many classes hold the tokens of each counter; `COUNTERS` numbers in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for each in batch.column(0):
                np.add.at(counters, (np.frombuffer(each.as_buffer(), np.uint64) % np.uint64(COUNTERS)).astype(np.int64), 1)
        cut = counters.reshape(_SLICES, -1).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(_SLICES)), pa.array([c.tobytes() for c in cut], pa.binary())], ["slice", "counters"]
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum((np.frombuffer(c, np.uint32).astype(np.int64) for c in frame["counters"]))
        return pd.DataFrame({"slice": frame["slice"][:1], "counters": [total.tobytes()]})

    summed = sets.select("tokens").mapInArrow(run, "slice bigint, counters binary").groupBy("slice").applyInPandas(
        add, "slice bigint, counters binary"
    )
    out = np.zeros((_SLICES, COUNTERS // _SLICES), np.int64)
    for row in summed.collect():
        out[row["slice"]] = np.frombuffer(row["counters"], np.int64)
    return out.ravel()


def _postings(sets: DataFrame, sketch) -> DataFrame:
    """(token, class, n, place) of the prefix tokens under the first order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = sketch.value
        for batch in batches:
            for of_set, n, each in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                tokens = np.frombuffer(each.as_buffer(), np.uint64)
                chosen = tokens[_ordered(tokens, counters, 0)[: prefix_size(n)]]
                places = np.arange(len(chosen))
                # A counter of 1 means that no other class has the token.
                alone = counters[(chosen % np.uint64(COUNTERS)).astype(np.int64)] <= 1
                chosen, places = chosen[~alone], places[~alone]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(chosen.view(np.int64)),
                        pa.array(np.full(len(chosen), of_set, np.int64)),
                        pa.array(np.full(len(chosen), n, np.int64)),
                        pa.array(places),
                    ],
                    ["token", "class", "n", "place"],
                )

    return sets.select("class", "n", "tokens").mapInArrow(run, "token bigint, class bigint, n bigint, place bigint")


def _possible(a: str, b: str):
    """Sets that have this as their first common token can still reach the needed intersection."""
    most = F.least(F.col(f"{a}.n") - F.col(f"{a}.place"), F.col(f"{b}.n") - F.col(f"{b}.place"))
    return most * (100 + PERCENT) >= PERCENT * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _band(size: str):
    """Linked sets are at most one band of sizes apart."""
    return F.floor(F.log(F.col(size)) / math.log(100 / PERCENT))


def _pivots(postings: DataFrame) -> DataFrame:
    """(token, band, class, n, place): of the classes of a size that have a token, the one with the least share before it."""
    order = F.struct((F.col("place") / F.col("n")).alias("share"), F.xxhash64("class").alias("h"), "class", "n", "place")
    least = postings.groupBy("token", _band("n").alias("band")).agg(F.min(order).alias("p"))
    return least.select("token", "band", "p.class", "p.n", "p.place")


def _masks(sets: DataFrame) -> DataFrame:
    """(class, m0, m1, ...): the bits that the tokens of a class hash to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.zeros((batch.num_rows, MASK_WORDS * 64), np.uint8)
            for row, each in enumerate(batch.column(1)):
                bits[row, (mix(np.frombuffer(each.as_buffer(), np.uint64)) % np.uint64(MASK_WORDS * 64)).astype(np.int64)] = 1
            words = np.packbits(bits, axis=1).view(np.int64)
            columns = [batch.column(0), *(pa.array(np.ascontiguousarray(words[:, w])) for w in range(MASK_WORDS))]
            yield pa.RecordBatch.from_arrays(columns, ["class", *(f"m{w}" for w in range(MASK_WORDS))])

    masks = ", ".join(f"m{w} bigint" for w in range(MASK_WORDS))
    return sets.select("class", "tokens").mapInArrow(run, f"class bigint, {masks}")


def _masks_allow(a: str, b: str):
    """A bit that only one set has stands for a token at least that the other one lacks."""

    def most(one: str, other: str):
        lone = [F.bit_count(F.col(f"{one}.m{w}").bitwiseAND(F.bitwise_not(F.col(f"{other}.m{w}")))) for w in range(MASK_WORDS)]
        return F.col(f"{one}.n") - sum(lone[1:], lone[0])

    return F.least(most(a, b), most(b, a)) * (100 + PERCENT) >= PERCENT * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _links(pairs: DataFrame, sets: DataFrame, sketch) -> DataFrame:
    """Those of the pairs (a, b) of classes that pass the other orders and then the exact test."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = sketch.value
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                least = int(needed(np.int64(len(x)), np.int64(len(y))))
                keep.append(
                    min(len(x), len(y)) >= least
                    and all(
                        len(
                            np.intersect1d(
                                x[_ordered(x, counters, k)[: prefix_size(len(x))]],
                                y[_ordered(y, counters, k)[: prefix_size(len(y))]],
                                assume_unique=True,
                            )
                        )
                        for k in range(1, ORDERS)
                    )
                    and len(np.intersect1d(x, y, assume_unique=True)) >= least
                )
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    one = sets.select(F.col("class").alias("a"), F.col("tokens").alias("x"))
    two = sets.select(F.col("class").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links reach, for every node of `links` (a, b).

    Labels fall to the smallest neighbouring label and then to the label of that label, until none falls; each
    round is stored. Labels are only combined by minimum, so a node with very many links is no burden.
    """
    ways = materialize(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "ways"
    )
    labels = materialize(ways.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        seen = ways.join(labels, ways["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(seen, "node").select("node", F.least("label", "near").alias("to"), "label")
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("jumped"))
        fallen = materialize(
            lower.join(jump, "to").select("node", F.least("to", "jumped").alias("label"), F.col("label").alias("old")), "labels"
        )
        labels = fallen.select("node", "label")
        if fallen.where(F.col("label") != F.col("old")).isEmpty():
            return labels.withColumnRenamed("label", "component")


def similar_documents(docs: DataFrame, words: int = 5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_shingles, class_id and component_id of every row of `docs`.

    Words are runs of characters other than ASCII white space, with A-Z lower-cased; the set of a text are its
    distinct shingles of `words` words, or its whole sequence if that is shorter. `component_id` is the smallest id that
    links reach, `class_id` the smallest id with the same set. A text without words, or null, has an empty set, which
    links with nothing: both are its own id. Ids are integers; rows with a null id link with nothing and have null
    there; rows that repeat an id are judged by their own texts. Tokens and sets are compared by 64-bit hashes. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    found = materialize(_classes(rows, words, "bigint"), "classes")
    linkable = found.where(F.col("id").isNotNull() & (F.col("class") != 0))
    total = linkable.agg(F.sum("n")).first()[0] or 0
    groups = linkable.groupBy("class").agg(F.min("id").alias("first"), F.first("n").alias("n"))
    parts, homes = (max(12, -(-n // most)) for n, most in ((total, PART_TOKENS), (linkable.count(), HOME_CLASSES)))
    shared = _shared_counts(rows, words, parts, homes)
    # A linked set shares at least PERCENT % of its tokens with another class.
    able = groups.join(shared, "class").where(100 * F.col("shared") >= PERCENT * F.col("n"))
    able = materialize(able.select(F.col("first").alias("id"), "class"), "able")
    picked = rows.join(able.select("id").distinct(), "id", "left_semi")
    sets = materialize(_stored_sets(picked, words).join(able.select("class").distinct(), "class", "left_semi"), "sets")
    sketch = spark.sparkContext.broadcast(_sketch(sets))  # COUNTERS numbers, whatever the input
    postings = materialize(_postings(sets, sketch), "postings")
    pivots = _pivots(postings)
    ordered = [F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")]
    first_pairs = (
        postings.alias("x")
        .join(pivots.alias("y"), "token")
        .where((F.col("x.class") != F.col("y.class")) & (F.abs(_band("x.n") - F.col("y.band")) <= 1) & _possible("x", "y"))
        .select(*ordered)
        .distinct()
    )
    links = materialize(_links(first_pairs, sets, sketch), "links")
    joined = components(links)
    placed = materialize(
        postings.join(postings.groupBy("token").count().where("count > 1").select("token"), "token", "left_semi")
        .join(joined, postings["class"] == joined["node"], "left")
        .select("token", "class", "n", "place", F.coalesce("component", "class").alias("component")),
        "postings",
    )
    # Only tokens that still are in several components.
    several = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    placed = placed.join(several.where("low <> high").select("token"), "token", "left_semi").join(_masks(sets), "class")
    placed = materialize(placed, "postings")
    rest = (
        placed.alias("x")
        .join(placed.alias("y"), "token")
        .where(
            (F.col("x.class") < F.col("y.class"))
            & (F.col("x.component") != F.col("y.component"))
            & _possible("x", "y")
            & _masks_allow("x", "y")
        )
        .select(*ordered)
        .distinct()
    )
    labels = components(links.union(_links(rest, sets, sketch)))
    with_label = groups.join(labels, groups["class"] == labels["node"], "left").select(
        "class", F.col("first").alias("class_id"), F.coalesce("component", "class").alias("label")
    )
    with_label = materialize(with_label, "labels")
    least = with_label.groupBy("label").agg(F.min("class_id").alias("component_id"))
    of_class = with_label.join(least, "label").select("class", "class_id", "component_id")
    known = found.join(of_class, "class", "left")
    own = lambda name: F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("class") != 0, F.col(name)), F.col("id")))
    return known.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        own("class_id").alias("class_id"),
        own("component_id").alias("component_id"),
    )
