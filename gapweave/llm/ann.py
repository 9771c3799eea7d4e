"""Approximate nearest neighbours by learned partitions.

On a bounded sample, the graph of nearest neighbours is cut into balanced parts; a small network then learns to
tell from a vector in which parts its neighbours are. Every row is put in its most probable part, a query looks
into its several most probable parts, and what it finds there is ranked by the exact inner product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.topk import best_of, finite_vectors, pack, same_width, unpack

#: Rows of the sample at most, neighbours in its graph, rows of a part per row of the sample that it should have.
FIT_ROWS, FIT_NEIGHBOURS, FIT_ROWS_PER_PART = 8_192, 16, 48
#: Share of a sample's true neighbours that its queries must find; sets how many parts are looked into.
TARGET_RECALL = 0.97
#: Rows of a block of a part, and queries that meet a block at once.
BLOCK_ROWS, QUERY_ROWS = 16_384, 1_024
_HIDDEN, _EPOCHS, _BATCH, _RATE = 96, 30, 256, 3e-3


def neighbours(vectors: np.ndarray, k: int, rows: np.ndarray | None = None) -> np.ndarray:
    """The k rows with the largest inner product with each of `rows` (all, if not given), without themselves."""
    rows = np.arange(len(vectors)) if rows is None else rows
    k = min(k, len(vectors) - 1)
    out = np.zeros((len(rows), max(k, 0)), np.int64)
    for at in range(0, len(rows), 1_024):
        part = rows[at : at + 1_024]
        scores = vectors[part] @ vectors.T
        scores[np.arange(len(part)), part] = -np.inf
        if k > 0:
            out[at : at + 1_024] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator, rounds: int = 25) -> np.ndarray:
    """A part for each node, with at most a tenth more than the mean in any part and few edges between parts.

    Starts from medians of random projections; then nodes move to the part that most of their neighbours are in,
    the largest gains first, while that part has room.
    """
    n = len(vectors)
    label = np.zeros(n, np.int64)
    stack = [(np.arange(n), 0, parts)]
    while stack:
        rows, first, count = stack.pop()
        if count == 1 or not len(rows):
            label[rows] = first
            continue
        # The direction between two far rows separates better than a random one.
        a, b = vectors[rng.choice(rows)], vectors[rng.choice(rows)]
        order = rows[np.argsort(vectors[rows] @ (a - b) + 1e-9 * rng.standard_normal(len(rows)), kind="stable")]
        left = count // 2
        cut = len(rows) * left // count
        stack += [(order[:cut], first, left), (order[cut:], first + left, count - left)]
    room = int(np.ceil(1.1 * n / parts))
    both = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])
    others = np.concatenate([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])
    for _ in range(rounds):
        votes = np.bincount(both * parts + label[others], minlength=n * parts).reshape(n, parts)
        wanted = votes.argmax(axis=1)
        gain = votes[np.arange(n), wanted] - votes[np.arange(n), label]
        sizes = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[wanted[i]] < room and rng.random() < 0.7:  # not all at once, lest neighbours swap for ever
                sizes[label[i]] -= 1
                sizes[wanted[i]] += 1
                label[i] = wanted[i]
                moved += 1
        if moved < n / 500:
            break
    return label


@dataclass
class Router:
    """A network with one hidden layer that gives the parts of a vector by their probability."""

    weights: list[np.ndarray]
    probes: int

    @property
    def parts(self) -> int:
        return self.weights[3].shape[0]

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        width = w1.shape[0]
        vectors = np.pad(vectors, ((0, 0), (0, max(0, width - vectors.shape[1]))))[:, :width]
        return np.maximum(vectors @ w1 + b1, 0) @ w2 + b2

    def best(self, vectors: np.ndarray, count: int) -> np.ndarray:
        return np.argsort(-self.logits(vectors), axis=1, kind="stable")[:, :count]

    def looked_into(self, vectors: np.ndarray, sizes: np.ndarray, rows: int) -> list[np.ndarray]:
        """The best parts of each vector: `probes`, or more where these do not hold more than `rows` rows."""
        order = self.best(vectors, self.parts)
        short = (np.cumsum(sizes[order], axis=1) <= rows).sum(axis=1)
        return [line[:count] for line, count in zip(order, np.maximum(self.probes, short + 1))]


def train_router(vectors: np.ndarray, targets: np.ndarray, rng: np.random.Generator) -> Router:
    """Fits the network to the share that each part has of the neighbours of a row (Adam on the cross-entropy)."""
    dim, parts = vectors.shape[1], targets.shape[1]
    scale = 1.0 / max(1e-12, float(np.sqrt((vectors**2).mean()))) if vectors.size else 1.0
    weights = [
        rng.standard_normal((dim, _HIDDEN)) * np.sqrt(2.0 / max(1, dim)),
        np.zeros(_HIDDEN),
        rng.standard_normal((_HIDDEN, parts)) * np.sqrt(1.0 / _HIDDEN),
        np.zeros(parts),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for epoch in range(_EPOCHS):
        rate = _RATE * 0.5 * (1 + np.cos(np.pi * epoch / _EPOCHS))
        order = rng.permutation(len(vectors))
        for at in range(0, len(order), _BATCH):
            rows = order[at : at + _BATCH]
            x = vectors[rows] * scale
            hidden = np.maximum(x @ weights[0] + weights[1], 0)
            logits = hidden @ weights[2] + weights[3]
            share = np.exp(logits - logits.max(axis=1, keepdims=True))
            delta = (share / share.sum(axis=1, keepdims=True) - targets[rows]) / len(rows)
            back = (delta @ weights[2].T) * (hidden > 0)
            step += 1
            for i, gradient in enumerate([x.T @ back, back.sum(0), hidden.T @ delta, delta.sum(0)]):
                first[i] += 0.1 * (gradient - first[i])
                second[i] += 0.001 * (gradient**2 - second[i])
                weights[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    weights[0] = weights[0] * scale
    return Router(weights, 1)


def fit_router(vectors: np.ndarray, parts: int, k: int = 20, seed: int = 7) -> Router:
    """Graph, parts, network, and the number of parts to look into for `TARGET_RECALL` on held-out rows."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(vectors))
    held, kept = order[: len(vectors) // 8], np.sort(order[len(vectors) // 8 :])
    train = vectors[kept]
    graph = neighbours(train, FIT_NEIGHBOURS)
    label = balanced_parts(train, graph, parts, rng)
    targets = np.bincount(
        np.repeat(np.arange(len(train)), graph.shape[1] + 1) * parts
        + np.concatenate([label[:, None], label[graph]], axis=1).ravel(),
        minlength=len(train) * parts,
    ).reshape(len(train), parts) / (graph.shape[1] + 1)
    router = train_router(train, targets, rng)
    # Rows go where the network puts them, held-out rows ask.
    place = router.best(vectors, 1)[:, 0]
    near = neighbours(vectors, k, held)
    ranks = np.argsort(router.best(vectors[held], parts), axis=1)  # ranks[q, part]: how probable the part is for q
    needed = ranks[np.arange(len(held))[:, None], place[near]] + 1 if len(held) else np.ones((1, 1), np.int64)
    found = np.cumsum(np.bincount(needed.ravel(), minlength=parts + 1)) / max(1, needed.size)
    router.probes = int(np.searchsorted(found, TARGET_RECALL)) or 1
    router.probes = min(router.probes, parts)
    return router


def nearest_in_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int
) -> Iterator[tuple[int, int, float]]:
    """The k best rows of a block for each query. Scores are summed component by component, so equal rows tie."""
    queries, rows = same_width(queries, rows)
    rough = queries @ rows.T
    slack = 1e-9 * (np.abs(queries) @ np.abs(rows).max(axis=0, initial=0) + 1e-300)
    for q in range(len(query_ids)):
        line = np.where(ids == query_ids[q], -np.inf, rough[q])
        fit = np.flatnonzero(line > -np.inf)
        if len(fit) > k:
            fit = np.flatnonzero(line >= np.partition(line, len(line) - k)[len(line) - k] - slack[q])
            fit = fit[line[fit] > -np.inf]
        scores = np.cumsum(rows[fit] * queries[q], axis=1)[:, -1] if rows.shape[1] else np.zeros(len(fit))
        for i in np.lexsort((ids[fit], -scores))[:k]:
            yield int(query_ids[q]), int(ids[fit[i]]), float(scores[i])


def search(
    queries: DataFrame, rows: DataFrame, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), id and score of the k nearest rows found for each query, other than itself.

    Nearness is the inner product in double precision; ties go to the smaller id. Vectors that are null, zero, or
    hold null or non-finite components, and rows without an id, take no part; shorter vectors count as padded with
    zeros. Where the parts looked into do not hold more than k rows, the query looks into further ones. Ids are integers;
    repeated rows count each. Other columns are ignored; an empty table gives an empty result.
    """
    nonzero = lambda df: df.where(F.exists("vector", lambda x: x != 0))
    stored = nonzero(finite_vectors(rows, id_column, vector_column))
    asked = nonzero(finite_vectors(queries, id_column, vector_column))
    total = stored.count()
    bound = 1.0 if total <= FIT_ROWS else min(1.0, 1.2 * FIT_ROWS / total)
    order = F.md5(F.col("id").cast("string"))
    near = stored.where(F.substring(order, 1, 8) <= format(min(int(bound * (1 << 32)), (1 << 32) - 1), "08x"))
    sample = [row["vector"] for row in near.orderBy(order, "id").limit(FIT_ROWS).select("vector").collect()]
    width = max(map(len, sample), default=0)
    matrix = np.zeros((len(sample), width))
    for i, vector in enumerate(sample):
        matrix[i, : len(vector)] = vector
    parts = int(max(1, min(len(sample) // FIT_ROWS_PER_PART, round(total**0.5 / 16))))
    router = fit_router(matrix, parts, k)

    def place(pick):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                dim = max(map(len, frame["vector"]), default=0)
                vectors = np.zeros((len(frame), dim))
                for i, vector in enumerate(frame["vector"]):
                    vectors[i, : len(vector)] = vector
                yield frame.assign(parts=list(pick(vectors)) if len(frame) else [])

        return run

    schema = "id bigint, vector array<double>, parts array<int>"
    typed = lambda df: df.select(F.col("id").cast("bigint").alias("id"), "vector")
    placed = typed(stored).mapInPandas(place(lambda v: router.best(v, 1)), schema).select("id", "vector", F.col("parts")[0].alias("part"))
    sizes = {row["part"]: row["count"] for row in placed.groupBy("part").count().collect()}  # one row per part
    if not sizes:
        return stored.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(id_column), F.lit(0.0).alias("score")
        ).limit(0)
    # A part is cut into blocks by a hash of the id, so that a part with most rows, or very many equal rows, spreads.
    blocks = {part: -(-count // (BLOCK_ROWS // 2)) for part, count in sizes.items()}
    blocks_of = F.create_map(*(F.lit(x) for pair in blocks.items() for x in pair))
    first = F.create_map(*(F.lit(x) for part in blocks for x in (part, sum(n for p, n in blocks.items() if p < part))))
    keyed = placed.select(
        "id", "vector", (first[F.col("part")] + F.pmod(F.xxhash64("id"), blocks_of[F.col("part")])).cast("bigint").alias("block")
    )
    held = np.array([sizes.get(part, 0) for part in range(parts)])
    routed = typed(asked).mapInPandas(place(lambda v: router.looked_into(v, held, k)), schema)
    to_blocks = F.flatten(
        F.transform(
            "parts",
            lambda p: F.when(
                blocks_of[p].isNotNull(), F.sequence(first[p].cast("bigint"), (first[p] + blocks_of[p] - 1).cast("bigint"))
            ).otherwise(F.array().cast("array<bigint>")),
        )
    )
    batches = max(1, -(-queries.count() // QUERY_ROWS))
    asking = routed.select(
        "id", "vector", F.explode(to_blocks).alias("block"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(batches)).alias("batch")
    ).withColumn("both", F.struct("block", "batch").cast("string"))
    met = (
        pack(asking, "both", QUERY_ROWS)
        .withColumn("block", F.regexp_extract("both", "[0-9]+", 0).cast("bigint"))
        .join(pack(keyed, "block", BLOCK_ROWS).toDF("block", "r_ids", "r_dim", "r_matrix"), "block")
        .drop("both", "block")
    )

    def rank(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                pair = (*unpack(row.ids, row.dim, row.matrix), *unpack(row.r_ids, row.r_dim, row.r_matrix))
                yield pd.DataFrame(nearest_in_block(*pair, k), columns=["query_id", "id", "score"])

    found = met.mapInPandas(rank, "query_id bigint, id bigint, score double")
    return best_of(found, k).withColumnRenamed("id", id_column)
