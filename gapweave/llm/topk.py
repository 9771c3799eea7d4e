"""Exact top-k search by inner product, block at a time.

Vector components are the terms. Rows are put in document ranges, ranges in blocks; a block carries the
least and the greatest value of each term, which bound the score of a query in it, and a forward index (the matrix
of its rows). Per query, blocks are taken in the order of their bounds until a bound falls below the k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gapweave.operators.blocks import beside

#: Rows of one document range (the unit that Spark deals out), rows of a block in it, queries that meet a range at once.
RANGE_ROWS, BLOCK_ROWS, QUERY_ROWS = 8_192, 128, 1_024
#: Terms whose signs order the rows, so that a block holds similar rows and has tight bounds.
_ORDER_TERMS = 10


def finite_vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector as doubles) of rows whose vector is neither null nor holds null or non-finite components."""
    vector = F.col(vector_column).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    rows = df.select(F.col(id_column).alias("id"), vector.alias("vector"))
    return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", bad))


def pack(rows: DataFrame, group: str, limit: int, order: list[str] = ()) -> DataFrame:
    """Rows (id, vector, group, order columns) as few rows (group, ids, dim, matrix).

    A group must be bounded; it is sorted by `order` and the id and cut into batches of at most `limit` rows.
    Shorter vectors are padded with zeros to the longest of the batch.
    """
    kind = rows.schema[group].dataType.simpleString()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([*order, "id"], kind="stable")
        out = []
        for at in range(0, len(frame), limit):
            part = frame.iloc[at : at + limit]
            dim = max((len(v) for v in part["vector"]), default=0)
            matrix = np.zeros((len(part), dim))
            for i, v in enumerate(part["vector"]):
                matrix[i, : len(v)] = v
            out.append([part.iloc[0][group], part["id"].to_numpy(np.int64).tobytes(), dim, matrix.tobytes()])
        return pd.DataFrame(out, columns=[group, "ids", "dim", "matrix"])

    keyed = rows.select(group, "id", "vector", *order)
    return keyed.groupBy(group).applyInPandas(run, f"{group} {kind}, ids binary, dim int, matrix binary")


def unpack(ids: bytes, dim: int, matrix: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(matrix, np.float64).reshape(-1, dim) if dim else np.zeros(
        (len(ids) // 8, 0)
    )


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (a, b))


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while these are exact, else in Python's integers."""
    most = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, queries.shape[1])
    if most < 2**53:
        return queries @ rows.T
    exact = np.array([[int(x) for x in row] for row in queries], object).reshape(queries.shape)
    others = np.array([[int(x) for x in row] for row in rows], object).reshape(rows.shape)
    return exact @ others.T


def search_range(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, block_rows: int = BLOCK_ROWS
) -> tuple[list[tuple[int, int, int]], int]:
    """The k best rows of one document range for each query, other than itself, as (query, id, score).

    Also gives the number of scored query-block pairs. Ties go to the smaller id; `rows` may be in any order.
    """
    queries, rows = same_width(queries, rows)
    blocks = [slice(at, at + block_rows) for at in range(0, len(ids), block_rows)]
    least = np.array([rows[b].min(axis=0) for b in blocks]).reshape(len(blocks), -1)
    most = np.array([rows[b].max(axis=0) for b in blocks]).reshape(len(blocks), -1)
    positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
    exact = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1]) < 2**53
    # Doubles would round such large bounds, so then no block is skipped.
    bounds = positive @ most.T + negative @ least.T if exact else np.full((len(queries), len(blocks)), np.inf)
    order = np.argsort(-bounds, axis=1, kind="stable")
    best: list[list[tuple[int, int]]] = [[] for _ in query_ids]  # (-score, id), sorted
    going = np.arange(len(query_ids))
    scored = 0
    for step in range(len(blocks)):
        # Queries whose next bound is below their k-th score are done: later bounds are no larger.
        going = np.array(
            [q for q in going if len(best[q]) < k or bounds[q, order[q, step]] >= -best[q][-1][0]], np.int64
        )
        if not len(going):
            break
        scored += len(going)
        at_block = order[going, step]
        for b in np.unique(at_block):  # queries that are at the same block share its forward index
            own = going[at_block == b]
            block_ids = ids[blocks[b]]
            scores = products(queries[own], rows[blocks[b]])
            for q, line in zip(own, scores):
                floor = -best[q][-1][0] if len(best[q]) >= k else None
                fit = np.flatnonzero((block_ids != query_ids[q]) & (True if floor is None else line >= floor))
                if len(fit):
                    merged = best[q] + [(-int(line[i]), int(block_ids[i])) for i in fit]
                    best[q] = sorted(merged)[:k]
    return [(int(query_ids[q]), i, -s) for q in range(len(query_ids)) for s, i in best[q]], scored


def top_k(
    queries: DataFrame, rows: DataFrame, k: int, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256
) -> DataFrame:
    """The k rows with the largest inner product for each query, by floor(scale * x) of the components.

    Scores beyond 64 bits are refused by the conversion. Returns query_id, rank (from 1), id column and score. A query is never its own result; ties go to the smaller
    id. Vectors that are null or hold null or non-finite components, and rows without an id, take no part; shorter
    vectors count as padded with zeros. Ids are integers; of repeated ids each row counts. Other columns are ignored.
    """

    def quantized(df: DataFrame) -> DataFrame:
        whole = F.transform("vector", lambda x: F.floor(x * scale).cast("double"))
        return finite_vectors(df, id_column, vector_column).select("id", whole.alias("vector"))

    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    batches = max(1, -(-queries.count() // QUERY_ROWS))
    sign = lambda i: F.when(F.coalesce(F.get("vector", F.lit(i)), F.lit(0.0)) < 0, "0").otherwise("1")
    # A range is a stretch of a hash, so that equal rows spread; in it, rows are ordered by the signs of their terms.
    stored = quantized(rows).select(
        "*",
        F.pmod(F.xxhash64("id"), F.lit(ranges)).alias("range"),
        F.concat(*map(sign, range(_ORDER_TERMS))).alias("near"),
    )
    asked = quantized(queries).withColumn("batch", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(batches)))
    # Every batch of queries meets every range once, and neither is copied for that.
    met = beside(
        pack(asked, "batch", QUERY_ROWS),
        "batch",
        batches,
        pack(stored, "range", RANGE_ROWS, ["near"]).toDF("range", "r_ids", "r_dim", "r_matrix"),
        "range",
        ranges,
    )

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                found, _ = search_range(
                    *unpack(row.ids, row.dim, row.matrix), *unpack(row.r_ids, row.r_dim, row.r_matrix), k
                )
                yield pd.DataFrame(found, columns=["query_id", "id", "score"], dtype="int64")

    found = met.drop("batch", "range").mapInPandas(search, "query_id bigint, id bigint, score bigint")
    return best_of(found, k).withColumnRenamed("id", id_column)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of (query_id, id, score) for each query; there are at most k per query and range."""
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.select("query_id", rank.alias("rank"), "id", "score").where(F.col("rank") <= k)
