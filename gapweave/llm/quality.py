"""Quality classifier by importance resampling.

Two generative models of hashed word n-grams, one of target text and one of all text, give each document the log of
their ratio. Adding Gumbel noise and keeping the k largest draws documents without replacement, with chances
in proportion to the ratio to the power of 1 / temperature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapweave.llm.text import IS_WORD, mix, prefix_hashes, range_hashes, runs, text_chunks
from gapweave.storage import materialize

BUCKETS = 10_000
#: Target documents that the target model is fitted on, at most: those with the least md5 of the id.
TARGET_DOCUMENTS = 20_000
_SMOOTHING = 1.0
_TWICE = np.uint64(0x7257)
#: Log weights are told apart between -_RANGE and _RANGE when the cut-off is looked for.
_RANGE = 2_000
_IS_WORD_CHAR = np.zeros(256, bool)
_IS_WORD_CHAR[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True
_IS_MARK = IS_WORD & ~_IS_WORD_CHAR


def features(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every 1-gram and 2-gram. Tokens are runs of letters, digits and _, and runs of other marks.

    A token twice in a row is one and the same 2-gram, whatever the token.
    """
    word, mark = runs(_IS_WORD_CHAR[data], rows), runs(_IS_MARK[data], rows)
    starts, ends = np.concatenate([word[0], mark[0]]), np.concatenate([word[1], mark[1]])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    hashes = range_hashes(*prefix_hashes(data), starts, ends)
    row_of = np.searchsorted(rows, starts, "right") - 1
    pairs = mix(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) else hashes
    pairs[hashes[:-1] == hashes[1:]] = _TWICE
    same = row_of[:-1] == row_of[1:]
    both = np.concatenate([hashes, pairs[same]])
    return np.concatenate([row_of, row_of[:-1][same]]), (both % np.uint64(BUCKETS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams of all rows and of target rows, by bucket."""
    everything, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        wanted = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for first, last, data, rows in text_chunks(batch.column(0)):
            row, bucket = features(data, rows)
            everything += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[wanted[first:last][row]], minlength=BUCKETS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(BUCKETS)), pa.array(everything), pa.array(target)], ["bucket", "everything", "target"]
    )


def fit(docs: DataFrame, targets: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = TARGET_DOCUMENTS) -> np.ndarray:
    """Log ratio of the target model to the model of all text, by bucket.

    All rows of `docs` count for the model of all text. `targets` (id column) names target documents, of which at
    most `limit` are used; these ids are broadcast. The driver gets one row per bucket. Without text all ratios are 0.
    """
    ids = targets.select(F.col(id_column).alias("id")).where(F.col("id").isNotNull()).distinct()
    chosen = ids.orderBy(F.md5(F.col("id").cast("string")), "id").limit(limit).withColumn("wanted", F.lit(True))
    flagged = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(
        F.broadcast(chosen), "id", "left"
    )
    counted = flagged.select("text", F.coalesce("wanted", F.lit(False)).alias("wanted")).mapInArrow(
        _count, "bucket bigint, everything bigint, target bigint"
    )
    sums = counted.groupBy("bucket").agg(F.sum("everything").alias("e"), F.sum("target").alias("t")).collect()
    everything, target = np.full(BUCKETS, _SMOOTHING), np.full(BUCKETS, _SMOOTHING)
    for row in sums:
        everything[row["bucket"]] += row["e"]
        target[row["bucket"]] += row["t"]
    if target.sum() == _SMOOTHING * BUCKETS:
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(everything / everything.sum())


def score(docs: DataFrame, ratios: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, log_weight, n_grams) of every row; a text without tokens, or null, has log weight 0 and no n-grams."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights, counts = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for first, last, data, rows in text_chunks(batch.column(1)):
                row, bucket = features(data, rows)
                weights[first:last] = np.bincount(row, weights=ratios[bucket], minlength=last - first)
                counts[first:last] = np.bincount(row, minlength=last - first)
            # Rounded, so that the sum does not depend on how texts were put together.
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.round(weights, 6) + 0.0), pa.array(counts)], ["id", "log_weight", "n_grams"]
            )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, log_weight double, n_grams bigint").withColumnRenamed("id", id_column)


def cutoff(scored: DataFrame, targets: DataFrame, keep: float, id_column: str = "doc_id") -> float:
    """The log weight that a share `keep` of the target documents reaches, to a quarter; all of them are counted.

    The driver gets one row per quarter between -`_RANGE` and `_RANGE`.
    """
    bins = F.least(F.greatest(F.floor(F.col("log_weight") * 4), F.lit(-4 * _RANGE)), F.lit(4 * _RANGE))
    wanted = targets.select(F.col(id_column)).distinct()
    counts = scored.join(wanted, id_column, "left_semi").groupBy(bins.alias("bin")).count().collect()
    total, below = sum(row["count"] for row in counts), 0
    for row in sorted(counts, key=lambda row: row["bin"]):
        if below + row["count"] > (1 - keep) * total:
            return row["bin"] / 4
        below += row["count"]
    return float("-inf")


def resample(
    docs: DataFrame,
    targets: DataFrame,
    keep: float = 0.9998,
    margin: float = 4.0,
    temperature: float = 0.05,
    seed: int = 17,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, log_weight, n_grams, sample_key, rank, selected) of every row of `docs`.

    `targets` (id column) names documents of the wanted kind. As many documents are drawn as have a log weight
    that a share `keep` of the targets reaches, or less by at most `margin`; the draw is by Gumbel top-k on log weight + temperature * noise, where the
    noise is a hash of the id and the seed. Ties go to the smaller id. Null and empty texts have log weight 0; repeated
    rows are ranked each (and drawn or not together, but for the last rank); null ids get the noise of an empty id.
    Without targets, everything is drawn. Other columns are ignored.
    """
    ratios = fit(docs, targets, id_column, text_column)
    uniform = (F.shiftrightunsigned(F.xxhash64(F.col(id_column).cast("string"), F.lit(seed)), 11) + 0.5) / float(1 << 53)
    key = F.col("log_weight") - temperature * F.log(-F.log(uniform))
    scored = materialize(score(docs, ratios, id_column, text_column).withColumn("sample_key", key), "quality")
    wanted = scored.where(F.col("log_weight") >= cutoff(scored, targets, keep, id_column) - margin).count()
    return number_globally(scored, [F.desc("sample_key"), F.asc(id_column)], "rank").withColumn(
        "selected", F.col("rank") <= wanted
    )


def number_globally(rows: DataFrame, order: list, name: str) -> DataFrame:
    """Numbers all rows from 1 in an order, without sorting in one task.

    Rows are range-partitioned and stored; each range is numbered by itself and shifted by the sizes of those before.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    stored = materialize(ranged, "ranges")
    sizes = stored.groupBy("_range").count()
    before = F.sum("count").over(Window.orderBy("_range")) - F.col("count")
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    offsets = F.broadcast(sizes.select("_range", before.alias("_before")))  # one row per range
    numbered = stored.withColumn("_own", own).join(offsets, "_range")
    return numbered.select(*rows.columns, (F.col("_before") + F.col("_own")).alias(name))
