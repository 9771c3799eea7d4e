"""Texts to vectors."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.functions.text import normalize_text
from gapweave.operators.lookup import skew_safe_lookup
from gapweave.operators.scoring import LexicalScorer, token_counts

_ROWS_PER_BATCH = 100_000

# Bytes of a batch that are worked on at a time, and tokens whose places an encoder remembers.
_PIECE_BYTES = 4 * 2**20
_KNOWN_TOKENS = 100_000


def _small_pieces(batches, column: str | int):
    """The batches cut so that `column` has a few megabytes in each piece, as what is made of it takes several times that."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * min(1.0, _PIECE_BYTES / max(1, batch.column(column).nbytes))))
        yield from (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


class Encoder(Protocol):
    """What `embed_texts` needs: a batch of texts in, a matrix with one row per text out."""

    def encode(self, texts: Sequence[str]) -> np.ndarray: ...


class HashedTokenEncoder:
    """Token counts folded into `dimension` places by a hash of the token; needs no model file."""

    def __init__(self, dimension: int = 64):
        self.dimension = dimension
        self.places: dict[str, int] = {}

    def _place(self, token: str) -> int:
        place = self.places.get(token)
        if place is None:
            place = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % self.dimension
            if len(self.places) < _KNOWN_TOKENS:
                self.places[token] = place
        return place

    def encode(self, texts: Sequence[str]) -> np.ndarray:
        vectors = np.zeros((len(texts), self.dimension))
        for row, text in enumerate(texts):
            places = [self._place(t) for t in text.lower().split()]
            vectors[row] = np.bincount(places, minlength=self.dimension) if places else 0
        return vectors


def embed_texts(
    df: DataFrame,
    text: str,
    encoder: Callable[[], Encoder],
    batch_size: int = 16,
    vector: str = "vector",
    partitions: int | None = None,
) -> DataFrame:
    """Append a unit-length float vector of the column `text`.

    `encoder` is called once per task, where a model is then loaded; texts reach it in batches of
    `batch_size`. An empty or null text gets the zero vector. With `partitions` the rows are first
    spread over that many tasks, for an input of few files.
    """
    if partitions:
        df = df.repartition(partitions)
    schema = T.StructType(
        [*df.schema.fields, T.StructField(vector, T.ArrayType(T.FloatType(), False))]
    )
    prepared = "_prepared_text"
    names = df.columns

    def encode(batches):
        model = encoder()
        for batch in _small_pieces(batches, prepared):
            texts = batch.column(prepared).to_pylist()
            parts = [
                np.asarray(model.encode(texts[i : i + batch_size]), dtype=np.float64)
                for i in range(0, len(texts), batch_size)
            ]
            if not parts:
                continue
            matrix = np.vstack(parts)
            matrix[[not t for t in texts]] = 0.0
            norms = np.linalg.norm(matrix, axis=1, keepdims=True)
            unit = (matrix / np.where(norms > 0, norms, 1.0)).astype(np.float32)
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * unit.shape[1]
            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(unit.ravel()))
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, values], [*names, vector])

    return df.withColumn(prepared, normalize_text(F.col(text))).mapInArrow(encode, schema)


def embed_cached(
    df: DataFrame,
    text: str,
    encoder: Callable[[], Encoder],
    store: str,
    version: str,
    spread: str,
    batch_size: int = 16,
    vector: str = "vector",
    partitions: int | None = None,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """`embed_texts`, but a text is encoded once, however often and in however many runs it occurs.

    `store` is a folder of Parquet files with a subfolder per `version`, the name of the encoder and its settings: SHA-256
    of the normalised text, and vector. Only texts it lacks are encoded, one row of each, and added as one write, which counts
    when it is complete; runs at the same time may both encode a text. Vectors are joined back by the hash, texts with more than
    `hot_rows` rows salted by the column `spread`. Rows are kept as they are, repeated ones too; null counts as the empty
    text.
    """
    spark, place, key = df.sparkSession, f"{store.rstrip('/')}/encoder={version}", f"_hash_of_{vector}"
    schema = T.StructType([T.StructField(key, T.BinaryType()), T.StructField(vector, T.ArrayType(T.FloatType(), False))])

    def cached() -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(f"{place}/run-*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    prepared = F.coalesce(normalize_text(F.col(text)), F.lit(""))
    hashed = df.withColumn(key, F.unhex(F.sha2(prepared, 256)))
    texts = hashed.select(key, prepared.alias("text")).join(cached(), key, "left_anti").dropDuplicates([key])
    new = embed_texts(texts, "text", encoder, batch_size, vector, partitions).select(key, vector)
    new.write.parquet(f"{place}/run-{uuid.uuid4().hex}")
    return skew_safe_lookup(hashed, cached().dropDuplicates([key]), key, spread, hot_rows=hot_rows).select(*df.columns, vector)


def lexical_vectors(df: DataFrame, key: str, text: str, partitions: int | None = None) -> DataFrame:
    """(key, token, weight): unit-length counts of the lower-cased tokens of each text.

    Counted inside the row's Arrow batch, so neither texts nor tokens are shuffled. `partitions` is as
    in `embed_texts`.
    """
    if partitions:
        df = df.repartition(partitions)
    scorer = LexicalScorer()
    texts = scorer.ready(df.select(key, F.col(text).alias(scorer.column)))
    schema = T.StructType(
        [df.schema[key], T.StructField("token", T.StringType()), T.StructField("weight", T.DoubleType())]
    )

    def count(batches):
        for batch in _small_pieces(batches, 1):
            vocabulary, row, token, weight = token_counts(batch.column(1))
            for start in range(0, len(row), _ROWS_PER_BATCH):
                piece = slice(start, start + _ROWS_PER_BATCH)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row[piece])),
                        vocabulary.take(pa.array(token[piece])),
                        pa.array(weight[piece]),
                    ],
                    schema.names,
                )

    return texts.mapInArrow(count, schema)


def mean_pool(df: DataFrame, key: str, vector: str, mask: str | None = None) -> DataFrame:
    """(key, vector): element-wise mean of the vectors of each key, masked ones left out.

    Sums are combined per task and position before the shuffle, so a hot key is no burden.
    """
    if mask:
        df = df.where(F.col(mask) > 0)
    means = (
        df.select(key, F.posexplode(vector).alias("pos", "x"))
        .groupBy(key, "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(key).agg(F.transform(ordered, lambda p: p["x"]).alias("vector"))
