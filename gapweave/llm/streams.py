"""Sorted rows read one by one inside a task, with bounded state per group."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROWS = 8192


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, in the order of the columns."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def batches_of(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows given as tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def walk_sorted(
    df: DataFrame, key: str, order: list[Column], walk: Callable[[Iterator[tuple]], Iterator[tuple]], out: pa.Schema, ddl: str
) -> DataFrame:
    """`walk` over the rows of every key in `order`; a key is never divided, and its rows are never held together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(walk(rows_of(batches)), out)

    return df.repartition(F.col(key)).sortWithinPartitions(F.col(key), *order).mapInArrow(run, ddl)


def joined_digests(pieces: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the texts of a key, comma-joined by `order`. The texts are streamed."""

    def walk(rows: Iterator[tuple]) -> Iterator[tuple]:
        last, digest = None, None
        for name, _, piece in rows:
            if digest is None or name != last:
                if digest is not None:
                    yield last, digest.hexdigest()
                last, digest = name, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        if digest is not None:
            yield last, digest.hexdigest()

    out = pa.schema([(key, pa.binary()), ("ends_sha256", pa.string())])
    rows = pieces.select(key, order, text)
    return walk_sorted(rows, key, [F.col(order)], walk, out, f"{key} binary, ends_sha256 string")
