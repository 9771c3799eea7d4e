"""Distinct rows without moving rows that have no copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions.text import quoted
from gapweave.storage import materialize

#: Bits of a piece of the bit map, as `bitmap_construct_agg` makes them.
_PIECE = 32_768
#: Most pieces of the map that is broadcast: 64 MB. Bits for each repeated hash, where that many fit.
MAX_PIECES, BITS_PER_HASH = 16_384, 32
#: Types that have no hash, or whose equality is not that of their bytes.
_UNHASHED = ("map<", "variant", "collate", "interval")


def distinct_rows(df: DataFrame) -> DataFrame:
    """The rows of `df.dropDuplicates()`.

    A first pass shuffles a 64-bit hash and a count for each row, at most 24 bytes. Hashes that occur twice set bits of a
    map of bounded size, which is broadcast. Rows whose bit is not set have no copy and stay where they are; the others
    are compared as a whole, so neither equal hashes nor a full map change the result, only how many rows move.
    Copies are combined before the shuffle, so a group with a third of all rows costs no more than others.

    `df` is evaluated three times and must give the same rows each time; write it first if it is costly. Nulls are equal to
    each other, as are NaN and both zeros. Tables with intervals or collated texts take the plain way, and with maps
    or variants they are refused as there. An empty table gives an empty table; columns may have any names.
    """
    if not df.columns or any(kind in field.dataType.simpleString() for field in df.schema for kind in _UNHASHED):
        return df.dropDuplicates()
    if len(set(df.columns)) < len(df.columns):
        raise ValueError("columns of one name cannot be told apart")
    key = F.xxhash64(*[quoted(c) for c in df.columns])
    repeated = materialize(df.groupBy(key.alias("key")).count().where("count > 1").select("key"), "repeated")
    bits = _PIECE * min(MAX_PIECES, max(1, -(-repeated.count() * BITS_PER_HASH // _PIECE)))
    place = F.pmod(F.col("key"), F.lit(bits))
    pieces = repeated.groupBy((place / _PIECE).cast("long").alias("piece")).agg(
        F.bitmap_construct_agg(place % _PIECE).alias("map")
    )
    # Working columns stand beside the row, so no name of it can clash.
    rows = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("row"), F.pmod(key, F.lit(bits)).alias("place"))
    piece = (F.col("place") / _PIECE).cast("long")
    at = F.col("place") % _PIECE
    byte = F.conv(F.hex(F.substring("map", (at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    marked = rows.withColumn("piece", piece).join(F.broadcast(pieces), "piece", "left").select("row", is_set.alias("again"))
    alone = marked.where("not again").select("row.*")
    return alone.unionAll(marked.where("again").select("row.*").dropDuplicates())
