"""A stored dictionary that only grows: the code of a value is the same in every later version.

A store is a folder with one subfolder per version, which holds the values that were new then. A version counts once its
folder has its name, which happens when all of it is written; nothing is rewritten. One run at a time may add to a store.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.functions.text import quoted
from gapweave.operators.narrow import join_codes
from gapweave.operators.ordering import running_total
from gapweave.storage import rename

_ENTRIES = "column string, value string, code bigint"


def versions(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the versions in a store, ascending; none if there is no store yet."""
    root = spark._jvm.org.apache.hadoop.fs.Path(store)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(root)] if system.exists(root) else []
    return sorted(int(n.removeprefix("version=")) for n in names if re.fullmatch(r"version=\d+", n))


def stored_codes(spark: SparkSession, store: str, version: int | None = None) -> DataFrame:
    """(column, value, code, version): all values up to `version`, or of the newest one."""
    known = versions(spark, store)
    if version is not None and version not in known:
        raise ValueError(f"{store} has no version {version}")
    places = [f"{store.rstrip('/')}/version={v}" for v in known if version is None or v <= version]
    if not places:
        return spark.createDataFrame([], f"{_ENTRIES}, version int")
    return spark.read.schema(f"{_ENTRIES}, version int").option("basePath", store).parquet(*places)


def extend_codes(df: DataFrame, columns: Sequence[str], store: str) -> int:
    """Give the values of text `columns` that the store lacks codes of their own; returns the version that has all of them.

    New values are numbered in sorted order, after the highest code of their column. Only distinct values are shuffled.
    Null has no code, the empty text has one. Without new values no version is added, but for the first one.
    """
    spark = df.sparkSession
    cells = F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns])
    seen = df.select(F.inline(cells)).where("value IS NOT NULL").distinct()
    known = stored_codes(spark, store)
    new = running_total(seen.join(known, ["column", "value"], "left_anti").withColumn("one", F.lit(1)), "value", "one", ["column"])
    # One row per column.
    last = known.groupBy("column").agg((F.max("code") + 1).alias("first"))
    coded = new.join(F.broadcast(last), "column", "left").select(
        "column", "value", (F.coalesce("first", F.lit(0)) + F.col("upto") - 1).cast("bigint").alias("code")
    )
    newest = max(versions(spark, store), default=0)
    if newest and new.isEmpty():
        return newest
    pending = f"{store.rstrip('/')}/_pending-{newest + 1}"
    coded.write.mode("overwrite").parquet(pending)
    rename(spark, pending, f"{store.rstrip('/')}/version={newest + 1}")
    return newest + 1


def encode_stored(
    df: DataFrame, columns: Sequence[str], store: str, spread: str, version: int | None = None,
    broadcast_bytes: int = 32 * 2**20,
) -> DataFrame:
    """Add `<column>_code` as of `version`; a null, and a value that is not in it, has no code. Hot values are salted by `spread`."""
    entries = stored_codes(df.sparkSession, store, version)
    for column in columns:
        of_column = entries.where(F.col("column") == column)
        codes = of_column.select(F.col("value").alias(column), F.col("code").alias(f"{column}_code"))
        df = join_codes(df, codes, column, spread, broadcast_bytes)
    return df


def decode_stored(
    df: DataFrame, columns: Sequence[str], store: str, spread: str, version: int | None = None,
    broadcast_bytes: int = 32 * 2**20,
) -> DataFrame:
    """Add `<column>` as text for each column `<column>_code`; the reverse of `encode_stored`."""
    entries = stored_codes(df.sparkSession, store, version)
    for column in columns:
        of_column = entries.where(F.col("column") == column)
        values = of_column.select(F.col("code").alias(f"{column}_code"), F.col("value").alias(column))
        df = join_codes(df, values, f"{column}_code", spread, broadcast_bytes)
    return df
