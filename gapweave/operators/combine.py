"""Union, projection, cleaning and renaming of extracts."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions.text import quoted


def as_strings(df: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    """All columns, or those named, as text."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(
        *[quoted(c).cast("string").alias(c) if c in chosen else quoted(c) for c in df.columns]
    )


def union_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; absent columns are null, columns come in alphabetical order.

    A column whose type differs between the tables becomes text in all of them.
    """
    frames = list(dfs)
    if not frames:
        raise ValueError("No tables given to combine")
    types: dict[str, set[str]] = {}
    for name, kind in (column for df in frames for column in df.dtypes):
        types.setdefault(name, set()).add(kind)
    mixed = {name for name, kinds in types.items() if len(kinds) > 1}
    if mixed:
        frames = [as_strings(df, mixed) for df in frames]
    while len(frames) > 1:
        paired = [
            a.unionByName(b, allowMissingColumns=True)
            for a, b in zip(frames[::2], frames[1::2])
        ]
        if len(frames) % 2:
            paired.append(frames[-1])
        frames = paired
    return frames[0].select(*[quoted(c) for c in sorted(frames[0].columns)])


def missing_required(columns: Sequence[str], required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in columns]


def project_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The required columns that are there, in the required order."""
    available = [c for c in required if c in df.columns]
    if not available:
        raise ValueError("None of the required columns is in the table")
    return df.select(*[quoted(c) for c in available])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(how="all")


def clean(df: DataFrame, remove_duplicates: bool = True, remove_empty_rows: bool = False) -> DataFrame:
    if remove_empty_rows:
        df = drop_empty_rows(df)
    if remove_duplicates:
        df = df.dropDuplicates()
    return df


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[quoted(c).alias(mapping.get(c, c)) for c in df.columns])


def missing_columns_by_source(
    sources: dict[str, DataFrame], required: Sequence[str]
) -> DataFrame:
    """One row per source and absent required column, with the rows that lack it."""
    counts = [
        df.groupBy().agg(F.count("*").alias("rows_without")).select(
            F.lit(name).alias("source"),
            F.explode(F.array(*[F.lit(c) for c in missing_required(df.columns, required)])).alias("column"),
            "rows_without",
        )
        for name, df in sources.items()
        if missing_required(df.columns, required)
    ]
    if not counts:
        spark = next(iter(sources.values())).sparkSession
        return spark.createDataFrame([], "source string, column string, rows_without bigint")
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def combination_stats(dfs: Sequence[DataFrame], combined: DataFrame, files: int | None = None) -> DataFrame:
    """One row: inputs, rows before and after, rows removed, columns kept.

    `files` gives the number of inputs where `dfs` holds them as one union already.
    """
    before = [df.groupBy().agg(F.count("*").alias("n")).withColumn("final", F.lit(False)) for df in dfs]
    counts = combined.groupBy().agg(F.count("*").alias("n")).withColumn("final", F.lit(True))
    for part in before:
        counts = counts.unionByName(part)
    original = F.coalesce(F.sum(F.when(~F.col("final"), F.col("n"))), F.lit(0))
    final = F.sum(F.when(F.col("final"), F.col("n")))
    return counts.groupBy().agg(
        F.lit(len(dfs) if files is None else files).cast("bigint").alias("files_combined"),
        original.alias("original_total_rows"),
        final.alias("final_rows"),
        (original - final).alias("rows_removed"),
        F.lit(len(combined.columns)).cast("bigint").alias("final_columns"),
    )
