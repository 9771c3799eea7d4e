"""Profiles that add up: a small state per part of a table and column, from which profiles of any union follow.

A state has rows, non-null values, bytes, a sketch of the distinct values and the smallest distinct values. States of
parts, such as files, are stored; the profile of many of them is a merge of states, for which no row is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapweave.functions.ratios import percent
from gapweave.functions.text import quoted

#: Values that a state keeps.
SAMPLES = 5
#: Logarithm of the registers of a sketch. The standard error of a distinct count is at most 1.04 / sqrt(2**12), 1.63 %.
REGISTERS = 12
STANDARD_ERROR = 1.04 / 2 ** (REGISTERS / 2)
PROFILE = (
    "part string, column string, rows bigint, non_null_count bigint, bytes bigint, sketch binary, smallest array<string>"
)


def profile_states(df: DataFrame, part: str, columns: Sequence[str]) -> DataFrame:
    """`PROFILE` rows: the state of each column in each part, values as text.

    Sums and sketches of all columns are one aggregate that shuffles one row per task and part. The smallest values are
    ranked after a limit inside each task, over distinct values. A part without rows has no states.
    """
    columns = list(columns)
    parts = F.col(part).alias("part")
    texts = [quoted(c).cast("string") for c in columns]
    wide = df.groupBy(parts).agg(
        F.count("*").alias("rows"),
        *(F.count(t).alias(f"non_null_count_{i}") for i, t in enumerate(texts)),
        *(F.coalesce(F.sum(F.octet_length(t)), F.lit(0)).alias(f"bytes_{i}") for i, t in enumerate(texts)),
        # A sketch does not see empty texts, so none is given to it.
        *(F.hll_sketch_agg(F.concat(F.lit("="), t), REGISTERS).alias(f"sketch_{i}") for i, t in enumerate(texts)),
    )
    cells = F.array(*(
        F.struct(F.lit(c).alias("column"), *(F.col(f"{m}_{i}").alias(m) for m in ("non_null_count", "bytes", "sketch")))
        for i, c in enumerate(columns)
    ))
    facts = wide.select("part", "rows", F.inline(cells))
    values = F.array(*(F.struct(F.lit(c).alias("column"), t.alias("value")) for c, t in zip(columns, texts)))
    found = df.select(parts, F.inline(values)).where("value IS NOT NULL").distinct()
    smallest = _smallest(found, ["part", "column"])
    return facts.join(smallest, [F.col("part").eqNullSafe(F.col("part_of")), facts["column"] == F.col("column_of")], "left").select(
        "part", facts["column"], "rows", "non_null_count", "bytes", "sketch",
        F.coalesce("smallest", F.array().cast("array<string>")).alias("smallest"),
    )


def _smallest(values: DataFrame, by: list[str]) -> DataFrame:
    """The first distinct values of each group, from (*by, value) without repeats; keys get the suffix `_of`."""
    order = Window.partitionBy(*by).orderBy("value")
    return (
        values.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLES)
        .groupBy(*(F.col(c).alias(f"{c}_of") for c in by)).agg(F.sort_array(F.collect_list("value")).alias("smallest"))
    )


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, column, rows, non_null_count, bytes, sketch, smallest): states of unions of parts, by the columns `by`."""
    keys = [*by, "column"]
    sums = states.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in ("rows", "non_null_count", "bytes")), F.hll_union_agg("sketch").alias("sketch")
    )
    smallest = _smallest(states.select(*keys, F.explode("smallest").alias("value")).distinct(), keys)
    matched = [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in keys]
    return sums.join(smallest, matched, "left").select(
        *keys, "rows", "non_null_count", "bytes", "sketch",
        F.coalesce("smallest", F.array().cast("array<string>")).alias("smallest"),
    )


def state_profile(states: DataFrame, total_rows: int | None = None) -> DataFrame:
    """(column, rows, non_null_count, null_count, completeness_percent, unique_values, bytes) of merged states.

    `unique_values` is an estimate (see `STANDARD_ERROR`). Parts that lack a column have no state for it; with
    `total_rows`, the rows of all parts, their rows count as null.
    """
    rows = F.col("rows") if total_rows is None else F.lit(total_rows).cast("bigint")
    return states.select(
        "column",
        rows.alias("rows"),
        "non_null_count",
        (rows - F.col("non_null_count")).alias("null_count"),
        percent(F.col("non_null_count"), rows).alias("completeness_percent"),
        F.hll_sketch_estimate("sketch").alias("unique_values"),
        "bytes",
    )


def state_samples(states: DataFrame) -> DataFrame:
    """(column, position, value): the smallest distinct values of merged states."""
    return states.select("column", F.posexplode("smallest").alias("at", "value")).select(
        "column", (F.col("at") + 1).cast("bigint").alias("position"), "value"
    )
