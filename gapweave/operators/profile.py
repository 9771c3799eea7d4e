"""Column profiles. Every profile is one pass over the table, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.functions.ratios import percent, ratio
from gapweave.functions.text import quoted

# Bytes of one value of a fixed-width type.
TYPE_WIDTHS = {
    "boolean": 1,
    "tinyint": 1,
    "smallint": 2,
    "int": 4,
    "bigint": 8,
    "float": 4,
    "double": 8,
    "date": 4,
    "timestamp": 8,
    "timestamp_ntz": 8,
}


def tall(wide: DataFrame, columns: Sequence[str], metrics: Sequence[str], shared: Sequence[str] = ()):
    """One-row aggregate with columns `<metric>_<i>` -> one row per profiled column."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"{m}_{i}").alias(m) for m in metrics])
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(*shared, F.inline(rows))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, rows, non_null_count, null_count), from one map-side combined aggregate."""
    columns = list(columns or df.columns)
    wide = df.groupBy().agg(
        F.count("*").alias("rows"),
        *[F.count(quoted(c)).alias(f"non_null_count_{i}") for i, c in enumerate(columns)],
    )
    return tall(wide, columns, ["non_null_count"], ["rows"]).select(
        "column", "rows", "non_null_count", (F.col("rows") - F.col("non_null_count")).alias("null_count")
    )


def missing_field_census(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Fields that have nulls, with how many."""
    present = [f for f in fields if f in df.columns]
    return (
        null_counts(df, present)
        .where("null_count > 0")
        .select(F.col("column").alias("field"), F.col("null_count").alias("missing"))
    )


def completeness(df: DataFrame) -> DataFrame:
    return completeness_of(null_counts(df))


def completeness_of(counts: DataFrame) -> DataFrame:
    """From the result of `null_counts`."""
    return counts.select(
        "column",
        "non_null_count",
        "null_count",
        percent(F.col("non_null_count"), F.col("rows")).alias("completeness_percent"),
    )


def _cell(df: DataFrame, at: int, name: str):
    """(at, whole, real, value) with the value in the field of its kind; -0.0 counts as 0.0."""
    kind = df.schema[name].dataType
    c = quoted(name)
    whole, real, value = F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(kind, T.IntegralType):
        whole = c.cast("bigint")
    elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        real = F.when(c == 0, F.lit(0.0)).otherwise(c.cast("double"))
    else:
        value = c.cast("string")
    return F.struct(F.lit(at).alias("at"), whole.alias("whole"), real.alias("real"), value.alias("value"))


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, filled, n): occurrences of each value of each column, null included.

    Numbers are grouped as numbers; only what is neither whole nor real is shown as text in
    `value`. The count is combined before the shuffle, so a value that fills a third of the table costs
    one row per task.
    """
    columns = list(columns or df.columns)
    cells = F.array(*[_cell(df, i, c) for i, c in enumerate(columns)])
    counts = df.select(F.inline(cells)).groupBy("at", "whole", "real", "value").agg(F.count("*").alias("n"))
    names = F.array(*[F.lit(c) for c in columns])
    return counts.select(
        names[F.col("at")].alias("column"),
        "value",
        (F.col("whole").isNotNull() | F.col("real").isNotNull() | F.col("value").isNotNull()).alias("filled"),
        "n",
    )


def column_info(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, distinct values, non-null count and null percentage of each column.

    With `approximate` distinct values are estimated from sketches in one pass without a shuffle of
    the values.
    """
    if approximate:
        wide = df.groupBy().agg(
            F.count("*").alias("rows"),
            *[F.count(quoted(c)).alias(f"non_null_count_{i}") for i, c in enumerate(df.columns)],
            *[F.approx_count_distinct(quoted(c)).alias(f"unique_values_{i}") for i, c in enumerate(df.columns)],
        )
        facts = tall(wide, df.columns, ["non_null_count", "unique_values"], ["rows"])
    else:
        return column_info_of(value_counts(df), df.dtypes)
    return _column_info(facts, df.dtypes)


def column_info_of(counts: DataFrame, dtypes: Sequence[tuple[str, str]]) -> DataFrame:
    """From the result of `value_counts`."""
    facts = counts.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("filled"), F.col("n"))), F.lit(0)).alias("non_null_count"),
        F.count_if("filled").alias("unique_values"),
    )
    return _column_info(facts, dtypes)


def _column_info(facts: DataFrame, dtypes: Sequence[tuple[str, str]]) -> DataFrame:
    types = F.create_map(*[F.lit(x) for name, kind in dtypes for x in (name, kind)])
    return facts.select(
        "column",
        types[F.col("column")].alias("data_type"),
        "unique_values",
        "non_null_count",
        percent(F.col("rows") - F.col("non_null_count"), F.col("rows")).alias("null_percentage"),
    )


def sample_values(df: DataFrame, limit: int = 5) -> DataFrame:
    """The `limit` smallest distinct values of each text column.

    The rank filter becomes a window group limit, which keeps `limit` rows per column and task
    before anything is shuffled to the final rank.
    """
    texts = [name for name, kind in df.dtypes if kind == "string"]
    return sample_values_of(value_counts(df, texts), texts, limit)


def sample_values_of(counts: DataFrame, texts: Sequence[str], limit: int = 5) -> DataFrame:
    """From the result of `value_counts`, for the columns `texts`."""
    values = counts.where(F.col("column").isin(*texts) & F.col("value").isNotNull())
    order = Window.partitionBy("column").orderBy("value")
    return (
        values.select("column", "value", F.row_number().over(order).alias("position"))
        .where(F.col("position") <= limit)
        .select("column", F.col("position").cast("bigint").alias("position"), "value")
    )


def cardinality_ratio(
    df: DataFrame, columns: Sequence[str] | None = None, first: float = 0.5, second: float = 0.3
) -> DataFrame:
    """Distinct values per row of each column, against the two thresholds for categories."""
    return cardinality_ratio_of(value_counts(df, columns), first, second)


def cardinality_ratio_of(counts: DataFrame, first: float = 0.5, second: float = 0.3) -> DataFrame:
    """From the result of `value_counts`."""
    facts = counts.groupBy("column").agg(F.sum("n").alias("rows"), F.count_if("filled").alias("unique_values"))
    share = F.col("unique_values") / F.col("rows")
    return facts.select(
        "column",
        "unique_values",
        "rows",
        ratio(F.col("unique_values"), F.col("rows")).alias("ratio"),
        (share < first).alias("category_first_pass"),
        (share < second).alias("category_second_pass"),
    )


def value_bytes(name: str, kind: str):
    """Bytes of the values of a column; nested values count as long as their JSON."""
    if kind in ("string", "binary") or kind.startswith(("char", "varchar")):
        return F.coalesce(F.sum(F.octet_length(quoted(name))), F.lit(0))
    if kind.startswith("decimal"):
        digits = int(kind[len("decimal(") :].split(",")[0])
        return F.count(quoted(name)) * (8 if digits <= 18 else 16)
    if kind.startswith(("array", "map", "struct")):
        return F.coalesce(F.sum(F.octet_length(F.to_json(quoted(name)))), F.lit(0))
    return F.count(quoted(name)) * TYPE_WIDTHS.get(kind, 8)


def footprint(df: DataFrame) -> DataFrame:
    """Bytes of the values of each column: text by its length, other types by their width."""
    wide = df.groupBy().agg(
        F.count("*").alias("rows"),
        *[
            value_bytes(name, kind).cast("bigint").alias(f"bytes_{i}")
            for i, (name, kind) in enumerate(df.dtypes)
        ],
    )
    return tall(wide, df.columns, ["bytes"], ["rows"]).select("column", "rows", "bytes")


def footprint_summary(df: DataFrame) -> DataFrame:
    """One row: total MB, KB per row, rows, columns."""
    return footprint_total(footprint(df), len(df.columns))


def footprint_total(sizes: DataFrame, columns: int) -> DataFrame:
    """From the result of `footprint`."""
    total = sizes.groupBy().agg(F.sum("bytes").alias("bytes"), F.max("rows").alias("rows"))
    return total.select(
        F.round(F.col("bytes") / (1024.0 * 1024.0), 2).alias("total_mb"),
        F.coalesce(F.round(F.try_divide(F.col("bytes") / 1024.0, F.col("rows")), 3), F.lit(0.0)).alias("kb_per_row"),
        "rows",
        F.lit(columns).cast("bigint").alias("columns"),
    )


def category_footprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bytes of text columns when stored as codes plus one copy of each distinct value."""
    facts = value_counts(df, columns).groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.count("value").alias("unique_values"),
        F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("value_bytes"),
    )
    width = (
        F.when(F.col("unique_values") <= 127, 1).when(F.col("unique_values") <= 32767, 2).otherwise(4)
    )
    return facts.select("column", "rows", (F.col("rows") * width + F.col("value_bytes")).alias("bytes"))


def footprint_reduction(before: DataFrame, after: DataFrame) -> DataFrame:
    """Bytes before and after narrowing per column, and the reduction in percent (0 if none before).

    Both inputs are `footprint` results, so the join is between tables of one row per column.
    """
    joined = before.select("column", F.col("bytes").alias("bytes_before")).join(
        after.select("column", F.col("bytes").alias("bytes_after")), "column"
    )
    saved = F.col("bytes_before") - F.col("bytes_after")
    return joined.select(
        "column",
        "bytes_before",
        "bytes_after",
        percent(saved, F.col("bytes_before"), 1).alias("reduction_percent"),
    )
