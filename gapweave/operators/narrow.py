"""Type narrowing: one statistics job, then lazy casts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions.dates import parse_date
from gapweave.functions.text import quoted
from gapweave.operators.lookup import skew_safe_lookup
from gapweave.operators.ordering import running_total
from gapweave.operators.profile import cardinality_ratio, category_footprint, footprint

_SIGNED = (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31))
# Fixed value: the absolute error up to which a float counts as equal to a double.
FLOAT_TOLERANCE = 5e-4
_INTEGER_TYPES = ("bigint", "int", "smallint", "tinyint")


def smallest_integer_type(low: int, high: int) -> str:
    for name, bound in _SIGNED:
        if low >= -bound and high < bound:
            return name
    return "bigint"


def narrow_numbers(
    df: DataFrame, integers: bool = True, floats: bool = True, tolerance: float = FLOAT_TOLERANCE
) -> DataFrame:
    """Integers to the smallest signed type of their range, doubles to float where that is faithful.

    All columns are measured by a single aggregate. Columns without any value keep their type.
    """
    ints = [n for n, k in df.dtypes if integers and k in _INTEGER_TYPES]
    doubles = [n for n, k in df.dtypes if floats and k == "double"]
    if not ints and not doubles:
        return df
    measures = []
    for i, name in enumerate(ints):
        measures += [F.min(quoted(name)).alias(f"lo{i}"), F.max(quoted(name)).alias(f"hi{i}")]
    for i, name in enumerate(doubles):
        c = quoted(name)
        as_float = c.cast("float").cast("double")
        # A value other than zero must not become zero, however small it is.
        faithful = (as_float == c) | ((F.abs(as_float - c) <= tolerance) & ((as_float != 0) | (c == 0)))
        measures.append(F.bool_and(faithful).alias(f"ok{i}"))
    stats = df.agg(*measures).first()
    target = {}
    for i, name in enumerate(ints):
        if stats[f"lo{i}"] is not None:
            target[name] = smallest_integer_type(stats[f"lo{i}"], stats[f"hi{i}"])
    for i, name in enumerate(doubles):
        if stats[f"ok{i}"]:
            target[name] = "float"
    return df.select(*[quoted(n).cast(target.get(n, k)).alias(n) for n, k in df.dtypes])


def narrow_integers(df: DataFrame) -> DataFrame:
    return narrow_numbers(df, floats=False)


def narrow_floats(df: DataFrame, tolerance: float = FLOAT_TOLERANCE) -> DataFrame:
    return narrow_numbers(df, integers=False, tolerance=tolerance)


def parse_date_columns(df: DataFrame, columns: Sequence[str], formats: Sequence[str]) -> DataFrame:
    """Text columns among `columns` as timestamps; absent ones are skipped."""
    wanted = {n for n, k in df.dtypes if n in columns and k == "string"}
    return df.select(
        *[parse_date(quoted(n), formats).alias(n) if n in wanted else quoted(n) for n in df.columns]
    )


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, code): the distinct values of a column, coded 0, 1, ... in sorted order."""
    values = df.select(quoted(column).alias("value")).where("value is not null").distinct()
    ranked = running_total(values.withColumn("one", F.lit(1)), "value", "one")
    return ranked.select("value", (F.col("upto") - 1).alias("code"))


def dictionary_encode(
    df: DataFrame, columns: Sequence[str], spread: str, broadcast_bytes: int = 32 * 2**20
) -> DataFrame:
    """Add `<column>_code` for each column; null has no code.

    A dictionary measured to be small is broadcast, so that the table itself is not shuffled. A larger
    one is joined by value, with frequent values salted by a hash of `spread`.
    """
    for column in columns:
        codes = dictionary(df, column).select(
            F.col("value").alias(column), F.col("code").alias(f"{column}_code")
        )
        df = join_codes(df, codes, column, spread, broadcast_bytes)
    return df


def join_codes(df: DataFrame, codes: DataFrame, column: str, spread: str, broadcast_bytes: int) -> DataFrame:
    """Left join to a table with unique values of `column`, broadcast if measured to be small, else salted."""
    texts = [quoted(n) for n, kind in codes.dtypes if kind == "string"]
    size = codes.agg(F.sum(sum((F.octet_length(c) for c in texts), F.lit(16))).alias("bytes")).first()["bytes"] or 0
    if size <= broadcast_bytes:
        return df.join(F.broadcast(codes), column, "left")
    return skew_safe_lookup(df, codes, column, spread)


@dataclass(frozen=True)
class Narrowed:
    df: DataFrame
    categories: tuple[str, ...]


def narrow_types(df: DataFrame, date_columns: Sequence[str], date_formats: Sequence[str]) -> DataFrame:
    """Numbers narrowed and dates parsed."""
    return parse_date_columns(narrow_numbers(df), date_columns, date_formats)


def category_columns(df: DataFrame, first: float = 0.5, second: float = 0.3) -> tuple[str, ...]:
    """Text columns with few enough distinct values per row for either threshold."""
    texts = [n for n, k in df.dtypes if k == "string"]
    if not texts:
        return ()
    flags = cardinality_ratio(df, texts, first, second)
    low = flags.where("category_first_pass or category_second_pass").select("column").collect()
    return tuple(sorted(r["column"] for r in low))


def narrow_schema(df: DataFrame, date_columns: Sequence[str], date_formats: Sequence[str]) -> Narrowed:
    """Narrowed table with its category columns named.

    Category columns stay text: columnar files dictionary-encode them anyway.
    """
    narrowed = narrow_types(df, date_columns, date_formats)
    return Narrowed(narrowed, category_columns(narrowed))


def narrowed_footprint(narrowed: Narrowed) -> DataFrame:
    """Bytes per column after narrowing, categories stored as codes and one copy of each value."""
    plain = footprint(narrowed.df).where(~F.col("column").isin(*narrowed.categories))
    if not narrowed.categories:
        return plain
    return plain.unionByName(category_footprint(narrowed.df, narrowed.categories))


def narrowing_decisions(before: DataFrame, narrowed: Narrowed) -> DataFrame:
    """Per column: type before and after, category flag, rows and non-null values after."""
    facts = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(old).alias("type_before"),
            F.lit(new).alias("type_after"),
            F.lit(name in narrowed.categories).alias("category"),
            F.col(f"n{i}").alias("non_null_count"),
        )
        for i, ((name, old), (_, new)) in enumerate(zip(before.dtypes, narrowed.df.dtypes))
    ]
    counts = [F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(narrowed.df.columns)]
    return narrowed.df.groupBy().agg(*counts).select(F.inline(F.array(*facts)))
