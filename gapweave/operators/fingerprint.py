"""What a table holds, in a few numbers that do not depend on the order of its rows.

The check of a column is the sum of two independent 64-bit hashes of its values, modulo 2**64; that of the rows is the
same over whole rows. Such sums add up: the check of a union is the sum of the checks, so partitions, files and retries
can be combined, and a lost copy of a repeated row shows, which it would not in an exclusive or.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.functions.text import quoted
from gapweave.operators.profile import tall, value_bytes

_SEEDS = (1, 2)
# 64 bits as pieces whose sums fit 64 bits for 2 * 10**12 rows.
_PIECES = ((0, 21), (21, 21), (42, 22))
_MODULUS = Decimal(2**64)
CHECKS = ("check_a", "check_b")


def _comparable(name: str, kind: T.DataType, blank_is_null: bool) -> Column:
    c = quoted(name)
    if isinstance(kind, T.MapType):
        return F.array_sort(F.map_entries(c))
    if isinstance(kind, (T.VariantType, T.StructType, T.ArrayType)) and "map" in kind.simpleString():
        return F.to_json(c)
    if blank_is_null and isinstance(kind, T.StringType):
        return F.nullif(c, F.lit(""))
    return c


def _sums(values: list[Column], label: int | str) -> list[Column]:
    """Sums of the pieces of both hashes of the values, as `p<label>_<hash>_<piece>`."""
    found = []
    for seed in _SEEDS:
        hashed = F.xxhash64(F.lit(seed), *values)
        for piece, (shift, bits) in enumerate(_PIECES):
            part = F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
            found.append(F.coalesce(F.sum(part), F.lit(0)).cast("bigint").alias(f"p{label}_{seed}_{piece}"))
    return found


def content_aggregates(df: DataFrame, blank_is_null: bool = False) -> list[Column]:
    """Rows, values and pieces of the checks of all columns and of the rows; columns go by name in a row."""
    cells = {f.name: _comparable(f.name, f.dataType, blank_is_null) for f in df.schema.fields}
    found = [F.count("*").alias("rows")]
    for i, name in enumerate(df.columns):
        found.append(F.count(cells[name]).alias(f"non_null_count_{i}"))
        found += _sums([cells[name]], i)
    # A null is skipped by the hash, so where it stands is hashed as well.
    whole = [part for name in sorted(cells) for part in (cells[name], cells[name].isNull())]
    return [*found, *_sums(whole, "row")]


def _check(label: int | str, seed: int) -> Column:
    big = [F.col(f"p{label}_{seed}_{piece}").cast("decimal(38,0)") * F.lit(Decimal(1 << shift))
           for piece, (shift, _) in enumerate(_PIECES)]
    return ((big[0] + big[1] + big[2]) % F.lit(_MODULUS)).cast("decimal(20,0)")


def content_rows(wide: DataFrame, columns: list[str], keep: Sequence[str] = ()) -> DataFrame:
    """`content_aggregates` as rows (*keep, level, column, rows, non_null_count, check_a, check_b)."""
    cells = [
        F.struct(
            F.lit(level).alias("level"), F.lit(name).alias("column"), count.alias("non_null_count"),
            *(_check(label, seed).alias(check) for seed, check in zip(_SEEDS, CHECKS)),
        )
        for level, name, count, label in (
            *(("column", name, F.col(f"non_null_count_{i}"), i) for i, name in enumerate(columns)),
            ("row", "", F.col("rows"), "row"),
        )
    ]
    return wide.select(*keep, "rows", F.inline(F.array(*cells))).select(*keep, "level", "column", "rows", "non_null_count", *CHECKS)


def content_facts(df: DataFrame, blank_is_null: bool = False) -> DataFrame:
    """(level, column, rows, non_null_count, check_a, check_b): one row per column and one for whole rows, in one pass.

    With `blank_is_null` empty texts count as null, as for a file that cannot tell them apart. An empty table has zeros.
    """
    return content_rows(df.groupBy().agg(*content_aggregates(df, blank_is_null)), df.columns)


def merge_content(facts: DataFrame) -> DataFrame:
    """The facts of the union of tables with equal columns, from the facts of each."""
    total = F.sum(F.col("check_a").cast("decimal(38,0)")), F.sum(F.col("check_b").cast("decimal(38,0)"))
    modulus = F.lit(_MODULUS)
    return facts.groupBy("level", "column").agg(
        F.sum("rows").alias("rows"), F.sum("non_null_count").alias("non_null_count"),
        *((t % modulus).cast("decimal(20,0)").alias(name) for t, name in zip(total, CHECKS)),
    )


def beside(found: DataFrame, expected: DataFrame) -> DataFrame:
    """(level, column, found, expected): two results of `content_facts`, null where only the other one has the column."""
    values = ("rows", "non_null_count", *CHECKS)
    side = lambda facts, name: facts.select("level", "column", F.struct(*values).alias(name))
    return side(found, "found").join(side(expected, "expected"), ["level", "column"], "full")


def compare_content(found: DataFrame, expected: DataFrame) -> DataFrame:
    """(level, column, same) from two results of `content_facts`; a column that only one has is not the same."""
    return beside(found, expected).select("level", "column", F.col("found").eqNullSafe(F.col("expected")).alias("same"))


class TableFacts:
    """Facts of a table that are taken while an action reads it: rows, values, bytes and checks, at no further pass.

    Write or count `df`; after that, the other members give small tables of facts. The first action on `df` counts.
    """

    def __init__(self, df: DataFrame, blank_is_null: bool = False):
        self.columns = df.columns
        self._observation = Observation()
        sizes = [value_bytes(name, kind).cast("bigint").alias(f"bytes_{i}") for i, (name, kind) in enumerate(df.dtypes)]
        aggregates = [*content_aggregates(df, blank_is_null), *sizes]
        self._wide = df.groupBy().agg(*aggregates).schema
        self.df = df.observe(self._observation, *aggregates)

    def _row(self, spark: SparkSession) -> DataFrame:
        values = self._observation.get
        return spark.createDataFrame([tuple(values[name] for name in self._wide.names)], self._wide)

    @property
    def rows(self) -> int:
        return self._observation.get["rows"]

    def null_counts(self, spark: SparkSession) -> DataFrame:
        """As `profile.null_counts`."""
        counts = tall(self._row(spark), self.columns, ["non_null_count"], ["rows"])
        return counts.select("column", "rows", "non_null_count", (F.col("rows") - F.col("non_null_count")).alias("null_count"))

    def footprint(self, spark: SparkSession) -> DataFrame:
        """As `profile.footprint`."""
        return tall(self._row(spark), self.columns, ["bytes"], ["rows"]).select("column", "rows", "bytes")

    def content(self, spark: SparkSession) -> DataFrame:
        """As `content_facts`."""
        return content_rows(self._row(spark), self.columns)
