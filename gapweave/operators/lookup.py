"""Equi-joins to a table with unique keys that stay balanced when single keys are hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NULL_SALTS = 4096


def skew_safe_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    on: str,
    spread: str,
    how: str = "left",
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Join `facts` to the unique keys of `dimension`.

    Keys with more than `hot_rows` facts are salted by a hash of the column `spread`, and only their
    dimension rows are copied once per salt. The table of hot keys has at most
    rows / `hot_rows` entries, which is what makes its broadcast safe. Facts without a key match
    nothing; they are salted as well, so that they do not all meet in one partition.
    """
    hot = (
        facts.where(F.col(on).isNotNull())
        .groupBy(on)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    )
    salts = F.when(F.col(on).isNull(), _NULL_SALTS).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_facts = facts.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread), salts).cast("int")
    )
    salted_dimension = dimension.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    return salted_facts.drop("_salts").join(
        salted_dimension.drop("_salts"), [on, "_salt"], how
    ).drop("_salt")
