from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cast_vector(c: Column) -> Column:
    return c.cast("array<float>")


def dot(a: Column, b: Column) -> Column:
    """Inner product, accumulated in double."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(c: Column) -> Column:
    return F.sqrt(dot(c, c))


def l2_normalize(c: Column) -> Column:
    """Unit vector in double; a zero vector stays as it is."""
    wide = c.cast("array<double>")
    norm = l2_norm(c)
    return F.when(norm > 0, F.transform(wide, lambda x: x / norm)).otherwise(wide)
