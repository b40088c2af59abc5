"""Dense-vector helpers on ``array<float|double>`` columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def pad(a: Column, width: int) -> Column:
    """Zero-pad an array to ``width``."""
    return F.concat(a, F.array_repeat(F.lit(0.0), F.greatest(F.lit(width) - F.size(a), F.lit(0))))
