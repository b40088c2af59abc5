"""Unions, distinct values and token-set sizes."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def add_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Columns are added by expression, never by row position."""
    return df.withColumns(columns)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def set_sizes(a: Column, b: Column) -> dict[str, Column]:
    return {"n_common": F.size(F.array_intersect(a, b)), "n_union": F.size(F.array_union(a, b))}


def any_flag(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(f, F.lit(False)) for f in flags))
