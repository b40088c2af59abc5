"""Registry of driver queries and the SQL each one must equal."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; doubles are rounded to 6 places on both sides."""

    def wrap(fn):
        assert name not in REGISTRY, name
        REGISTRY[name] = Query(name, tuple(covers.split()), lambda s, d: rounded(fn(s, d)), sql)
        return fn

    return wrap


def rounded(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({n: F.round(F.col(n).cast("double"), 6) for n in names}) if names else df
