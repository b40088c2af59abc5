"""Ranking, top-k, lag, share and running-sum operators.

Group sizes are assumed to be skewed: rankings stay of the ``row_number <= n``
form so that Spark prunes each task's rows before the shuffle, and whole-group
statistics are aggregated first and joined back instead of being computed in a
window that would pull a hot group into one task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_by(df: DataFrame, keys: list[str], order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """First ``n`` rows per key in the given total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep-first deduplication: the earliest row per key in a stable order."""
    return top_n_by(df, keys, [F.col(c) for c in order], 1, "_rank").drop("_rank")


def with_group_stats(df: DataFrame, keys: list[str], stats: dict[str, Column]) -> DataFrame:
    """Aggregate per key (map-side combined) and join the result back to the rows."""
    agg = df.groupBy(*keys).agg(*[c.alias(name) for name, c in stats.items()])
    renamed = agg.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *stats)
    cond = [df[k].eqNullSafe(renamed[f"_k_{k}"]) for k in keys]
    return df.join(renamed, cond, "left").drop(*[f"_k_{k}" for k in keys])


def reviewer_counts(df: DataFrame, key: str = "reviewer_name", text: str = "review_text", power: int = 5) -> DataFrame:
    out = with_group_stats(df, [key], {"reviewer_review_count": F.count(text)})
    return out.withColumn("is_power_reviewer", (F.col("reviewer_review_count") >= power).cast("int"))


def product_stats(df: DataFrame, key: str = "product_id", stars: str = "star_rating") -> DataFrame:
    """Product mean, sample deviation and count on each row, plus the row's own deviation."""
    out = with_group_stats(
        df,
        [key],
        {
            "product_avg_rating": F.avg(stars),
            "product_rating_std": F.stddev_samp(stars),
            "product_review_count": F.count(stars),
        },
    )
    return out.withColumn("rating_deviation", F.abs(F.col(stars) - F.col("product_avg_rating")))


def with_lag(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Previous value and change; meant for aggregated series (months), not raw rows."""
    w = Window.partitionBy(*keys).orderBy(order)
    previous = F.lag(value).over(w)
    return df.withColumn(f"prev_{value}", previous).withColumn(f"{value}_change", F.col(value) - previous)


def share_of(df: DataFrame, keys: list[str], value: str, scale: float = 100.0, name: str = "share") -> DataFrame:
    """Value as a share of its key's total; ``df`` holds one row per cell already."""
    total = F.sum(value).over(Window.partitionBy(*keys))
    return df.withColumn(name, F.try_divide(F.col(value) * scale, total))


def running_sum(df: DataFrame, keys: list[str], order: list[Column], value: str, name: str = "running") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(w))


def row_normalise(cm: DataFrame, row: str = "actual", value: str = "n") -> DataFrame:
    return share_of(cm, [row], value, 1.0, "row_share")


def month_edges(months: DataFrame, month: str = "month") -> DataFrame:
    """Rank of every distinct month from both ends (1-based)."""
    distinct = months.select(month).where(F.col(month).isNotNull()).distinct()
    # months number in the hundreds at most, so an unpartitioned window is one small task
    return distinct.select(
        month,
        F.row_number().over(Window.orderBy(F.col(month).asc())).alias("from_first"),
        F.row_number().over(Window.orderBy(F.col(month).desc())).alias("from_last"),
    )


def two_windows(df: DataFrame, ts: str, days: int = 30) -> DataFrame:
    """Row counts of the last ``days`` before the newest row and of the ``days`` before that."""
    newest = df.agg(F.max(ts).alias("m")).scalar()
    cut = newest - F.expr(f"INTERVAL {days} DAYS")
    start = cut - F.expr(f"INTERVAL {days} DAYS")
    return df.agg(
        F.count_if(F.col(ts) >= cut).alias("recent"),
        F.count_if((F.col(ts) >= start) & (F.col(ts) < cut)).alias("prior"),
    ).withColumn("change_pct", (F.col("recent") - F.col("prior")) * 100.0 / F.greatest("prior", F.lit(1)))


def order_limit(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def worst_row(df: DataFrame, where: Column, order: list[Column]) -> DataFrame:
    return df.filter(where).orderBy(*order).limit(1)


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Repeatable sample of ``n`` rows: the smallest MD5 digests of a stable key and the seed."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)).limit(n)
