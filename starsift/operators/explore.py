"""Exploratory tables: overview, distributions, correlations, outliers."""

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.functions import labels
from starsift.operators import windows
from starsift.operators.quantiles import quantile_columns, quantile_values

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def overview(df: DataFrame) -> DataFrame:
    middle = quantile_values(df, ["star_rating", "word_count"], [0.5])
    return df.agg(
        F.count("*").alias("rows"),
        F.countDistinct("product_id").alias("products"),
        F.countDistinct("user_id").alias("reviewers"),
        F.avg("star_rating").alias("avg_star"),
        F.lit(middle["star_rating"][0]).cast("double").alias("median_star"),
        F.avg("word_count").alias("avg_words"),
        F.lit(middle["word_count"][0]).cast("double").alias("median_words"),
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Null count and percent per column, only columns with nulls (one pass)."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns])
    return (
        counts.select("_rows", F.inline(cells))
        .filter(F.col("missing") > 0)
        .select("column", "missing", (F.col("missing") * 100.0 / F.col("_rows")).alias("pct"))
        .orderBy(F.desc("missing"), "column")
    )


def share_by(df: DataFrame, col: str | Column, name: str) -> DataFrame:
    """Counts and percent of the total per value, nulls left out."""
    c = F.col(col) if isinstance(col, str) else col
    counted = df.select(c.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    return windows.share_of(counted, [], "n", name="pct")


def star_distribution(df: DataFrame) -> DataFrame:
    return share_by(df, "star_rating", "star_rating")


def tier_share(df: DataFrame) -> DataFrame:
    return share_by(df, labels.length_tier(F.col("word_count")), "length_tier")


def histogram(spark: SparkSession, df: DataFrame, col: str, bins: int, cap: float | None = None) -> DataFrame:
    """Equal-width bins between the smallest and largest value; all bins listed."""
    x = F.col(col).cast("double") if cap is None else F.least(F.col(col).cast("double"), F.lit(float(cap)))
    values = df.select(x.alias("x")).where(F.col("x").isNotNull())
    lo = values.agg(F.min("x").alias("lo")).scalar()
    hi = values.agg(F.max("x").alias("hi")).scalar()
    lo, hi = F.when(lo == hi, lo - 0.5).otherwise(lo), F.when(lo == hi, hi + 0.5).otherwise(hi)
    place = F.least(F.floor((F.col("x") - lo) / ((hi - lo) / bins)).cast("int"), F.lit(bins - 1))
    counted = values.groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin", (lo + F.col("bin") * ((hi - lo) / bins)).alias("low_edge"), F.coalesce("n", F.lit(0)).alias("n")
    )


def quartiles_by(df: DataFrame, key: str, col: str, below: float | None = None) -> DataFrame:
    """Exact quartiles per key."""
    rows = df.filter(F.col(key).isNotNull())
    if below is not None:
        rows = rows.filter(F.col(col) < below)
    return quantile_columns(rows, col, QUARTILES, key)


def sentiment_distribution(df: DataFrame, compound: str = "compound") -> DataFrame:
    return share_by(df, labels.compound_label_bins(F.col(compound)), "label")


def star_sentiment_fit(df: DataFrame, x: str = "star_rating", y: str = "compound") -> DataFrame:
    return df.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.corr(x, y).alias("r")
    )


def monthly_trend(df: DataFrame) -> DataFrame:
    """Reviews (the count tells how far to trust a month), mean star and mean score per month."""
    dated = df.filter(F.col("review_time").isNotNull())
    return (
        dated.groupBy(labels.month_key(F.col("review_time")).alias("month"))
        .agg(
            F.count("review_text").alias("review_count"),
            F.avg("star_rating").alias("avg_rating"),
            F.avg("compound").alias("avg_sentiment"),
        )
    )


def verified_report(df: DataFrame) -> DataFrame:
    """Count, share, mean star and score quartiles, keyed by the verified value."""
    per = df.filter(F.col("verified").isNotNull()).groupBy("verified").agg(
        F.count("*").alias("n"),
        F.avg("star_rating").alias("avg_star"),
    )
    shares = windows.share_of(per, [], "n", name="pct")
    return shares.join(quantile_columns(df, "compound", QUARTILES, "verified"), "verified", "left").select(
        "verified", "n", "pct", "avg_star", "q1", "median", "q3"
    )


def votes_by_label(df: DataFrame) -> DataFrame:
    label = labels.compound_label_bins(F.col("compound"))
    return quantile_columns(df.select(label.alias("label"), "helpful_votes"), "helpful_votes", {"median_votes": 0.5}, "label")


def votes_histogram(spark: SparkSession, df: DataFrame, bins: int = 30, cap: float | None = None) -> DataFrame:
    return histogram(spark, df.filter(F.col("helpful_votes") > 0), "helpful_votes", bins, cap)


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """All pairwise correlations in one aggregate (pairs with a null are skipped pairwise)."""
    pairs = list(combinations(cols, 2))
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
                   for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c{i}").alias("r"))
             for i, (a, b) in enumerate(pairs)]
    return agg.select(F.inline(F.array(*cells)))


def top_correlations(matrix: DataFrame, target: str, n: int = 8) -> DataFrame:
    other = F.when(F.col("col_a") == target, F.col("col_b")).otherwise(F.col("col_a"))
    return (
        matrix.filter((F.col("col_a") == target) | (F.col("col_b") == target))
        .select(other.alias("feature"), "r")
        .orderBy(F.desc(F.abs("r")), "feature")
        .limit(n)
    )


def product_comparison(df: DataFrame, n: int = 8) -> DataFrame:
    """The ``n`` most reviewed products with at least two reviews."""
    return (
        df.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count("review_text").alias("review_count"),
            F.avg("star_rating").alias("avg_rating"),
            F.avg("compound").alias("avg_sentiment"),
            F.avg("word_count").alias("avg_words"),
        )
        .filter(F.col("review_count") >= 2)
        .orderBy(F.desc("review_count"), "product_id")
        .limit(n)
    )


def _fences(df: DataFrame, cols: list[str], k: float) -> dict[str, tuple[Column, Column]]:
    """Lower and upper fence of each column; null without values, so that nothing is flagged."""
    quarters = quantile_values(df, cols, [0.25, 0.75])
    out = {}
    for c, (q1, q3) in quarters.items():
        out[c] = tuple(F.lit(None if q1 is None else v).cast("double") for v in ((q1, q3) if q1 is None else (q1 - k * (q3 - q1), q3 + k * (q3 - q1))))
    return out


def iqr_outliers(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    """Rows outside the fences of any column, with one flag per column."""
    bounds = _fences(df, cols, k)
    flagged = df.withColumns(
        {f"{c}_outlier": F.coalesce((F.col(c) < lo) | (F.col(c) > hi), F.lit(False)) for c, (lo, hi) in bounds.items()}
    )
    any_of = F.lit(False)
    for c in cols:
        any_of = any_of | F.col(f"{c}_outlier")
    return flagged.filter(any_of)


def iqr_report(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    bounds = _fences(df, cols, k)
    agg = df.agg(*[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c) for c, (lo, hi) in bounds.items()])
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("outliers"), lo.alias("low"), hi.alias("high")) for c, (lo, hi) in bounds.items()]
    return agg.select(F.inline(F.array(*cells)))


def scrape_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("rows"),
        F.countDistinct("product_id").alias("products"),
        F.avg("star_rating").alias("avg_star"),
        F.avg("word_count").alias("avg_words"),
        F.count_if("has_images").alias("with_images"),
        (F.count_if("has_images") * 100.0 / F.count("*")).alias("pct_images"),
        F.count_if("verified").alias("verified"),
        (F.count_if("verified") * 100.0 / F.count("*")).alias("pct_verified"),
    )
