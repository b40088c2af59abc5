"""Joins between reviews, aspects, topics and products.

No join carries a broadcast hint: Spark broadcasts a side only when its size is
known (or measured at run time by adaptive execution) to be under the threshold,
and otherwise sort-merges with skewed partitions split.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reviews_with_aspects(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    return reviews.join(aspects, "review_id")


def join_topics(reviews: DataFrame, topics: DataFrame, default: str = "General") -> DataFrame:
    named = topics.select("topic_id", F.col("name").alias("topic_name"))
    return reviews.join(named, "topic_id", "left").withColumn("topic_name", F.coalesce("topic_name", F.lit(default)))


def reviews_with_first_aspect(reviews: DataFrame, aspects: DataFrame, n: int | None = None) -> DataFrame:
    """Alphabetically first aspect per review joined on; newest ``n`` reviews when given."""
    if n is not None:
        reviews = reviews.orderBy(F.desc("review_time"), "review_id").limit(n)
    first = aspects.groupBy("review_id").agg(F.min("aspect_term").alias("aspect"))
    return reviews.join(first, "review_id", "left")


def semi_filter(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on), on, "left_semi")


def new_products(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Products seen in reviews but not stored yet, with default brand and category."""
    seen = reviews.select(F.col("product_id").alias("id")).where(F.col("product_id").isNotNull()).distinct()
    return seen.join(products.select("id"), "id", "left_anti").select(
        "id", F.lit("Unknown").alias("brand"), F.lit("General").alias("category")
    )


def merge_products(reviews: DataFrame, products: DataFrame) -> DataFrame:
    cols = ["id", "brand", "category"]
    return products.select(*cols).unionByName(new_products(reviews, products))


def map_labels(col: Column, mapping: dict) -> Column:
    """Label for an id from a small literal map; the id itself when unmapped."""
    chain = None
    for key, label in mapping.items():
        chain = F.when(col == key, label) if chain is None else chain.when(col == key, label)
    return chain.otherwise(col.cast("string"))


def attach_scalars(df: DataFrame, scalars: dict[str, Column], of: DataFrame | None = None) -> DataFrame:
    """Add global aggregates to every row as scalar subqueries (no join, no shuffle of rows)."""
    source = of if of is not None else df
    return df.withColumns({name: source.agg(c.alias(name)).scalar() for name, c in scalars.items()})
