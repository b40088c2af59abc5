"""Summary tables from partial ones: sums and counts of each part of the reviews, merged without the reviews.

A part is any set of reviews with all their aspect rows. Partials hold sums and counts only, a row per group and part, so
merging any of them gives the summaries of all their reviews, and a part that changes is summed again alone.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.operators import joins, rollups

COUNTS = ["positive_count", "neutral_count", "negative_count"]


def partial_summaries(reviews: DataFrame, aspects: DataFrame) -> dict[str, DataFrame]:
    """The partial tables of one part."""
    low = reviews.filter(F.col("star_rating") <= 2)
    per_review = aspects.groupBy("review_id", "aspect_term").agg(
        *[F.count_if(F.col("sentiment_label") == k).alias(f"{k}_count") for k in ("positive", "neutral", "negative")],
        F.sum("confidence").alias("confidence"),
        F.count("confidence").alias("confidences"),
    )
    held = reviews.select("review_id", "product_id").join(per_review, "review_id")
    return {
        "product_partial": reviews.groupBy("product_id").agg(
            F.count("*").alias("total_reviews"),
            F.sum("star_rating").alias("stars"),
            F.count("star_rating").alias("starred"),
            F.sum(F.coalesce("predicted_helpfulness", F.lit(0.5))).alias("helpfulness"),
            *rollups.star_counts(),
        ),
        "monthly_partial": rollups.monthly_sentiment(reviews),
        "aspect_partial": held.groupBy("product_id", "aspect_term").agg(*[F.sum(c).alias(c) for c in [*COUNTS, "confidence", "confidences"]]),
        "complaint_partial": low.groupBy("product_id", "topic_id").agg(F.count("*").alias("complaint_count"), F.sum("star_rating").alias("stars")),
    }


def _summed(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in df.columns if c not in keys])


def merged_summaries(partials: dict[str, DataFrame], topics: DataFrame) -> dict[str, DataFrame]:
    """The four summary tables of all the parts that the partial tables cover."""
    product = _summed(partials["product_partial"], "product_id")
    aspect = _summed(partials["aspect_partial"], "product_id", "aspect_term")
    complaint = joins.join_topics(_summed(partials["complaint_partial"], "product_id", "topic_id"), topics)
    complaint = _summed(complaint.drop("topic_id"), "product_id", "topic_name")
    mean = F.col("stars") / F.col("complaint_count")
    return {
        "product_summary": product.select(
            "product_id",
            "total_reviews",
            F.try_divide("stars", "starred").alias("average_stars"),
            (F.col("helpfulness") / F.col("total_reviews")).alias("average_helpfulness"),
            *COUNTS,
        ),
        "monthly_sentiment": _summed(partials["monthly_partial"], "month", "product_id"),
        "aspect_summary": aspect.select("product_id", "aspect_term", *COUNTS, F.try_divide("confidence", "confidences").alias("avg_confidence")),
        "complaint_summary": complaint.select(
            "product_id", "topic_name", "complaint_count", (F.col("complaint_count") * (5.0 - mean)).alias("severity_score")
        ),
    }
