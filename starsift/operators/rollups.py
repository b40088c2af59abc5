"""Summary tables and the read-path tables built from them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.functions import labels
from starsift.functions import text as tx
from starsift.operators import joins, windows


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def star_counts(stars: str = "star_rating") -> list[Column]:
    s = F.col(stars)
    return [
        _count(s >= 4).alias("positive_count"),
        _count(s == 3).alias("neutral_count"),
        _count(s <= 2).alias("negative_count"),
    ]


def product_summary(reviews: DataFrame) -> DataFrame:
    """Reviews, stars, helpfulness (.5 when missing) and sentiment counts per product."""
    return reviews.groupBy("product_id").agg(
        F.count("*").alias("total_reviews"),
        F.avg("star_rating").alias("average_stars"),
        F.avg(F.coalesce("predicted_helpfulness", F.lit(0.5))).alias("average_helpfulness"),
        *star_counts(),
    )


def monthly_sentiment(reviews: DataFrame) -> DataFrame:
    """Sentiment counts per month and product; rows without a time are left out."""
    dated = reviews.filter(F.col("review_time").isNotNull())
    return dated.groupBy(labels.month_key(F.col("review_time")).alias("month"), "product_id").agg(
        F.count("*").alias("total_reviews"), *star_counts()
    )


def monthly_sentiment_rollup(reviews: DataFrame) -> DataFrame:
    """The same with subtotals per month and a grand total."""
    dated = reviews.filter(F.col("review_time").isNotNull()).withColumn(
        "month", labels.month_key(F.col("review_time"))
    )
    return dated.rollup("month", "product_id").agg(F.count("*").alias("total_reviews"), *star_counts())


def aspect_summary(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    """Aspect sentiment per product and aspect.

    Aspect rows are collapsed per review, aspect and label first, so the join
    moves fewer rows than the raw table when a review repeats an aspect.
    """
    per_review = aspects.groupBy("review_id", "aspect_term").agg(
        _count(F.col("sentiment_label") == "positive").alias("p"),
        _count(F.col("sentiment_label") == "neutral").alias("u"),
        _count(F.col("sentiment_label") == "negative").alias("n"),
        F.sum("confidence").alias("c"),
        F.count("confidence").alias("k"),
    )
    joined = reviews.select("review_id", "product_id").join(per_review, "review_id")
    return joined.groupBy("product_id", "aspect_term").agg(
        F.sum("p").alias("positive_count"),
        F.sum("u").alias("neutral_count"),
        F.sum("n").alias("negative_count"),
        F.try_divide(F.sum("c"), F.sum("k")).alias("avg_confidence"),
    )


def complaint_summary(reviews: DataFrame, topics: DataFrame) -> DataFrame:
    """Reviews of at most two stars per product and topic, severity = n * (5 - mean stars).

    Counted per topic id before the topic names are joined on.
    """
    low = reviews.filter(F.col("star_rating") <= 2)
    counted = low.groupBy("product_id", "topic_id").agg(F.count("*").alias("n"), F.sum("star_rating").alias("stars"))
    return (
        joins.join_topics(counted, topics)
        .groupBy("product_id", "topic_name")
        .agg(F.sum("n").alias("complaint_count"), F.sum("stars").alias("stars"))
        .select(
            "product_id",
            "topic_name",
            "complaint_count",
            (F.col("complaint_count") * (5.0 - F.col("stars") / F.col("complaint_count"))).alias("severity_score"),
        )
    )


def complaint_scores(cs: DataFrame) -> DataFrame:
    """Complaints over all products: count, severity, share of all complaints."""
    per_topic = cs.groupBy(F.col("topic_name").alias("complaint")).agg(
        F.sum("complaint_count").alias("count"), F.sum("severity_score").alias("severity")
    )
    return windows.share_of(per_topic, [], "count", name="pct").orderBy(F.desc("severity"), "complaint")


def kpis_from_summary(ps: DataFrame) -> DataFrame:
    total = F.sum("total_reviews")
    return ps.agg(
        F.coalesce(total, F.lit(0)).alias("total_reviews"),
        F.coalesce(F.try_divide(F.sum(F.col("average_stars") * F.col("total_reviews")), total), F.lit(0.0)).alias(
            "avg_star"
        ),
        *[
            F.coalesce(F.try_divide(F.sum(f"{k}_count") * 100.0, total), F.lit(0.0)).alias(f"pct_{k}")
            for k in ("positive", "neutral", "negative")
        ],
    )


def month_delta(ms: DataFrame) -> DataFrame:
    """Positive share of the latest month against the month before, with its direction."""
    monthly = ms.groupBy("month").agg(
        F.coalesce(F.try_divide(F.sum("positive_count") * 100.0, F.sum("total_reviews")), F.lit(0.0)).alias("pos_pct")
    )
    edges = windows.month_edges(ms)
    last_two = monthly.join(edges.filter(F.col("from_last") <= 2), "month")
    recent = F.max(F.when(F.col("from_last") == 1, F.col("pos_pct")))
    prior = F.max(F.when(F.col("from_last") == 2, F.col("pos_pct")))
    change = F.col("recent_pos_pct") - F.col("prior_pos_pct")
    return last_two.agg(recent.alias("recent_pos_pct"), prior.alias("prior_pos_pct")).select(
        "recent_pos_pct",
        "prior_pos_pct",
        change.alias("change"),
        F.when(change > 0, "up").when(change < 0, "down").otherwise("flat").alias("direction"),
    )


def sentiment_long(ms: DataFrame) -> DataFrame:
    """Three count columns to (month, sentiment, count)."""
    long = ms.unpivot(["month"], ["positive_count", "neutral_count", "negative_count"], "sentiment", "n")
    return long.groupBy("month", F.regexp_replace("sentiment", "_count$", "").alias("sentiment")).agg(
        F.sum("n").alias("count")
    )


def rating_heatmap(ms: DataFrame, months: int | None = None, products: int | None = None) -> DataFrame:
    """Estimated rating per product and month; on request of the latest months and first products only."""
    cells = ms.filter(F.col("month").isNotNull())
    if months is not None:
        edges = windows.month_edges(ms).filter(F.col("from_last") <= months)
        cells = cells.join(edges.select("month"), "month")
    if products is not None:
        chosen = ms.select("product_id").distinct().orderBy("product_id").limit(products)
        cells = cells.join(chosen, "product_id", "left_semi")
    rating = F.col("positive_count") * 4.5 + F.col("neutral_count") * 3.0 + F.col("negative_count") * 1.5
    return cells.select("product_id", "month", (rating / F.greatest("total_reviews", F.lit(1))).alias("est_rating"))


def aspect_diverging(as_: DataFrame) -> DataFrame:
    """Mentions, positive and negative share and net score per aspect, ordered by net."""
    g = as_.groupBy("aspect_term").agg(
        F.sum("positive_count").alias("p"), F.sum("neutral_count").alias("u"), F.sum("negative_count").alias("n")
    )
    total = F.col("p") + F.col("u") + F.col("n")
    return (
        g.filter(total > 0)
        .select(
            tx.capitalize(F.col("aspect_term")).alias("aspect"),
            total.alias("mentions"),
            (F.col("p") * 100.0 / total).alias("pos_pct"),
            (F.col("n") * 100.0 / total).alias("neg_pct"),
            ((F.col("p") - F.col("n")) / total).alias("net"),
        )
        .orderBy("net", "aspect")
    )


def star_histogram(spark: SparkSession, df: DataFrame, product: str) -> DataFrame:
    """Five star counts of one product, zeros included."""
    counts = df.filter(F.col("product_id") == product).groupBy("star_rating").agg(F.count("*").alias("n"))
    stars = spark.range(1, 6).select(F.col("id").cast("int").alias("star_rating"))
    return stars.join(counts, "star_rating", "left").select("star_rating", F.coalesce("n", F.lit(0)).alias("n"))


def sentiment_badge(ps: DataFrame) -> DataFrame:
    total = F.greatest("total_reviews", F.lit(1))
    pos, neg = F.col("positive_count") * 100.0 / total, F.col("negative_count") * 100.0 / total
    return ps.select(
        "product_id",
        "total_reviews",
        pos.alias("pos_pct"),
        neg.alias("neg_pct"),
        labels.sentiment_badge(pos, neg).alias("badge"),
    )
