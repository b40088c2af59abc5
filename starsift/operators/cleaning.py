"""Row cleaning, filtering and deduplication."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.functions import labels, parsing
from starsift.functions import text as tx
from starsift.operators.windows import first_by_key

ESSENTIAL = ["ProductId", "Score", "Summary", "Text"]
ESSENTIAL_INGEST = ["ProductId", "Score", "Text"]


def drop_null_essentials(df: DataFrame, cols=ESSENTIAL) -> DataFrame:
    return df.na.drop(subset=list(cols))


def drop_null_ingest(df: DataFrame) -> DataFrame:
    """Ingest variant: the summary may be null."""
    return df.na.drop(subset=ESSENTIAL_INGEST)


def filter_exposure(df: DataFrame, n: int, votes: str = "HelpfulnessDenominator") -> DataFrame:
    return df.filter(F.col(votes) >= n)


def filter_exposure_adaptive(
    df: DataFrame, n: int = 5, minimum_rows: int = 100, fallback: int = 1, votes: str = "HelpfulnessDenominator"
) -> DataFrame:
    """Threshold ``n`` unless fewer than ``minimum_rows`` rows would remain, then ``fallback``.

    Which of the two was used stands in ``exposure_threshold``. Behaviour depends on the size of the data, so other
    operators take an explicit threshold instead.
    """
    threshold = df.agg(
        F.when(F.count_if(F.col(votes) >= n) >= minimum_rows, n).otherwise(fallback).alias("t")
    ).scalar()
    return df.withColumn("exposure_threshold", threshold).filter(F.col(votes) >= F.col("exposure_threshold"))


def drop_blank(df: DataFrame, col: str = "clean_review_text") -> DataFrame:
    return df.filter(F.trim(F.col(col)) != "")


def dedupe_reviews(df: DataFrame) -> DataFrame:
    """Keep the first row (by Id) per product, user and cleaned text."""
    return first_by_key(df, ["ProductId", "UserId", "clean_review_text"], ["Id"])


def dedupe_scraped(df: DataFrame, order: str = "row_id") -> DataFrame:
    return first_by_key(df, ["product_id", "reviewer_name", "review_text"], [order])


def take_first(df: DataFrame, n: int, order: str = "Id") -> DataFrame:
    return df.orderBy(order).limit(n)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Empty text and title, "Anonymous" reviewer, zero votes."""
    return df.withColumns(
        {
            "reviewer_name": F.coalesce("reviewer_name", F.lit("Anonymous")),
            "review_title": tx.strip(F.coalesce("review_title", F.lit(""))),
            "review_text": tx.strip(F.coalesce("review_text", F.lit(""))),
            "helpful_votes": F.coalesce(F.col("helpful_votes").try_cast("int"), F.lit(0)),
        }
    )


def read_review_slice(df: DataFrame, offset: int, n: int, id_col: str = "Id", bucket: int = 1_000_000) -> DataFrame:
    """Rows ``offset`` to ``offset + n`` of the non-null rows in id order.

    Positions come from counts per id range, so only the ranges that overlap the
    slice are ranked and no row-level window spans the table. Consecutive slices
    neither overlap nor leave gaps.
    """
    rows = drop_null_ingest(df).withColumn("_b", F.floor(F.col(id_col) / bucket))
    counts = rows.groupBy("_b").agg(F.count("*").alias("_n"))
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per id range
    starts = counts.select("_b", (F.sum("_n").over(upto) - F.col("_n")).alias("_start"), "_n").filter(
        (F.col("_start") < offset + n) & (F.col("_start") + F.col("_n") > offset)
    )
    position = F.col("_start") + F.row_number().over(Window.partitionBy("_b").orderBy(id_col)) - 1
    return (
        rows.join(starts.select("_b", "_start"), "_b")
        .withColumn("_p", position)
        .filter((F.col("_p") >= offset) & (F.col("_p") < offset + n))
        .drop("_b", "_start", "_p")
    )


def standardise_reviews(raw: DataFrame, source: str = "review-csv") -> DataFrame:
    """Public review-CSV columns to the review schema, derived columns, keep-first dedupe."""
    text = tx.strip(F.coalesce("Text", F.lit("")))
    posted = F.expr("timestampadd(SECOND, Time, timestamp_ntz'1970-01-01 00:00:00')")
    votes = F.coalesce("HelpfulnessNumerator", F.lit(0))
    out = raw.select(
        F.col("Id").alias("row_id"),
        F.col("ProductId").alias("product_id"),
        F.col("ProductId").alias("product_name"),
        F.coalesce("ProfileName", F.lit("Anonymous")).alias("reviewer_name"),
        F.col("Score").try_cast("double").alias("star_rating"),
        tx.strip(F.coalesce("Summary", F.lit(""))).alias("review_title"),
        text.alias("review_text"),
        posted.alias("review_date"),
        posted.cast("date").alias("review_date_parsed"),
        F.lit(False).alias("verified"),
        votes.alias("helpful_votes"),
        F.lit("").alias("image_urls"),
        F.lit(source).alias("source_url"),
        F.length(text).alias("review_length"),
        tx.word_count(text).alias("word_count"),
        F.lit(False).alias("has_images"),
        F.lit(0).alias("image_count"),
        (tx.word_count(text) > 100).alias("is_long_review"),
        (votes >= 10).alias("is_highly_helpful"),
        labels.star_label(F.col("Score").try_cast("double")).alias("sentiment_label"),
    )
    return dedupe_scraped(out)


def type_scraped_reviews(df: DataFrame) -> DataFrame:
    """Coerce, date-parse and clean scraped rows, add flags, dedupe, fix the column order."""
    text = tx.collapse(F.coalesce("review_text", F.lit("")))
    stars = F.col("star_rating").try_cast("double")
    votes = F.coalesce(F.col("helpful_votes").try_cast("int"), F.lit(0))
    n_images = F.when(F.coalesce("image_urls", F.lit("")) == "", 0).otherwise(F.size(F.split("image_urls", r"\|")))
    typed = df.select(
        "row_id",
        "product_id",
        "product_name",
        "reviewer_name",
        stars.alias("star_rating"),
        labels.star_label(stars).alias("sentiment_label"),
        tx.strip(F.coalesce("review_title", F.lit(""))).alias("review_title"),
        text.alias("review_text"),
        F.length(text).alias("review_length"),
        tx.word_count(text).alias("word_count"),
        (tx.word_count(text) > 100).alias("is_long_review"),
        "review_date",
        parsing.parse_review_date(F.col("review_date")).alias("review_date_parsed"),
        F.col("verified").cast("boolean").alias("verified"),
        votes.alias("helpful_votes"),
        (votes >= 10).alias("is_highly_helpful"),
        (n_images > 0).alias("has_images"),
        n_images.alias("image_count"),
        "image_urls",
        "source_url",
    )
    return dedupe_scraped(typed)


def recent_reviews(df: DataFrame, products=None, term: str | None = None, n: int = 50) -> DataFrame:
    """Newest ``n`` reviews, optionally for some products and containing a term (case-insensitive)."""
    if products:
        df = df.filter(F.col("product_id").isin(*products))
    if term:
        df = df.filter(F.contains(F.lower("review_text"), F.lit(term.lower())))
    return (
        df.orderBy(F.desc("review_time"), "review_id")
        .limit(n)
        .select(
            "review_id",
            F.date_format("review_time", "yyyy-MM-dd").alias("review_date"),
            "product_id",
            "star_rating",
            labels.sentiment_from_score(F.col("star_rating")).alias("sentiment"),
            "review_text",
            F.col("helpfulness_denominator").alias("helpful_votes"),
        )
    )


def filter_summaries(df: DataFrame, products=None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Product and inclusive month filters on a summary table (months as ``yyyy-MM``)."""
    if products:
        df = df.filter(F.col("product_id").isin(*products))
    if start:
        df = df.filter(F.col("month") >= start)
    if end:
        df = df.filter(F.col("month") <= end)
    return df


def dashboard_frame(df: DataFrame) -> DataFrame:
    """Defaults and month/quarter keys on reviews joined to their first aspect."""
    sentiment = labels.sentiment_from_score(F.col("star_rating"))
    return df.select(
        "review_id",
        "product_id",
        sentiment.alias("sentiment"),
        "star_rating",
        F.lit(True).alias("verified"),
        F.lit(0).alias("img_defect"),
        (sentiment == "negative").cast("int").alias("is_defect"),
        tx.capitalize(F.coalesce("aspect", F.lit("Value"))).alias("aspect"),
        labels.month_key(F.col("review_time")).alias("month"),
        F.trunc("review_time", "month").alias("month_dt"),
        labels.quarter_key(F.col("review_time")).alias("quarter"),
    )


def clean_stage(raw: DataFrame) -> DataFrame:
    """Null filter, text cleaning, merge, blank and language filters (no shuffle).

    The cleaned values are built and tested inside one array value that is then
    inlined. A plain ``filter`` on them would be pushed below the projection, which
    repeats the whole cleaning chain for every mention of a cleaned column.
    """
    cleaned = F.array(
        F.struct(
            tx.clean_review_text(F.col("Summary")).alias("clean_summary"),
            tx.clean_review_text(F.col("Text")).alias("clean_text"),
        )
    )
    merged = F.transform(
        cleaned,
        lambda v: F.struct(
            v["clean_summary"].alias("clean_summary"),
            v["clean_text"].alias("clean_text"),
            tx.merge_summary_text(v["clean_summary"], v["clean_text"]).alias("clean_review_text"),
        ),
    )
    kept = F.filter(
        merged,
        lambda v: (F.trim(v["clean_review_text"]) != "") & tx.is_likely_english(v["clean_review_text"]),
    )
    return drop_null_essentials(raw).select("*", F.inline(kept))


def ingest_stats(raw: DataFrame) -> DataFrame:
    """Rows read, rows passing the filters, rows after deduplication, duplicates removed."""
    kept = clean_stage(raw)
    per_key = kept.groupBy("ProductId", "UserId", "clean_review_text").agg(F.count("*").alias("n"))
    counts = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_clean"), F.count("*").alias("rows_kept"))
    read = raw.agg(F.count("*").alias("c")).scalar()
    return counts.select(
        read.alias("rows_read"),
        "rows_clean",
        "rows_kept",
        (F.col("rows_clean") - F.col("rows_kept")).alias("duplicates_removed"),
    )
