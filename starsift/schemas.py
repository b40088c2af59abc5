"""Schemas of the stored tables and an empty-frame factory."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_REVIEW = (
    "Id bigint, ProductId string, UserId string, ProfileName string, HelpfulnessNumerator int, "
    "HelpfulnessDenominator int, Score int, Time bigint, Summary string, Text string"
)

TABLES = {
    "products": "id string, brand string, category string, created_at timestamp",
    "reviews": (
        "id bigint, product_id string, user_id string, profile_name string, score int, "
        "helpfulness_numerator int, helpfulness_denominator int, helpfulness_score double, "
        "predicted_helpfulness double, review_time timestamp, summary string, review_text string, "
        "clean_review_text string, topic_id int, created_at timestamp"
    ),
    "review_embeddings": "review_id bigint, embedding array<float>",
    "entities": (
        "review_id bigint, entity_text string, entity_type string, confidence double, start_char int, end_char int"
    ),
    "aspect_sentiments": "review_id bigint, aspect_term string, sentiment_label string, confidence double",
    "topics": "topic_id int, name string, keywords array<struct<word:string,score:double>>, created_at timestamp",
    "summaries": (
        "product_id string, cohort_type string, cohort_value string, summary_text string, generated_at timestamp"
    ),
    "product_summary": (
        "product_id string, total_reviews bigint, average_stars double, average_helpfulness double, "
        "positive_count bigint, neutral_count bigint, negative_count bigint, last_updated timestamp"
    ),
    "monthly_sentiment": (
        "month string, product_id string, total_reviews bigint, positive_count bigint, neutral_count bigint, "
        "negative_count bigint"
    ),
    "aspect_summary": (
        "product_id string, aspect_term string, positive_count bigint, neutral_count bigint, "
        "negative_count bigint, avg_confidence double"
    ),
    "complaint_summary": "product_id string, topic_name string, complaint_count bigint, severity_score double",
}

SUMMARIES = ("product_summary", "monthly_sentiment", "aspect_summary", "complaint_summary")


def struct(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], struct(name))


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select and cast to a stored table's schema; absent columns become null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in struct(name)
        ]
    )
