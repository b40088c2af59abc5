"""The four summary tables."""

from pyspark.sql import DataFrame

from starsift.operators import rollups
from starsift.sources import files


def rebuild_all(reviews: DataFrame, aspects: DataFrame, topics: DataFrame) -> dict[str, DataFrame]:
    """All summary tables as lazy frames."""
    return {
        "product_summary": rollups.product_summary(reviews),
        "monthly_sentiment": rollups.monthly_sentiment(reviews),
        "aspect_summary": rollups.aspect_summary(reviews, aspects),
        "complaint_summary": rollups.complaint_summary(reviews, topics),
    }


def write_all(tables: dict[str, DataFrame], folder: str) -> None:
    """Replace each stored table (one at a time, each staged first)."""
    for name, df in tables.items():
        files.rebuild(df, f"{folder}/{name}")
