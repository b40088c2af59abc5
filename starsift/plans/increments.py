"""A store of reviews that grows by parts, with summaries that read partial tables only."""

from pyspark.sql import DataFrame, SparkSession

from starsift.operators import partials
from starsift.plans.preprocess import preprocess
from starsift.sources import durable, parts

PARTIALS = ["product_partial", "monthly_partial", "aspect_partial", "complaint_partial"]


def add_part(reviews: DataFrame, aspects: DataFrame, folder: str, part: str) -> int:
    """Store the reviews and aspect rows of a part with its partial summaries, as one version; no other part is read.

    A part of that name is replaced. ``aspects`` are those of the part's reviews.
    """
    spark = reviews.sparkSession
    held = {"reviews": durable.stored(reviews, "part-reviews"), "aspects": durable.stored(aspects, "part-aspects")}
    return parts.commit(spark, folder, part, held | partials.partial_summaries(held["reviews"], held["aspects"]))


def summaries(spark: SparkSession, folder: str, topics: DataFrame, version: int | None = None) -> dict[str, DataFrame]:
    """The four summary tables of a version, by default the newest, from its partial tables."""
    version = parts.latest(spark, folder) if version is None else version  # all four of the same one
    return partials.merged_summaries({name: parts.read(spark, folder, name, version) for name in PARTIALS}, topics)


def write_clean(raw: DataFrame, folder: str, part: str) -> int:
    """Preprocess a batch of raw reviews and store it as a part of the table ``clean``."""
    return parts.commit(raw.sparkSession, folder, part, {"clean": preprocess(raw)})
