"""Analysed reviews to the stored tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift import schemas
from starsift.operators import partials
from starsift.plans import increments, summaries
from starsift.plans.annotate import annotate
from starsift.sources import parts


def fan_out(analysed: DataFrame, id_col: str = "review_id") -> dict[str, DataFrame]:
    """One analysed row to rows of the reviews, embeddings, entities and aspect tables."""
    out = {}
    key = F.col(id_col).alias("review_id")
    if "review_text" in analysed.columns:
        renamed = analysed.withColumnsRenamed({id_col: "id", "star_rating": "score"})
        out["reviews"] = schemas.conform(renamed, "reviews")
    if "embedding" in analysed.columns:
        out["review_embeddings"] = schemas.conform(analysed.select(key, "embedding"), "review_embeddings")
    if "entities" in analysed.columns:
        e = analysed.select(key, F.explode("entities").alias("e"))
        out["entities"] = e.select(
            "review_id",
            F.col("e.text").alias("entity_text"),
            F.col("e.label").alias("entity_type"),
            F.col("e.confidence").alias("confidence"),
            F.col("e.start").alias("start_char"),
            F.col("e.end").alias("end_char"),
        )
    if "aspect_sentiments" in analysed.columns:
        out["aspect_sentiments"] = analysed.select(key, F.inline("aspect_sentiments"))
    return out


def write_analysis(analysed: DataFrame, folder: str, part: str = "all") -> None:
    """Write every fan-out table under ``<table>/part=<part>``, replacing that part only.

    The analysed rows are stored first and read back, so the annotation runs once and
    a lost executor re-reads files. Re-running a part (a retried batch) repeats nothing.
    """
    staged = f"{folder}/_analysed/part={part}"
    analysed.write.mode("overwrite").parquet(staged)
    stored = analysed.sparkSession.read.schema(analysed.schema).parquet(staged)
    for name, rows in fan_out(stored).items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}/part={part}")


def ingest(reviews: DataFrame, topics: DataFrame, folder: str, part: str = "all", **annotate_args) -> None:
    """Annotate, store the four detail tables, and rebuild the four summaries from the partial ones of all parts.

    Only this part's reviews are read; other parts have left their partial summaries in ``<folder>/_partials``.
    """
    spark = reviews.sparkSession
    helped = F.when(
        F.col("helpfulness_denominator") > 0, F.col("helpfulness_numerator") / F.col("helpfulness_denominator")
    ).otherwise(0.0)
    analysed = annotate(reviews, **annotate_args).withColumn("helpfulness_score", helped)
    write_analysis(analysed, folder, part)
    stored = spark.read.schema(schemas.TABLES["reviews"]).parquet(f"{folder}/reviews/part={part}").withColumnsRenamed(
        {"id": "review_id", "score": "star_rating"}
    )
    aspects = spark.read.schema(schemas.TABLES["aspect_sentiments"]).parquet(f"{folder}/aspect_sentiments/part={part}")
    parts.commit(spark, f"{folder}/_partials", part, partials.partial_summaries(stored, aspects))
    summaries.write_all(increments.summaries(spark, f"{folder}/_partials", topics), folder)
