"""Train everything from raw reviews."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.functions import features as ft
from starsift.operators import cleaning, evaluate, models, summaries, text_models
from starsift.plans.annotate import annotate
from starsift.plans.preprocess import preprocess
from starsift.sources import artifacts, durable


def train_helpfulness(clean: DataFrame, key: str = "Id", trees: int = 100, test_share: float = 0.2, min_votes: int = 5):
    """(model, scored test rows, error report) on reviews with at least ``min_votes`` votes."""
    dated = clean.withColumn("review_time", F.timestamp_seconds("Time"))
    exposed = cleaning.filter_exposure(dated, min_votes)
    rows = models.helpfulness_features(exposed).withColumn(
        "target", ft.helpfulness_ratio(F.col("HelpfulnessNumerator"), F.col("HelpfulnessDenominator"))
    )
    rows = durable.materialise(evaluate.split(rows, key, test_share))
    model = models.fit_helpfulness(rows.filter(~F.col("is_test")), trees=trees)
    scored = models.score_helpfulness(rows.filter("is_test"), model)
    return model, scored, evaluate.regression_report(scored, "target", "predicted_helpfulness")


def train_all(raw: DataFrame, folder: str, n_topics: int = 10, dim: int = 512, trees: int = 100) -> dict[str, DataFrame]:
    """Clean set, topic table, product summaries and helpfulness model, all stored under ``folder``.

    The fitted topic and helpfulness models are also versions of the artefacts ``topics`` and ``helpfulness``
    there (:mod:`starsift.sources.artifacts`), from which :func:`annotate_stored` scores new reviews.
    """
    spark = raw.sparkSession
    preprocess(raw).write.mode("overwrite").parquet(f"{folder}/clean_reviews")
    clean = spark.read.parquet(f"{folder}/clean_reviews")
    model = text_models.fit_topics(clean, "Id", "clean_review_text", k=n_topics, dim=dim)
    artifacts.save(spark, f"{folder}/artifacts", "topics", model, settings={"k": n_topics, "dim": dim})
    model = artifacts.load(spark, f"{folder}/artifacts", "topics")[0]
    assigned = text_models.assign_topics(clean, "Id", "clean_review_text", model)
    assigned.select("Id", "topic_id").write.mode("overwrite").parquet(f"{folder}/review_topics")
    model["names"].write.mode("overwrite").parquet(f"{folder}/topics")
    told = summaries.summarize_cohorts(clean, "ProductId", "Id", "clean_review_text")
    told.select(
        F.col("ProductId").alias("product_id"), F.lit("all").alias("cohort_type"), F.lit(None).cast("string").alias("cohort_value"),
        "summary_text", F.current_timestamp().alias("generated_at"),
    ).write.mode("overwrite").parquet(f"{folder}/summaries")
    model, _, report = train_helpfulness(clean, trees=trees)
    models.save_model(model, f"{folder}/helpfulness_model")
    errors = {c: float(v) for c, v in report.first().asDict().items() if v is not None}
    artifacts.save(spark, f"{folder}/artifacts", "helpfulness", {}, {"trees": model}, {"trees": trees, **errors})
    return {"topics": spark.read.parquet(f"{folder}/topics"), "helpfulness": report}


def annotate_stored(df: DataFrame, folder: str, version: int | None = None, **settings) -> DataFrame:
    """Reviews annotated with the topic and helpfulness models that :func:`train_all` left under ``folder``."""
    spark = df.sparkSession
    topic_model, _, _ = artifacts.load(spark, f"{folder}/artifacts", "topics", version)
    _, fitted, _ = artifacts.load(spark, f"{folder}/artifacts", "helpfulness", version)
    return annotate(df, topic_model=topic_model, helpfulness_model=fitted["trees"], **settings)
