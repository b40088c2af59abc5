"""Per-review annotation as one chain of columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.functions import sentiment as fs
from starsift.functions import text as tx
from starsift.operators import entities as en
from starsift.operators import features, models, sentiment, text_models


def rejects(df: DataFrame, text: str = "review_text") -> DataFrame:
    """Rows whose text is empty after cleaning."""
    return df.filter(tx.clean_review_text(F.col(text)) == "").withColumn(
        "error", F.lit("Text cleaning returned an empty review.")
    )


def annotate(
    df: DataFrame,
    text: str = "review_text",
    stars: str = "star_rating",
    lexicon: dict[str, float] | None = None,
    entities: Column | None = None,
    topics: DataFrame | None = None,
    helpfulness_model=None,
    topic_model: text_models.Model | None = None,
    key: str = "review_id",
) -> DataFrame:
    """Clean text, entities, aspect sentiment, topic, readability, sentiment and helpfulness.

    Everything but the topic is computed in the row. With a fitted ``topic_model`` (its
    tables, see :func:`text_models.fit_topics`) the cleaned text gets its topic by joins on
    ``key``; else ``topics`` is (topic_id, topic_name) for rows that carry a ``topic_id``.
    Without a ``helpfulness_model`` a given ``predicted_helpfulness`` stays, and is 0.5 where
    null. Rows rejected for empty text are in :func:`rejects`.
    """
    out = df.withColumn("clean_review_text", tx.clean_review_text(F.col(text))).filter(F.col("clean_review_text") != "")
    c = F.col("clean_review_text")
    found = en.extract_entities(c) if entities is None else entities
    out = out.withColumn("entities", en.resolve_overlaps(found))
    given = sentiment.aspects_from_entities(F.col("entities"))
    out = out.withColumns(
        {"_aspects": F.array_distinct(sentiment.aspect_candidates(c, given)), "_sentences": tx.sentences(c)}
    )
    out = out.withColumns(
        {"_scores": fs.sentence_scores(F.col("_sentences"), lexicon), "_overall": fs.lexicon_sentiment(c, lexicon)}
    )
    out = out.withColumn(
        "_rated", sentiment.aspect_scores(F.col("_sentences"), F.col("_scores"), F.col("_aspects"))
    ).withColumn(
        "aspect_sentiments",
        F.transform(
            "_rated",
            lambda a: F.struct(
                a["aspect"].alias("aspect_term"),
                a["sentiment_label"].alias("sentiment_label"),
                F.round(a["confidence"], 2).alias("confidence"),
            ),
        ),
    )
    if topic_model is not None:
        out = text_models.assign_topics(out.drop("topic_id"), key, "clean_review_text", topic_model)
        topics = topic_model["names"]
    if "topic_id" not in out.columns:
        out = out.withColumn("topic_id", F.lit(-1))
    if topics is not None:
        names = topics.select("topic_id", "topic_name")
        out = out.join(names, "topic_id", "left")
        out = out.withColumn("topic_name", F.coalesce("topic_name", F.lit("General")))
    else:
        out = out.withColumn("topic_name", F.lit("General"))
    out = features.readability(out, "clean_review_text")
    out = sentiment.overall_sentiment(
        out.withColumns({f"_{k}": F.col(f"_overall.{k}") for k in ("compound", "pos", "neg", "neu")}),
        "_compound", "_pos", "_neg", "_neu",
    )
    density = en.densities(c, F.col("entities"), F.col("aspect_sentiments"))
    out = out.withColumns(
        {
            "sentiment_polarity": F.col("_compound"),
            "rating_normalized": F.col(stars) / 5.0,
            "time_delta_days": F.lit(0.0),
            "is_topic_assigned": (F.col("topic_id") >= 0).cast("int"),
            **density,
        }
    )
    if helpfulness_model is None and "predicted_helpfulness" in out.columns:
        out = out.withColumn("predicted_helpfulness", F.coalesce("predicted_helpfulness", F.lit(0.5)))
    else:
        out = models.score_helpfulness(out.drop("predicted_helpfulness"), helpfulness_model)
    return out.withColumn("sentiment_confidence", F.round("sentiment_confidence", 2)).drop(
        "_aspects", "_sentences", "_scores", "_rated", "_overall", "_compound", "_pos", "_neg", "_neu"
    )
