"""Sentiment columns, aspect sentiment by sentence, ensembles."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import labels
from starsift.functions import sentiment as fs
from starsift.functions import text as tx


def sentiment_features(df: DataFrame, text: str, lexicon=None, stars: str | None = None) -> DataFrame:
    """Four lexicon scores, the binned label and its agreement with the stars."""
    out = df.withColumn("_s", fs.lexicon_sentiment(F.coalesce(F.col(text), F.lit("")), lexicon)).withColumns(
        {
            "vader_compound": F.col("_s.compound"),
            "vader_positive": F.col("_s.pos"),
            "vader_negative": F.col("_s.neg"),
            "vader_neutral": F.col("_s.neu"),
        }
    ).drop("_s")
    out = out.withColumn("vader_label", labels.compound_label_bins(F.col("vader_compound")))
    if stars:
        agree = F.col("vader_label") == labels.star_label(F.col(stars))
        out = out.withColumn("sentiment_star_agree", F.coalesce(agree, F.lit(False)).cast("int"))
    return out


def overall_sentiment(df: DataFrame, compound: str, pos: str, neg: str, neu: str) -> DataFrame:
    return df.withColumns(
        {
            "overall_sentiment": labels.compound_label(F.col(compound)),
            "sentiment_confidence": F.greatest(pos, neg, neu),
        }
    )


def aspect_candidates(text: Column, given: Column | None = None, default=tuple(fv.DEFAULT_ASPECTS)) -> Column:
    """Given aspects, or the default aspects contained in the text when none are given."""
    low = F.lower(F.coalesce(text, F.lit("")))
    contained = F.array_compact(F.array(*[F.when(low.contains(a), F.lit(a)) for a in default]))
    if given is None:
        return contained
    return F.when(F.coalesce(F.size(given), F.lit(0)) > 0, given).otherwise(contained)


def aspects_from_entities(entities: Column, entity_labels=("FEATURE", "PRODUCT")) -> Column:
    return F.transform(F.filter(entities, lambda e: e["label"].isin(*entity_labels)), lambda e: e["text"])


def aspect_scores(sentences: Column, scores: Column, aspects: Column) -> Column:
    """Aspect, label, confidence and mean score from the sentences that mention each aspect."""
    scored = F.zip_with(sentences, scores, lambda t, x: F.struct(F.lower(t).alias("t"), x.alias("x")))
    means = "array<struct<aspect:string,m:double>>"
    # the scored sentences ride in the fold's state: evaluated once, not once per aspect
    start = F.struct(scored.alias("p"), F.array().cast(means).alias("out"))

    def one(acc, aspect):
        hits = F.transform(F.filter(acc["p"], lambda p: F.contains(p["t"], F.lower(aspect))), lambda p: p["x"])
        mean = tx.let(
            hits, lambda h: F.try_divide(F.aggregate(h, F.lit(0.0), lambda total, x: total + x), F.size(h))
        )
        found = F.array(F.struct(aspect.alias("aspect"), mean.alias("m")))
        return F.struct(acc["p"].alias("p"), F.concat(acc["out"], found).alias("out"))

    def rated(e: Column) -> Column:
        m = e["m"]
        confidence = (
            F.when(m.isNull(), 0.5).when((m >= 0.05) | (m <= -0.05), F.least(F.lit(0.95), 0.5 + F.abs(m))).otherwise(0.6)
        )
        return F.struct(
            e["aspect"].alias("aspect"),
            F.coalesce(labels.compound_label(m), F.lit("neutral")).alias("sentiment_label"),
            confidence.alias("confidence"),
            F.coalesce(m, F.lit(0.0)).alias("score"),
        )

    return F.transform(F.aggregate(aspects, start, one, lambda acc: acc["out"]), rated)


def aspect_sentiment(
    df: DataFrame,
    key: str,
    text: str,
    aspects: Column,
    scorer: Callable[[Column], Column] = fs.sentence_scores,
) -> DataFrame:
    """One row per review and aspect. Sentences, scores and aspects stay arrays of their
    review, so nothing is shuffled; ``scorer`` maps a sentence array to a score array."""
    rows = df.select(key, tx.sentences(F.col(text)).alias("_s"), F.array_distinct(aspects).alias("_a"))
    rows = rows.withColumn("_x", scorer(F.col("_s")))
    return rows.select(key, F.inline(aspect_scores(F.col("_s"), F.col("_x"), F.col("_a"))))


def ensemble(model: Column, compound: Column, weight: float = 0.4, mode: str = "ternary") -> Column:
    """Weighted mean of model probabilities and lexicon-derived ones.

    Classes are in name order: negative, positive or negative, neutral, positive.
    """
    if mode == "binary":
        p = (compound + 1) / 2
        lex = F.array(1 - p, p)
    else:
        pos = F.least(F.greatest((compound - 0.05) / 0.95, F.lit(0.0)), F.lit(1.0))
        neg = F.least(F.greatest((-compound - 0.05) / 0.95, F.lit(0.0)), F.lit(1.0))
        lex = F.array(neg, F.greatest(1 - pos - neg, F.lit(0.0)), pos)
    return F.zip_with(model, lex, lambda a, b: (1 - weight) * a + weight * b)


def argmax(values: Column) -> Column:
    """0-based position of the first largest element."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
