"""Feature columns added to a review table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import features as ft
from starsift.functions import labels
from starsift.functions import readability as rd
from starsift.functions import text as tx
from starsift.operators import windows


def basic_text_features(df: DataFrame, text: str = "review_text") -> DataFrame:
    c = F.col(text)
    df = df.withColumns(
        {
            "char_count": ft.char_count(c),
            "word_count": tx.word_count(c),
            "sentence_count": F.size(tx.sentences(c)),
            "avg_word_length": ft.avg_word_len(c),
            "exclamation_count": ft.count_of(c, "!"),
            "question_count": ft.count_of(c, r"\?"),
            "caps_word_count": ft.caps_word_count(c),
            "has_number": ft.has_number(c),
            "number_count": ft.number_count(c),
            "has_price": ft.has_price(c),
        }
    )
    return df.withColumns(
        {
            "avg_sentence_length": ft.avg_sentence_len(F.col("word_count"), F.col("sentence_count")),
            "caps_ratio": F.col("caps_word_count") / (F.col("word_count") + 1),
            "length_tier": labels.length_tier(F.col("word_count")),
        }
    )


def preprocessed_columns(df: DataFrame, text: str = "review_text", lemma_map: Column | None = None) -> DataFrame:
    c = F.col(text)
    return df.withColumns(
        {"clean_text": tx.clean_text_num(c), "processed_text": tx.preprocess_text(c, 2, lemma_map=lemma_map)}
    )


def review_flags(df: DataFrame, text: str = "review_text", images: str = "image_urls") -> DataFrame:
    n_images = F.when(F.coalesce(images, F.lit("")) == "", 0).otherwise(F.size(F.split(images, r"\|")))
    return df.withColumns(
        {
            "is_long_review": tx.word_count(F.col(text)) > 100,
            "is_highly_helpful": F.col("helpful_votes").try_cast("int") >= 10,
            "has_images": n_images > 0,
            "image_count": n_images,
        }
    )


def lexicon_features(df: DataFrame, tokens: Column, word_count: Column) -> DataFrame:
    df = df.withColumns(
        {
            "positive_word_count": ft.lexicon_hits(tokens, fv.POSITIVE_WORDS),
            "negative_word_count": ft.lexicon_hits(tokens, fv.NEGATIVE_WORDS),
            "feature_word_count": ft.lexicon_hits(tokens, fv.FEATURE_WORDS),
        }
    )
    return df.withColumns(
        {
            "positive_word_ratio": F.col("positive_word_count") / (word_count + 1),
            "negative_word_ratio": F.col("negative_word_count") / (word_count + 1),
            "lexicon_net_score": F.col("positive_word_count") - F.col("negative_word_count"),
        }
    )


def rating_features(df: DataFrame, stars: str = "star_rating") -> DataFrame:
    """Bucket, positive flag, one-hot columns and global z-score."""
    s = F.col(stars)
    bucket = labels.rating_bucket(s)
    out = df.withColumns({"rating_bucket": bucket, "is_positive_review": F.coalesce(s >= 4, F.lit(False)).cast("int")})
    out = out.withColumns(
        {f"rating_{k}star": F.coalesce(bucket == f"{k}star", F.lit(False)).cast("int") for k in range(1, 6)}
    )
    return rating_zscore(out, stars)


def rating_zscore(df: DataFrame, stars: str = "star_rating") -> DataFrame:
    mean = df.agg(F.avg(stars).alias("m")).scalar()
    std = df.agg(F.stddev_samp(stars).alias("s")).scalar()
    return df.withColumn("star_rating_zscore", (F.col(stars) - mean) / (std + 1e-9))


def vote_features(df: DataFrame) -> DataFrame:
    votes = F.coalesce(F.col("helpful_votes").try_cast("double"), F.lit(0.0))
    return df.withColumns(
        {
            "is_verified": F.col("verified").cast("int"),
            "helpful_votes": votes,
            "log_helpful_votes": F.log1p(votes),
            "is_helpful": (votes >= 5).cast("int"),
        }
    )


def image_features(df: DataFrame, count: str = "image_count") -> DataFrame:
    return df.withColumns(
        {"has_images": (F.col(count) > 0).cast("int"), "log_img_count": F.log1p(F.col(count).cast("double"))}
    )


def metadata_features(df: DataFrame, ts: str, reviewer: str = "reviewer_name") -> DataFrame:
    """Vote, image and date columns plus reviewer and product statistics (when the columns exist)."""
    df = vote_features(df)
    if "image_count" in df.columns:
        df = image_features(df)
    df = df.withColumns(ft.date_features(F.col(ts)))
    if reviewer in df.columns:
        df = windows.reviewer_counts(df, reviewer)
    return windows.product_stats(df) if "product_id" in df.columns else df


def readability(df: DataFrame, text: str = "review_text") -> DataFrame:
    c = F.col(text)
    n_words, n_syl = tx.word_count(c), rd.syllable_total(c)
    n_sent = F.when(n_words > 0, F.greatest(F.size(tx.sentence_pieces(c)), F.lit(1))).otherwise(0)
    blank = n_words == 0
    df = df.withColumns({"word_count": n_words, "sentence_count": n_sent, "syllable_count": n_syl})
    return df.withColumns(
        {
            "char_count": F.when(blank, 0).otherwise(F.length(c)),
            "flesch_reading_ease": rd.two_places(
                rd.flesch_ease(F.col("word_count"), F.col("sentence_count"), F.col("syllable_count"))
            ),
            "flesch_kincaid_grade": rd.two_places(
                rd.fk_grade(F.col("word_count"), F.col("sentence_count"), F.col("syllable_count"))
            ),
        }
    )


def time_delta_days(df: DataFrame, ts: str) -> DataFrame:
    """Days between each row and the newest row."""
    newest = df.agg(F.max(ts).alias("m")).scalar()
    seconds = F.timestamp_diff("SECOND", F.col(ts), newest)
    return df.withColumn("time_delta_days", seconds / 86400.0)


def scale_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Population standardisation, null counted as 0, zero deviation treated as 1."""
    def value(c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0))

    stats = df.agg(
        F.struct(
            *[F.avg(value(c)).alias(f"mean_{c}") for c in cols],
            *[F.stddev_pop(value(c)).alias(f"std_{c}") for c in cols],
        ).alias("stats")
    ).scalar()
    out = {}
    for c in cols:
        mean, std = F.col(f"_stats.mean_{c}"), F.col(f"_stats.std_{c}")
        out[f"{c}_scaled"] = (value(c) - mean) / F.when(std == 0, 1.0).otherwise(std)
    return df.withColumn("_stats", stats).withColumns(out).drop("_stats")


def pos_features(df: DataFrame, tags: DataFrame, key: str, text: str = "clean_text") -> DataFrame:
    """Counts and ratios of nouns, verbs, adjectives, adverbs from a token-to-tag table.

    Each document's distinct tokens are counted before the dictionary join, so a
    frequent token costs one row per document.
    """
    tokens = df.select(key, F.explode(tx.words(F.lower(F.col(text)))).alias("token"))
    counts = tokens.groupBy(key, "token").agg(F.count("*").alias("n"))
    tagged = counts.join(tags.select("token", "tag"), "token")
    groups = {"noun": "NN", "verb": "VB", "adj": "JJ", "adv": "RB"}
    per_doc = tagged.groupBy(key).agg(
        *[F.sum(F.when(F.startswith("tag", F.lit(p)), F.col("n"))).alias(f"{g}_count") for g, p in groups.items()]
    )
    out = df.join(per_doc, key, "left").withColumns(
        {f"{g}_count": F.coalesce(f"{g}_count", F.lit(0)) for g in groups}
    )
    total = tx.word_count(F.col(text)) + 1
    return out.withColumns({f"{g}_ratio": F.col(f"{g}_count") / total for g in groups})


FEATURE_GROUPS = {
    "text": [
        "char_count", "word_count", "sentence_count", "avg_word_length", "avg_sentence_length",
        "exclamation_count", "question_count", "caps_word_count", "caps_ratio", "has_number",
        "number_count", "has_price", "length_tier",
    ],
    "sentiment": ["vader_compound", "vader_positive", "vader_negative", "vader_neutral", "vader_label",
                  "sentiment_star_agree"],
    "lexicon": ["positive_word_count", "negative_word_count", "feature_word_count", "positive_word_ratio",
                "negative_word_ratio", "lexicon_net_score"],
    "rating": ["rating_bucket", "is_positive_review", "star_rating_zscore"],
    "metadata": ["is_verified", "log_helpful_votes", "is_helpful", "has_images", "log_img_count", "review_year",
                 "review_month", "review_dow", "is_weekend", "reviewer_review_count", "is_power_reviewer",
                 "product_avg_rating", "product_rating_std", "product_review_count", "rating_deviation"],
    "pos": ["noun_count", "verb_count", "adj_count", "adv_count", "noun_ratio", "verb_ratio", "adj_ratio",
            "adv_ratio"],
}


def feature_groups(columns: list[str]) -> dict[str, list[str]]:
    """Feature columns present, by group; LSA and scaled columns by their name pattern."""
    found = {g: [c for c in names if c in columns] for g, names in FEATURE_GROUPS.items()}
    found["lsa"] = [c for c in columns if c.startswith("lsa")]
    found["scaled"] = [c for c in columns if c.endswith("_scaled")]
    return found
