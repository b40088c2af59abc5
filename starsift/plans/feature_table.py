"""The full feature table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import text as tx
from starsift.operators import features, models, sentiment


def build_features(
    df: DataFrame,
    key: str = "review_id",
    text: str = "review_text",
    ts: str = "review_time",
    reviewer: str = "user_id",
    tfidf: bool = False,
    tags: DataFrame | None = None,
    scale: bool = True,
    lexicon: dict[str, float] | None = None,
    lemma_map: Column | None = None,
    max_features: int = 5000,
    components: int = 50,
) -> DataFrame:
    """Text, sentiment, lexicon, rating and metadata columns; POS, LSA and scaled ones on request."""
    out = features.basic_text_features(df, text)
    out = features.preprocessed_columns(out, text, lemma_map)
    out = sentiment.sentiment_features(out, "clean_text", lexicon, "star_rating")
    out = features.lexicon_features(out, tx.words(F.col("processed_text")), F.col("word_count"))
    out = features.rating_features(out)
    out = features.metadata_features(out, ts, reviewer)
    if tags is not None:
        out = features.pos_features(out, tags, key)
    if tfidf:
        vectors, _ = models.text_vectors(out, key, "processed_text", max_features, name="_v")
        _, reduced = models.lsa(vectors, "_v", components, max_features)
        out = reduced.drop("_v")
    if scale:
        out = features.scale_columns(out, [c for c in fv.SCALED_COLUMNS if c in out.columns])
    return out
