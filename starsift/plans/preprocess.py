"""Raw reviews to the clean set."""

from pyspark.sql import DataFrame

from starsift.operators import cleaning


def preprocess(raw: DataFrame, n: int | None = None) -> DataFrame:
    """Null filter, cleaning, merge, blank and language filters, keep-first dedupe, optional
    first ``n``: one lazy plan whose only shuffle is the dedupe."""
    clean = cleaning.dedupe_reviews(cleaning.clean_stage(raw))
    return clean if n is None else cleaning.take_first(clean, n)
