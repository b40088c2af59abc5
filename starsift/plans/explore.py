"""The exploratory run: every table of the report."""

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from starsift.operators import explore


class Tables(Mapping):
    """Tables by name, each built when it is asked for: those with quantiles run jobs as they are built."""

    def __init__(self, build: dict[str, Callable[[], DataFrame]]):
        self.build = build

    def __getitem__(self, name: str) -> DataFrame:
        return self.build[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self.build)

    def __len__(self) -> int:
        return len(self.build)


def eda(spark: SparkSession, df: DataFrame, numeric: list[str]) -> Tables:
    """Frames by name. ``df`` has word_count and compound; store it (or cache it) first, since every table scans it."""
    matrix = explore.corr_matrix(df, numeric)
    return Tables({
        "overview": lambda: explore.overview(df),
        "missing": lambda: explore.missing_report(df),
        "stars": lambda: explore.star_distribution(df),
        "word_histogram": lambda: explore.histogram(spark, df, "word_count", 40),
        "word_quartiles": lambda: explore.quartiles_by(df, "star_rating", "word_count"),
        "tiers": lambda: explore.tier_share(df),
        "sentiment": lambda: explore.sentiment_distribution(df),
        "compound_histogram": lambda: explore.histogram(spark, df, "compound", 40),
        "fit": lambda: explore.star_sentiment_fit(df),
        "trend": lambda: explore.monthly_trend(df),
        "verified": lambda: explore.verified_report(df),
        "votes": lambda: explore.votes_by_label(df),
        "vote_histogram": lambda: explore.votes_histogram(spark, df),
        "correlations": lambda: matrix,
        "top_correlations": lambda: explore.top_correlations(matrix, "star_rating"),
        "products": lambda: explore.product_comparison(df),
        "outliers": lambda: explore.iqr_outliers(df, ["word_count", "helpful_votes", "compound"]),
        "outlier_report": lambda: explore.iqr_report(df, ["word_count", "helpful_votes", "compound"]),
    })
