"""The pure functions as SQL functions of a session."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions.plain_sentiment import score

SQL_FUNCTIONS = {
    "sentiment_from_score(stars DOUBLE) RETURNS STRING":
        "CASE WHEN stars >= 4 THEN 'positive' WHEN stars = 3 THEN 'neutral' ELSE 'negative' END",
    "compound_label(c DOUBLE) RETURNS STRING":
        "CASE WHEN c >= 0.05 THEN 'positive' WHEN c <= -0.05 THEN 'negative' ELSE 'neutral' END",
    "helpfulness_ratio(num DOUBLE, den DOUBLE) RETURNS DOUBLE": "CASE WHEN den > 0 THEN num / den ELSE 0D END",
    "alert_level(rate DOUBLE) RETURNS STRING":
        "CASE WHEN rate > 10 THEN 'CRITICAL' WHEN rate > 5 THEN 'WARNING' ELSE 'OK' END",
    "word_count(t STRING) RETURNS INT": f"regexp_count(coalesce(t, ''), r'[^{fv.SPACE}]+')",
    "clean_review_text(t STRING) RETURNS STRING":
        "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(t, ''), '<[^>]*>', ' '), "
        f"r'https?://[^{fv.SPACE}]+|www\\.[^{fv.SPACE}]+', ' '), r'[^\\x00-\\x7F\\x{{00C0}}-\\x{{017F}}]', ''), r'[{fv.SPACE}]+', ' '))",
}


def register(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions and the ``lexicon_compound`` scorer; returns their names."""
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")

    @F.pandas_udf("double")
    def lexicon_compound(s):
        return s.map(lambda t: score(t)[0])

    spark.udf.register("lexicon_compound", lexicon_compound)
    return [s.split("(")[0] for s in SQL_FUNCTIONS] + ["lexicon_compound"]
