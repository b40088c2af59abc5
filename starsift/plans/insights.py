"""The business-insight run."""

from pyspark.sql import DataFrame

from starsift.operators import insights, topics


def run(df: DataFrame, topic: str | None = None) -> dict[str, DataFrame]:
    """Complaint, defect, aspect, authenticity and KPI tables; topic trends when rows carry a topic."""
    flagged = insights.suspicious_reviews(df)
    out = {
        "kpis": insights.kpis(df),
        "complaints": insights.analyse_complaints(df),
        "complaint_matrix": insights.complaint_matrix(df),
        "complaint_by_star": insights.complaint_by_star(df),
        "defects": insights.defect_rates(df),
        "aspects": insights.aspect_keyword_sentiment(df),
        "suspicious": flagged,
        "suspicious_rate": insights.suspicious_rate(flagged),
        "rating_share": insights.rating_share(df),
        "monthly_volume": insights.monthly_volume(df),
    }
    if topic:
        out["topic_trend"] = topics.topic_trend(df, topic)
    return out
