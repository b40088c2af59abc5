"""Star and polarity labels, alert levels, histogram bins."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def sentiment_from_score(stars: Column) -> Column:
    """4 and above positive, 3 neutral, everything else negative (null included)."""
    return F.when(stars >= 4, "positive").when(stars == 3, "neutral").otherwise("negative")


def star_label(stars: Column, mode: str = "ternary") -> Column:
    """Binary drops 3 stars; ternary uses the bins (0,2], (2,3], (3,5]; null outside."""
    if mode == "binary":
        return F.when(stars == 3, None).when(stars >= 4, "positive").otherwise("negative")
    return (
        F.when((stars > 0) & (stars <= 2), "negative")
        .when((stars > 2) & (stars <= 3), "neutral")
        .when((stars > 3) & (stars <= 5), "positive")
    )


def compound_label(compound: Column, mode: str = "ternary") -> Column:
    """Inclusive rule: at least .05 positive, at most -.05 negative."""
    if mode == "binary":
        return F.when(compound >= 0.05, "positive").otherwise("negative")
    return F.when(compound >= 0.05, "positive").when(compound <= -0.05, "negative").otherwise("neutral")


def compound_label_bins(compound: Column) -> Column:
    """Right-closed bins (-1.01,-.05], (-.05,.05], (.05,1.01]; null outside."""
    return (
        F.when((compound > -1.01) & (compound <= -0.05), "negative")
        .when((compound > -0.05) & (compound <= 0.05), "neutral")
        .when((compound > 0.05) & (compound <= 1.01), "positive")
    )


def length_tier(n: Column) -> Column:
    """Right-closed word-count tiers; zero words has no tier."""
    return (
        F.when((n > 0) & (n <= 20), "very_short")
        .when((n > 20) & (n <= 75), "short")
        .when((n > 75) & (n <= 200), "medium")
        .when(n > 200, "long")
    )


def rating_bucket(stars: Column) -> Column:
    return F.when((stars > 0) & (stars <= 5), F.concat(F.ceil(stars).cast("string"), F.lit("star")))


def alert_level(rate: Column, warn: float = 5.0, critical: float = 10.0) -> Column:
    return F.when(rate > critical, "CRITICAL").when(rate > warn, "WARNING").otherwise("OK")


def sentiment_badge(pos_pct: Column, neg_pct: Column) -> Column:
    return (
        F.when(pos_pct > 60, "MOSTLY POSITIVE").when(neg_pct > 40, "MOSTLY NEGATIVE").otherwise("MIXED SENTIMENT")
    )


def histogram_bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """0-based equal-width bin; the upper edge falls in the last bin, outside is null."""
    width = (hi - lo) / bins
    raw = F.floor((x - F.lit(float(lo))) / F.lit(width)).cast("int")
    return F.when((x >= lo) & (x <= hi), F.least(raw, F.lit(bins - 1)))


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def quarter_key(ts: Column) -> Column:
    return F.concat(F.year(ts).cast("string"), F.lit("Q"), F.quarter(ts).cast("string"))
