"""Parsing of scraped label text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from starsift.functions import text as tx


def parse_stars(label: Column) -> Column:
    """First numeric token within 1..5 in a label such as "Rated 4.0 out of 5 stars"."""
    numbers = F.transform(tx.words(label), lambda t: t.try_cast("double"))
    return F.get(F.filter(numbers, lambda x: (x >= 1) & (x <= 5)), F.lit(0))


def parse_votes(label: Column) -> Column:
    """First integer token (thousands commas removed), default 0."""
    tokens = F.transform(tx.words(label), lambda t: F.replace(t, F.lit(","), F.lit("")))
    digits = F.get(F.filter(tokens, lambda t: t.rlike("^[0-9]+$")), F.lit(0))
    return F.coalesce(digits.try_cast("bigint"), F.lit(0))


def parse_review_date(label: Column) -> Column:
    """Date inside "Reviewed in India on 12 March 2024"; null when absent or invalid."""
    found = F.regexp_extract(label, r"(\d{1,2}\s\w+\s\d{4})", 1)
    return F.try_to_date(F.nullif(found, F.lit("")), "d MMMM yyyy")


def image_urls(urls: Column) -> Column:
    """Swap the thumbnail suffix for the large one, keep http(s) URLs."""
    large = F.transform(urls, lambda u: F.replace(u, F.lit("._SY88."), F.lit("._SL500_.")))
    return F.filter(large, lambda u: u.startswith("http"))
