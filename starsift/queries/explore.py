"""Queries for exploratory tables, window operators and set operations."""

from pyspark.sql import functions as F

from starsift.functions import labels
from starsift.functions import text as tx
from starsift.operators import explore, rollups, setops, windows
from starsift.operators.quantiles import quantile_values, quantiles
from starsift.queries.oracle import over, words
from starsift.queries.registry import query
from starsift.queries.rollups import MS
from starsift.sources import adapters as ad


def _reviews(s, d):
    return ad.reviews(s, d).withColumn("word_count", tx.word_count(F.col("review_text")))


def _docs(s, d):
    return ad.documents(s, d).withColumn("word_count", tx.word_count(F.col("text")))


R = f", r AS (SELECT *, len({words('review_text')}) AS word_count FROM reviews)"
D = f"WITH r AS (SELECT *, len({words('text')}) AS word_count FROM documents)"


@query(
    "overview",
    "E-18 M-06",
    over(
        "reviews",
        R + """ SELECT count(*) AS rows, count(DISTINCT product_id) AS products, count(DISTINCT user_id) AS reviewers,
              round(avg(star_rating), 6) AS avg_star, median(star_rating) AS median_star, round(avg(word_count), 6) AS avg_words,
              median(word_count) AS median_words FROM r""",
    ),
)
def overview(s, d):
    return explore.overview(_reviews(s, d))


_RAW_COLS = ["Id", "ProductId", "ProfileName", "Score", "Summary", "Text"]


@query(
    "missing_report",
    "E-19 M-06",
    over(
        "raw",
        ", m AS ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS missing, (count(*) - count("{c}")) * 100.0 / count(*) AS pct FROM raw"""
            for c in _RAW_COLS
        )
        + """) SELECT "column", missing, round(pct, 6) AS pct FROM m WHERE missing > 0""",
    ),
)
def missing_report(s, d):
    return explore.missing_report(ad.raw_reviews(s, d).select(*_RAW_COLS))


@query(
    "star_distribution",
    "E-20 G-06",
    over(
        "raw",
        """SELECT "Score" AS star_rating, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
           FROM raw WHERE "Score" IS NOT NULL GROUP BY 1""",
    ),
)
def star_distribution(s, d):
    return explore.star_distribution(ad.raw_reviews(s, d).withColumnRenamed("Score", "star_rating"))


def _hist_sql(cte: str, x: str, bins: int) -> str:
    return f"""{cte}, v AS (SELECT cast({x} AS double) AS x FROM r WHERE {x} IS NOT NULL),
    e AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
    h AS (SELECT least(cast(floor((x - lo) / ((hi - lo) / {bins})) AS int), {bins - 1}) AS bin, count(*) AS n FROM v, e GROUP BY 1)
    SELECT cast(b.range AS int) AS bin, round(lo + b.range * ((hi - lo) / {bins}), 6) AS low_edge, coalesce(n, 0) AS n
    FROM range(0, {bins}) b LEFT JOIN h ON h.bin = b.range, e"""


@query("word_count_histogram", "E-21", _hist_sql(D, "word_count", 40))
def word_count_histogram(s, d):
    return explore.histogram(s, _docs(s, d), "word_count", 40)


@query(
    "word_count_summary",
    "E-21",
    D + " SELECT round(avg(word_count), 6) AS mean, median(word_count) AS median FROM r",
)
def word_count_summary(s, d):
    docs = _docs(s, d)
    middle = quantile_values(docs, ["word_count"], [0.5])["word_count"][0]
    return docs.agg(F.avg("word_count").alias("mean"), F.lit(middle).cast("double").alias("median"))


_TENTHS = [i / 10 for i in range(11)]


@query(
    "measure_quantiles",
    "E-22 E-31 L-32",
    " UNION ALL ".join(
        f"""SELECT l_returnflag, '{c}' AS "column", unnest({_TENTHS}) AS p, unnest(list_transform(quantile_cont(cast({c} AS double), {_TENTHS}), lambda x: round(x, 6))) AS value
            FROM lineitem GROUP BY l_returnflag""" for c in ("l_extendedprice", "l_discount")
    ),
)
def measure_quantiles(s, d):
    """Deciles of unrounded measurements with many distinct values, by group."""
    return quantiles(ad.table(s, d, "lineitem"), ["l_extendedprice", "l_discount"], _TENTHS, "l_returnflag")


@query(
    "word_count_quartiles",
    "E-22",
    D + """ SELECT lang, round(quantile_cont(word_count, 0.25), 6) AS q1, round(quantile_cont(word_count, 0.5), 6) AS median,
            round(quantile_cont(word_count, 0.75), 6) AS q3 FROM r GROUP BY 1""",
)
def word_count_quartiles(s, d):
    return explore.quartiles_by(_docs(s, d), "lang", "word_count")


@query(
    "tier_share",
    "E-23 C-10",
    D + """, t AS (SELECT CASE WHEN word_count = 0 THEN NULL WHEN word_count <= 20 THEN 'very_short' WHEN word_count <= 75 THEN 'short'
                   WHEN word_count <= 200 THEN 'medium' ELSE 'long' END AS length_tier FROM r)
    SELECT length_tier, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM t
    WHERE length_tier IS NOT NULL GROUP BY 1""",
)
def tier_share(s, d):
    return explore.tier_share(_docs(s, d))


_BINS = "CASE WHEN compound <= -0.05 THEN 'negative' WHEN compound <= 0.05 THEN 'neutral' ELSE 'positive' END"


@query(
    "sentiment_distribution",
    "E-24",
    over("reviews", f"SELECT {_BINS} AS label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM reviews GROUP BY 1"),
)
def sentiment_distribution(s, d):
    return explore.sentiment_distribution(ad.reviews(s, d))


@query("compound_histogram", "E-24", over("reviews", _hist_sql(R, "compound", 40)))
def compound_histogram(s, d):
    return explore.histogram(s, ad.reviews(s, d), "compound", 40)


@query(
    "star_sentiment_fit",
    "E-25",
    over(
        "reviews",
        """SELECT round(regr_slope(compound, star_rating), 6) AS slope, round(regr_intercept(compound, star_rating), 6) AS intercept,
                  round(corr(star_rating, compound), 6) AS r FROM reviews""",
    ),
)
def star_sentiment_fit(s, d):
    return explore.star_sentiment_fit(ad.reviews(s, d))


@query(
    "monthly_trend",
    "E-26",
    over(
        "reviews",
        """SELECT month, count(*) AS review_count, round(avg(star_rating), 6) AS avg_rating, round(avg(compound), 6) AS avg_sentiment
           FROM reviews GROUP BY 1""",
    ),
)
def monthly_trend(s, d):
    return explore.monthly_trend(ad.reviews(s, d))


@query(
    "verified_report",
    "E-27",
    over(
        "reviews",
        """SELECT verified, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct,
                  round(avg(star_rating), 6) AS avg_star, round(quantile_cont(compound, 0.25), 6) AS q1,
                  round(median(compound), 6) AS median, round(quantile_cont(compound, 0.75), 6) AS q3 FROM reviews GROUP BY 1""",
    ),
)
def verified_report(s, d):
    return explore.verified_report(ad.reviews(s, d))


@query(
    "votes_by_label",
    "E-28",
    over("reviews", f"SELECT {_BINS} AS label, median(helpful_votes) AS median_votes FROM reviews GROUP BY 1"),
)
def votes_by_label(s, d):
    return explore.votes_by_label(ad.reviews(s, d))


@query("votes_histogram", "E-28", over("reviews", _hist_sql(", r AS (SELECT * FROM reviews WHERE helpful_votes > 0)", "helpful_votes", 30)))
def votes_histogram(s, d):
    return explore.votes_histogram(s, ad.reviews(s, d))


_NUM = ["star_rating", "word_count", "helpful_votes", "helpfulness_denominator", "compound", "predicted_helpfulness"]
_PAIRS = [(a, b) for i, a in enumerate(_NUM) for b in _NUM[i + 1:]]


@query(
    "corr_matrix",
    "E-29",
    over(
        "reviews",
        R + " " + " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM r" for a, b in _PAIRS),
    ),
)
def corr_matrix(s, d):
    return explore.corr_matrix(_reviews(s, d), _NUM)


@query(
    "top_correlations",
    "E-29",
    over(
        "reviews",
        R + ", c AS (" + " UNION ALL ".join(f"SELECT '{b}' AS feature, corr({a}, {b}) AS r FROM r" for a, b in _PAIRS if a == "star_rating")
        + ") SELECT feature, round(r, 6) AS r FROM c ORDER BY abs(r) DESC, feature LIMIT 3",
    ),
)
def top_correlations(s, d):
    return explore.top_correlations(explore.corr_matrix(_reviews(s, d), _NUM), "star_rating", 3)


@query(
    "product_comparison",
    "E-30 G-11",
    over(
        "reviews",
        R + """ SELECT product_id, count(*) AS review_count, round(avg(star_rating), 6) AS avg_rating,
              round(avg(compound), 6) AS avg_sentiment, round(avg(word_count), 6) AS avg_words
              FROM r GROUP BY 1 HAVING count(*) >= 2 ORDER BY review_count DESC, product_id LIMIT 8""",
    ),
)
def product_comparison(s, d):
    return explore.product_comparison(_reviews(s, d))


_OUT = ["word_count", "n_chars"]
_BOUNDS = ", ".join(
    f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c}, "
    f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}"
    for c in _OUT
)


@query(
    "iqr_outliers",
    "E-31 H-05",
    D + f""", q AS (SELECT {_BOUNDS} FROM r)
    SELECT doc_id, word_count, n_chars, (word_count < lo_word_count OR word_count > hi_word_count) AS word_count_outlier,
           (n_chars < lo_n_chars OR n_chars > hi_n_chars) AS n_chars_outlier FROM r, q
    WHERE word_count < lo_word_count OR word_count > hi_word_count OR n_chars < lo_n_chars OR n_chars > hi_n_chars""",
)
def iqr_outliers(s, d):
    return explore.iqr_outliers(_docs(s, d).select("doc_id", *_OUT), _OUT)


@query(
    "iqr_report",
    "E-31",
    D + f", q AS (SELECT {_BOUNDS} FROM r) " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < lo_{c} OR {c} > hi_{c}) AS outliers,
            any_value(lo_{c}) AS low, any_value(hi_{c}) AS high FROM r, q"""
        for c in _OUT
    ),
)
def iqr_report(s, d):
    return explore.iqr_report(_docs(s, d), _OUT)


@query(
    "reviewer_counts",
    "G-01",
    over(
        "reviews",
        """, c AS (SELECT user_id, count(review_text) AS n FROM reviews GROUP BY 1)
        SELECT review_id, n AS reviewer_review_count, cast(n >= 5 AS int) AS is_power_reviewer FROM reviews JOIN c USING (user_id)""",
    ),
)
def reviewer_counts(s, d):
    return windows.reviewer_counts(ad.reviews(s, d), "user_id").select(
        "review_id", "reviewer_review_count", "is_power_reviewer"
    )


@query(
    "product_stats",
    "G-02 D-04",
    over(
        "reviews",
        """, p AS (SELECT product_id, avg(star_rating) AS a, stddev_samp(star_rating) AS sd, count(star_rating) AS n FROM reviews GROUP BY 1)
        SELECT review_id, round(a, 6) AS product_avg_rating, round(sd, 6) AS product_rating_std, n AS product_review_count,
               round(abs(star_rating - a), 6) AS rating_deviation FROM reviews JOIN p USING (product_id)""",
    ),
)
def product_stats(s, d):
    return windows.product_stats(ad.reviews(s, d)).select(
        "review_id", "product_avg_rating", "product_rating_std", "product_review_count", "rating_deviation"
    )


@query(
    "top_reviews_per_product",
    "G-04 D-08",
    over(
        "reviews",
        """, k AS (SELECT review_id, product_id, cast(row_number() OVER (PARTITION BY product_id ORDER BY helpful_votes DESC, review_id)
                   AS int) AS rank FROM reviews)
        SELECT * FROM k WHERE rank <= 3""",
    ),
)
def top_reviews_per_product(s, d):
    r = ad.reviews(s, d).select("review_id", "product_id", "helpful_votes")
    return windows.top_n_by(r, ["product_id"], [F.desc("helpful_votes"), F.asc("review_id")], 3).drop("helpful_votes")


@query(
    "month_over_month",
    "G-05",
    over(
        "reviews",
        f""", {MS} SELECT product_id, month, total_reviews, lag(total_reviews) OVER w AS prev_total_reviews,
              total_reviews - lag(total_reviews) OVER w AS total_reviews_change
              FROM ms WINDOW w AS (PARTITION BY product_id ORDER BY month)""",
    ),
)
def month_over_month(s, d):
    ms = rollups.monthly_sentiment(ad.reviews(s, d)).select("product_id", "month", "total_reviews")
    return windows.with_lag(ms, ["product_id"], "month", "total_reviews")


@query(
    "running_volume",
    "G-07",
    over(
        "reviews",
        f""", {MS} SELECT product_id, month, total_reviews,
              cast(sum(total_reviews) OVER (PARTITION BY product_id ORDER BY month ROWS UNBOUNDED PRECEDING) AS bigint) AS running
              FROM ms""",
    ),
)
def running_volume(s, d):
    ms = rollups.monthly_sentiment(ad.reviews(s, d)).select("product_id", "month", "total_reviews")
    return windows.running_sum(ms, ["product_id"], [F.asc("month")], "total_reviews")


@query(
    "month_edges",
    "G-09",
    over(
        "reviews",
        """, m AS (SELECT DISTINCT month FROM reviews)
        SELECT month, cast(row_number() OVER (ORDER BY month) AS int) AS from_first,
               cast(row_number() OVER (ORDER BY month DESC) AS int) AS from_last FROM m""",
    ),
)
def month_edges(s, d):
    return windows.month_edges(ad.reviews(s, d))


@query(
    "top_products",
    "G-11",
    over("reviews", "SELECT product_id, count(*) AS n FROM reviews GROUP BY 1 ORDER BY n DESC, product_id LIMIT 50"),
)
def top_products(s, d):
    counted = ad.reviews(s, d).groupBy("product_id").agg(F.count("*").alias("n"))
    return windows.order_limit(counted, [F.desc("n"), F.asc("product_id")], 50)


@query(
    "sampled_rows",
    "G-13",
    over("reviews", "SELECT review_id, star_rating, round(compound, 6) AS compound FROM reviews ORDER BY md5(review_id || ':42'), review_id LIMIT 1000"),
)
def sampled_rows(s, d):
    return windows.sample_rows(ad.reviews(s, d).select("review_id", "star_rating", "compound"), 1000, "review_id")


@query(
    "union_of_chunks",
    "H-01",
    over("reviews", "SELECT topic_id, count(*) AS n FROM reviews GROUP BY 1"),
)
def union_of_chunks(s, d):
    r = ad.reviews(s, d)
    return setops.union_all([r.filter(F.col("topic_id") == k) for k in range(6)]).groupBy("topic_id").agg(
        F.count("*").alias("n")
    )


@query("distinct_products", "H-03", over("reviews", "SELECT DISTINCT product_id FROM reviews"))
def distinct_products(s, d):
    return setops.distinct_values(ad.reviews(s, d), "product_id")


_T = "list_distinct(string_split(lower(review_text), ' '))"


@query(
    "token_set_sizes",
    "H-04 H-02",
    over(
        "reviews",
        f"""SELECT review_id, len(list_intersect({_T}, ['the', 'battery', 'is', 'good'])) AS n_common,
                   len(list_distinct(list_concat({_T}, ['the', 'battery', 'is', 'good']))) AS n_union FROM reviews""",
    ),
)
def token_set_sizes(s, d):
    tokens = F.split(F.lower("review_text"), " ")
    base = F.array(*[F.lit(w) for w in ("the", "battery", "is", "good")])
    return setops.add_columns(ad.reviews(s, d).select("review_id", "review_text"), setops.set_sizes(tokens, base)).drop(
        "review_text"
    )


@query(
    "any_flag",
    "H-05",
    over("reviews", "SELECT review_id, (star_rating = 1 OR verified OR coalesce(predicted_helpfulness > 0.9, false)) AS flagged FROM reviews"),
)
def any_flag(s, d):
    flags = [F.col("star_rating") == 1, F.col("verified"), F.col("predicted_helpfulness") > 0.9]
    return ad.reviews(s, d).select("review_id", setops.any_flag(flags).alias("flagged"))
