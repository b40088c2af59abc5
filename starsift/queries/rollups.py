"""Queries for joins, summary tables and insight tables."""

from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.operators import insights, joins, rollups, windows
from starsift.queries.oracle import any_of, any_word, clean, over
from starsift.queries.registry import query
from starsift.sources import adapters as ad

COUNTS = """count(*) FILTER (WHERE star_rating >= 4) AS positive_count, count(*) FILTER (WHERE star_rating = 3) AS neutral_count,
            count(*) FILTER (WHERE star_rating <= 2) AS negative_count"""
PS = f"""ps AS (SELECT product_id, count(*) AS total_reviews, avg(star_rating) AS average_stars,
                 avg(coalesce(predicted_helpfulness, 0.5)) AS average_helpfulness, {COUNTS} FROM reviews GROUP BY 1)"""
MS = f"ms AS (SELECT month, product_id, count(*) AS total_reviews, {COUNTS} FROM reviews GROUP BY 1, 2)"
AS_ = """asum AS (SELECT product_id, aspect_term, count(*) FILTER (WHERE sentiment_label = 'positive') AS positive_count,
                 count(*) FILTER (WHERE sentiment_label = 'neutral') AS neutral_count,
                 count(*) FILTER (WHERE sentiment_label = 'negative') AS negative_count, avg(confidence) AS avg_confidence
          FROM reviews JOIN aspects USING (review_id) GROUP BY 1, 2)"""
CS = """cs AS (SELECT product_id, coalesce(name, 'General') AS topic_name, count(*) AS complaint_count,
               count(*) * (5.0 - avg(star_rating)) AS severity_score
        FROM reviews LEFT JOIN topics USING (topic_id) WHERE star_rating <= 2 GROUP BY 1, 2)"""


@query(
    "joined_aspects",
    "D-01",
    over(
        "reviews aspects",
        """SELECT review_id, product_id, aspect_term, sentiment_label, round(confidence, 6) AS confidence
           FROM reviews JOIN aspects USING (review_id)""",
    ),
)
def joined_aspects(s, d):
    r = ad.reviews(s, d).select("review_id", "product_id")
    return joins.reviews_with_aspects(r, ad.aspects(s, d))


@query(
    "joined_topics",
    "D-02",
    over("reviews topics", "SELECT review_id, topic_id, coalesce(name, 'General') AS topic_name FROM reviews LEFT JOIN topics USING (topic_id)"),
)
def joined_topics(s, d):
    return joins.join_topics(ad.reviews(s, d).select("review_id", "topic_id"), ad.topics(s))


@query(
    "first_aspect_newest",
    "D-03",
    over(
        "reviews aspects",
        """, n AS (SELECT review_id, review_time FROM reviews ORDER BY review_time DESC, review_id LIMIT 20000)
        SELECT n.review_id, min(aspect_term) AS aspect FROM n LEFT JOIN aspects USING (review_id) GROUP BY 1""",
    ),
)
def first_aspect_newest(s, d):
    r = ad.reviews(s, d).select("review_id", "review_time")
    return joins.reviews_with_first_aspect(r, ad.aspects(s, d), 20000).drop("review_time")


@query(
    "semi_filtered",
    "D-05",
    over(
        "reviews",
        """SELECT review_id FROM reviews WHERE user_id IN
             (SELECT user_id FROM reviews GROUP BY user_id HAVING count(*) > 10)""",
    ),
)
def semi_filtered(s, d):
    r = ad.reviews(s, d).select("review_id", "user_id")
    busy = r.groupBy("user_id").agg(F.count("*").alias("n")).filter(F.col("n") > 10)
    return joins.semi_filter(r, busy, ["user_id"]).select("review_id")


@query(
    "mapped_labels",
    "D-07",
    over(
        "reviews",
        """SELECT review_id, CASE topic_id WHEN 0 THEN 'power' WHEN 1 THEN 'photo' WHEN 2 THEN 'build' WHEN 3 THEN 'value'
                  WHEN 4 THEN 'software' ELSE cast(topic_id AS varchar) END AS label FROM reviews""",
    ),
)
def mapped_labels(s, d):
    names = dict(enumerate(ad.TOPIC_NAMES))
    return ad.reviews(s, d).select("review_id", joins.map_labels(F.col("topic_id"), names).alias("label"))


@query(
    "attached_scalars",
    "D-08",
    over(
        "reviews",
        """SELECT review_id, round(star_rating - (SELECT avg(star_rating) FROM reviews), 6) AS above_mean,
                  (SELECT max(review_time) FROM reviews) AS newest FROM reviews""",
    ),
)
def attached_scalars(s, d):
    r = ad.reviews(s, d).select("review_id", "star_rating", "review_time")
    out = joins.attach_scalars(r, {"mean_star": F.avg("star_rating"), "newest": F.max("review_time")})
    return out.select("review_id", (F.col("star_rating") - F.col("mean_star")).alias("above_mean"), "newest")


@query(
    "product_summary",
    "E-01 M-08",
    over(
        "reviews",
        f""", {PS} SELECT product_id, total_reviews, round(average_stars, 6) AS average_stars,
              round(average_helpfulness, 6) AS average_helpfulness, positive_count, neutral_count, negative_count FROM ps""",
    ),
)
def product_summary(s, d):
    return rollups.product_summary(ad.reviews(s, d))


@query("monthly_sentiment", "E-02 M-08", over("reviews", f", {MS} SELECT * FROM ms"))
def monthly_sentiment(s, d):
    return rollups.monthly_sentiment(ad.reviews(s, d))


@query(
    "monthly_sentiment_subtotals",
    "E-02",
    over("reviews", f"SELECT month, product_id, count(*) AS total_reviews, {COUNTS} FROM reviews GROUP BY ROLLUP (month, product_id)"),
)
def monthly_sentiment_subtotals(s, d):
    return rollups.monthly_sentiment_rollup(ad.reviews(s, d))


@query(
    "aspect_summary",
    "E-03 D-01 M-08",
    over("reviews aspects", f", {AS_} SELECT * REPLACE (round(avg_confidence, 6) AS avg_confidence) FROM asum"),
)
def aspect_summary(s, d):
    return rollups.aspect_summary(ad.reviews(s, d), ad.aspects(s, d))


@query(
    "complaint_summary",
    "E-04 D-02 M-08",
    over("reviews topics", f", {CS} SELECT * REPLACE (round(severity_score, 6) AS severity_score) FROM cs"),
)
def complaint_summary(s, d):
    return rollups.complaint_summary(ad.reviews(s, d), ad.topics(s))


@query(
    "complaint_scores",
    "E-05 G-06",
    over(
        "reviews topics",
        f""", {CS}, g AS (SELECT topic_name AS complaint, cast(sum(complaint_count) AS bigint) AS count,
                          sum(severity_score) AS severity FROM cs GROUP BY 1)
        SELECT complaint, count, round(severity, 6) AS severity, round(count * 100.0 / (SELECT sum(count) FROM g), 6) AS pct FROM g""",
    ),
)
def complaint_scores(s, d):
    return rollups.complaint_scores(rollups.complaint_summary(ad.reviews(s, d), ad.topics(s)))


def _complaint_sql() -> str:
    parts = []
    for name, keys in fv.COMPLAINT_KEYWORDS.items():
        hit = any_of("low", keys)
        parts.append(
            f"""SELECT '{name}' AS complaint, count(*) FILTER (WHERE {hit} AND star_rating <= 3) AS n,
                avg(star_rating) FILTER (WHERE {hit} AND star_rating <= 3) AS a,
                count(*) FILTER (WHERE star_rating <= 3) AS neg, count(*) AS total, {fv.SEVERITY_WEIGHTS[name]} AS w FROM t"""
        )
    return (
        ", t AS (SELECT lower(review_text) AS low, star_rating FROM reviews), c AS ("
        + " UNION ALL ".join(parts)
        + """) SELECT complaint, n AS mention_count, round(n * 100.0 / greatest(neg, 1), 6) AS pct_neg_reviews,
              round(n * 100.0 / greatest(total, 1), 6) AS pct_all_reviews, round(a, 6) AS avg_star_rating,
              cast(w AS double) AS severity_weight, round(n * w * (4 - a), 6) AS severity_score FROM c WHERE n > 0"""
    )


@query("complaint_taxonomy", "E-06 M-09", over("reviews", _complaint_sql()))
def complaint_taxonomy(s, d):
    return insights.analyse_complaints(ad.text_reviews(s, d))


DEFECT = any_of("lower(review_text)", fv.DEFECT_KEYWORDS)
DEFECTS_SQL = f""", g AS (SELECT product_id, month, count(*) AS total_reviews, count(*) FILTER (WHERE {DEFECT}) AS defect_mentions
                          FROM reviews GROUP BY 1, 2),
  r AS (SELECT *, defect_mentions * 100.0 / total_reviews AS rate FROM g),
  defects AS (SELECT product_id, month, total_reviews, defect_mentions, round(rate, 6) AS defect_rate_pct,
       CASE WHEN rate > 10 THEN 'CRITICAL' WHEN rate > 5 THEN 'WARNING' ELSE 'OK' END AS alert FROM r)"""


@query("defect_rates", "E-07 M-09", over("reviews", DEFECTS_SQL + " SELECT * FROM defects"))
def defect_rates(s, d):
    return insights.defect_rates(ad.text_reviews(s, d))


@query(
    "worst_defect",
    "G-12 E-07",
    over("reviews", DEFECTS_SQL + " SELECT * FROM defects WHERE alert = 'CRITICAL' ORDER BY defect_rate_pct DESC, product_id, month LIMIT 1"),
)
def worst_defect(s, d):
    return windows.worst_row(
        insights.defect_rates(ad.text_reviews(s, d)),
        F.col("alert") == "CRITICAL",
        [F.desc(F.round("defect_rate_pct", 6)), F.asc("product_id"), F.asc("month")],
    )


def _aspect_sql() -> str:
    pos, neg = any_of("low", fv.ASPECT_POSITIVE), any_of("low", fv.ASPECT_NEGATIVE)
    parts = [
        f"""SELECT '{name}' AS aspect, count(*) FILTER (WHERE {any_word('low', keys)}) AS m,
            count(*) FILTER (WHERE {any_word('low', keys)} AND pos) AS p, count(*) FILTER (WHERE {any_word('low', keys)} AND neg) AS n,
            count(*) AS total FROM t"""
        for name, keys in fv.ASPECT_KEYWORDS.items()
    ]
    return (
        f", l AS (SELECT lower(review_text) AS low FROM reviews), t AS (SELECT low, {pos} AS pos, {neg} AS neg FROM l), c AS ("
        + " UNION ALL ".join(parts)
        + """) SELECT aspect, m AS mentions, round(m * 100.0 / total, 6) AS mention_pct, p AS positive, n AS negative,
              m - p - n AS neutral, round(p * 100.0 / m, 6) AS pos_pct, round(n * 100.0 / m, 6) AS neg_pct,
              round((p - n) / m, 6) AS net_sentiment FROM c WHERE m > 0"""
    )


@query("aspect_keyword_sentiment", "E-08 M-09", over("reviews", _aspect_sql()))
def aspect_keyword_sentiment(s, d):
    return insights.aspect_keyword_sentiment(ad.text_reviews(s, d))


@query(
    "worst_aspect",
    "G-12",
    over("reviews", f", a AS (WITH {_aspect_sql().lstrip(', ')}) SELECT aspect, mentions FROM a WHERE net_sentiment < 0 ORDER BY mentions DESC, aspect LIMIT 1"),
)
def worst_aspect(s, d):
    return windows.worst_row(
        insights.aspect_keyword_sentiment(ad.text_reviews(s, d)),
        F.col("net_sentiment") < 0,
        [F.desc("mentions"), F.asc("aspect")],
    ).select("aspect", "mentions")


@query(
    "kpis",
    "E-09 E-10 M-09",
    over(
        "reviews",
        """, m AS (SELECT max(review_time) - INTERVAL 30 DAY AS cut FROM reviews),
        v AS (SELECT count(*) FILTER (WHERE review_time >= cut) AS recent,
                     count(*) FILTER (WHERE review_time >= cut - INTERVAL 30 DAY AND review_time < cut) AS prior FROM reviews, m)
        SELECT count(*) AS total_reviews, round(avg(star_rating), 6) AS avg_star_rating,
               round(count(*) FILTER (WHERE star_rating >= 4) * 100.0 / count(*), 6) AS pct_positive,
               round(count(*) FILTER (WHERE star_rating <= 2) * 100.0 / count(*), 6) AS pct_negative,
               round((count(*) FILTER (WHERE star_rating = 5) - count(*) FILTER (WHERE star_rating = 1)) * 100.0 / count(*), 6)
                 AS nps_proxy,
               round(count(*) FILTER (WHERE verified) * 100.0 / count(*), 6) AS verified_pct,
               round(avg(helpful_votes), 6) AS avg_helpful_votes,
               (SELECT round((recent - prior) * 100.0 / greatest(prior, 1), 6) FROM v) AS review_velocity_chg,
               count(DISTINCT product_id) AS products_analysed FROM reviews""",
    ),
)
def kpis(s, d):
    return insights.kpis(ad.reviews(s, d))


@query(
    "review_velocity",
    "E-10 G-10",
    over(
        "reviews",
        """, m AS (SELECT max(review_time) - INTERVAL 30 DAY AS cut FROM reviews),
        v AS (SELECT count(*) FILTER (WHERE review_time >= cut) AS recent,
                     count(*) FILTER (WHERE review_time >= cut - INTERVAL 30 DAY AND review_time < cut) AS prior FROM reviews, m)
        SELECT recent, prior, round((recent - prior) * 100.0 / greatest(prior, 1), 6) AS change_pct FROM v""",
    ),
)
def review_velocity(s, d):
    return windows.two_windows(ad.reviews(s, d), "review_time", 30)


@query(
    "kpis_from_summary",
    "E-11",
    over(
        "reviews",
        f""", {PS} SELECT cast(sum(total_reviews) AS bigint) AS total_reviews,
              round(sum(average_stars * total_reviews) / sum(total_reviews), 6) AS avg_star,
              round(sum(positive_count) * 100.0 / sum(total_reviews), 6) AS pct_positive,
              round(sum(neutral_count) * 100.0 / sum(total_reviews), 6) AS pct_neutral,
              round(sum(negative_count) * 100.0 / sum(total_reviews), 6) AS pct_negative FROM ps""",
    ),
)
def kpis_from_summary(s, d):
    return rollups.kpis_from_summary(rollups.product_summary(ad.reviews(s, d)))


@query(
    "month_delta",
    "E-12 G-05",
    over(
        "reviews",
        f""", {MS}, g AS (SELECT month, sum(positive_count) * 100.0 / sum(total_reviews) AS p FROM ms GROUP BY 1),
        l AS (SELECT month, p, lag(p) OVER (ORDER BY month) AS q FROM g)
        SELECT round(p, 6) AS recent_pos_pct, round(q, 6) AS prior_pos_pct, round(p - q, 6) AS change,
               CASE WHEN p > q THEN 'up' WHEN p < q THEN 'down' ELSE 'flat' END AS direction
        FROM l ORDER BY month DESC LIMIT 1""",
    ),
)
def month_delta(s, d):
    return rollups.month_delta(rollups.monthly_sentiment(ad.reviews(s, d)))


@query(
    "sentiment_long",
    "E-13",
    over(
        "reviews",
        f""", {MS} SELECT month, 'positive' AS sentiment, cast(sum(positive_count) AS bigint) AS count FROM ms GROUP BY 1
        UNION ALL SELECT month, 'neutral', cast(sum(neutral_count) AS bigint) FROM ms GROUP BY 1
        UNION ALL SELECT month, 'negative', cast(sum(negative_count) AS bigint) FROM ms GROUP BY 1""",
    ),
)
def sentiment_long(s, d):
    return rollups.sentiment_long(rollups.monthly_sentiment(ad.reviews(s, d)))


@query(
    "rating_heatmap",
    "E-14 G-09",
    over(
        "reviews",
        f""", {MS} SELECT product_id, month,
               round((positive_count * 4.5 + neutral_count * 3.0 + negative_count * 1.5) / greatest(total_reviews, 1), 6) AS est_rating
        FROM ms WHERE month IS NOT NULL""",
    ),
)
def rating_heatmap(s, d):
    return rollups.rating_heatmap(rollups.monthly_sentiment(ad.reviews(s, d)))


@query(
    "aspect_diverging",
    "E-15 G-11",
    over(
        "reviews aspects",
        f""", {AS_}, g AS (SELECT aspect_term, sum(positive_count) AS p, sum(neutral_count) AS u, sum(negative_count) AS n
                           FROM asum GROUP BY 1)
        SELECT upper(left(aspect_term, 1)) || substr(aspect_term, 2) AS aspect, cast(p + u + n AS bigint) AS mentions,
               round(p * 100.0 / (p + u + n), 6) AS pos_pct, round(n * 100.0 / (p + u + n), 6) AS neg_pct,
               round((p - n) / (p + u + n), 6) AS net FROM g""",
    ),
)
def aspect_diverging(s, d):
    return rollups.aspect_diverging(rollups.aspect_summary(ad.reviews(s, d), ad.aspects(s, d)))


@query(
    "star_histogram",
    "E-16",
    over(
        "reviews",
        """, c AS (SELECT star_rating, count(*) AS n FROM reviews WHERE product_id = 'P014' GROUP BY 1)
        SELECT cast(r.range AS int) AS star_rating, coalesce(n, 0) AS n FROM range(1, 6) r LEFT JOIN c ON c.star_rating = r.range""",
    ),
)
def star_histogram(s, d):
    return rollups.star_histogram(s, ad.reviews(s, d), "P014")


@query(
    "sentiment_badge",
    "E-17",
    over(
        "reviews",
        f""", {PS}, b AS (SELECT product_id, total_reviews, positive_count * 100.0 / total_reviews AS p,
                          negative_count * 100.0 / total_reviews AS n FROM ps)
        SELECT product_id, total_reviews, round(p, 6) AS pos_pct, round(n, 6) AS neg_pct,
               CASE WHEN p > 60 THEN 'MOSTLY POSITIVE' WHEN n > 40 THEN 'MOSTLY NEGATIVE' ELSE 'MIXED SENTIMENT' END AS badge FROM b""",
    ),
)
def sentiment_badge(s, d):
    return rollups.sentiment_badge(rollups.product_summary(ad.reviews(s, d)))


@query(
    "rating_share",
    "E-32 G-06",
    over(
        "reviews",
        """SELECT product_id, star_rating, count(*) AS n,
                  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY product_id), 6) AS pct FROM reviews GROUP BY 1, 2""",
    ),
)
def rating_share(s, d):
    return insights.rating_share(ad.reviews(s, d))


@query(
    "monthly_volume",
    "E-33 O-04",
    over(
        "reviews",
        """SELECT month, count(review_text) AS total, count(*) FILTER (WHERE star_rating >= 4) AS pos,
                  count(*) FILTER (WHERE star_rating <= 2) AS neg FROM reviews GROUP BY 1""",
    ),
)
def monthly_volume(s, d):
    return insights.monthly_volume(ad.reviews(s, d))


@query(
    "complaint_matrix",
    "E-34",
    over(
        "reviews",
        ", t AS (SELECT product_id, lower(review_text) AS low FROM reviews WHERE star_rating <= 3) "
        + " UNION ALL ".join(
            f"SELECT product_id, '{n}' AS complaint, round(count(*) FILTER (WHERE {any_of('low', k)}) * 100.0 / count(*), 6) AS pct "
            "FROM t GROUP BY 1"
            for n, k in fv.COMPLAINT_KEYWORDS.items()
        ),
    ),
)
def complaint_matrix(s, d):
    return insights.complaint_matrix(ad.text_reviews(s, d))


@query(
    "complaint_by_star",
    "E-35",
    over(
        "reviews",
        ", t AS (SELECT star_rating, lower(review_text) AS low FROM reviews) "
        + " UNION ALL ".join(
            f"SELECT '{n}' AS complaint, "
            + ", ".join(
                f"round(coalesce(count(*) FILTER (WHERE {any_of('low', k)} AND star_rating = {i}) * 100.0 / "
                f"nullif(count(*) FILTER (WHERE star_rating = {i}), 0), 0), 6) AS pct_{i}star"
                for i in (1, 2, 3)
            )
            + " FROM t"
            for n, k in fv.COMPLAINT_KEYWORDS.items()
        ),
    ),
)
def complaint_by_star(s, d):
    return insights.complaint_by_star(ad.text_reviews(s, d))


_TOP = any_of("lower(review_text)", fv.COMPLAINT_KEYWORDS["Defective Unit"])


@query(
    "complaint_trend",
    "E-36",
    over(
        "reviews",
        f"""SELECT month, count(*) AS total, count(*) FILTER (WHERE {_TOP}) AS complaint,
                   round(count(*) FILTER (WHERE {_TOP}) * 100.0 / count(*), 6) AS rate FROM reviews GROUP BY 1""",
    ),
)
def complaint_trend(s, d):
    return insights.complaint_trend(ad.text_reviews(s, d), "Defective Unit")


BATCH = """, s AS (SELECT CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS name
                   FROM reviews),
  a AS (SELECT CASE sentiment_label WHEN 'positive' THEN 'praise' ELSE 'complaint' END AS kind,
               upper(left(aspect_term, 1)) || substr(aspect_term, 2) AS name, count(*) AS n
        FROM aspects WHERE sentiment_label <> 'neutral' GROUP BY 1, 2),
  k AS (SELECT *, cast(row_number() OVER (PARTITION BY kind ORDER BY n DESC, name) AS int) AS rank FROM a),
  batch AS (SELECT 'sentiment' AS kind, name, count(*) AS n, 0 AS rank FROM s GROUP BY 2
            UNION ALL SELECT * FROM k WHERE rank <= 5)"""


def _batch(s, d):
    from starsift.functions import labels

    annotated = ad.reviews(s, d).withColumn("overall_sentiment", labels.compound_label(F.col("compound")))
    return insights.batch_insights(annotated, ad.aspects(s, d))


@query("batch_insights", "E-37 G-04", over("reviews aspects", BATCH + " SELECT * FROM batch"))
def batch_insights(s, d):
    return _batch(s, d)


@query(
    "recommendations",
    "E-38",
    over(
        "reviews aspects",
        BATCH
        + """ SELECT CASE kind WHEN 'complaint' THEN 1 ELSE 2 END AS part, rank,
              CASE kind WHEN 'complaint' THEN 'Improve ' || lower(name) || ' quality. It is a recurring pain point mentioned in '
                        || n || ' negative customer reviews.'
                   ELSE 'Highlight ' || lower(name) || ' performance in marketing campaigns, as it is praised in ' || n
                        || ' positive reviews.' END AS recommendation
              FROM batch WHERE kind <> 'sentiment' AND rank <= 2""",
    ),
)
def recommendations(s, d):
    return insights.recommendations(_batch(s, d))


@query(
    "brand_sentiment",
    "E-39",
    over(
        "reviews",
        """, b AS (SELECT 'Sony' AS brand, compound FROM reviews WHERE contains(review_text, 'Sony')
                   UNION ALL SELECT 'Bose', compound FROM reviews WHERE contains(review_text, 'Bose')
                   UNION ALL SELECT p_brand, p_retailprice / 1000 FROM part)
        SELECT brand, round(avg(compound), 6) AS avg_sentiment, count(*) AS review_count, round(stddev_samp(compound), 6) AS sentiment_std
        FROM b GROUP BY 1""",
    ),
)
def brand_sentiment(s, d):
    found = F.array_compact(
        F.array(*[F.when(F.contains("review_text", F.lit(b)), F.lit(b)) for b in ("Sony", "Bose")])
    )
    r = ad.reviews(s, d).select(F.array_join(found, " | ").alias("brands"), "compound")
    p = ad.table(s, d, "part").select(F.col("p_brand").alias("brands"), (F.col("p_retailprice") / 1000).alias("compound"))
    return insights.brand_sentiment(r.unionByName(p))


@query(
    "ingest_stats",
    "E-42",
    over(
        "raw",
        """, c AS (SELECT "ProductId" AS p, "UserId" AS u, {text} AS t FROM raw
                   WHERE "ProductId" IS NOT NULL AND "Score" IS NOT NULL AND "Summary" IS NOT NULL AND "Text" IS NOT NULL),
        k AS (SELECT * FROM c WHERE trim(t) <> '' AND len(regexp_extract_all(t, '[a-zA-Z\\s.,!?''"-]')) / length(t) >= 0.8)
        SELECT (SELECT count(*) FROM raw) AS rows_read, count(*) AS rows_clean,
               count(DISTINCT p || chr(1) || u || chr(1) || t) AS rows_kept,
               count(*) - count(DISTINCT p || chr(1) || u || chr(1) || t) AS duplicates_removed FROM k""",
    ).replace("{text}", "CASE WHEN {s} = '' THEN {t} WHEN right({s}, 1) IN ('.', '!', '?') THEN concat({s}, ' ', {t}) "
              "ELSE concat({s}, '. ', {t}) END").replace("{s}", clean('"Summary"'))
    .replace("{t}", clean('"Text"')),
)
def ingest_stats(s, d):
    from starsift.operators import cleaning

    return cleaning.ingest_stats(ad.raw_reviews(s, d))
