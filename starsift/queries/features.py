"""Queries for scalar feature columns."""

from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import features as ft
from starsift.functions import labels
from starsift.functions import readability as rd
from starsift.functions import text as tx
from starsift.operators import features as op
from starsift.queries.oracle import NSP, SP, any_of, over, sql_in, sql_list, words
from starsift.queries.registry import query
from starsift.sources import adapters as ad


def _docs(s, d):
    return ad.documents(s, d)


W = words("text")
SENTENCES = (
    f"[x FOR x IN [regexp_replace(y, '^{SP}+|{SP}+$', '', 'g') FOR y IN "
    f"string_split(regexp_replace(text, '([.!?]+){SP}+', '\\1' || chr(1), 'g'), chr(1))] IF x <> '']"
)
PIECES = f"[x FOR x IN regexp_split_to_array(text, '[.!?]+') IF regexp_replace(x, '{SP}+', '', 'g') <> '']"
CAPS = f"len([w FOR w IN {W} IF w = upper(w) AND w <> lower(w) AND length(w) > 1])"


@query(
    "basic_text_features",
    "C-01 C-02 C-04 C-05 C-06 C-07 C-08 C-09 C-10",
    f"""WITH b AS (
      SELECT doc_id, text, length(text) AS char_count, len({W}) AS word_count, len({SENTENCES}) AS sentence_count,
             coalesce(list_avg([length(w) FOR w IN {W}]), 0) AS avg_word_length,
             length(text) - length(replace(text, '!', '')) AS exclamation_count,
             length(text) - length(replace(text, '?', '')) AS question_count, {CAPS} AS caps_word_count,
             cast(regexp_matches(text, '\\p{{Nd}}') AS int) AS has_number,
             cast(regexp_matches(text, '(?i)₹|\\$|rs\\.|price|cost') AS int) AS has_price
      FROM documents)
    SELECT doc_id, char_count, word_count, sentence_count, round(avg_word_length, 6) AS avg_word_length, exclamation_count,
           question_count, caps_word_count, has_number, has_price,
           round(CASE WHEN sentence_count > 0 THEN word_count / sentence_count ELSE 0 END, 6) AS avg_sentence_length,
           round(caps_word_count / (word_count + 1), 6) AS caps_ratio,
           CASE WHEN word_count = 0 THEN NULL WHEN word_count <= 20 THEN 'very_short' WHEN word_count <= 75 THEN 'short'
                WHEN word_count <= 200 THEN 'medium' ELSE 'long' END AS length_tier
    FROM b""",
)
def basic_text_features(s, d):
    return op.basic_text_features(_docs(s, d), "text").drop("text", "lang", "source", "n_chars", "number_count")


@query(
    "number_count",
    "C-08",
    over("numbered", """SELECT review_id, len(regexp_extract_all(review_text, '\\b[0-9]+\\b')) AS number_count FROM numbered"""
         .replace("reviews)", "reviews)")),
)
def number_count(s, d):
    return ad.numbered_reviews(s, d).select("review_id", ft.number_count(F.col("review_text")).alias("number_count"))


@query("sentence_pieces", "C-03", f"SELECT doc_id, len({PIECES}) AS pieces FROM documents")
def sentence_pieces(s, d):
    return _docs(s, d).select("doc_id", F.size(tx.sentence_pieces(F.col("text"))).alias("pieces"))


@query("sentence_rows", "C-02 O-03", f"SELECT doc_id, unnest({SENTENCES}) AS sentence FROM documents")
def sentence_rows(s, d):
    return _docs(s, d).select("doc_id", F.explode(tx.sentences(F.col("text"))).alias("sentence"))


@query(
    "review_flags",
    "C-11",
    over(
        "scraped",
        f"""SELECT row_id, len({words('review_text')}) > 100 AS is_long_review, cast(helpful_votes AS int) >= 10 AS is_highly_helpful,
                   image_urls <> '' AS has_images,
                   CASE WHEN image_urls = '' THEN 0 ELSE len(string_split(image_urls, '|')) END AS image_count FROM scraped""",
    ),
)
def review_flags(s, d):
    return op.review_flags(ad.scraped_reviews(s, d)).select(
        "row_id", "is_long_review", "is_highly_helpful", "has_images", "image_count"
    )


@query(
    "rating_features",
    "C-12 C-13 C-14 D-08",
    over(
        "raw",
        """, m AS (SELECT avg("Score") AS mean, stddev_samp("Score") AS std FROM raw)
        SELECT "Id", concat("Score", 'star') AS rating_bucket, cast(coalesce("Score" >= 4, false) AS int) AS is_positive_review,
               cast(coalesce("Score" = 1, false) AS int) AS rating_1star, cast(coalesce("Score" = 2, false) AS int) AS rating_2star,
               cast(coalesce("Score" = 3, false) AS int) AS rating_3star, cast(coalesce("Score" = 4, false) AS int) AS rating_4star,
               cast(coalesce("Score" = 5, false) AS int) AS rating_5star,
               round(("Score" - mean) / (std + 1e-9), 6) AS star_rating_zscore
        FROM raw, m""".replace("concat(\"Score\", 'star')", "\"Score\" || 'star'"),
    ),
)
def rating_features(s, d):
    r = ad.raw_reviews(s, d).select("Id", F.col("Score").alias("star_rating"))
    return op.rating_features(r).drop("star_rating")


@query(
    "vote_features",
    "C-15 C-16 C-17",
    over(
        "scraped",
        """SELECT row_id, cast(verified AS int) AS is_verified, cast(helpful_votes AS double) AS helpful_votes,
                  round(ln(1 + cast(helpful_votes AS double)), 6) AS log_helpful_votes,
                  cast(cast(helpful_votes AS int) >= 5 AS int) AS is_helpful, cast(image_urls <> '' AS int) AS has_images,
                  round(ln(1 + CASE WHEN image_urls = '' THEN 0 ELSE len(string_split(image_urls, '|')) END), 6) AS log_img_count,
                  year(t) AS review_year, month(t) AS review_month, (dayofweek(t) + 6) % 7 AS review_dow,
                  cast(dayofweek(t) IN (0, 6) AS int) AS is_weekend
           FROM (SELECT *, CASE WHEN review_date <> 'unknown' THEN order_ts END AS t FROM scraped)""",
    ),
)
def vote_features(s, d):
    from starsift.functions import parsing

    flagged = op.review_flags(ad.scraped_reviews(s, d)).withColumn("t", parsing.parse_review_date(F.col("review_date")))
    out = op.metadata_features(
        flagged.select("row_id", "verified", "helpful_votes", "image_count", "t"), "t"
    )
    return out.drop("verified", "image_count", "t")


_TOK = "list_distinct(string_split(lower(regexp_replace(review_text, '[^A-Za-z0-9 ]', ' ', 'g')), ' '))"


@query(
    "lexicon_features",
    "C-18 C-19 H-04",
    over(
        "reviews",
        f""", t AS (SELECT review_id, len({words('review_text')}) AS wc,
                 len([x FOR x IN {_TOK} IF x IN {sql_in(fv.POSITIVE_WORDS)}]) AS p,
                 len([x FOR x IN {_TOK} IF x IN {sql_in(fv.NEGATIVE_WORDS)}]) AS n,
                 len([x FOR x IN {_TOK} IF x IN {sql_in(fv.FEATURE_WORDS)}]) AS f FROM reviews)
        SELECT review_id, p AS positive_word_count, n AS negative_word_count, f AS feature_word_count,
               round(p / (wc + 1), 6) AS positive_word_ratio, round(n / (wc + 1), 6) AS negative_word_ratio,
               p - n AS lexicon_net_score FROM t""",
    ),
)
def lexicon_features(s, d):
    tokens = tx.words(F.lower(F.regexp_replace("review_text", "[^A-Za-z0-9 ]", " ")))
    return op.lexicon_features(ad.text_reviews(s, d), tokens, tx.word_count(F.col("review_text"))).select(
        "review_id", "positive_word_count", "negative_word_count", "feature_word_count", "positive_word_ratio",
        "negative_word_ratio", "lexicon_net_score",
    )


_SYL = (
    "[CASE WHEN w = '' THEN 0 WHEN w IN " + sql_in(list(fv.SYLLABLE_EXCEPTIONS)) + " THEN 1 ELSE "
    "greatest(len(regexp_extract_all(w, '[aeiouy]+')) - CASE WHEN ends_with(w, 'e') AND NOT regexp_matches(w, '[^aeiouy]le$') "
    "AND len(regexp_extract_all(w, '[aeiouy]+')) > 1 THEN 1 ELSE 0 END, 1) END "
    f"FOR w IN [regexp_replace(lower(v), '[^{fv.WORD}]', '', 'g') FOR v IN {W}]]"
)


@query(
    "readability",
    "C-20 C-21 C-22",
    f"""WITH b AS (SELECT doc_id, length(text) AS cc, len({W}) AS w, greatest(len({PIECES}), 1) AS s,
                          coalesce(list_sum({_SYL}), 0) AS y FROM documents),
    r AS (SELECT *, CASE WHEN w > 0 THEN least(greatest(206.835 - 1.015 * w / s - 84.6 * y / w, 0), 100) ELSE 0 END AS ease,
                 CASE WHEN w > 0 THEN greatest(0.39 * w / s + 11.8 * y / w - 15.59, 0) ELSE 0 END AS grade FROM b)
    SELECT doc_id, w AS word_count, CASE WHEN w > 0 THEN s ELSE 0 END AS sentence_count, cast(y AS bigint) AS syllable_count,
           CASE WHEN w > 0 THEN cc ELSE 0 END AS char_count,
           cast(round(cast(ease AS decimal(18,6)), 2) AS double) AS flesch_reading_ease,
           cast(round(cast(grade AS decimal(18,6)), 2) AS double) AS flesch_kincaid_grade FROM r""",
)
def readability(s, d):
    return op.readability(_docs(s, d).select("doc_id", "text"), "text").drop("text")


@query(
    "linguistic_features",
    "C-23",
    f"""SELECT doc_id, len({W}) AS ling_word_count, len(regexp_split_to_array(text, '[.!?]+')) AS ling_sentence_count,
               round(coalesce(list_avg([length(w) FOR w IN {W}]), 0), 6) AS ling_avg_word_len, length(text) AS ling_char_count,
               round(len(list_distinct([lower(w) FOR w IN {W}])) / greatest(len({W}), 1), 6) AS ling_vocab_richness,
               length(text) - length(replace(text, '!', '')) AS ling_exclamation_count,
               length(text) - length(replace(text, '?', '')) AS ling_question_count, {CAPS} AS ling_caps_word_count,
               cast(regexp_matches(text, '\\p{{Nd}}') AS int) AS ling_has_numbers,
               cast(regexp_matches(lower(text), '\\b(vs|compared|versus|better|worse)\\b') AS int) AS ling_has_comparison,
               cast(regexp_matches(lower(text), '\\b(however|but|although|despite|downside)\\b') AS int) AS ling_has_concession
        FROM documents""",
)
def linguistic_features(s, d):
    cols = ft.linguistic_features(F.col("text"))
    return _docs(s, d).select("doc_id", *[c.alias(n) for n, c in cols.items()])


@query(
    "rating_and_helpfulness",
    "C-24 C-29",
    over(
        "reviews",
        """SELECT review_id, round(star_rating / 5.0, 6) AS rating_normalized,
                  round(CASE WHEN helpfulness_denominator > 0 THEN helpfulness_numerator / helpfulness_denominator ELSE 0 END, 6)
                    AS helpfulness FROM reviews""",
    ),
)
def rating_and_helpfulness(s, d):
    ratio = ft.helpfulness_ratio(F.col("helpfulness_numerator"), F.col("helpfulness_denominator"))
    return ad.text_reviews(s, d).select(
        "review_id", (F.col("star_rating") / 5.0).alias("rating_normalized"), ratio.alias("helpfulness")
    )


@query(
    "time_delta_days",
    "C-25 D-08",
    over(
        "reviews",
        """SELECT review_id, round(date_diff('second', review_time, (SELECT max(review_time) FROM reviews)) / 86400.0, 6)
                  AS time_delta_days FROM reviews""",
    ),
)
def time_delta_days(s, d):
    return op.time_delta_days(ad.text_reviews(s, d).select("review_id", "review_time"), "review_time").drop("review_time")


@query(
    "text_densities",
    "C-26 C-27 C-28",
    over(
        "reviews",
        f""", t AS (SELECT review_id, lower(review_text) AS low, {words('review_text')} AS w FROM reviews)
        SELECT review_id,
               round(CASE WHEN len(w) > 1 THEN len([x FOR x IN w[2:] IF regexp_matches(x, '^\\p{{Lu}}')]) / len(w) ELSE 0 END, 6)
                 AS entity_density,
               round(CASE WHEN len(w) > 0 THEN len([a FOR a IN {sql_list(fv.HELPFULNESS_ASPECTS)} IF contains(low, a)]) / len(w)
                     ELSE 0 END, 6) AS aspect_density,
               cast({any_of('low', fv.HELPFULNESS_ASPECTS)} AS int) AS is_topic_assigned
        FROM t""",
    ),
)
def text_densities(s, d):
    c = F.col("review_text")
    return ad.text_reviews(s, d).select(
        "review_id",
        ft.caps_entity_density(c).alias("entity_density"),
        ft.aspect_density(c).alias("aspect_density"),
        ft.topic_flag(c).alias("is_topic_assigned"),
    )


@query(
    "sentiment_star_agreement",
    "C-30",
    over(
        "reviews",
        """SELECT review_id, cast(CASE WHEN compound <= -0.05 THEN 'negative' WHEN compound <= 0.05 THEN 'neutral' ELSE 'positive' END
                  = CASE WHEN star_rating <= 2 THEN 'negative' WHEN star_rating <= 3 THEN 'neutral' ELSE 'positive' END AS int)
                  AS agree FROM reviews""",
    ),
)
def sentiment_star_agreement(s, d):
    same = labels.compound_label_bins(F.col("compound")) == labels.star_label(F.col("star_rating"))
    return ad.text_reviews(s, d).select("review_id", F.coalesce(same, F.lit(False)).cast("int").alias("agree"))


@query(
    "caps_letter_ratio",
    "C-32",
    "SELECT doc_id, round(len(regexp_extract_all(text, '[A-Z]')) / greatest(length(text), 1), 6) AS ratio FROM documents",
)
def caps_letter_ratio(s, d):
    return _docs(s, d).select("doc_id", ft.caps_letter_ratio(F.col("text")).alias("ratio"))


@query(
    "entity_context",
    "C-33",
    """WITH t AS (SELECT doc_id, text, length(text) // 2 AS a, least(length(text) // 2 + 5, length(text)) AS b FROM documents)
       SELECT doc_id, '...' || substr(text, greatest(a - 30, 0) + 1, least(b + 30, length(text)) - greatest(a - 30, 0)) || '...'
              AS context FROM t""",
)
def entity_context(s, d):
    text = F.col("text")
    a = F.floor(F.length(text) / 2)
    b = F.least(a + 5, F.length(text))
    return _docs(s, d).select("doc_id", tx.entity_context(text, a, b).alias("context"))


@query(
    "aspect_names",
    "C-34",
    over(
        "aspects",
        """SELECT DISTINCT aspect_term, upper(left(aspect_term, 1)) || substr(aspect_term, 2) AS shown,
                  'aspect_' || replace(aspect_term, ' ', '_') AS column_name FROM aspects""",
    ),
)
def aspect_names(s, d):
    a = F.col("aspect_term")
    return (
        ad.aspects(s, d)
        .select("aspect_term")
        .distinct()
        .select(
            a,
            tx.capitalize(a).alias("shown"),
            F.concat(F.lit("aspect_"), F.replace(a, F.lit(" "), F.lit("_"))).alias("column_name"),
        )
    )


@query(
    "date_keys",
    "C-35",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day_key, strftime(ts, '%Y-%m') AS month_key,
              concat(year(ts), 'Q', quarter(ts)) AS quarter_key FROM events""",
)
def date_keys(s, d):
    t = F.col("ts")
    return ad.table(s, d, "events").select(
        "event_id",
        F.date_format(t, "yyyy-MM-dd").alias("day_key"),
        labels.month_key(t).alias("month_key"),
        labels.quarter_key(t).alias("quarter_key"),
    )


_SC = ["char_count", "word_count", "exclamation_count", "caps_ratio"]


@query(
    "scaled_columns",
    "L-05 M-04",
    f"""WITH b AS (SELECT doc_id, length(text) AS char_count, len({W}) AS word_count,
                          length(text) - length(replace(text, '!', '')) AS exclamation_count,
                          {CAPS} / (len({W}) + 1) AS caps_ratio FROM documents),
    m AS (SELECT {', '.join(f'avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}' for c in _SC)} FROM b)
    SELECT doc_id, {', '.join(f'round(({c} - m_{c}) / s_{c}, 6) AS {c}_scaled' for c in _SC)} FROM b, m""",
)
def scaled_columns(s, d):
    base = op.basic_text_features(_docs(s, d), "text").select("doc_id", *_SC)
    return op.scale_columns(base, _SC).drop(*_SC)
