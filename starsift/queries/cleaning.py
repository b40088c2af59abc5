"""Queries for row cleaning, labels and filters."""

from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import labels
from starsift.functions import text as tx
from starsift.operators import cleaning, joins
from starsift.queries.oracle import NSP, SP, WD, clean, collapse, over, sql_in, words
from starsift.queries.registry import query
from starsift.sources import adapters as ad


def _docs(s, d):
    return ad.documents(s, d)


@query(
    "drop_null_essentials",
    "B-01",
    over("raw", """SELECT "Id" FROM raw WHERE "ProductId" IS NOT NULL AND "Score" IS NOT NULL
                   AND "Summary" IS NOT NULL AND "Text" IS NOT NULL"""),
)
def drop_null_essentials(s, d):
    return cleaning.drop_null_essentials(ad.raw_reviews(s, d)).select("Id")


@query(
    "drop_null_ingest",
    "B-02",
    over("raw", """SELECT "Id" FROM raw WHERE "ProductId" IS NOT NULL AND "Score" IS NOT NULL AND "Text" IS NOT NULL"""),
)
def drop_null_ingest(s, d):
    return cleaning.drop_null_ingest(ad.raw_reviews(s, d)).select("Id")


@query("filter_exposure", "B-03", over("raw", 'SELECT "Id" FROM raw WHERE "HelpfulnessDenominator" >= 5'))
def filter_exposure(s, d):
    return cleaning.filter_exposure(ad.raw_reviews(s, d), 5).select("Id")


@query(
    "filter_exposure_adaptive",
    "B-04 D-08",
    over(
        "raw",
        """, t AS (SELECT CASE WHEN count(*) >= 100 THEN 8 ELSE 1 END AS exposure_threshold FROM raw WHERE "HelpfulnessDenominator" >= 8)
           SELECT "Id", exposure_threshold FROM raw, t WHERE "HelpfulnessDenominator" >= exposure_threshold""",
    ),
)
def filter_exposure_adaptive(s, d):
    return cleaning.filter_exposure_adaptive(ad.raw_reviews(s, d), 8).select("Id", "exposure_threshold")


@query("clean_review_text", "B-05", over("raw", f'SELECT "Id", {clean(chr(34) + "Text" + chr(34))} AS cleaned FROM raw'))
def clean_review_text(s, d):
    return ad.raw_reviews(s, d).select("Id", tx.clean_review_text(F.col("Text")).alias("cleaned"))


@query("clean_documents", "B-05", f"SELECT doc_id, {clean('text')} AS cleaned FROM documents")
def clean_documents(s, d):
    return _docs(s, d).select("doc_id", tx.clean_review_text(F.col("text")).alias("cleaned"))


@query(
    "remove_symbols",
    "B-06",
    "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F\\x{00C0}-\\x{017F}]', '', 'g') AS kept FROM documents",
)
def remove_symbols(s, d):
    return _docs(s, d).select("doc_id", tx.remove_symbols(F.col("text")).alias("kept"))


_ENGLISH = f"[a-zA-Z{fv.SPACE}.,!?''\"-]".replace("\\x85", "\\x{85}")


@query(
    "likely_english",
    "B-07",
    f"""SELECT doc_id, length(text) > 0 AND len(regexp_extract_all(text, '{_ENGLISH}')) / greatest(length(text), 1) >= 0.8
               AS english FROM documents""",
)
def likely_english(s, d):
    return _docs(s, d).select("doc_id", tx.is_likely_english(F.col("text")).alias("english"))


@query(
    "merge_summary_text",
    "B-08 O-02",
    over(
        "raw",
        """SELECT "Id", CASE WHEN "Summary" = '' THEN "Text" WHEN right("Summary", 1) IN ('.', '!', '?')
                  THEN concat("Summary", ' ', "Text") ELSE concat("Summary", '. ', "Text") END AS merged
           FROM raw WHERE "Summary" IS NOT NULL AND "Text" IS NOT NULL""",
    ),
)
def merge_summary_text(s, d):
    both = ad.raw_reviews(s, d).na.drop(subset=["Summary", "Text"])
    return both.select("Id", tx.merge_summary_text(F.col("Summary"), F.col("Text")).alias("merged"))


@query(
    "merge_raw",
    "B-09",
    over(
        "raw",
        """SELECT "Id", CASE WHEN "Summary" IS NOT NULL AND "Summary" <> '' THEN "Summary" || '. ' || "Text" ELSE "Text" END
                  AS merged FROM raw""",
    ),
)
def merge_raw(s, d):
    return ad.raw_reviews(s, d).select("Id", tx.merge_raw(F.col("Summary"), F.col("Text")).alias("merged"))


@query(
    "drop_blank",
    "B-10",
    over("raw", f"""SELECT "Id" FROM raw WHERE trim({clean('"Text"')}) <> '' """),
)
def drop_blank(s, d):
    cleaned = ad.raw_reviews(s, d).withColumn("clean_review_text", tx.clean_review_text(F.col("Text")))
    return cleaning.drop_blank(cleaned).select("Id")


@query(
    "dedupe_reviews",
    "B-11 G-03",
    over(
        "raw",
        f""", k AS (SELECT "Id", row_number() OVER (PARTITION BY "ProductId", "UserId", {clean('"Text"')} ORDER BY "Id") AS rn
                    FROM raw)
        SELECT "Id" FROM k WHERE rn = 1""",
    ),
)
def dedupe_reviews(s, d):
    cleaned = ad.raw_reviews(s, d).withColumn("clean_review_text", tx.clean_review_text(F.col("Text")))
    return cleaning.dedupe_reviews(cleaned).select("Id")


@query(
    "dedupe_scraped",
    "B-12",
    over(
        "scraped",
        """, k AS (SELECT row_id, row_number() OVER (PARTITION BY product_id, reviewer_name, review_text ORDER BY row_id) AS rn
                   FROM scraped)
        SELECT row_id FROM k WHERE rn = 1""",
    ),
)
def dedupe_scraped(s, d):
    return cleaning.dedupe_scraped(ad.scraped_reviews(s, d)).select("row_id")


@query("take_first", "B-13", over("raw", 'SELECT "Id", "ProductId" FROM raw ORDER BY "Id" LIMIT 1000'))
def take_first(s, d):
    return cleaning.take_first(ad.raw_reviews(s, d).select("Id", "ProductId"), 1000)


def _sql_lower_clean(x: str, tag: str, keep: str = "") -> str:
    unlinked = f"regexp_replace(lower(coalesce({x}, '')), 'http{NSP}+|www\\.{NSP}+', ' ', 'g')"
    untagged = f"regexp_replace({unlinked}, '{tag}', ' ', 'g')"
    cls = f"[^{WD}{fv.SPACE}{keep}]".replace("\\x85", "\\x{85}")
    return f"regexp_replace({untagged}, '{cls}', ' ', 'g')"


CLEAN_NUM = collapse(f"regexp_replace({_sql_lower_clean('text', '<[^>]*>')}, '\\p{{Nd}}+', ' NUM ', 'g')")
CLEAN_NODIGIT = collapse(f"regexp_replace({_sql_lower_clean('text', '<[^>]+>')}, '\\p{{Nd}}+', ' ', 'g')")


@query("clean_text_num", "B-14", f"SELECT doc_id, {CLEAN_NUM} AS cleaned FROM documents")
def clean_text_num(s, d):
    return _docs(s, d).select("doc_id", tx.clean_text_num(F.col("text")).alias("cleaned"))


@query("clean_text_nodigits", "B-15", f"SELECT doc_id, {CLEAN_NODIGIT} AS cleaned FROM documents")
def clean_text_nodigits(s, d):
    return _docs(s, d).select("doc_id", tx.clean_text_nodigits(F.col("text")).alias("cleaned"))


_JOB = _sql_lower_clean("text", "<[^>]+>", ".,+#")
_JOB = f"regexp_replace(regexp_replace({_JOB}, 'c\\+\\+', 'cpp', 'g'), 'c#', 'csharp', 'g')"
_JOB = collapse(f"regexp_replace({_JOB}, '\\b[0-9]+\\+?\\s*years?\\b', ' ', 'g')")


@query("clean_job_text", "B-16", f"SELECT doc_id, {_JOB} AS cleaned FROM documents")
def clean_job_text(s, d):
    return _docs(s, d).select("doc_id", tx.clean_job_text(F.col("text")).alias("cleaned"))


def _sql_tokens(x: str, stop, min_len: int) -> str:
    return f"array_to_string([t FOR t IN {words(x)} IF t NOT IN {sql_in(stop)} AND length(t) >= {min_len}], ' ')"


@query(
    "preprocess_text",
    "B-17 B-20",
    f"SELECT doc_id, {_sql_tokens(CLEAN_NUM, fv.REVIEW_STOP_WORDS, 2)} AS processed FROM documents",
)
def preprocess_text(s, d):
    return _docs(s, d).select("doc_id", tx.preprocess_text(F.col("text"), 2).alias("processed"))


@query(
    "preprocess_text_nodigits",
    "B-17",
    f"SELECT doc_id, {_sql_tokens(CLEAN_NODIGIT, fv.REVIEW_STOP_WORDS, 3)} AS processed FROM documents",
)
def preprocess_text_nodigits(s, d):
    return _docs(s, d).select("doc_id", tx.preprocess_text(F.col("text"), 3, digits="drop").alias("processed"))


_LIGHT = f"regexp_replace(lower(text), '[^{WD}{fv.SPACE}]', ' ', 'g')".replace("\\x85", "\\x{85}")


@query(
    "preprocess_light", "B-18", f"SELECT doc_id, {_sql_tokens(_LIGHT, fv.REVIEW_STOP_WORDS, 3)} AS processed FROM documents"
)
def preprocess_light(s, d):
    return _docs(s, d).select("doc_id", tx.preprocess_light(F.col("text")).alias("processed"))


@query("prep_lda", "B-19", f"SELECT doc_id, {_sql_tokens(_LIGHT, fv.REVIEW_STOP_WORDS, 4)} AS processed FROM documents")
def prep_lda(s, d):
    return _docs(s, d).select("doc_id", tx.prep_lda(F.col("text")).alias("processed"))


@query(
    "stop_word_counts",
    "B-20",
    f"""SELECT doc_id, len([t FOR t IN {words('lower(text)')} IF t IN {sql_in(sorted(set(fv.JOB_STOP_WORDS) | set(fv.GENERAL_STOP_WORDS)))}])
               AS n FROM documents""",
)
def stop_word_counts(s, d):
    both = sorted(set(fv.JOB_STOP_WORDS) | set(fv.GENERAL_STOP_WORDS))
    tokens = tx.words(F.lower("text"))
    return _docs(s, d).select("doc_id", F.size(F.filter(tokens, lambda t: t.isin(*both))).alias("n"))


@query(
    "fill_defaults",
    "B-21",
    over(
        "raw",
        """SELECT "Id", coalesce("ProfileName", 'Anonymous') AS reviewer_name, trim(coalesce("Summary", '')) AS review_title,
                  trim(coalesce("Text", '')) AS review_text, coalesce("HelpfulnessNumerator", 0) AS helpful_votes FROM raw""",
    ),
)
def fill_defaults(s, d):
    r = ad.raw_reviews(s, d).selectExpr(
        "Id", "ProfileName as reviewer_name", "Summary as review_title", "Text as review_text",
        "HelpfulnessNumerator as helpful_votes",
    )
    return cleaning.fill_defaults(r)


@query(
    "recent_reviews",
    "B-22 G-11",
    over(
        "reviews",
        """SELECT review_id, strftime(review_time, '%Y-%m-%d') AS review_date, product_id, star_rating,
                  CASE WHEN star_rating >= 4 THEN 'positive' WHEN star_rating = 3 THEN 'neutral' ELSE 'negative' END AS sentiment,
                  review_text, helpfulness_denominator AS helpful_votes
           FROM reviews WHERE product_id IN ('P001', 'P002', 'P003') AND review_text ILIKE '%BATTERY%'
           ORDER BY review_time DESC, review_id LIMIT 50""",
    ),
)
def recent_reviews(s, d):
    return cleaning.recent_reviews(ad.reviews(s, d), ["P001", "P002", "P003"], "BATTERY")


@query(
    "filter_summaries",
    "B-23",
    over(
        "reviews",
        """SELECT month, product_id, count(*) AS total_reviews FROM reviews
           WHERE product_id IN ('P001', 'P002', 'P003') AND month BETWEEN '1995-01' AND '1997-06' GROUP BY ALL""",
    ),
)
def filter_summaries(s, d):
    from starsift.operators import rollups

    ms = rollups.monthly_sentiment(ad.reviews(s, d))
    return cleaning.filter_summaries(ms, ["P001", "P002", "P003"], "1995-01", "1997-06").select(
        "month", "product_id", "total_reviews"
    )


@query(
    "star_sentiment",
    "B-24 B-25 B-26",
    over(
        "raw",
        """SELECT "Id", CASE WHEN "Score" >= 4 THEN 'positive' WHEN "Score" = 3 THEN 'neutral' ELSE 'negative' END AS three_way,
                  CASE WHEN "Score" = 3 THEN NULL WHEN "Score" >= 4 THEN 'positive' ELSE 'negative' END AS two_way,
                  CASE WHEN "Score" > 0 AND "Score" <= 2 THEN 'negative' WHEN "Score" <= 3 THEN 'neutral'
                       WHEN "Score" <= 5 THEN 'positive' END AS binned FROM raw""",
    ),
)
def star_sentiment(s, d):
    c = F.col("Score")
    return ad.raw_reviews(s, d).select(
        "Id",
        labels.sentiment_from_score(c).alias("three_way"),
        labels.star_label(c, "binary").alias("two_way"),
        labels.star_label(c).alias("binned"),
    )


@query(
    "compound_labels",
    "B-27 C-31",
    over(
        "reviews",
        """SELECT review_id, CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END
                  AS inclusive, CASE WHEN compound >= 0.05 THEN 'positive' ELSE 'negative' END AS two_way,
                  CASE WHEN compound <= -0.05 THEN 'negative' WHEN compound <= 0.05 THEN 'neutral' ELSE 'positive' END AS binned
           FROM reviews""",
    ),
)
def compound_labels(s, d):
    c = F.col("compound")
    return ad.reviews(s, d).select(
        "review_id",
        labels.compound_label(c).alias("inclusive"),
        labels.compound_label(c, "binary").alias("two_way"),
        labels.compound_label_bins(c).alias("binned"),
    )


@query(
    "dashboard_frame",
    "B-28 D-03",
    over(
        "reviews aspects",
        """, f AS (SELECT review_id, min(aspect_term) AS aspect FROM aspects GROUP BY 1),
        j AS (SELECT *, CASE WHEN star_rating >= 4 THEN 'positive' WHEN star_rating = 3 THEN 'neutral' ELSE 'negative' END
                     AS sentiment FROM reviews LEFT JOIN f USING (review_id))
        SELECT review_id, product_id, sentiment, star_rating, true AS verified, 0 AS img_defect,
               cast(sentiment = 'negative' AS int) AS is_defect,
               upper(left(coalesce(aspect, 'Value'), 1)) || lower(substr(coalesce(aspect, 'Value'), 2)) AS aspect, month,
               cast(date_trunc('month', review_time) AS date) AS month_dt,
               concat(year(review_time), 'Q', quarter(review_time)) AS quarter
        FROM j""",
    ),
)
def dashboard_frame(s, d):
    return cleaning.dashboard_frame(joins.reviews_with_first_aspect(ad.reviews(s, d), ad.aspects(s, d)))
