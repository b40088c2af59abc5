"""Queries for whole runs, streams and SQL functions."""

import uuid

from pyspark.sql import functions as F

from starsift import sql_functions
from starsift.functions import labels
from starsift.functions import text as tx
from starsift.operators import cleaning, explore, features, insights
from starsift.plans import annotate as an
from starsift.plans import explore as explore_plan
from starsift.plans import feature_table, increments, ingest, summaries
from starsift.plans import insights as insight_plan
from starsift.plans.preprocess import preprocess
from starsift.queries.explore import R
from starsift.queries.oracle import any_of, clean, over, words
from starsift.queries.registry import query
from starsift.queries.rollups import COUNTS
from starsift.sources import adapters as ad
from starsift.sources import durable, files, parts
from starsift.streaming import ingest as si
from starsift.streaming import rollups as sr

_S, _T = clean('"Summary"'), clean('"Text"')
PREPROCESSED = f""", c AS (SELECT "Id", "ProductId", "UserId", CASE WHEN {_S} = '' THEN {_T}
      WHEN right({_S}, 1) IN ('.', '!', '?') THEN concat({_S}, ' ', {_T}) ELSE concat({_S}, '. ', {_T}) END AS t FROM raw
    WHERE "ProductId" IS NOT NULL AND "Score" IS NOT NULL AND "Summary" IS NOT NULL AND "Text" IS NOT NULL),
  k AS (SELECT *, row_number() OVER (PARTITION BY "ProductId", "UserId", t ORDER BY "Id") AS rn FROM c
        WHERE trim(t) <> '' AND len(regexp_extract_all(t, '[a-zA-Z\\s.,!?''"-]')) / length(t) >= 0.8)"""


def _folder(s) -> str:
    return f"{durable.checkpoint_folder(s)}/run-{uuid.uuid4().hex}"


def _orders_stream(s, d):
    return si.file_stream(s, f"{d}/orders*.parquet", s.read.parquet(f"{d}/orders.parquet").schema)


@query("preprocessed", "M-01 B-11", over("raw", PREPROCESSED + ' SELECT "Id", "ProductId", t AS clean_review_text FROM k WHERE rn = 1'))
def preprocessed(s, d):
    return preprocess(ad.raw_reviews(s, d)).select("Id", "ProductId", "clean_review_text")


@query(
    "preprocessed_documents",
    "M-01 E-42",
    f"""WITH c AS (SELECT doc_id, source, lang, {clean('text')} AS t FROM documents),
    k AS (SELECT *, row_number() OVER (PARTITION BY source, lang, t ORDER BY doc_id) AS rn FROM c
          WHERE t <> '' AND len(regexp_extract_all(t, '[a-zA-Z\\s.,!?''"-]')) / length(t) >= 0.8)
    SELECT doc_id, t AS clean_review_text FROM k WHERE rn = 1""",
)
def preprocessed_documents(s, d):
    docs = ad.documents(s, d).select(
        F.col("doc_id").alias("Id"), F.col("source").alias("ProductId"), F.col("lang").alias("UserId"),
        F.lit(3).alias("Score"), F.lit("").alias("Summary"), F.col("text").alias("Text"),
    )
    return preprocess(docs).select(F.col("Id").alias("doc_id"), "clean_review_text")


@query("annotated_reviews", "M-02 F-26 F-27 J-08")
def annotated_reviews(s, d):
    topics = ad.topics(s).withColumnRenamed("name", "topic_name")
    a = an.annotate(ad.text_reviews(s, d), topics=topics)
    return a.select(
        "review_id", "overall_sentiment", "sentiment_confidence", "topic_name", F.size("entities").alias("entities"),
        F.size("aspect_sentiments").alias("aspects"), "flesch_reading_ease", "predicted_helpfulness",
    )


@query("annotation_rejects", "M-02", over("raw", f"""SELECT "Id" FROM raw WHERE {_T} = '' """))
def annotation_rejects(s, d):
    return an.rejects(ad.raw_reviews(s, d), "Text").select("Id")


@query(
    "ingested_summary",
    "M-03 A-13 A-17 M-08",
    over(
        "reviews",
        f"""SELECT product_id, count(*) AS total_reviews, round(avg(star_rating), 6) AS average_stars, 0.5 AS average_helpfulness, {COUNTS}
            FROM reviews GROUP BY 1""",
    ),
)
def ingested_summary(s, d):
    folder = _folder(s)
    ingest.ingest(ad.text_reviews(s, d).drop("predicted_helpfulness"), ad.topics(s), folder)
    return files.load_summaries(s, folder)["product_summary"].drop("last_updated")


@query(
    "ingested_given_helpfulness",
    "M-03 M-08",
    over(
        "reviews",
        f"""SELECT product_id, count(*) AS total_reviews, round(sum(coalesce(predicted_helpfulness, 0.5)), 4) AS helpfulness, {COUNTS}
            FROM reviews GROUP BY 1""",
    ),
)
def ingested_given_helpfulness(s, d):
    """Two parts, one after the other; helpfulness that comes with the reviews is kept."""
    folder = _folder(s)
    reviews = ad.text_reviews(s, d)
    for p in range(2):
        ingest.ingest(reviews.filter(F.pmod(F.xxhash64("review_id"), F.lit(2)) == p), ad.topics(s), folder, part=str(p))
    ps = files.load_summaries(s, folder)["product_summary"].withColumn("helpfulness", F.round(F.col("average_helpfulness") * F.col("total_reviews"), 4))
    return ps.select("product_id", "total_reviews", "helpfulness", "positive_count", "neutral_count", "negative_count")


@query("feature_table", "M-04 M-05")
def feature_table_rows(s, d):
    out = feature_table.build_features(ad.text_reviews(s, d))
    groups = features.feature_groups(out.columns)
    return out.select("review_id", *[c for g in ("text", "lexicon", "rating", "scaled") for c in groups[g]])


@query(
    "eda_products",
    "M-06",
    over(
        "reviews",
        R + """ SELECT product_id, count(*) AS review_count, round(avg(star_rating), 6) AS avg_rating, round(avg(compound), 6) AS avg_sentiment,
              round(avg(word_count), 6) AS avg_words FROM r GROUP BY 1 HAVING count(*) >= 2 ORDER BY 2 DESC, 1 LIMIT 8""",
    ),
)
def eda_products(s, d):
    r = ad.reviews(s, d).withColumn("word_count", tx.word_count(F.col("review_text")))
    return explore_plan.eda(s, r, ["star_rating", "word_count", "compound"])["products"]


@query(
    "rebuilt_monthly",
    "M-08 A-15",
    over("reviews", f"SELECT month, product_id, count(*) AS total_reviews, {COUNTS} FROM reviews GROUP BY 1, 2"),
)
def rebuilt_monthly(s, d):
    tables = summaries.rebuild_all(ad.reviews(s, d), ad.aspects(s, d), ad.topics(s))
    folder = _folder(s)
    summaries.write_all(tables, folder)
    return files.load_summaries(s, folder)["monthly_sentiment"]


@query(
    "insight_run_volume",
    "M-09",
    over("reviews", """SELECT month, count(review_text) AS total, count(*) FILTER (WHERE star_rating >= 4) AS pos,
                              count(*) FILTER (WHERE star_rating <= 2) AS neg FROM reviews GROUP BY 1"""),
)
def insight_run_volume(s, d):
    return insight_plan.run(ad.reviews(s, d), "topic_id")["monthly_volume"]


@query(
    "stream_ingest",
    "N-01 A-03 A-12",
    over("reviews", "SELECT product_id, count(*) AS n, cast(sum(star_rating) AS bigint) AS stars FROM reviews GROUP BY 1"),
)
def stream_ingest(s, d):
    folder = _folder(s)
    si.ingest_available(_orders_stream(s, d), f"{folder}/out", f"{folder}/ckpt", ad.reviews_from).awaitTermination()
    return s.read.parquet(f"{folder}/out").groupBy("product_id").agg(
        F.count("*").alias("n"), F.sum("star_rating").alias("stars")
    )


@query(
    "stream_monthly",
    "N-02",
    over("reviews", f"SELECT month, product_id, count(*) AS total_reviews, {COUNTS} FROM reviews GROUP BY 1, 2"),
)
def stream_monthly(s, d):
    folder = _folder(s)
    monthly = sr.stream_monthly(ad.reviews_from(_orders_stream(s, d)))
    sr.run_available(monthly, f"{folder}/out", f"{folder}/ckpt", "complete").awaitTermination()
    return s.read.parquet(f"{folder}/out/state")


@query(
    "stream_dedupe",
    "N-03",
    over("reviews", "SELECT product_id, count(DISTINCT user_id || review_text) AS n FROM reviews GROUP BY 1"),
)
def stream_dedupe(s, d):
    folder = _folder(s)
    r = ad.reviews_from(_orders_stream(s, d)).withColumn("ts", F.col("review_time").cast("timestamp"))
    unique = sr.stream_dedupe(r, ["product_id", "user_id", "review_text"], "ts", "36500 days")
    sr.run_available(unique, f"{folder}/out", f"{folder}/ckpt", "append").awaitTermination()
    return s.read.parquet(f"{folder}/out").groupBy("product_id").agg(F.count("*").alias("n"))


_HIT = any_of("lower(review_text)", ["defective", "defect", "broken", "broke", "cracked", "snapped", "not working", "never worked",
                                     "manufacturing", "faulty", "doa", "damaged", "malfunction", "stopped working"])


@query(
    "stream_defects",
    "N-04",
    over(
        "reviews",
        f""", w AS (SELECT *, make_timestamp(cast(floor(epoch(review_time) / 2592000) * 2592000 AS bigint) * 1000000) AS window_start FROM reviews),
        g AS (SELECT window_start, product_id, count(*) AS total_reviews, count(*) FILTER (WHERE {_HIT}) AS defect_mentions FROM w
              WHERE window_start + INTERVAL 30 DAY <= (SELECT max(review_time) FROM reviews) - INTERVAL 10 DAY GROUP BY 1, 2)
        SELECT *, round(defect_mentions * 100.0 / total_reviews, 6) AS defect_rate_pct,
               CASE WHEN defect_mentions * 100.0 / total_reviews > 10 THEN 'CRITICAL'
                    WHEN defect_mentions * 100.0 / total_reviews > 5 THEN 'WARNING' ELSE 'OK' END AS alert FROM g""",
    ),
)
def stream_defects(s, d):
    folder = _folder(s)
    r = ad.reviews_from(_orders_stream(s, d)).withColumn("ts", F.col("review_time").cast("timestamp"))
    alerts = sr.stream_defects(r, "ts", "10 days")
    sr.run_available(alerts, f"{folder}/out", f"{folder}/ckpt", "append").awaitTermination()
    return s.read.parquet(f"{folder}/out").drop("batch").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "sql_function_columns",
    "O-06 O-05 O-01",
    over(
        "raw",
        f"""SELECT "Id", CASE WHEN "Score" >= 4 THEN 'positive' WHEN "Score" = 3 THEN 'neutral' ELSE 'negative' END AS sentiment,
                   {_T} AS cleaned, len({words('"Text"')}) AS n_words,
                   round(CASE WHEN "HelpfulnessDenominator" > 0 THEN "HelpfulnessNumerator" / "HelpfulnessDenominator" ELSE 0 END, 6) AS helpful
            FROM raw""",
    ),
)
def sql_function_columns(s, d):
    sql_functions.register(s)
    return ad.raw_reviews(s, d).selectExpr(
        "Id", "sentiment_from_score(Score) AS sentiment", "clean_review_text(Text) AS cleaned", "word_count(Text) AS n_words",
        "helpfulness_ratio(HelpfulnessNumerator, HelpfulnessDenominator) AS helpful",
    )


@query(
    "row_functions",
    "O-02 O-04",
    over(
        "reviews",
        """SELECT product_id, count(*) FILTER (WHERE star_rating >= 4 AND verified) AS good, count(*) FILTER (WHERE star_rating <= 2) AS bad
           FROM reviews GROUP BY 1""",
    ),
)
def row_functions(s, d):
    star = F.col("star_rating")
    return ad.reviews(s, d).groupBy("product_id").agg(
        F.count_if((star >= 4) & F.col("verified")).alias("good"), F.count_if(star <= 2).alias("bad")
    )


def _added(s, d) -> str:
    """A store to which all reviews came in three parts by year, one of them first as a wrong batch."""
    folder = _folder(s)
    r, a = (durable.stored(x, "part-source") for x in (ad.reviews(s, d), ad.aspects(s, d)))
    years = r.select("review_id", F.coalesce(F.year("review_time") % 3, F.lit(0)).alias("p"))
    r, a = (durable.stored(x.join(years, "review_id"), "by-part") for x in (r, a))
    wrong = [x.filter("p = 1").drop("p") for x in (r, a)]
    increments.add_part(*wrong, folder, "0")
    for p in range(3):
        increments.add_part(*[x.filter(F.col("p") == p).drop("p") for x in (r, a)], folder, str(p))
    return folder


@query(
    "merged_product_summary",
    "A-12 A-17 M-03 M-08",
    over(
        "reviews",
        f"""SELECT product_id, count(*) AS total_reviews, round(avg(star_rating), 6) AS average_stars,
                   round(sum(coalesce(predicted_helpfulness, 0.5)), 4) AS helpfulness, {COUNTS} FROM reviews GROUP BY 1""",
    ),
)
def merged_product_summary(s, d):
    ps = increments.summaries(s, _added(s, d), ad.topics(s))["product_summary"]
    return ps.withColumn("helpfulness", F.round(F.col("average_helpfulness") * F.col("total_reviews"), 4)).drop("average_helpfulness")


@query(
    "merged_aspect_summary",
    "M-03 M-08",
    over(
        "reviews aspects",
        """SELECT product_id, aspect_term, count(*) FILTER (WHERE sentiment_label = 'positive') AS positive_count,
                  count(*) FILTER (WHERE sentiment_label = 'neutral') AS neutral_count,
                  count(*) FILTER (WHERE sentiment_label = 'negative') AS negative_count, round(sum(confidence), 3) AS confidence
           FROM reviews JOIN aspects USING (review_id) GROUP BY 1, 2""",
    ),
)
def merged_aspect_summary(s, d):
    folder = _added(s, d)
    merged = increments.summaries(s, folder, ad.topics(s))["aspect_summary"]
    held = parts.read(s, folder, "aspect_partial").groupBy("product_id", "aspect_term").agg(F.round(F.sum("confidence"), 3).alias("confidence"))
    return merged.drop("avg_confidence").join(held, ["product_id", "aspect_term"])


@query(
    "earlier_version",
    "A-17",
    over("reviews", """SELECT product_id, count(*) AS total_reviews FROM reviews WHERE coalesce(year(review_time) % 3, 0) IN (0, 1) GROUP BY 1"""),
)
def earlier_version(s, d):
    """A version goes on being readable after later commits: the third one has the parts 0 and 1."""
    return increments.summaries(s, _added(s, d), ad.topics(s), 3)["product_summary"].select("product_id", "total_reviews")


@query("cleaned_parts", "A-12 M-01", over("raw", PREPROCESSED + ' SELECT "Id", "ProductId", t AS clean_review_text FROM k WHERE rn = 1'))
def cleaned_parts(s, d):
    """Batches of whole products, cleaned and stored one after the other."""
    folder = _folder(s)
    raw = durable.stored(ad.raw_reviews(s, d).withColumn("p", F.pmod(F.xxhash64("ProductId"), F.lit(2))), "raw-parts")
    for p in range(2):
        increments.write_clean(raw.filter(F.col("p") == p).drop("p"), folder, str(p))
    return parts.read(s, folder, "clean").select("Id", "ProductId", "clean_review_text")
