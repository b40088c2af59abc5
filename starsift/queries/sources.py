"""Queries for scans, typing, parsing and stored tables."""

from pyspark.sql import functions as F

from starsift import schemas
from starsift.functions import parsing as pr
from starsift.operators import cleaning, joins
from starsift.queries.oracle import collapse, over, words
from starsift.queries.registry import query
from starsift.sources import adapters as ad
from starsift.sources import html_pages


@query(
    "review_slice",
    "A-02",
    over(
        "raw",
        """, kept AS (SELECT *, row_number() OVER (ORDER BY "Id") - 1 AS p FROM raw
                     WHERE "ProductId" IS NOT NULL AND "Score" IS NOT NULL AND "Text" IS NOT NULL)
        SELECT "Id", "ProductId", "Score", "Text" FROM kept WHERE p >= 500 AND p < 1200""",
    ),
)
def review_slice(s, d):
    return cleaning.read_review_slice(ad.raw_reviews(s, d), 500, 700, bucket=1000).select(
        "Id", "ProductId", "Score", "Text"
    )


@query(
    "standardise_reviews",
    "A-04 C-11 B-12",
    over(
        "raw",
        f""", t AS (
          SELECT "Id" AS row_id, "ProductId" AS product_id, coalesce("ProfileName", 'Anonymous') AS reviewer_name,
                 cast("Score" AS double) AS star_rating, trim(coalesce("Summary", '')) AS review_title,
                 trim(coalesce("Text", '')) AS review_text, make_timestamp("Time" * 1000000) AS review_date,
                 cast(coalesce("HelpfulnessNumerator", 0) AS int) AS helpful_votes FROM raw),
        k AS (SELECT *, row_number() OVER (PARTITION BY product_id, reviewer_name, review_text ORDER BY row_id) AS rn FROM t)
        SELECT row_id, product_id, product_id AS product_name, reviewer_name, star_rating, review_title, review_text,
               review_date, cast(review_date AS date) AS review_date_parsed, false AS verified, helpful_votes,
               '' AS image_urls, 'review-csv' AS source_url, length(review_text) AS review_length,
               len({words('review_text')}) AS word_count, false AS has_images, 0 AS image_count,
               len({words('review_text')}) > 100 AS is_long_review, helpful_votes >= 10 AS is_highly_helpful,
               CASE WHEN star_rating <= 2 THEN 'negative' WHEN star_rating <= 3 THEN 'neutral'
                    WHEN star_rating <= 5 THEN 'positive' END AS sentiment_label
        FROM k WHERE rn = 1""",
    ),
)
def standardise(s, d):
    return cleaning.standardise_reviews(ad.raw_reviews(s, d))


_SCRAPED_BODY = f""", t AS (
  SELECT row_id, product_id, product_name, reviewer_name, try_cast(star_rating AS double) AS star_rating,
         trim(review_title) AS review_title, {collapse('review_text')} AS review_text, review_date,
         CASE WHEN review_date <> 'unknown' THEN cast(order_ts AS date) END AS review_date_parsed, verified,
         coalesce(try_cast(helpful_votes AS int), 0) AS helpful_votes,
         CASE WHEN image_urls = '' THEN 0 ELSE len(string_split(image_urls, '|')) END AS image_count, image_urls, source_url
  FROM scraped),
k AS (SELECT *, row_number() OVER (PARTITION BY product_id, reviewer_name, review_text ORDER BY row_id) AS rn FROM t),
typed AS (
  SELECT * EXCLUDE (rn), length(review_text) AS review_length, len({words('review_text')}) AS word_count,
         len({words('review_text')}) > 100 AS is_long_review, helpful_votes >= 10 AS is_highly_helpful,
         image_count > 0 AS has_images,
         CASE WHEN star_rating <= 2 THEN 'negative' WHEN star_rating <= 3 THEN 'neutral'
              WHEN star_rating <= 5 THEN 'positive' END AS sentiment_label
  FROM k WHERE rn = 1)"""


@query("type_scraped_reviews", "A-05", over("scraped", _SCRAPED_BODY + " SELECT * FROM typed"))
def type_scraped(s, d):
    return cleaning.type_scraped_reviews(ad.scraped_reviews(s, d))


@query(
    "scrape_summary",
    "E-43",
    over(
        "scraped",
        _SCRAPED_BODY
        + """ SELECT count(*) AS rows, count(DISTINCT product_id) AS products, round(avg(star_rating), 6) AS avg_star,
              round(avg(word_count), 6) AS avg_words, count(*) FILTER (WHERE has_images) AS with_images,
              round(count(*) FILTER (WHERE has_images) * 100.0 / count(*), 6) AS pct_images,
              count(*) FILTER (WHERE verified) AS verified,
              round(count(*) FILTER (WHERE verified) * 100.0 / count(*), 6) AS pct_verified FROM typed""",
    ),
)
def scrape_summary(s, d):
    from starsift.operators import explore

    return explore.scrape_summary(cleaning.type_scraped_reviews(ad.scraped_reviews(s, d)))


@query(
    "parse_stars",
    "A-07",
    over(
        "scraped",
        """SELECT row_id, list_filter([try_cast(t AS double) FOR t IN string_split(stars_label, ' ')],
                  lambda x: x BETWEEN 1 AND 5)[1] AS stars FROM scraped""",
    ),
)
def parse_stars(s, d):
    return ad.scraped_reviews(s, d).select("row_id", pr.parse_stars(F.col("stars_label")).alias("stars"))


@query(
    "parse_votes",
    "A-08",
    over(
        "scraped",
        """SELECT row_id, coalesce(try_cast(nullif(regexp_extract(replace(votes_label, ',', ''), '^[0-9]+'), '') AS bigint), 0)
                  AS votes FROM scraped""",
    ),
)
def parse_votes(s, d):
    return ad.scraped_reviews(s, d).select("row_id", pr.parse_votes(F.col("votes_label")).alias("votes"))


@query(
    "image_urls",
    "A-09",
    over(
        "scraped",
        """SELECT row_id, array_to_string([replace(u, '._SY88.', '._SL500_.') FOR u IN string_split(image_urls, '|')
                  IF starts_with(u, 'http')], '|') AS urls FROM scraped""",
    ),
)
def image_url_list(s, d):
    urls = pr.image_urls(F.split("image_urls", r"\|"))
    return ad.scraped_reviews(s, d).select("row_id", F.array_join(urls, "|").alias("urls"))


@query(
    "page_reviews",
    "A-06 A-09 O-03",
    over(
        "scraped",
        """SELECT row_id AS page_id, 0 AS position, reviewer_name,
                  CASE WHEN starts_with(stars_label, 'Rated 0') OR starts_with(stars_label, 'Rated 5')
                         OR starts_with(stars_label, 'Rated 6') THEN 5.0
                       ELSE cast(regexp_extract(stars_label, '[0-9.]+') AS double) END AS star_rating,
                  trim(review_title) AS review_title,
                  replace(regexp_replace(review_text, '^\\s+|\\s+$', '', 'g'), ' <br/> ', '') AS review_text,
                  review_date, verified,
                  coalesce(try_cast(nullif(regexp_extract(replace(votes_label, ',', ''), '^[0-9]+'), '') AS bigint), 0)
                    AS helpful_votes,
                  'http://img/a._SL500_.jpg' AS image_urls,
                  concat('http://shop.example.com/p/', row_id, '?page=1') AS source_url
           FROM scraped""",
    ),
)
def page_reviews(s, d):
    return html_pages.pages_to_reviews(ad.review_pages(s, d))


@query(
    "next_pages",
    "A-10",
    over(
        "scraped",
        """SELECT row_id AS page_id, concat('http://shop.example.com/p/', row_id, '?page=1') AS from_url,
                  concat('http://shop.example.com/p/', row_id, '?page=2') AS to_url FROM scraped""",
    ),
)
def next_pages(s, d):
    return html_pages.next_page_links(ad.review_pages(s, d))


@query(
    "page_links",
    "A-10",
    """SELECT page_id, len(list_filter(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1), lambda u: u <> '')) AS links
       FROM pages""",
)
def page_links(s, d):
    links = html_pages.links(ad.table(s, d, "pages"))
    pages = ad.table(s, d, "pages").select("page_id")
    counted = links.groupBy("page_id").agg(F.count("*").alias("links"))
    return pages.join(counted, "page_id", "left").select("page_id", F.coalesce("links", F.lit(0)).alias("links"))


@query(
    "fan_out_rows",
    "A-13 F-29",
    over(
        "reviews aspects",
        """SELECT product_id, count(DISTINCT r.review_id) AS reviews, count(*) AS aspect_rows
           FROM reviews r JOIN aspects a USING (review_id) GROUP BY product_id""",
    ),
)
def fan_out(s, d):
    from starsift.plans import ingest

    one = F.array(F.struct("aspect_term", "sentiment_label", "confidence"))
    analysed = ad.aspects(s, d).select("review_id", one.alias("aspect_sentiments"))
    rows = ingest.fan_out(analysed)["aspect_sentiments"]
    joined = rows.join(ad.reviews(s, d).select("review_id", "product_id"), "review_id")
    return joined.groupBy("product_id").agg(
        F.countDistinct("review_id").alias("reviews"), F.count("*").alias("aspect_rows")
    )


_NEW_PRODUCTS = """, known AS (SELECT DISTINCT product_id AS id FROM reviews WHERE product_id < 'P020'),
  missing AS (SELECT DISTINCT product_id AS id FROM reviews WHERE product_id NOT IN (SELECT id FROM known))"""


@query(
    "new_products",
    "A-14 D-06",
    over("reviews", _NEW_PRODUCTS + " SELECT id, 'Unknown' AS brand, 'General' AS category FROM missing"),
)
def new_products(s, d):
    r = ad.reviews(s, d)
    known = r.filter(F.col("product_id") < "P020").select(F.col("product_id").alias("id"))
    return joins.new_products(r, known.distinct())


@query(
    "merged_products",
    "A-14 H-01",
    over(
        "reviews",
        _NEW_PRODUCTS
        + """ SELECT id, 'Known' AS brand, 'Stored' AS category FROM known
              UNION ALL SELECT id, 'Unknown', 'General' FROM missing""",
    ),
)
def merged_products(s, d):
    r = ad.reviews(s, d)
    known = (
        r.filter(F.col("product_id") < "P020")
        .select(F.col("product_id").alias("id"), F.lit("Known").alias("brand"), F.lit("Stored").alias("category"))
        .distinct()
    )
    return joins.merge_products(r, known)


@query(
    "upload_validation",
    "A-19",
    over(
        "raw",
        """SELECT CASE WHEN "Score" IS NULL OR "Text" IS NULL THEN 'quarantine' ELSE 'accepted' END AS route, count(*) AS n
           FROM raw GROUP BY 1""",
    ),
)
def upload_validation(s, d):
    from starsift.sources import files

    good, bad = files.validate(ad.raw_reviews(s, d), required=["ProductId", "Score", "Text"])
    return good.agg(F.count("*").alias("n")).select(F.lit("accepted").alias("route"), "n").unionByName(
        bad.agg(F.count("*").alias("n")).select(F.lit("quarantine").alias("route"), "n")
    )


@query(
    "stored_schema_defaults",
    "A-16 D-06",
    over("reviews", "SELECT count(*) AS reviews, count(DISTINCT product_id) AS products FROM reviews"),
)
def stored_schema_defaults(s, d):
    """Reviews cast to the stored schema keep every row."""
    r = ad.reviews(s, d).withColumnRenamed("review_id", "id").withColumnRenamed("star_rating", "score")
    return schemas.conform(r, "reviews").agg(
        F.count("id").alias("reviews"), F.countDistinct("product_id").alias("products")
    )


_DOCUMENT_CSV = "doc_id bigint, lang string, source string, n_chars bigint, text string"


def _as_csv(s, rows):
    """The rows as quoted CSV in the checkpoint folder."""
    from starsift.sources import durable

    place = durable.folder(s, "csv")
    rows.write.option("escape", '"').csv(place, header=True)
    return place


@query(
    "csv_records",
    "A-01 A-11",
    "SELECT doc_id, n_chars, md5(text) AS text_md5, len(regexp_extract_all(text, '\\n')) AS line_breaks FROM documents",
)
def csv_records_read(s, d):
    """Texts with line breaks and quotes, written as CSV and read by several tasks a file; only three columns are converted."""
    from starsift.sources import csv_records

    place = _as_csv(s, ad.table(s, d, "documents").select("doc_id", "lang", "source", "n_chars", "text"))
    rows = csv_records.read_csv(s, place, _DOCUMENT_CSV, ["doc_id", "n_chars", "text"], split_bytes=8 << 20)
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return rows.select("doc_id", "n_chars", F.md5("text").alias("text_md5"), breaks.cast("long").alias("line_breaks"))


@query(
    "upload_records",
    "A-19",
    """SELECT CASE WHEN doc_id % 7 = 0 THEN 'malformed' WHEN lang = 'en' THEN 'required value missing' ELSE 'accepted' END AS route,
              count(*) AS n, sum(CASE WHEN doc_id % 7 <> 0 THEN doc_id END) AS ids,
              sum(CASE WHEN doc_id % 7 = 0 THEN len(regexp_extract_all(coalesce(text, ''), '\\n')) ELSE 0 END) AS kept_line_breaks FROM documents GROUP BY 1""",
)
def upload_records(s, d):
    """An upload in which every seventh number is none and one language lacks its source: malformed records are kept whole."""
    from starsift.sources import csv_records, files

    docs = ad.table(s, d, "documents")
    given = docs.withColumns({
        "doc_id": F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("no. "), F.col("doc_id"))).otherwise(F.col("doc_id").cast("string")),
        "source": F.when(F.col("lang") != "en", F.col("source")),
    })
    place = _as_csv(s, given.select("doc_id", "lang", "source", "n_chars", "text"))
    rows = csv_records.read_csv(s, place, _DOCUMENT_CSV, corrupt=files.CORRUPT, split_bytes=8 << 20)
    good, bad = files.validate(rows, ["doc_id", "source"])
    route = F.when(F.col(files.CORRUPT).isNotNull(), "malformed").otherwise("required value missing")
    breaks = F.length(files.CORRUPT) - F.length(F.replace(files.CORRUPT, F.lit("\n"), F.lit("")))
    both = good.select(F.lit("accepted").alias("route"), "doc_id", F.lit(0).alias("breaks")).unionByName(
        bad.select(route.alias("route"), F.when(F.col(files.CORRUPT).isNull(), F.col("doc_id")).alias("doc_id"), F.coalesce(breaks, F.lit(0)).alias("breaks"))
    )
    return both.groupBy("route").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"), F.sum("breaks").alias("kept_line_breaks"))
