"""Views over the benchmark tables in the shapes the review operators expect."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.sources import files

# --- Fixed values: phrases from which review texts are composed -----------------
OPEN = [
    "Battery drain is awful and the battery life is short.",
    "Great camera, photos look clear.",
    "The hinge broke and the plastic cracked.",
    "Excellent value, fast delivery.",
    "App crashes after every update.",
    "It is okay, nothing special.",
]
BODY = [
    "I paid too much, the price is not worth it.",
    "Screen is bright and the display is smooth.",
    "Customer service refused a refund.",
    "Works as expected!",
    "The box arrived damaged.",
    "Sound quality is good but the bass is poor.",
    "DEFECTIVE unit, never worked!!!",
    "My Sony and Bose sets sound better.",
]
CLOSE = [
    "Highly recommend.",
    "Would not buy again.",
    "Best purchase of 2024.",
    "See https://example.com/r?id=1 <br/> for more.",
    "",
]
ASPECT_TERMS = ["battery", "screen", "camera", "price", "sound", "shipping", "durability"]
TOPIC_NAMES = ["power", "photo", "build", "value", "software"]
NON_LATIN = "Отличный товар, рекомендую всем друзьям"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a task should get at most. Texts are taken apart where they lie, so a task's share must not grow with the table.
ROWS_A_TASK = {"documents": 2_000, "orders": 25_000}


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """The benchmark tables are files of one row group, so they are dealt by key over the session's shuffle partitions,
    or over more tasks where a table has more than ``ROWS_A_TASK`` rows for each. Rows are counted from the file footers."""
    df = table(spark, sf_dir, name)
    tasks = -(-df.count() // ROWS_A_TASK[name])
    return files.spread(df, key, max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(spark, sf_dir, "documents", "doc_id")


def text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews laid out for text work."""
    return reviews_from(dealt(spark, sf_dir, "orders", "o_orderkey"))


def _pick(values: list[str], index: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.expr(f"cast(1 + {index} as int)"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_from(table(spark, sf_dir, "orders"))


def reviews_from(orders: DataFrame) -> DataFrame:
    """One review per order (the orders may be a stream)."""
    return orders.select(
        F.col("o_orderkey").alias("review_id"),
        F.expr("concat('P', lpad(cast(o_custkey % 40 as string), 3, '0'))").alias("product_id"),
        F.expr("concat('U', cast(o_custkey as string))").alias("user_id"),
        F.expr("cast(1 + (o_orderkey * 7 + o_custkey) % 5 as int)").alias("star_rating"),
        F.expr("cast(least(o_orderkey % 9, o_custkey % 9) as int)").alias("helpfulness_numerator"),
        F.expr("cast(o_orderkey % 9 as int)").alias("helpfulness_denominator"),
        F.expr("cast(least(o_orderkey % 9, o_custkey % 9) as int)").alias("helpful_votes"),
        F.col("o_orderdate").alias("review_time"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.expr("o_orderstatus <> 'P'").alias("verified"),
        F.expr("cast(o_orderkey % 6 as int)").alias("topic_id"),
        F.expr("if(o_orderkey % 5 = 0, null, (o_orderkey % 100) / 100.0D)").alias("predicted_helpfulness"),
        F.expr("((o_orderkey * 37 + o_custkey) % 201 - 100) / 100.0D").alias("compound"),
        F.concat(
            _pick(OPEN, "o_orderkey % 6"), F.lit(" "),
            _pick(BODY, "o_custkey % 8"), F.lit(" "),
            _pick(CLOSE, "(o_orderkey + o_custkey) % 5"),
        ).alias("review_text"),
    )


def numbered_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews where only a third of the texts stay repeated (the rest end in their id)."""
    tag = F.when(F.col("review_id") % 3 != 0, F.concat(F.lit(" #"), F.col("review_id"))).otherwise("")
    return text_reviews(spark, sf_dir).withColumn("review_text", F.concat("review_text", tag))


def aspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aspect sentiment rows, the many side of reviews."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("review_id"),
        _pick(ASPECT_TERMS, "l_linenumber - 1").alias("aspect_term"),
        F.expr(
            "case l_returnflag when 'A' then 'positive' when 'N' then 'neutral' else 'negative' end"
        ).alias("sentiment_label"),
        F.expr("0.5D + abs(l_discount) * 4").alias("confidence"),
    )


def topics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(TOPIC_NAMES)), "topic_id int, name string")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_reviews_from(dealt(spark, sf_dir, "orders", "o_orderkey"))


def raw_reviews_from(orders: DataFrame) -> DataFrame:
    """The public review-CSV layout, with nulls, symbols and non-Latin text."""
    return orders.select(
        F.col("o_orderkey").alias("Id"),
        F.expr("concat('P', lpad(cast(o_custkey % 40 as string), 3, '0'))").alias("ProductId"),
        F.expr("concat('U', cast(o_custkey as string))").alias("UserId"),
        F.expr("if(o_orderkey % 7 = 0, null, concat('Customer ', o_custkey))").alias("ProfileName"),
        F.expr("cast(least(o_orderkey % 9, o_custkey % 9) as int)").alias("HelpfulnessNumerator"),
        F.expr("cast(o_orderkey % 9 as int)").alias("HelpfulnessDenominator"),
        F.expr(
            "if(o_orderkey % 17 = 3, null, cast(1 + (o_orderkey * 7 + o_custkey) % 5 as int))"
        ).alias("Score"),
        F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', o_orderdate)").alias("Time"),
        F.when(F.expr("o_orderkey % 11 <> 0"), F.rtrim(_pick(OPEN, "o_orderkey % 6"), F.lit("."))).alias("Summary"),
        F.when(F.expr("o_orderkey % 13 = 5"), None)
        .when(F.expr("o_custkey % 25 = 1"), F.lit(NON_LATIN))
        .otherwise(
            F.concat(
                _pick(BODY, "o_custkey % 8"),
                F.when(F.expr("o_custkey % 10 = 0"), F.lit(" <b>Love</b> it \U0001f600 café  ")).otherwise(F.lit(" ")),
                _pick(CLOSE, "(o_orderkey + o_custkey) % 5"),
            )
        )
        .alias("Text"),
    )


def scraped_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped scraped rows: every value is the page's text."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.expr("concat('P', lpad(cast(o_custkey % 40 as string), 3, '0'))").alias("product_id"),
        F.expr("concat('Product ', cast(o_custkey % 40 as string))").alias("product_name"),
        F.expr("concat('U', cast(o_custkey as string))").alias("reviewer_name"),
        F.expr(
            "if(o_orderkey % 19 = 4, 'n/a', concat(cast(1 + (o_orderkey * 7 + o_custkey) % 5 as string), '.0'))"
        ).alias("star_rating"),
        F.concat(F.lit(" "), _pick(OPEN, "o_orderkey % 6"), F.lit("  ")).alias("review_title"),
        F.concat(
            F.lit("  "), _pick(BODY, "o_custkey % 8"), F.lit(" \n "), _pick(CLOSE, "(o_orderkey + o_custkey) % 5")
        ).alias("review_text"),
        F.expr(
            "if(o_orderkey % 23 = 6, 'unknown', concat('Reviewed in India on ', date_format(o_orderdate, 'd MMMM yyyy')))"
        ).alias("review_date"),
        F.expr("o_orderstatus <> 'P'").alias("verified"),
        F.expr(
            "case o_orderkey % 4 when 0 then '1,047 people found this helpful' "
            "when 1 then concat(cast(o_custkey % 30 as string), ' people found this helpful') "
            "when 2 then 'One person found this helpful' else '' end"
        ).alias("votes_label"),
        F.expr("concat('Rated ', cast((o_orderkey * 7 + o_custkey) % 7 as string), '.5 out of 5 stars')").alias(
            "stars_label"
        ),
        F.expr("cast(o_custkey % 30 as string)").alias("helpful_votes"),
        F.expr(
            "case o_orderkey % 3 when 0 then '' when 1 then 'http://img/a._SY88.jpg' "
            "else 'http://img/a._SY88.jpg|http://img/b.jpg' end"
        ).alias("image_urls"),
        F.lit("http://shop/page").alias("source_url"),
    )


def labelled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary label, score and thresholded prediction per labelled document."""
    score = (F.col("n_chars") % 100) / 100.0
    return (
        table(spark, sf_dir, "labels")
        .join(table(spark, sf_dir, "documents"), "doc_id")
        .select(
            "doc_id",
            F.col("quality").alias("label"),
            score.alias("score"),
            (score >= 0.5).cast("int").alias("prediction"),
            F.col("lang"),
            "text",
        )
    )


def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review page per scraped row, in the markup the page reader expects."""
    c = F.col
    html = F.concat(
        F.lit("<html><body><ul><li class='x'><a href='/home'>Home</a><p>unclosed<div data-hook='review'><span class='a-profile-name'>"),
        c("reviewer_name"),
        F.lit("</span><i data-hook='review-star-rating'><span aria-label='"), c("stars_label"),
        F.lit("'>stars</span></i><a data-hook='review-title'><span>"), c("review_title"),
        F.lit("</span></a><span data-hook='review-date'>"), c("review_date"),
        F.when(c("verified"), "</span><span data-hook='avp-badge'>Verified Purchase</span>").otherwise("</span>"),
        F.lit("<div><span data-hook='review-body'><span>"), c("review_text"),
        F.lit("</span></span></div><div class='review-image-tile'><img src='http://img/a._SY88.jpg'><img data-src='/rel.png'></div>"),
        F.lit("<span data-hook='helpful-vote-statement'>"), c("votes_label"),
        F.lit("</span></div><li class='a-last'><a href='?page=2'>Next</a></li></ul></body></html>"),
    )
    return scraped_reviews(spark, sf_dir).select(
        c("row_id").alias("page_id"),
        F.concat(F.lit("http://shop.example.com/p/"), c("row_id"), F.lit("?page=1")).alias("url"),
        html.alias("html"),
    )
