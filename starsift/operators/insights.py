"""Complaint, defect, aspect, authenticity and KPI tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import features as ft
from starsift.functions import labels
from starsift.functions import text as tx
from starsift.operators import windows


def _rows(df: DataFrame, names: list[str], fields: dict[str, str], key: str, keep: list[str]) -> DataFrame:
    """Turn columns ``<field>_<i>`` into one row per name (bounded by the taxonomy, not the data)."""
    structs = [
        F.struct(F.lit(n).alias(key), *[F.col(f"{src}_{i}").alias(out) for out, src in fields.items()])
        for i, n in enumerate(names)
    ]
    return df.select(*keep, F.inline(F.array(*structs)))


def _flagged(df: DataFrame, text: str, groups: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """``keep`` columns plus one boolean ``h_<i>`` per keyword group. The lower-cased text is
    projected first, so it is computed once per row and not once per keyword."""
    low = df.select(*keep, F.lower(F.col(text)).alias("_low"))
    return low.select(*keep, *[tx.contains_any(F.col("_low"), w).alias(f"h_{i}") for i, w in enumerate(groups.values())])


def analyse_complaints(
    df: DataFrame, text: str = "review_text", groups=fv.COMPLAINT_KEYWORDS, weights=fv.SEVERITY_WEIGHTS
) -> DataFrame:
    """Complaint groups over reviews of at most three stars, ranked by severity (one pass)."""
    low_star = F.col("star_rating") <= 3
    aggs = [F.count("*").alias("n_all"), F.count_if(low_star).alias("n_neg")]
    for i in range(len(groups)):
        hit = F.col(f"h_{i}") & low_star
        aggs.append(F.count_if(hit).alias(f"c_{i}"))
        aggs.append(F.avg(F.when(hit, F.col("star_rating"))).alias(f"s_{i}"))
    names = list(groups)
    rows = _rows(_flagged(df, text, groups, ["star_rating"]).agg(*aggs), names, {"mention_count": "c", "avg_star_rating": "s"}, "complaint", ["n_all", "n_neg"])
    weight = F.element_at(F.create_map(*[F.lit(x) for n in names for x in (n, float(weights.get(n, 1.0)))]),
                          F.col("complaint"))
    n = F.col("mention_count")
    return (
        rows.filter(n > 0)
        .select(
            "complaint",
            "mention_count",
            (n * 100.0 / F.greatest("n_neg", F.lit(1))).alias("pct_neg_reviews"),
            (n * 100.0 / F.greatest("n_all", F.lit(1))).alias("pct_all_reviews"),
            "avg_star_rating",
            weight.alias("severity_weight"),
            (n * weight * (4 - F.col("avg_star_rating"))).alias("severity_score"),
        )
        .orderBy(F.desc("severity_score"), "complaint")
    )


def defect_rates(
    df: DataFrame, text: str = "review_text", words=tuple(fv.DEFECT_KEYWORDS), warn: float = 5.0, crit: float = 10.0
) -> DataFrame:
    """Defect mention rate per product and month with its alert level."""
    keyed = df.filter(F.col("product_id").isNotNull() & F.col("month").isNotNull())
    flagged = _flagged(keyed.withColumn("_has", F.col(text).isNotNull()), text, {"defect": words}, ["product_id", "month", "_has"])
    per = flagged.groupBy("product_id", "month").agg(
        F.count_if("_has").alias("total_reviews"), F.count_if("h_0").alias("defect_mentions")
    )
    rate = F.coalesce(F.try_divide(F.col("defect_mentions") * 100.0, F.col("total_reviews")), F.lit(0.0))
    return per.withColumn("defect_rate_pct", rate).withColumn(
        "alert", labels.alert_level(F.col("defect_rate_pct"), warn, crit)
    )


def aspect_keyword_sentiment(df: DataFrame, text: str = "review_text", aspects=fv.ASPECT_KEYWORDS) -> DataFrame:
    """Mentions and polarity hits per aspect. A text may count as both positive and
    negative, so ``neutral`` can be below zero, as in the surveyed behaviour."""
    low = df.select(F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_low"))
    padded = low.select("_low", tx.spaced(F.col("_low")).alias("_pad"))
    marked = padded.select(
        tx.contains_any(F.col("_low"), fv.ASPECT_POSITIVE).alias("pos"),
        tx.contains_any(F.col("_low"), fv.ASPECT_NEGATIVE).alias("neg"),
        *[tx.contains_word_in(F.col("_pad"), w).alias(f"a_{i}") for i, w in enumerate(aspects.values())],
    )
    aggs = [F.count("*").alias("n_all")]
    for i in range(len(aspects)):
        hit = F.col(f"a_{i}")
        aggs += [
            F.count_if(hit).alias(f"m_{i}"),
            F.count_if(hit & F.col("pos")).alias(f"p_{i}"),
            F.count_if(hit & F.col("neg")).alias(f"n_{i}"),
        ]
    rows = _rows(
        marked.agg(*aggs), list(aspects), {"mentions": "m", "positive": "p", "negative": "n"}, "aspect", ["n_all"]
    ).filter(F.col("mentions") > 0)
    m, p, n = F.col("mentions"), F.col("positive"), F.col("negative")
    return rows.select(
        "aspect",
        "mentions",
        (m * 100.0 / F.col("n_all")).alias("mention_pct"),
        "positive",
        "negative",
        (m - p - n).alias("neutral"),
        (p * 100.0 / m).alias("pos_pct"),
        (n * 100.0 / m).alias("neg_pct"),
        ((p - n) / m).alias("net_sentiment"),
    ).orderBy(F.desc("mentions"), "aspect")


def kpis(df: DataFrame) -> DataFrame:
    """Headline figures in one global aggregate; velocity from the newest review date."""
    s = F.col("star_rating")
    newest = df.agg(F.max("review_time").alias("m")).scalar()
    cut = newest - F.expr("INTERVAL 30 DAYS")
    start = cut - F.expr("INTERVAL 30 DAYS")
    t = F.col("review_time")

    def pct(condition: Column) -> Column:
        return F.count_if(condition) * 100.0 / F.count("*")

    return df.agg(
        F.count("*").alias("total_reviews"),
        F.avg(s).alias("avg_star_rating"),
        pct(s >= 4).alias("pct_positive"),
        pct(s <= 2).alias("pct_negative"),
        (pct(s == 5) - pct(s == 1)).alias("nps_proxy"),
        pct(F.col("verified")).alias("verified_pct"),
        F.avg("helpful_votes").alias("avg_helpful_votes"),
        F.count_if(t >= cut).alias("recent"),
        F.count_if((t >= start) & (t < cut)).alias("prior"),
        F.countDistinct("product_id").alias("products_analysed"),
    ).select(
        "*", ((F.col("recent") - F.col("prior")) * 100.0 / F.greatest("prior", F.lit(1))).alias("review_velocity_chg")
    ).drop("recent", "prior")


def _text_digest(col: str) -> Column:
    """256-bit digest of the lower-cased, stripped text: shuffled instead of whole texts.

    Never null (a null text gets "", which no digest equals): a nullable join key would add a
    pushed-down null check that computes the digest a second time.
    """
    return F.coalesce(F.sha2(tx.strip(F.lower(F.col(col))), 256), F.lit(""))


def _repeated(keyed: DataFrame, more_than: int, name: str) -> DataFrame:
    counted = keyed.groupBy("_h").agg(F.count("*").alias("_n"))
    return counted.filter((F.col("_n") > more_than) & (F.col("_h") != "")).select(F.col("_h").alias(name))


def duplicate_text(df: DataFrame, text: str = "review_text", more_than: int = 2) -> DataFrame:
    """Rows whose text occurs more than ``more_than`` times.

    Digests are counted first (one row per distinct text leaves each task), then
    the repeated ones are semi-joined; a text held by a third of all rows is one
    digest on the small side and its rows spread by the skew-join split.
    """
    keyed = df.withColumn("_h", _text_digest(text))
    return keyed.join(_repeated(keyed, more_than, "_h"), "_h", "left_semi").drop("_h")


def suspicious_reviews(df: DataFrame, text: str = "review_text") -> DataFrame:
    """Four authenticity signals, their reasons, and a flag at two points."""
    keyed = df.withColumn("_h", _text_digest(text))
    repeated = _repeated(keyed, 2, "_dup")
    joined = keyed.join(repeated, F.col("_h") == F.col("_dup"), "left")
    five = F.col("star_rating") == 5
    signals = [
        ("short_5star", 1, (tx.word_count(F.col(text)) < 6) & five),
        ("excessive_caps", 1, (ft.caps_letter_ratio(F.col(text)) > 0.5) & five),
        ("unverified_5star_no_votes", 1, ~F.col("verified") & five & (F.col("helpful_votes") == 0)),
        ("duplicate_text", 2, F.col("_dup").isNotNull()),
    ]
    score = sum((F.when(F.coalesce(c, F.lit(False)), w).otherwise(0) for _, w, c in signals), F.lit(0))
    reasons = F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, _, c in signals])), "; ")
    return joined.withColumns(
        {"suspicion_score": score, "suspicion_reasons": reasons, "is_suspicious": score >= 2}
    ).drop("_h", "_dup")


def suspicious_rate(flagged: DataFrame) -> DataFrame:
    return flagged.agg((F.count_if("is_suspicious") * 100.0 / F.count("*")).alias("suspicious_pct"))


def rating_share(df: DataFrame) -> DataFrame:
    """Percent of each product's reviews per star (rows of a product sum to 100)."""
    cells = df.filter(F.col("product_id").isNotNull() & F.col("star_rating").isNotNull())
    counted = cells.groupBy("product_id", "star_rating").agg(F.count("*").alias("n"))
    return windows.share_of(counted, ["product_id"], "n", name="pct")


def monthly_volume(df: DataFrame) -> DataFrame:
    s = F.col("star_rating")
    return df.filter(F.col("month").isNotNull()).groupBy("month").agg(
        F.count("review_text").alias("total"), F.count_if(s >= 4).alias("pos"), F.count_if(s <= 2).alias("neg")
    )


def complaint_matrix(df: DataFrame, text: str = "review_text", groups=fv.COMPLAINT_KEYWORDS) -> DataFrame:
    """Share of each product's reviews of at most three stars that mention each complaint."""
    low = _flagged(df.filter(F.col("star_rating") <= 3), text, groups, ["product_id"])
    agg = low.groupBy("product_id").agg(
        F.count("*").alias("n_neg"), *[F.count_if(f"h_{i}").alias(f"c_{i}") for i in range(len(groups))]
    )
    rows = _rows(agg, list(groups), {"mentions": "c"}, "complaint", ["product_id", "n_neg"])
    return rows.select("product_id", "complaint", (F.col("mentions") * 100.0 / F.col("n_neg")).alias("pct"))


def complaint_by_star(df: DataFrame, text: str = "review_text", groups=fv.COMPLAINT_KEYWORDS) -> DataFrame:
    """Complaint share at one, two and three stars for every complaint group."""
    names = list(groups)
    flagged = _flagged(df, text, {n: groups[n] for n in names}, ["star_rating"])
    aggs = []
    for i in range(len(names)):
        for star in (1, 2, 3):
            at = F.col("star_rating") == star
            share = F.try_divide(F.count_if(F.col(f"h_{i}") & at) * 100.0, F.count_if(at))
            aggs.append(F.coalesce(share, F.lit(0.0)).alias(f"s{star}_{i}"))
    fields = {f"pct_{k}star": f"s{k}" for k in (1, 2, 3)}
    return _rows(flagged.agg(*aggs), names, fields, "complaint", [])


def complaint_trend(df: DataFrame, name: str, text: str = "review_text", groups=fv.COMPLAINT_KEYWORDS) -> DataFrame:
    """Monthly rate of one complaint group over all reviews."""
    dated = df.filter(F.col("month").isNotNull()).withColumn("_has", F.col(text).isNotNull())
    return (
        _flagged(dated, text, {name: groups[name]}, ["month", "_has"])
        .groupBy("month")
        .agg(F.count_if("_has").alias("total"), F.count_if("h_0").alias("complaint"))
        .withColumn("rate", F.try_divide(F.col("complaint") * 100.0, F.col("total")))
    )


def batch_insights(annotated: DataFrame, aspects: DataFrame, n: int = 5) -> DataFrame:
    """Sentiment counts and the most praised and most criticised aspects, in long form."""
    sentiments = annotated.groupBy(F.col("overall_sentiment").alias("name")).agg(F.count("*").alias("n"))
    per_aspect = aspects.filter(F.col("sentiment_label").isin("positive", "negative")).groupBy(
        F.when(F.col("sentiment_label") == "positive", "praise").otherwise("complaint").alias("kind"),
        tx.capitalize(F.replace("aspect_term", F.lit(" "), F.lit("_"))).alias("name"),
    ).agg(F.count("*").alias("n"))
    top = windows.top_n_by(per_aspect, ["kind"], [F.desc("n"), F.asc("name")], n)
    return sentiments.select(F.lit("sentiment").alias("kind"), "name", "n", F.lit(0).alias("rank")).unionByName(top)


def recommendations(insights: DataFrame) -> DataFrame:
    """Sentences from the top two complaints and praises, or a default line when there are none."""
    improve = F.format_string(
        "Improve %s quality. It is a recurring pain point mentioned in %d negative customer reviews.",
        F.lower("name"), "n",
    )
    highlight = F.format_string(
        "Highlight %s performance in marketing campaigns, as it is praised in %d positive reviews.",
        F.lower("name"), "n",
    )
    lines = insights.filter(F.col("kind").isin("complaint", "praise") & (F.col("rank") <= 2)).select(
        F.when(F.col("kind") == "complaint", 1).otherwise(2).alias("part"),
        "rank",
        F.when(F.col("kind") == "complaint", improve).otherwise(highlight).alias("recommendation"),
    )
    default = lines.agg(F.count("*").alias("n")).filter(F.col("n") == 0).select(
        F.lit(3).alias("part"),
        F.lit(1).alias("rank"),
        F.lit("Monitor product reception to gather performance points.").alias("recommendation"),
    )
    return lines.unionByName(default)


def brand_sentiment(mentions: DataFrame, brands: str = "brands", score: str = "compound") -> DataFrame:
    """Mean, count and sample deviation of a score per brand (brands pipe-joined per review)."""
    brand = F.explode(F.transform(F.split(F.coalesce(brands, F.lit("")), r"\|"), tx.strip))
    return (
        mentions.select(brand.alias("brand"), F.col(score).alias("sentiment"))
        .filter(F.col("brand") != "")
        .groupBy("brand")
        .agg(
            F.avg("sentiment").alias("avg_sentiment"),
            F.count("sentiment").alias("review_count"),
            F.stddev_samp("sentiment").alias("sentiment_std"),
        )
        .orderBy(F.desc("review_count"), "brand")
    )
