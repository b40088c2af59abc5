"""Hand-computed rows, edges included."""

from pyspark.sql import functions as F

from starsift.functions import features as ft
from starsift.functions import labels
from starsift.functions import sentiment as fs
from starsift.functions import text as tx
from starsift.operators import corpus, entities, explore, features, insights, sentiment, summaries, topics, windows
from starsift.sources import html_pages


def values(spark, texts, col):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(col(F.col("t")).alias("v")).collect()]


def test_clean_review_text(spark):
    got = values(spark, [None, "", "<b>Nice</b> see www.x.com/a now", "Love it 😀 café", "Хорошийтовар", "a  b"], tx.clean_review_text)
    assert got == ["", "", "Nice see now", "Love it café", "", "a b"]


def test_likely_english(spark):
    assert values(spark, [None, "", "Good one.", "12345", "Good 1"], tx.is_likely_english) == [False, False, True, False, True]


def test_merge(spark):
    rows = spark.createDataFrame([("Great!", "x"), ("Great", "x"), ("", "x")], "s string, t string")
    got = [r[0] for r in rows.select(tx.merge_summary_text(F.col("s"), F.col("t"))).collect()]
    assert got == ["Great! x", "Great. x", "x"]
    got = [r[0] for r in rows.select(tx.merge_raw(F.col("s"), F.col("t"))).collect()]
    assert got == ["Great!. x", "Great. x", "x"]


def test_cleaners_keep_accents(spark):
    assert values(spark, ["Café 12 <i>x</i>!"], tx.clean_text_num) == ["café NUM x"]
    assert values(spark, ["Café 12 <i>x</i>!"], tx.clean_text_nodigits) == ["café x"]
    assert values(spark, ["C++ and C# for 3+ years."], tx.clean_job_text) == ["cpp and csharp for ."]


def test_tokens_and_ngrams(spark):
    assert values(spark, ["  a b ", "", None], tx.words) == [["a", "b"], [], []]
    assert values(spark, ["a b c", "a"], lambda c: tx.ngrams(tx.words(c), 2)) == [["a b", "b c"], []]
    assert values(spark, ["a b c", "a b"], lambda c: tx.ngrams(tx.words(c), 3)) == [["a b c"], []]
    assert values(spark, ["One. Two? v2.0 is out! "], tx.sentences) == [["One.", "Two?", "v2.0 is out!"]]


def test_readability(spark):
    df = spark.createDataFrame([("The cat sat. The dog ran.",), ("",), (None,), ("little handle game",)], "t string")
    rows = features.readability(df, "t").collect()
    assert (rows[0].word_count, rows[0].sentence_count, rows[0].syllable_count) == (6, 2, 6)
    assert (rows[0].flesch_reading_ease, rows[0].flesch_kincaid_grade) == (100.0, 0.0)
    for r in rows[1:3]:
        assert (r.word_count, r.sentence_count, r.flesch_reading_ease, r.flesch_kincaid_grade) == (0, 0, 0.0, 0.0)
    assert rows[3].syllable_count == 2 + 2 + 1


def test_caps_and_tiers(spark):
    assert values(spark, ["BAD BAD BAD", "Bad I OK2 ok", "", None], ft.caps_word_count) == [3, 1, 0, 0]
    got = spark.range(1).select(*[labels.length_tier(F.lit(n)) for n in (0, 1, 20, 21, 200, 201)]).first()
    assert list(got) == [None, "very_short", "very_short", "short", "medium", "long"]


def test_label_boundaries(spark):
    got = spark.range(1).select(
        labels.compound_label(F.lit(0.05)), labels.compound_label(F.lit(-0.05)),
        labels.compound_label_bins(F.lit(0.05)), labels.compound_label_bins(F.lit(-0.05)),
        labels.compound_label(F.lit(0.0), "binary"),
    ).first()
    assert list(got) == ["positive", "negative", "neutral", "negative", "negative"]


def test_defect_counted_once_and_suspicion(spark):
    rows = [
        (1, "p", "2024-01", "Broke on day 2, defective", 1, True, 9),
        (2, "p", "2024-01", "Good", 5, False, 0),
        (3, "p", "2024-01", "BAD BAD BAD", 1, True, 5),
        (4, "p", "2024-01", "same", 3, True, 5), (5, "p", "2024-01", " SAME ", 3, True, 5), (6, "p", "2024-01", "same", 3, True, 5),
    ]
    df = spark.createDataFrame(rows, "review_id int, product_id string, month string, review_text string, star_rating int, verified boolean, helpful_votes int")
    d = insights.defect_rates(df).first()
    assert (d.total_reviews, d.defect_mentions, d.alert) == (6, 1, "CRITICAL")
    s = {r.review_id: r for r in insights.suspicious_reviews(df).collect()}
    assert s[2].suspicion_score == 2 and s[2].suspicion_reasons == "short_5star; unverified_5star_no_votes" and s[2].is_suspicious
    assert s[3].suspicion_score == 0
    assert [s[i].suspicion_reasons for i in (4, 5, 6)] == ["duplicate_text"] * 3


def test_entities(spark):
    text = "My sony WH-1000 and BOSE QC45 have great bass. Boat v2.0 Pro"
    got = values(spark, [text, None], entities.extract_entities)
    first = [(e["text"], e["label"]) for e in got[0]]
    assert first == [("sony", "BRAND"), ("WH-1000", "PRODUCT_MODEL"), ("BOSE", "BRAND"), ("QC45", "PRODUCT_MODEL"),
                     ("bass", "FEATURE"), ("Boat", "BRAND"), ("v2", "PRODUCT_MODEL")]
    assert all(text[e["start"]:e["end"]] == e["text"] for e in got[0]) and got[1] == []
    models = values(spark, ["Galaxy S24 Pro, 5th Gen, v3.1.2"], entities.model_numbers)[0]
    assert [m["text"] for m in models] == ["Galaxy S24", "Pro", "5th Gen", "v3.1.2"]


def test_layers_and_overlaps(spark):
    def ent(t, label, a, b, c):
        return F.struct(F.lit(t).alias("text"), F.lit(label).alias("label"), F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(c).alias("confidence"))

    a = F.array(ent("x", "BRAND", 5, 6, 0.9), ent("y", "BRAND", 0, 4, 0.8))
    b = F.array(ent("x", "FEATURE", 5, 6, 0.7), ent("yz", "FEATURE", 0, 6, 0.95), ent("X", "FEATURE", 9, 10, 0.9))
    row = spark.range(1).select(entities.merge_layers(a, b).alias("m"), entities.resolve_overlaps(F.concat(a, b)).alias("r")).first()
    assert [(e.text, e.label) for e in row.m] == [("y", "BRAND"), ("yz", "FEATURE"), ("x", "BRAND"), ("X", "FEATURE")]
    assert [(e.text, e.label) for e in row.r] == [("yz", "FEATURE"), ("X", "FEATURE")]


def test_noun_phrases(spark):
    df = spark.createDataFrame([(["the", "big", "cat", "ran", "cat", "food", "the", "big", "cat"], ["DT", "JJ", "NN", "VBD", "NN", "NNS", "DT", "JJ", "NN"])], "w array<string>, g array<string>")
    assert df.select(corpus.noun_phrases(F.col("w"), F.col("g"))).first()[0] == ["the big cat", "cat food"]


def test_lexicon_sentiment(spark):
    texts = ["good", "not good", "very good", "good!!!", "", "It is good but the battery is terrible", None]
    got = [tuple(r) for r in values(spark, texts, fs.lexicon_sentiment)]
    c = got[0][0]
    assert got[0] == (0.4404, 1.0, 0.0, 0.0)
    assert got[1][0] < 0 < got[2][0] and got[2][0] > c
    assert got[3][0] > c and got[4] == got[6] == (0.0, 0.0, 0.0, 0.0)
    assert got[5][0] < 0


def test_aspect_sentiment(spark):
    df = spark.createDataFrame([(1, "Great battery. Terrible screen."), (2, "Nothing here")], "id int, t string")
    got = {(r.id, r.aspect): r for r in sentiment.aspect_sentiment(df, "id", "t", F.array(F.lit("battery"), F.lit("screen"), F.lit("price"))).collect()}
    assert got[1, "battery"].sentiment_label == "positive" and got[1, "screen"].sentiment_label == "negative"
    assert (got[1, "price"].sentiment_label, got[1, "price"].confidence) == ("neutral", 0.5)
    assert len(got) == 6


def test_rake_and_taxonomy(spark):
    df = spark.createDataFrame([(1, "deep learning for big data and deep learning")], "id int, t string")
    got = {r.phrase: round(r.score, 3) for r in corpus.rake(df, "id", "t").collect()}
    assert got == {"deep learning": 1.0, "big data": 1.0}
    found = corpus.match_taxonomy(spark.createDataFrame([("C++ or R with PyTorch; learning",)], "t string"), "t").first().found
    assert found["frameworks"] == ["pytorch"] and "r" in found["languages"] and "c++" in found["languages"]


def test_summary_points(spark):
    text = "A long enough point. <br/> A long enough point. | Another long point here | short | SHORT | last"
    every = ["A long enough point. A long enough point.", "Another long point here", "short", "last"]
    assert values(spark, [text], summaries.summary_points) == [every]
    assert values(spark, [text], lambda c: summaries.summary_points(c, longer_than=15)) == [every[:2]]
    assert values(spark, [text], lambda c: summaries.summary_points(c, most=1)) == [every[:1]]


def test_topic_trend_counts_empty_months(spark):
    months = [f"2024-0{m}" for m in range(1, 7)]
    rows = [("a", m) for m in months[:3]] + [("b", m) for m in months for _ in range(3)]
    got = {r.topic: r.trend_pct for r in topics.topic_trend(spark.createDataFrame(rows, "topic string, month string"), "topic").collect()}
    assert got == {"a": -50.0, "b": 0.0}
    few = topics.topic_trend(spark.createDataFrame(rows[:2], "topic string, month string"), "topic").first()
    assert few.trend_pct is None and few.months == 2


def test_histogram_of_equal_values(spark):
    df = spark.createDataFrame([(3,), (3,), (None,)], "x int")
    rows = explore.histogram(spark, df, "x", 4).collect()
    assert sum(r.n for r in rows) == 2 and len(rows) == 4


def test_html_reader(spark):
    html = """<div class="a-section review"><span class="a-profile-name"> Ann </span>
      <a class="star-rating-4" title="4.0 out of 5 stars"></a><span data-hook="review-title">Nice</span>
      <span data-hook="review-body"><span>Works <b>well</b><p>yes</span></span>
      <img data-hook="review-image" src="http://i/a._SY88.jpg"><span class="verified-purchase-badge">V</span></div>
      <div class="other"><span data-hook="review-body">outside</span></div><a aria-label="Next page" href="/p2">n</a>"""
    pages = spark.createDataFrame([(1, "http://s/x/p1", html), (2, "http://s/y", None), (3, "u", "<p>none</p>")], "page_id long, url string, html string")
    rows = html_pages.pages_to_reviews(pages).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.reviewer_name, r.star_rating, r.review_title, r.review_text) == ("Ann", 4.0, "Nice", "Workswellyes")
    assert (r.verified, r.helpful_votes, r.image_urls) == (True, 0, "http://i/a._SL500_.jpg")
    assert html_pages.next_page_links(pages).collect()[0].to_url == "http://s/p2"


def test_top_n_ties_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v int").withColumn("id", F.monotonically_increasing_id())
    assert windows.top_n_by(df, ["k"], [F.desc("v"), F.asc("id")], 1).count() == 2
    assert windows.with_group_stats(df, ["k"], {"n": F.count("*")}).count() == 3
