"""Fits on small data: schema, probabilities, repeatability, better than guessing."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.operators import corpus, models, topics
from starsift.plans import training
from starsift.sources import adapters as ad


@pytest.fixture(scope="module")
def rows(spark):
    texts = {"positive": "great lovely screen", "negative": "awful broken battery", "neutral": "plain ordinary box"}
    data = [(i, c, f"{texts[c]} word{i % 7} item{i % 5}") for i, c in enumerate(list(texts) * 60)]
    df = spark.createDataFrame(data, "review_id long, label string, text string")
    return models.text_vectors(models.indexed(df, "label"), "review_id", "text", 50, 1)


def test_classifiers_beat_guessing(spark, rows):
    df, vocab = rows
    n = df.count()
    for est in (models.logistic_regression(n, iterations=30), models.naive_bayes(), models.random_forest(10, 5)):
        out = models.predict_batch(df, est.fit(df))
        assert out.filter(F.abs(F.col("p_negative") + F.col("p_neutral") + F.col("p_positive") - 1) > 0.001).count() == 0
        assert out.filter("label = predicted_label").count() / n > 0.9
    svc, calibrate = models.fit_calibrated_svc(df, "review_id", n, iterations=20)
    scored = models.apply_calibrated(df, svc, calibrate)
    assert scored.filter("label_index = prediction").count() / n > 0.9
    top = models.top_coefficients(spark, models.logistic_regression(n, iterations=30).fit(df), vocab, n=3)
    best = {r.term for r in top.filter("cls = 'negative'").collect()}
    assert best <= {"awful", "broken", "battery"}


def test_searches(spark, rows):
    df, _ = rows
    cv = models.grid_search(df, models.naive_bayes(), {"smoothing": [0.1, 1.0]}, 2)
    assert models.search_results(spark, cv).count() == 2
    a = models.random_search(df, models.naive_bayes(), {"smoothing": (0.01, 10.0)}, draws=2, folds=2)
    b = models.random_search(df, models.naive_bayes(), {"smoothing": (0.01, 10.0)}, draws=2, folds=2)
    assert a.avgMetrics == b.avgMetrics
    best, _, table = models.compare_models(df, {"nb": models.naive_bayes(), "rf": models.random_forest(3, 2)}, 2)
    assert table.count() == 2 and best in {"nb", "rf"}


def test_topics(spark, rows):
    df, _ = rows
    base = df.select("review_id", "text")
    assigned, names = topics.topic_model(base, "review_id", "text", k=3, dim=32, components=3)
    assert assigned.count() == base.count() and names.count() == 3
    e = topics.embed_tfidf(base, "review_id", "text", 384)
    assert e.filter(F.size("embedding") != 384).count() == 0
    cv, lda, out = topics.lda_fit(base, "text", 3, iterations=5)
    total = F.aggregate("topic_distribution", F.lit(0.0), lambda a, x: a + x)
    assert out.filter(F.abs(total - 1) > 1e-6).count() == 0 and topics.lda_labels(cv, lda).count() == 3


def test_train_all(spark, sf_dir, tmp_path):
    out = training.train_all(ad.raw_reviews(spark, sf_dir), str(tmp_path), n_topics=3, dim=32, trees=3)
    assert out["topics"].count() == 3
    assert out["helpfulness"].first().rmse >= 0
    model = models.load_model(f"{tmp_path}/helpfulness_model")
    assert models.importances(spark, model).count() == len(fv.HELPFULNESS_COLUMNS)
    assert spark.read.parquet(f"{tmp_path}/summaries").count() > 0
    plain = models.score_helpfulness(spark.range(2), None)
    assert [r.predicted_helpfulness for r in plain.collect()] == [0.5, 0.5]


def test_topic_fit_stores_vectors_without_the_grams(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(topics.durable, "stored", lambda df, name, store=topics.durable.stored: kept.append(df.columns) or store(df, name))
    base = spark.createDataFrame([(i, "good sound quality" if i % 2 else "broken screen arrived") for i in range(20)], "id int, text string")
    _, _, out = topics.lda_fit(base, "text", 2, iterations=2)
    assert kept == [["id", "text", "_v"]]
    assert out.columns == ["id", "text", "topic_distribution"] and out.count() == 20


def test_text_feature_block_widths(spark):
    """Words, nothing and no text at all: every row gets the block, and each signal is standardised over the rows."""
    texts = ["Great screen, but the battery is poor!", "The battery is great. 12 hours", "Is the screen better?", "", None]
    df = spark.createDataFrame([(i, texts[i % 5]) for i in range(20)], "id int, text string")
    out = models.text_feature_block(df, "id", "text", 16, 3)
    assert out.columns == ["id", "text", "text_features"]
    found = out.select("id", vector_to_array("text_features").alias("f")).collect()
    assert sorted(r.id for r in found) == list(range(20)) and {len(r.f) for r in found} == {14}
    assert all(abs(sum(r.f[i] for r in found)) < 1e-6 for i in range(14))


@pytest.mark.parametrize("name", ["_v", "_i", "tfidf"])
def test_vector_column_may_have_any_name(spark, name):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "id int, text string")
    counts = corpus.term_counts(df, "id", "text", tokens=F.split("text", " "))
    vocab = corpus.indexed_vocabulary(corpus.vocabulary(counts, F.lit(2)))
    out = corpus.tfidf_vectors(df, counts, vocab, "id", 2, name=name)
    assert out.columns == ["id", "text", name] and {r.id: r[name].numNonzeros() for r in out.collect()} == {1: 2, 2: 0}
