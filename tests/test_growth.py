"""Plans whose shuffles and broadcasts must not grow with rows times terms."""

import re

import pytest
from pyspark.sql import functions as F

from starsift.operators import attribution, corpus, models, topics


@pytest.fixture
def plain(spark):
    """Plans as they are for large tables: nothing is broadcast because it happens to be small, nothing replanned."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    for k, v in before.items():
        spark.conf.set(k, v)


def test_absent_features_need_no_join_by_row(spark, plain):
    """Repeated keys have a row each time, null keys meet no cell, and no table of one row per key is joined."""
    rows = models.corpus.sparse_column(F.col("i"), F.col("v"), 3)
    df = spark.createDataFrame(
        [(1, [0], [1.0]), (1, [1], [2.0]), (2, [], []), (None, [0], [3.0])], "id long, i array<int>, v array<double>"
    ).select("id", rows.alias("features"))
    weights = spark.createDataFrame([("a", 0, 1.0), ("a", 1, -2.0), ("b", 0, 0.5)], "cls string, idx int, coefficient double")
    means = spark.createDataFrame([(0, 0.5), (1, 0.25)], "idx int, mean double")
    out = attribution.linear_attributions(df, "id", "features", weights, means)
    rest = sorted((r.id or 0, r.cls, r.attribution) for r in out.filter("idx = -1").collect())
    # totals: a 0.5 - 0.5 = 0, b 0.25; seen by id 1: a 0.5 - 0.5 = 0, b 0.25
    assert rest == [(0, "a", 0.0), (0, "b", -0.25), (1, "a", 0.0), (1, "a", 0.0), (1, "b", 0.0), (1, "b", 0.0), (2, "a", 0.0), (2, "b", -0.25)]
    assert not re.search(r"Join.*\[id#\d+L", plain(out))


def test_vectors_are_not_shuffled_by_term(spark, plain):
    texts = spark.createDataFrame([(i, f"common word{i % 3}") for i in range(20)], "id long, text string").repartition(4, "id")
    counts = corpus.term_counts(texts, "id", "text")
    vocab = spark.createDataFrame([("common", 1.0, 0), ("word1", 2.0, 1)], "term string, idf double, idx int")
    out = corpus.tfidf_vectors(texts, counts, vocab, "id", 2)
    assert "hashpartitioning(term" not in plain(out) and "Window" not in plain(out)
    assert [r.tfidf.numNonzeros() for r in out.orderBy("id").collect()] == [1, 2, 1] * 6 + [1, 2]


def test_classes_are_not_shuffled(spark, plain):
    df = spark.createDataFrame([(i, "positive" if i else "neutral") for i in range(9)], "id long, label string")
    out = models.indexed(df, "label")
    assert "SortMergeJoin" not in plain(out)
    assert {(r.label, r.label_index, r.weight) for r in out.collect()} == {("positive", 2.0, 9 / 16), ("neutral", 1.0, 4.5)}


def test_tokens_are_not_shuffled(spark, plain):
    df = spark.createDataFrame([(1, "Good camera, good"), (1, "bad"), (None, "good"), (2, "plain")], "id long, text string")
    attr = spark.createDataFrame([(1, "good", 0.5), (1, "good", 0.5), (1, "bad", -2.0), (None, "good", 9.0), (1, "good camera", 7.0)], "id long, feature string, attribution double")
    out = attribution.token_contributions(df, "id", "text", attr)
    assert plain(out).count("SortMergeJoin") == 1
    got = sorted((r.id or 0, r.pos, r.token, r.contribution, round(r.intensity, 6)) for r in out.collect())
    assert got == [(0, 0, "good", 0.0, 0.0), (1, 0, "Good", 1.0, 0.5), (1, 0, "bad", -2.0, 1.0), (1, 1, "camera", 0.0, 0.0), (1, 2, "good", 1.0, 0.5), (2, 0, "plain", 0.0, 0.0)]


def test_texts_are_split_once_for_a_whole_vocabulary(spark, plain):
    """Vocabulary and lookup read one exchange of the counts; repeated and null keys count as they do by aggregation."""
    texts = spark.createDataFrame([(1, "red red car"), (1, "car red"), (2, "blue car"), (None, "blue"), (3, None), (4, "a")], "id long, text string")
    for out in (corpus.tfidf(texts, "id", "text", 2), topics.embed_hashed(texts.filter("id > 1"), "id", "text", 16)):
        assert plain(out).count("regexp_extract_all") == 1 and "ReusedExchange" in plain(out)
    both = [sorted((r.id or 0, r.term, r.tf) for r in f(texts, "id", "text", 2).collect()) for f in (corpus.term_counts, corpus.document_counts)]
    assert both[0] == both[1] and (1, "car red", 1) in both[1] and (1, "red car", 1) in both[1] and (0, "blue", 1) in both[1]
    assert corpus.document_counts(texts.limit(0), "id", "text", 2).count() == 0
