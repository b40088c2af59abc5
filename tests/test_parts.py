"""Versioned parts: atomic switches, and summaries from partial tables equal to those of all reviews."""

import pytest
from pyspark.sql import functions as F

from starsift.operators import partials
from starsift.plans import increments, summaries
from starsift.sources import adapters as ad
from starsift.sources import parts


def values(df):
    return sorted(r[0] for r in df.collect())


def rows_of(df):
    rounded = df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)])
    return sorted(map(tuple, rounded.collect()), key=repr)


def test_commits(spark, tmp_path):
    folder = str(tmp_path)
    one = lambda *xs: {"t": spark.createDataFrame([(x,) for x in xs], "x int")}
    assert parts.latest(spark, folder) == 0
    with pytest.raises(LookupError):
        parts.read(spark, folder, "t")
    assert parts.commit(spark, folder, "a", one(1, 2)) == 1
    assert parts.commit(spark, folder, "b", one(3) | {"u": spark.range(4)}) == 2
    before = parts.read(spark, folder, "t")
    assert parts.commit(spark, folder, "a", one(5)) == 3  # a repeated part replaces its rows
    assert values(parts.read(spark, folder, "t")) == [3, 5] and values(before) == [1, 2, 3]
    assert values(parts.read(spark, folder, "t", 1)) == [1, 2] and values(parts.read(spark, folder, "t", 2)) == [1, 2, 3]
    broken = spark.range(1).select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception, match="no"):  # neither table of a failed commit is seen
        parts.commit(spark, folder, "c", one(9) | {"u": broken})
    assert parts.latest(spark, folder) == 3 and values(parts.read(spark, folder, "t")) == [3, 5]
    assert parts.commit(spark, folder, "all", {"t": parts.read(spark, folder, "t").select((F.col("x") * 2).alias("x"))}, only=True) == 4
    assert values(parts.read(spark, folder, "t")) == [6, 10] and values(parts.read(spark, folder, "u")) == [0, 1, 2, 3]
    assert parts.remove(spark, folder, "all") == 5
    with pytest.raises(LookupError):
        parts.read(spark, folder, "t")
    assert values(parts.read(spark, folder, "t", 4)) == [6, 10]
    assert parts.unused(spark, folder, 1).count() == 0
    gone = {r.version for r in parts.unused(spark, folder, 4).collect()}
    assert gone == {1, 2, 3}
    assert parts.unused(spark, folder, 5).filter("version = 4").count() == 1
    empty = {"e": spark.createDataFrame([], "x int, y string")}
    parts.commit(spark, folder, "a", empty)
    assert parts.read(spark, folder, "e").count() == 0 and parts.read(spark, folder, "e").columns == ["x", "y"]


def test_two_writers_of_one_version(spark, tmp_path):
    folder = str(tmp_path)
    for part in "ab":
        place = f"{folder}/data/{part}"
        spark.range(2).write.parquet(place)
        row = [(1, "t", part, place, spark.range(2).schema.json())]
        spark.createDataFrame(row, parts.LOG).coalesce(1).write.mode("append").parquet(f"{folder}/log")
    assert values(parts.read(spark, folder, "t")) == [0, 0, 1, 1]


def test_increments_equal_whole_rebuild(spark, sf_dir, tmp_path):
    reviews, aspects, topics = ad.reviews(spark, sf_dir), ad.aspects(spark, sf_dir), ad.topics(spark)
    folder = str(tmp_path)
    of = lambda df, i: df.filter(F.pmod(F.xxhash64("review_id"), F.lit(3)) == i)
    increments.add_part(of(reviews, 1), of(aspects, 1), folder, "0")  # a wrong batch, replaced below
    for i in range(3):
        increments.add_part(of(reviews, i), of(aspects, i), folder, str(i))
    want = summaries.rebuild_all(reviews, aspects, topics)
    got = increments.summaries(spark, folder, topics)
    assert set(got) == set(want)
    for name, df in want.items():
        assert rows_of(got[name]) == rows_of(df), name
    first = increments.summaries(spark, folder, topics, 1)["product_summary"].agg(F.sum("total_reviews")).first()[0]
    assert first == of(reviews, 1).count()
    # adding a part reads no place of another part
    plan = partials.partial_summaries(of(reviews, 0), of(aspects, 0))["product_partial"].inputFiles()
    assert not any(folder in p for p in plan)
    files = [f for df in got.values() for f in df.inputFiles()]
    assert files and all("_partial-" in f for f in files if folder in f)
    assert parts.read(spark, folder, "reviews").count() == reviews.count()


def test_null_and_empty_parts(spark, tmp_path):
    folder = str(tmp_path)
    schema = "review_id long, product_id string, star_rating int, predicted_helpfulness double, review_time timestamp, topic_id int"
    aspects = spark.createDataFrame([(1, "a", "positive", None), (1, None, None, 0.5)], "review_id long, aspect_term string, sentiment_label string, confidence double")
    reviews = spark.createDataFrame([(1, None, None, None, None, None), (2, "p", 1, None, None, None)], schema)
    increments.add_part(reviews.limit(0), aspects.limit(0), folder, "empty")
    topics = ad.topics(spark)
    assert all(df.count() == 0 for df in increments.summaries(spark, folder, topics).values())
    increments.add_part(reviews, aspects, folder, "nulls")
    want = summaries.rebuild_all(reviews, aspects, topics)
    for name, df in increments.summaries(spark, folder, topics).items():
        assert rows_of(df) == rows_of(want[name]), name
