"""Properties that hold whatever the data: partitioning, totals, idempotence, decisions."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from starsift import schemas, sql_functions
from starsift.operators import attribution as at
from starsift.operators import cleaning, evaluate, insights, models, resample, similarity
from starsift.plans import annotate as an
from starsift.plans import ingest
from starsift.plans.preprocess import preprocess
from starsift.sources import adapters as ad
from starsift.sources import files
from starsift.streaming import ingest as si


def test_dedupe_is_idempotent_and_partition_free(spark, sf_dir):
    raw = ad.raw_reviews(spark, sf_dir)
    once = preprocess(raw).select("Id").collect()
    other = preprocess(raw.repartition(13)).select("Id").collect()
    assert sorted(r.Id for r in once) == sorted(r.Id for r in other)
    clean = preprocess(raw)
    assert cleaning.dedupe_reviews(clean).count() == clean.count()


def test_slices_tile_the_table(spark, sf_dir):
    raw = ad.raw_reviews(spark, sf_dir)
    want = [r.Id for r in cleaning.drop_null_ingest(raw).orderBy("Id").select("Id").collect()]
    got, step = [], 300
    for offset in range(0, len(want) + step, step):
        part = cleaning.read_review_slice(raw, offset, step, bucket=128).select("Id").collect()
        got += sorted(r.Id for r in part)
    assert got == want


def test_shares_sum_to_hundred(spark, sf_dir):
    shares = insights.rating_share(ad.reviews(spark, sf_dir)).groupBy("product_id").agg(F.sum("pct").alias("p")).collect()
    assert all(abs(r.p - 100) < 1e-9 for r in shares)


def test_confusion_total_and_folds(spark, sf_dir):
    df = ad.labelled_scores(spark, sf_dir)
    assert evaluate.confusion(df, "label", "prediction", [0, 1]).agg(F.sum("n")).first()[0] == df.count()
    r = ad.reviews(spark, sf_dir).select("review_id")
    a = {x.review_id: x.fold for x in evaluate.folds(r, "review_id", 5).collect()}
    b = {x.review_id: x.fold for x in evaluate.folds(r.repartition(7), "review_id", 5).collect()}
    assert a == b and set(a.values()) == set(range(5))
    share = evaluate.split(r, "review_id", 0.2).agg(F.avg(F.col("is_test").cast("int"))).first()[0]
    assert abs(share - 0.2) < 0.05


def test_hot_keys_keep_every_row(spark):
    """A third of the rows share one key, one text and one score."""
    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("review_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id"))).alias("product_id"),
        F.when(F.col("id") % 3 == 0, "the same words").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("review_text"),
        (F.col("id") % 5 + 1).cast("int").alias("star_rating"), F.lit(True).alias("verified"), F.lit(1).alias("helpful_votes"),
    )
    assert insights.duplicate_text(df).count() == n // 3
    assert insights.suspicious_reviews(df).count() == n
    from starsift.operators import windows

    stats = windows.product_stats(df)
    assert stats.count() == n and stats.filter("product_id = 'hot'").first().product_review_count == n // 3


def test_auc_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 400), np.round(rng.random(400), 2)
    df = spark.createDataFrame(list(zip(map(int, y), map(float, s))), "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert abs(evaluate.roc_auc(df, "y", "s", 7).first().auc - want) < 1e-12


def test_attributions_sum_to_margin(spark):
    rng = np.random.default_rng(2)
    x = rng.random((60, 4)) * (rng.random((60, 4)) > 0.4)
    labels = ["negative" if r[0] > 0.3 else "neutral" if r[1] > 0.3 else "positive" for r in x]
    df = spark.createDataFrame([(i, list(map(float, r)), c) for i, (r, c) in enumerate(zip(x, labels))], "id int, x array<double>, label string")
    rows = models.indexed(df.withColumn("features", array_to_vector("x")), "label")
    model = models.logistic_regression(60, iterations=30).fit(rows)
    means = at.feature_means(at.vector_cells(rows, "id", "features"), F.lit(60))
    attr = at.linear_attributions(rows, "id", "features", models.coefficient_rows(spark, model), means)
    got = {(r.id, r.cls): r.s for r in attr.groupBy("id", "cls").agg(F.sum("attribution").alias("s")).collect()}
    margin = (x - x.mean(axis=0)) @ model.coefficientMatrix.toArray().T
    for i in range(60):
        for j, c in enumerate(models.CLASSES):
            assert abs(got[i, c] - margin[i, j]) < 1e-9


def test_lsa_is_the_uncentred_svd(spark):
    rng = np.random.default_rng(3)
    x = rng.random((50, 6)) + 1
    df = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(x)], "id int, x array<double>").withColumn("v", array_to_vector("x"))
    model, reduced = models.lsa(df, "v", 3, 6)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.abs(model.pc.toArray()), np.abs(vt[:3].T), atol=1e-6)
    assert 0 < models.lsa_variance(reduced, "v", "lsa").first().explained <= 1


@pytest.mark.parametrize("sf, cell_rows", [("sf0.01", similarity.CELL_ROWS), ("sf0.1", similarity.CELL_ROWS), ("sf0.1", 100)])
def test_neighbours_against_brute_force(spark, sf, cell_rows):
    """Recall at the defaults, and with many cells; every row has k neighbours at true distances."""
    e = ad.table(spark, f"/root/testdata/{sf}", "embeddings")
    rows = e.collect()
    x = np.array([r.embedding for r in rows], float)
    ids = [r.vec_id for r in rows]
    at = {i: n for n, i in enumerate(ids)}
    far = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (x * x).sum(1) - 2 * x @ x.T, 0))
    np.fill_diagonal(far, np.inf)
    true = {ids[i]: {ids[j] for j in np.argsort(far[i])[:5]} for i in range(len(ids))}
    got = {}
    for r in similarity.neighbours(e, "vec_id", "embedding", 64, 5, cell_rows=cell_rows).collect():
        got.setdefault(r.id, set()).add(r.other)
        assert abs(r.distance - far[at[r.id], at[r.other]]) < 1e-4
    assert all(len(got[i]) == 5 for i in ids)
    assert np.mean([len(true[i] & got[i]) / 5 for i in ids]) >= 0.9


def test_neighbours_are_exact_with_many_cells(spark):
    """Some 200 cells at the default probes, in one group and in two."""
    x = np.random.default_rng(7).normal(size=(2000, 16)).astype(np.float32).astype(float)
    far = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2))
    np.fill_diagonal(far, np.inf)
    df = spark.createDataFrame([(i, i % 2, v.tolist()) for i, v in enumerate(x)], "id long, half int, v array<double>")
    for group in (None, "half"):
        near = far if group is None else np.where((np.arange(2000)[:, None] - np.arange(2000)) % 2, np.inf, far)
        got = similarity.neighbours(df, "id", "v", 16, 5, group=group, cell_rows=10).collect()
        assert {(r.id, r.rank): r.other for r in got} == {(i, n + 1): j for i in range(2000) for n, j in enumerate(np.argsort(near[i])[:5].tolist())}


def test_neighbours_of_a_hot_vector(spark):
    """A third of the rows are one vector: its cell is split and no row goes without neighbours."""
    rng = np.random.default_rng(1)
    rows = [(i, [1.0] * 4 if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(900)]
    got = similarity.neighbours(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", 4, 3, cell_rows=50, probes=3)
    assert {r["count"] for r in got.groupBy("id").count().collect()} == {3}
    assert got.filter("id % 3 = 0 and distance = 0").count() == 900


def test_neighbours_of_copies_are_the_smallest_ids(spark):
    """Equal distances go by id, also among more copies than a block's first picks."""
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 2 else rng.normal(size=4).tolist()) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, v array<float>").orderBy(F.rand(3))
    got = {}
    for r in similarity.neighbours(df, "id", "v", 4, 3, cell_rows=200).collect():
        got.setdefault(r.id, {})[r["rank"]] = r.other
    assert len(got) == 2000
    for i in range(1, 2000, 2):
        assert got[i] == dict(enumerate([j for j in (1, 3, 5, 7) if j != i][:3], 1))


def test_neighbours_in_blocks_and_sides(spark, monkeypatch):
    """Cells cut into many blocks that meet in many tasks give what brute force gives, far from the origin too."""
    for name, value in (("CELL_ROWS", 100), ("BLOCK_ROWS", 60), ("SIDE_ROWS", 150), ("CELLS_AT_ONCE", 1000), ("PAIRS_AT_ONCE", 50)):
        monkeypatch.setattr(similarity, name, value)
    x = (np.random.default_rng(5).normal(size=(900, 8)) + 40).astype(np.float32).astype(float)
    far = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2))
    np.fill_diagonal(far, np.inf)
    df = spark.createDataFrame([(f"r{i:03d}", v.tolist()) for i, v in enumerate(x)], "id string, v array<double>")
    got = similarity.neighbours(df, "id", "v", 8, 4, cell_rows=100).collect()
    assert {(r.id, r["rank"]): r.other for r in got} == {(f"r{i:03d}", n + 1): f"r{j:03d}" for i in range(900) for n, j in enumerate(np.argsort(far[i])[:4].tolist())}


def test_smote_balances_and_interpolates(spark, sf_dir):
    e = ad.table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("label") == 0, "rare").otherwise("common").alias("cls"), "embedding")
    counts = {r.cls: r["count"] for r in e.groupBy("cls").count().collect()}
    for make in (resample.smote, resample.adasyn):
        made = make(e, "vec_id", "cls", "embedding", 64)
        assert {r.cls for r in made.select("cls").distinct().collect()} == {"rare"}
        assert made.count() == counts["common"] - counts["rare"]
        assert made.filter(F.size("embedding") != 64).count() == 0
    under = resample.undersample(e, "vec_id", "cls", 0.5).groupBy("cls").count().collect()
    assert dict((r.cls, r["count"]) for r in under)["rare"] == counts["rare"]
    cleaned = resample.remove_tomek(e, "vec_id", "cls", "embedding", 64)
    assert cleaned.filter("cls = 'rare'").count() == counts["rare"]
    both = resample.smote_tomek(e, "vec_id", "cls", "embedding", 64).groupBy("cls").count().collect()
    assert all(0 < r["count"] <= counts["common"] for r in both)


def test_annotate_fan_out_and_retry(spark, sf_dir, tmp_path):
    r = ad.reviews(spark, sf_dir)
    analysed = an.annotate(r)
    assert analysed.count() + an.rejects(r).count() == r.count()
    want = analysed.agg(F.sum(F.size("entities")), F.sum(F.size("aspect_sentiments"))).first()
    folder = str(tmp_path / "tables")
    for _ in range(2):  # a repeated batch leaves one copy
        ingest.ingest(r, ad.topics(spark), folder, part="0")
    assert spark.read.parquet(f"{folder}/entities").count() == want[0]
    assert spark.read.parquet(f"{folder}/aspect_sentiments").count() == want[1]
    loaded = files.load_summaries(spark, folder)
    assert loaded["product_summary"].agg(F.sum("total_reviews")).first()[0] == r.count()
    assert files.load_summaries(spark, str(tmp_path / "none"))["monthly_sentiment"].count() == 0


def test_csv_round_trip_quarantine_and_resume(spark, sf_dir, tmp_path):
    raw = ad.raw_reviews(spark, sf_dir)
    src = tmp_path / "csv"
    raw.filter("Id < 500").coalesce(1).write.option("escape", '"').csv(str(src / "a"), header=True)
    back = files.read_reviews_csv(spark, str(src / "a"))
    assert back.count() == 500 and back.filter("Text IS NULL").count() == raw.filter("Id < 500 AND Text IS NULL").count()
    (tmp_path / "bad.csv").write_text("Id,ProductId,UserId,ProfileName,HelpfulnessNumerator,HelpfulnessDenominator,Score,Time,Summary,Text\n1,p,u,n,0,0,5,1,s,t\nx,p,u,n,0,0,five,1,s,t\n")
    good, bad = files.validate(files.read_upload(spark, str(tmp_path / "bad.csv")).cache(), ["ProductId", "Score", "Text"])
    assert (good.count(), bad.count()) == (1, 1)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def run():
        si.ingest_available(si.csv_stream(spark, str(src / "*")), out, ckpt).awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 500
    assert run() == 500  # nothing new: nothing repeated
    raw.filter("Id >= 500").coalesce(1).write.option("escape", '"').csv(str(src / "b"), header=True)
    assert run() == raw.count()


def test_stream_retry_after_failure(spark, sf_dir, tmp_path):
    src = str(tmp_path / "src")
    ad.reviews(spark, sf_dir).repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    out, ckpt, calls = str(tmp_path / "out"), str(tmp_path / "ckpt"), []

    def flaky(df):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return df

    def start():
        return si.ingest_available(si.file_stream(spark, src, schema, files_per_trigger=1), out, ckpt, flaky)

    with pytest.raises(Exception):
        start().awaitTermination()
    start().awaitTermination()
    assert spark.read.parquet(out).count() == ad.reviews(spark, sf_dir).count()


def test_stored_tables_and_rebuild(spark, tmp_path):
    files.create_tables(spark, "store_test")
    assert {t.name for t in spark.catalog.listTables("store_test")} == set(schemas.TABLES)
    path = str(tmp_path / "t")
    files.rebuild(spark.range(5), path)
    files.rebuild(spark.read.parquet(path).filter("id > 1"), path)  # reads what it replaces
    assert spark.read.parquet(path).count() == 3


def test_saved_copies(spark, sf_dir, tmp_path):
    r = ad.reviews(spark, sf_dir)
    files.save_reviews(r, str(tmp_path / "copies"))
    assert spark.read.parquet(str(tmp_path / "copies/parquet")).count() == r.count()
    csv = spark.read.csv(str(tmp_path / "copies/csv"), header=True, escape='"')
    assert csv.count() == r.count() and csv.columns == r.columns


def test_sql_functions(spark):
    names = sql_functions.register(spark)
    row = spark.sql("SELECT clean_review_text('<b>a</b>  b 😀'), word_count(' a b '), alert_level(6), lexicon_compound('good')").first()
    assert list(row) == ["a b", 2, "WARNING", 0.4404] and "lexicon_compound" in names


def test_no_python_in_sql_checked_rollups(spark, sf_dir):
    from starsift.queries import load

    registry = load()
    for name in ("product_summary", "aspect_summary", "complaint_taxonomy", "suspicious_reviews", "tfidf_keywords", "readability"):
        plan = registry[name].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
