"""Classical models on Spark ML: features, fits, searches, scoring."""

import random

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import features as ft
from starsift.functions import text as tx
from starsift.operators import corpus, evaluate, features, sentiment, topics
from starsift.operators.windows import top_n_by
from starsift.sources import durable

CLASSES = ["negative", "neutral", "positive"]


# --- features ---------------------------------------------------------------------


def text_vectors(df: DataFrame, key: str, text: str, max_features: int = 5000, max_n: int = 2, min_df: int = 2,
                 max_df: float = 0.95, extra: list[str] = (), name: str = "features") -> tuple[DataFrame, DataFrame]:
    """Sublinear TF-IDF vectors, optionally joined by numeric columns: (rows, vocabulary)."""
    counts, vocab = topics.fit_vocabulary(df, key, text, max_features, max_n, min_df, max_df)
    vocab = durable.materialise(vocab)
    column = "_tfidf" if extra else name
    rows = corpus.tfidf_vectors(df, counts, vocab, key, max_features, name=column)
    rows = VectorSizeHint(inputCol=column, size=max_features, handleInvalid="optimistic").transform(rows)
    if extra:
        rows = VectorAssembler(inputCols=["_tfidf", *extra], outputCol=name, handleInvalid="keep").transform(rows)
        rows = rows.drop("_tfidf")
    # fits and searches read the rows many times: compute them once
    return durable.materialise(rows), vocab


def lsa(df: DataFrame, vectors: str, k: int, size: int, name: str = "lsa"):
    """Truncated (uncentred) SVD of sparse rows: (model, rows with a dense ``name`` vector).

    The rows and their negatives together have mean zero, so their principal
    components are the right singular vectors of the rows; the component matrix
    is vocabulary by k, whatever the number of rows.
    """
    only = df.select(F.col(vectors).alias("_v"))
    flipped = ElementwiseProduct(scalingVec=[-1.0] * size, inputCol="_v", outputCol="_n").transform(only)
    both = only.unionByName(flipped.select(F.col("_n").alias("_v")))
    model = PCA(k=k, inputCol="_v", outputCol=name).fit(both)
    return model, model.transform(df.withColumnRenamed(vectors, "_v")).withColumnRenamed("_v", vectors)


def lsa_variance(df: DataFrame, vectors: str, reduced: str) -> DataFrame:
    """Share of the total variance kept by the reduced columns."""
    def total_variance(col: str):
        cells = df.select(F.posexplode(vector_to_array(col)).alias("dim", "x"))
        per = cells.groupBy("dim").agg(F.var_pop("x").alias("v"))
        return per.agg(F.sum("v").alias("v")).scalar()

    return df.sparkSession.range(1).select((total_variance(reduced) / total_variance(vectors)).alias("explained"))


def helpfulness_features(df: DataFrame, text: str = "clean_review_text", stars: str = "Score", ts: str = "review_time",
                         lexicon=None) -> DataFrame:
    """The twelve helpfulness columns."""
    out = features.readability(df, text)
    out = features.time_delta_days(out, ts)
    out = sentiment.sentiment_features(out, text, lexicon)
    c = F.col(text)
    return out.withColumns(
        {
            "rating_normalized": F.col(stars) / 5.0,
            "sentiment_polarity": F.col("vader_compound"),
            "sentiment_confidence": F.greatest("vader_positive", "vader_negative", "vader_neutral"),
            "entity_density": ft.caps_entity_density(c),
            "aspect_density": ft.aspect_density(c),
            "is_topic_assigned": ft.topic_flag(c),
        }
    ).drop("vader_compound", "vader_positive", "vader_negative", "vader_neutral", "vader_label", "syllable_count")


def text_feature_block(df: DataFrame, key: str, text: str, tfidf_dim: int = 128, n_svd: int = 64) -> DataFrame:
    """LSA plus linguistic signals, each standardised."""
    prepared = df.withColumn("_p", tx.preprocess_light(F.col(text)))
    vectors, _ = text_vectors(prepared, key, "_p", tfidf_dim, 2, 1, 1.0, name="_v")
    _, reduced = lsa(vectors, "_v", n_svd, tfidf_dim)
    ling = ft.linguistic_features(F.col(text))
    wide = reduced.withColumns({n: c.cast("double") for n, c in ling.items()})
    assembled = VectorAssembler(inputCols=["lsa", *ling], outputCol="_f").transform(wide)
    scaler = StandardScaler(inputCol="_f", outputCol="text_features", withMean=True, withStd=True).fit(assembled)
    return scaler.transform(assembled).drop("_p", "_v", "_f", "lsa", *ling)


# --- helpfulness regression ---------------------------------------------------------


def fit_helpfulness(df: DataFrame, target: str = "target", cols: list[str] = fv.HELPFULNESS_COLUMNS, trees: int = 100,
                    depth: int = 5, rate: float = 0.08, subsample: float = 0.8, seed: int = 42) -> PipelineModel:
    """Boosted trees on standardised columns."""
    stages = [
        VectorAssembler(inputCols=cols, outputCol="_raw", handleInvalid="keep"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True),
        GBTRegressor(labelCol=target, featuresCol="features", predictionCol="_score", maxIter=trees, maxDepth=depth,
                     stepSize=rate, subsamplingRate=subsample, seed=seed),
    ]
    return Pipeline(stages=stages).fit(df)


def score_helpfulness(df: DataFrame, model: PipelineModel | None, default: float = 0.5) -> DataFrame:
    """Predicted helpfulness clamped to 0..1 at two places; the default without a model."""
    if model is None:
        return df.withColumn("predicted_helpfulness", F.lit(default))
    scored = model.transform(df)
    clamped = F.round(F.least(F.greatest("_score", F.lit(0.0)), F.lit(1.0)), 2)
    return scored.withColumn("predicted_helpfulness", F.coalesce(clamped, F.lit(default))).drop("_raw", "features", "_score")


def importances(spark: SparkSession, model: PipelineModel, cols: list[str] = fv.HELPFULNESS_COLUMNS) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(v)) for c, v in zip(cols, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


# --- classifiers ---------------------------------------------------------------------


def indexed(df: DataFrame, label: str, classes: list = CLASSES) -> DataFrame:
    """Numeric ``label_index`` in class order and balanced ``weight``; unlabelled rows are dropped."""
    position = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    rows = df.filter(F.col(label).isin(*classes)).withColumn("label_index", position.cast("double"))
    weights = evaluate.class_weights(rows, label).select(F.col(label).alias("_l"), "weight")
    # at most one row per listed class: sent to the rows, which would else be shuffled by class
    return rows.join(F.broadcast(weights), rows[label] == F.col("_l")).drop("_l")


def logistic_regression(n_rows: int, c: float = 1.0, iterations: int = 1000) -> LogisticRegression:
    """Balanced logistic regression; the penalty follows C as 1 / (C * rows)."""
    return LogisticRegression(labelCol="label_index", weightCol="weight", maxIter=iterations, regParam=1.0 / (c * n_rows))


def linear_svc(n_rows: int, c: float = 1.0, iterations: int = 2000) -> OneVsRest:
    svc = LinearSVC(maxIter=iterations, regParam=1.0 / (c * n_rows))
    return OneVsRest(classifier=svc, labelCol="label_index", weightCol="weight")


def random_forest(trees: int = 200, depth: int = 20, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label_index", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed)


def naive_bayes(alpha: float = 0.1) -> NaiveBayes:
    return NaiveBayes(labelCol="label_index", smoothing=alpha)


def fit_calibrated_svc(train: DataFrame, key: str, n_rows: int, c: float = 1.0, iterations: int = 2000):
    """SVC fitted on most rows, its margins turned into probabilities on the held-out rest."""
    parts = evaluate.split(train, key, 0.2, seed=7)
    svc = linear_svc(n_rows, c, iterations).fit(parts.filter(~F.col("is_test")))
    margins = svc.transform(parts.filter("is_test")).select("label_index", "weight", F.col("rawPrediction").alias("_margin"))
    calibrate = LogisticRegression(labelCol="label_index", weightCol="weight", featuresCol="_margin",
                                   rawPredictionCol="_cal", predictionCol="_calibrated", maxIter=100).fit(margins)
    return svc, calibrate


def apply_calibrated(df: DataFrame, svc, calibrate) -> DataFrame:
    margins = svc.transform(df).withColumnRenamed("rawPrediction", "_margin").drop("prediction")
    out = calibrate.transform(margins)
    return out.withColumnRenamed("_calibrated", "prediction").drop("_margin", "_cal")


def weighted_f1() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol="label_index", metricName="weightedFMeasure")


def cross_validate(df: DataFrame, estimator: Estimator, grid=None, folds: int = 3, key: str = "review_id",
                   parallelism: int = 4) -> CrossValidatorModel:
    """Cross-validation on stable hash folds."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid or [{}], evaluator=weighted_f1(), numFolds=folds,
                        foldCol="fold", parallelism=parallelism)
    return cv.fit(evaluate.folds(df, key, folds))


def compare_models(df: DataFrame, models: dict[str, Estimator], folds: int = 3, key: str = "review_id"):
    """(best name, its fitted model, table of mean weighted F1 per model)."""
    fitted = {name: cross_validate(df, est, folds=folds, key=key) for name, est in models.items()}
    scores = [(name, float(cv.avgMetrics[0])) for name, cv in fitted.items()]
    best = max(scores, key=lambda x: (x[1], x[0]))[0]
    table = df.sparkSession.createDataFrame(scores, "model string, cv_f1 double").orderBy(F.desc("cv_f1"), "model")
    return best, fitted[best].bestModel, table


def grid_search(df: DataFrame, estimator: Estimator, grid: dict[str, list], folds: int = 3, key: str = "review_id"):
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return cross_validate(df, estimator, builder.build(), folds, key)


def random_search(df: DataFrame, estimator: Estimator, space: dict, draws: int = 20, folds: int = 5, seed: int = 42,
                  key: str = "review_id"):
    """Seeded draws; a tuple (low, high) is log-uniform, a list is a choice."""
    rng = random.Random(seed)

    def draw(v):
        return rng.choice(v) if isinstance(v, list) else v[0] * (v[1] / v[0]) ** rng.random()

    maps = [{estimator.getParam(n): draw(v) for n, v in space.items()} for _ in range(draws)]
    return cross_validate(df, estimator, maps, folds, key)


def search_results(spark: SparkSession, cv: CrossValidatorModel) -> DataFrame:
    """One row per tried setting and parameter with its mean score."""
    rows = [
        (i, p.name, str(v), float(m))
        for i, (pm, m) in enumerate(zip(cv.getEstimatorParamMaps(), cv.avgMetrics))
        for p, v in pm.items()
    ]
    return spark.createDataFrame(rows, "setting int, parameter string, value string, mean_score double")


def predict_batch(df: DataFrame, model, classes: list = CLASSES) -> DataFrame:
    """Predicted label, its probability and one probability column per class, four places."""
    scored = model.transform(df)
    names = F.array(*[F.lit(c) for c in classes])
    p = vector_to_array("probability")
    return scored.withColumns(
        {
            "predicted_label": F.element_at(names, F.col("prediction").cast("int") + 1),
            "confidence": F.round(F.array_max(p), 4),
            **{f"p_{c}": F.round(p[i], 4) for i, c in enumerate(classes)},
        }
    ).drop("rawPrediction", "probability", "prediction")


def coefficient_rows(spark: SparkSession, model, classes: list = CLASSES) -> DataFrame:
    """Coefficients as (class, idx, coefficient): classes by features, never by rows."""
    matrix = model.coefficientMatrix.toArray()
    names = classes if len(matrix) > 1 else classes[-1:]
    rows = [(c, j, float(x)) for c, r in zip(names, matrix) for j, x in enumerate(r)]
    return spark.createDataFrame(rows, "cls string, idx int, coefficient double")


def top_coefficients(spark: SparkSession, model, vocab: DataFrame, classes: list = CLASSES, n: int = 10) -> DataFrame:
    """Best ``n`` terms per class."""
    named = coefficient_rows(spark, model, classes).join(vocab.select("idx", "term"), "idx")
    return top_n_by(named, ["cls"], [F.desc("coefficient"), F.asc("term")], n).select("cls", "rank", "term", "coefficient")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
