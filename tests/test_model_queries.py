"""The model queries run their whole settings: features, n-grams, iterations, trees, draws and folds."""

import datetime as dt
from types import SimpleNamespace

import pytest

from starsift.operators import models
from starsift.queries import modelling


@pytest.fixture
def fits(spark, tmp_path, monkeypatch):
    """Runs a query on forty orders and tells with what its models would have been fitted."""
    rows = [(i, i % 7, "F", dt.datetime(2024, 1, 1 + i % 28)) for i in range(40)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz")
    orders.write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    seen = []

    def fit(df, estimator, grid=None, folds=3, key="review_id", parallelism=4):
        grid = grid or [{}]
        seen.append(SimpleNamespace(df=df, estimator=estimator, grid=grid, folds=folds))
        return SimpleNamespace(avgMetrics=[0.5] * len(grid), bestModel=None, getEstimatorParamMaps=lambda: grid)

    monkeypatch.setattr(models, "cross_validate", fit)

    def run(query):
        return query(spark, str(tmp_path)).collect(), seen

    return run


def _width(df):
    return df.schema["features"].metadata["ml_attr"]["num_attrs"]


def test_model_comparison_fits_whole_models(fits):
    _, seen = fits(modelling.model_comparison)
    by = {type(x.estimator).__name__: x.estimator for x in seen}
    assert [x.folds for x in seen] == [3, 3, 3] and {_width(x.df) for x in seen} == {5000}
    assert by["LogisticRegression"].getMaxIter() == 1000
    assert (by["RandomForestClassifier"].getNumTrees(), by["RandomForestClassifier"].getMaxDepth()) == (200, 20)


def test_grid_search_is_whole(fits):
    out, (x,) = fits(modelling.grid_search_results)
    assert (x.folds, _width(x.df), x.estimator.getMaxIter()) == (3, 5000, 1000)
    # C of 0.1, 0.5, 1 and 5: the penalty is 1 / (C * rows)
    assert sorted(round(1 / (v * x.df.count()), 6) for m in x.grid for v in m.values()) == [0.1, 0.5, 1.0, 5.0]
    assert len(out) == 4


def test_random_search_is_whole(fits):
    out, (x,) = fits(modelling.random_search_results)
    assert (x.folds, _width(x.df), len(x.grid), len(out)) == (5, 5000, 20, 20)


def test_helpfulness_features_are_made_for_the_rows_that_need_them(fits, spark, monkeypatch):
    """Importances need the exposed rows only, scores all rows; neither stores a text."""
    kept = []
    monkeypatch.setattr(modelling.durable, "materialise", lambda df: kept.append((df.columns, df.count())) or df)
    monkeypatch.setattr(models, "fit_helpfulness", lambda df: kept.append((df.columns, df.count())))
    monkeypatch.setattr(models, "importances", lambda s, model: s.range(1))
    fits(modelling.helpfulness_importances)
    assert len(fits(modelling.scored_helpfulness)[0]) == 40
    columns = ["review_id", *models.fv.HELPFULNESS_COLUMNS, "helpfulness_denominator", "target"]
    assert kept == [(columns, 16), (columns, 16), (columns, 40), (columns, 16)]
