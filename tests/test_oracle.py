"""Every SQL-expressible query equals its DuckDB twin; the rest return rows."""

import compare
import pytest

from starsift.queries import load

REGISTRY = load()
SQL = sorted(n for n, q in REGISTRY.items() if q.sql is not None)
# fits that take long are covered by test_models on small inputs
SLOW = {
    "model_comparison", "grid_search_results", "random_search_results", "calibrated_svc_predictions", "lda_topics",
    "helpfulness_importances", "scored_helpfulness", "linear_attributions", "topic_table", "forest_predictions",
    "logistic_predictions", "text_feature_block", "top_coefficients", "feature_table",
}
ROWS = sorted(n for n, q in REGISTRY.items() if q.sql is None and n not in SLOW)


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", SQL)
def test_equals_sql(spark, sf_dir, con, name):
    assert compare.difference(REGISTRY[name].run(spark, sf_dir), con, REGISTRY[name].sql) is None


@pytest.mark.parametrize("name", ROWS)
def test_returns_rows(spark, sf_dir, name):
    assert REGISTRY[name].run(spark, sf_dir).limit(1).count() == 1


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_module_needs_no_session():
    for name in REGISTRY:
        assert not name.startswith("op") and "pipeline" not in name
