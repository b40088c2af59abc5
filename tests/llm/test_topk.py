import brute
import compare
import numpy as np
import pytest

from starsift.llm import queries
from starsift.llm.topk import exact_top_k, quantised


def test_query_equals_sql(spark, sf_dir):
    assert compare.difference(queries.QUERIES["op8_exact_top_k"](spark, sf_dir), compare.connect(sf_dir), queries.ORACLES["op8_exact_top_k"]) is None


def test_clusters_ties_and_awkward_rows(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 5)) * 20
    data = [(i, (centres[i % 6] + rng.normal(size=5)).tolist()) for i in range(300)] + [(i, [1.0] * 5) for i in range(300, 400)]
    rows = [*data, (400, None), (401, [1.0, None, 2.0, 0.0, 1.0]), (402, [float("nan")] * 5), (403, [float("inf")] * 5), (404, [2.0, 1.0]), (0, data[0][1]), (None, [1.0] * 5)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit(1), "v": F.lit(2), "group": F.lit(3)})
    q = quantised(df)
    got = {}
    for r in exact_top_k(q.filter(F.col("id") % 20 == 0), q, 7, pivots=5, block=16).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ints = {i: np.r_[np.floor(64 * np.array(v)), np.zeros(5 - len(v))].astype(int) for i, v in [*data, (404, [2.0, 1.0])]}
    assert set(got) == {i for i in ints if i % 20 == 0}
    for i, found in got.items():
        want = sorted((-int(ints[i] @ v), j) for j, v in ints.items() if j != i)[:7]
        assert sorted(found) == [(n, j, -s) for n, (s, j) in enumerate(want, 1)]
    few = q.filter("id < 4")
    assert exact_top_k(few, few, 20).count() == 12
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert exact_top_k(quantised(none), quantised(none), 3).count() == 0
    assert exact_top_k(quantised(none), few, 3).count() == 0
    with pytest.raises(ValueError):
        exact_top_k(few, quantised(spark.createDataFrame([(1, [1e12, 1.0])], "vec_id long, embedding array<double>")), 2)
