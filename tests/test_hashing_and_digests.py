"""Signed feature hashing on awkward rows, and stream deduplication whose state holds digests and expires."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from starsift.operators import topics
from starsift.streaming import ingest as si
from starsift.streaming import rollups as sr


def test_hashed_embedding_awkward_rows(spark):
    rows = [(1, "apple apple pear"), (2, None), (3, ""), (4, "the a of"), (5, "pear " * 5000), (6, "apple apple pear"), (None, "lost words")]
    df = spark.createDataFrame([(i, t, "kept") for i, t in rows], "id long, text string, _cells string")
    got = {r.id: r for r in topics.embed_hashed(df.drop("_cells"), "id", "text", dim=16).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6} and all(len(r.embedding) == 16 for r in got.values())
    assert got[1].embedding == got[6].embedding and not any(got[2].embedding + got[3].embedding + got[4].embedding)
    assert sorted(np.abs(got[5].embedding))[-1] == 1 and np.isclose(np.linalg.norm(got[1].embedding), 1)
    assert topics.embed_hashed(df.limit(0).drop("_cells"), "id", "text", dim=16).count() == 0


def test_hashed_rows_are_projections_of_whole_vectors(spark, sf_dir):
    """Every row equals its whole TF-IDF vector, no term left out, projected term by term here."""
    from starsift import fixed_values as fv
    from starsift.operators import corpus

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("text IS NOT NULL").orderBy("doc_id").limit(60)
    whole = corpus.tfidf(docs, "doc_id", "text", stop_words=tuple(fv.GENERAL_STOP_WORDS)).collect()
    want = {r.doc_id: np.zeros(384) for r in whole}
    for r in whole:
        digest = hashlib.md5(r.term.encode()).hexdigest()
        want[r.doc_id][int(digest[:8], 16) % 384] += r.weight * (-1) ** int(digest[8:16], 16)
    got = {r.doc_id: r.embedding for r in topics.embed_hashed(docs, "doc_id", "text").collect()}
    assert len(want) > 50
    for i, v in want.items():
        assert np.allclose(got[i], v / np.linalg.norm(v), atol=1e-9), i


def test_stream_dedupe_by_digest(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    schema = "k string, v string, n int, ts timestamp"

    def arrive(batch, rows):
        spark.createDataFrame(rows, "k string, v string, n int, day int").select("k", "v", "n", F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, day)").alias("ts")).coalesce(1).write.parquet(f"{src}/b{batch}")
        stream = si.file_stream(spark, f"{src}/*", schema)
        query = sr.run_available(sr.stream_dedupe(stream, ["k", "v"], "ts", "10 days"), out, ckpt, "append")
        query.awaitTermination()
        return query.lastProgress

    long = "word " * 20000
    progress = arrive(0, [("a", long, 1, 0), ("a", long, 1, 0), ("a", None, 1, 0), ("a", "", 1, 0), (None, "a", 1, 0), ("a", "b", 1, 0), ("ab", "", 1, 0)] + [(f"x{i}", long, 1, 0) for i in range(200)])
    state = progress.stateOperators[0]
    assert state.memoryUsedBytes < 206 * 2000  # 206 texts of 100,000 characters would take 20 MB
    got = spark.read.parquet(out)
    assert got.columns[:4] == ["k", "v", "n", "ts"] and "_digest" not in got.columns and got.count() == 206
    arrive(1, [("a", long, 2, 5), ("new", "x", 2, 5)])  # within the delay: a repeat
    assert spark.read.parquet(out).count() == 207
    last = arrive(2, [("later", "x", 3, 40)])
    last = arrive(3, [("later", "y", 4, 41)])
    assert last.stateOperators[0].numRowsTotal < 10  # all but the late keys have gone
    arrive(4, [("a", long, 5, 60)])  # long after: kept again
    assert spark.read.parquet(out).filter(F.col("k") == "a").filter(F.length("v") > 10).count() == 2
