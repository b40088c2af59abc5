"""The pipeline: each stage on what the stage before kept, held against plain versions."""

import brute
import corpus_pipeline
import pytest
import test_documents
import test_lines
import test_repeats
import test_tokens
from pyspark.sql import functions as F

from starsift.llm.shared import stored


@pytest.fixture(scope="module")
def steps(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs.select(corpus_pipeline.COLUMNS)]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf), name))
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_keep_the_columns(steps):
    for s in steps[:-1]:
        assert s.columns == corpus_pipeline.COLUMNS
        assert all(r.n_chars == len(r.text) for r in s.collect())
    assert len(corpus_pipeline.STAGES) == 5


def test_quality_keeps_clean_documents(spark, steps):
    before, after = dict(texts(steps[0])), dict(texts(steps[1]))
    assert set(after.items()) <= set(before.items()) and not any(test_documents.failed(test_documents.base(t)) for t in after.values())
    good = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect() if r.quality == 1}
    clean = [i for i in good if not test_documents.failed(test_documents.base(before[i]))]
    assert sum(i in after for i in clean) >= 0.97 * len(clean)


def test_line_dedup(spark, steps):
    docs = texts(steps[1])
    want = [(i, t) for i, _, _, t in test_lines.plain(docs, test_lines.word_hashes(spark, docs)) if test_documents.WORD.search(t)]
    assert texts(steps[2]) == sorted(want)


def test_near_duplicate_removal(steps):
    docs = texts(steps[2])
    keep = {i for i, _, _, k in test_documents.components(docs, 5) if k}
    assert texts(steps[3]) == [d for d in docs if d[0] in keep]


def test_repeat_removal(steps):
    docs = texts(steps[3])
    want = sorted((i, w[3]) for (i, t), w in zip(docs, test_repeats.plain([t for _, t in docs], 200)) if w[2] < w[0])
    got = [(i, brute.sha(t)) for i, t in texts(steps[4])]
    # cuts inside a character leave out its other bytes
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sum(g == w for g, w in zip(got, want)) >= len(want) - 3


def test_packed_pieces(steps):
    test_tokens.check_packing(steps[5].collect(), texts(steps[4]), test_tokens.library("byte_bpe_50k.json"), 2048)


def test_stages_on_awkward_rows(spark):
    sf = "/root/testdata/sf0.001"
    real = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 40").withColumn("doc_id", F.col("doc_id") + 1000)
    docs = brute.awkward(spark).unionByName(brute.awkward(spark).filter("doc_id = 7")).unionByName(real, allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, sf).count()
        assert rows > 0 or name == "quality_rules"  # odd texts are its target here
        assert stage(spark, brute.empty(spark), sf).count() == 0, name
    assert corpus_pipeline.run(spark, sf).columns[:2] == ["doc_id", "piece"]
