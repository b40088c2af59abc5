"""Toxicity and language-model scores: exact neighbours, plain counts, held-out accuracy."""

import math
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starsift.llm import lm, queries, toxicity


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 200), st.integers(1, 20))
def test_block_max_neighbours_are_exact(seed, n, k):
    rng = np.random.default_rng(seed)
    dense = (rng.random((n, 12)) < 0.3) * rng.integers(1, 4, (n, 12)).astype(float)
    norm = np.linalg.norm(dense, axis=1, keepdims=True)
    dense = np.divide(dense, norm, out=np.zeros_like(dense), where=norm > 0)
    index = toxicity.Index([(np.flatnonzero(r), r[r > 0]) for r in dense], 12, block=8)
    q = dense[rng.integers(n)]
    if not q.any():
        return
    at, score = index.nearest(np.flatnonzero(q), q[q > 0], k, leave_out=0)
    want = sorted(((round(-float(dense[i] @ q), 9), i) for i in range(n) if i != 0 and dense[i] @ q > 0))[:k]
    assert [round(-s, 9) for s in score] == pytest.approx([w[0] for w in want])
    # the order among equal cosines may differ by rounding only
    assert len(set(at.tolist())) == len(want)


def test_toxicity_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = brute.rows(queries.QUERIES["op1_toxicity"](spark, sf), "doc_id")
    docs = [r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()]
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert set(got) == set(docs)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert all(zlib.crc32(str(e.id).encode()) % 5 for e in r.evidence)
    held = [(toxic[i], r.score) for i, r in got.items() if r.held_out and i in toxic]
    assert sum((s >= 0.5) == t for t, s in held) >= 0.9 * len(held)


def test_toxicity_learns_words_and_beginnings(spark):
    import random

    rng = random.Random(1)
    clean = [f"plain{rng.randrange(300)}" for _ in range(300)]
    docs, labels = [], []
    for i in range(400):
        words = rng.sample(clean, 20)
        bad = i % 4 == 0
        if bad:
            words[3] = rng.choice(["nasty", f"horri{chr(97 + i % 26)}"])
        docs.append((i, " ".join(words))), labels.append((i, int(bad)))
    docs += [(900, "horrizzz said all"), (901, ""), (902, None), (903, "nothing known"), (None, "a nasty word"), (0, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS label", "2 AS score", "3 AS terms", "4 AS tf")
    known = spark.createDataFrame([*labels, (None, 1), (5, None), (0, 0)], "doc_id long, label int")
    got = toxicity.toxicity(df, known).collect()
    assert len(got) == len(docs)
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == y for i, y in labels)
    assert by[900].score > 0.5 and by[None].score > 0.5 and by[901].score == by[902].score == by[903].score < 0.1
    assert toxicity.toxicity(brute.empty(spark), known).count() == 0
    assert all(r.score == 0 for r in toxicity.toxicity(brute.awkward(spark), known.filter("false")).collect())


def plain_difference(docs, target):
    """Both models from plain counts of hashed classes, each document left out of them."""
    one, two, t1, t2 = Counter(), Counter(), Counter(), Counter()
    made = {}
    for k, (i, t) in enumerate(docs):
        a, b = lm.classes(t)
        made[k] = a.tolist(), b.tolist()
        one.update(made[k][0]), two.update(made[k][1])
        if i in target:
            t1.update(made[k][0]), t2.update(made[k][1])
    scale = t1.total() / one.total() if t1 else 1.0
    out = []
    for k, (i, _) in enumerate(docs):
        a, b = made[k]
        if not a:
            out.append((i, 0, None, None))
            continue
        h = []
        for c1, c2, inside, s in ((t1, t2, i in target, 1.0), (one, two, True, scale)):
            o1, o2 = (Counter(a), Counter(b)) if inside else (Counter(), Counter())
            total = (c1.total() - (len(a) if inside else 0)) * s
            nats = 0.0
            for j, w in enumerate(a):
                p = ((c1[w] - o1[w]) * s + lm.PRIOR) / (total + lm.PRIOR * lm.WORDS)
                if j:
                    v = (c1[a[j - 1]] - o1[a[j - 1]]) * s
                    p = (1 - lm.LAMBDA) * p + lm.LAMBDA * (min(1.0, (c2[b[j - 1]] - o2[b[j - 1]]) * s / v) if v > 0 else 0.0)
                nats -= math.log(p)
            h.append(nats / len(a))
        out.append((i, len(a), *h))
    return out


def same(got, want):
    got = sorted(((r.doc_id, r.n_tokens, r.target_entropy, r.background_entropy) for r in got), key=repr)
    for g, w in zip(got, sorted(want, key=repr), strict=True):
        assert g[:2] == w[:2] and (g[2:] == w[2:] or g[2:] == pytest.approx(w[2:], rel=1e-5))


def test_lm_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.quality == 1}
    same(queries.QUERIES["op4_lm_scores"](spark, sf_dir).collect(), plain_difference(docs, target))


def test_lm_awkward_rows(spark):
    docs = [(i, t) for i, t, *_ in brute.AWKWARD]
    target = spark.createDataFrame([(7,), (7,), (8,), (77,), (None,)], "doc_id long")
    same(lm.cross_entropy_difference(brute.awkward(spark), target).collect(), plain_difference(docs, {7, 8}))
    assert lm.cross_entropy_difference(brute.empty(spark), target).count() == 0
    assert lm.cross_entropy_difference(brute.awkward(spark), target.filter("false")).count() == len(docs)


def test_lm_counts_words_themselves(spark, monkeypatch):
    """Many more words and pairs than would fit a fixed table without meeting; documents in many chunks and ranges."""
    monkeypatch.setattr(lm, "CHUNK_CHARS", 20_000, raising=False)
    monkeypatch.setattr(lm, "RANGE_CHARS", 50_000, raising=False)
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(["the", *(f"w{w}" for w in rng.zipf(1.2, 300) % 10**9), *(f"only{i}x{j}" for j in range(150))])) for i in range(240)]
    target = set(range(0, 240, 3))
    one, two = ([Counter(), Counter()] for _ in range(2))
    for i, t in docs:
        w = t.split()
        for k in {1, int(i not in target)}:
            one[k].update(w), two[k].update(zip(w, w[1:]))
    size, want, (few, all_) = max(lm.WORDS, len(one[1])), [], [c.total() for c in one]
    for i, t in docs:
        w, h = t.split(), []
        o1, o2 = Counter(w), Counter(zip(w, w[1:]))
        for k in range(2):
            inside, s = k or i in target, few / all_ if k else 1.0
            own = lambda c, o, x: (c[x] - (o[x] if inside else 0)) * s
            nats = 0.0
            for j, x in enumerate(w):
                p = (own(one[k], o1, x) + lm.PRIOR) / (((all_ if k else few) - (len(w) if inside else 0)) * s + lm.PRIOR * size)
                if j:
                    v = own(one[k], o1, w[j - 1])
                    p = (1 - lm.LAMBDA) * p + lm.LAMBDA * (min(1.0, own(two[k], o2, (w[j - 1], x)) / v) if v > 0 else 0.0)
                nats -= math.log(p)
            h.append(nats / len(w))
        want.append((i, len(w), *h))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = lm.cross_entropy_difference(df, spark.createDataFrame([(i,) for i in target], "doc_id long"))
    same(got.collect(), want)
