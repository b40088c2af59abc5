"""Removal of repeated byte strings against a plain count of all strings."""

import random
from collections import Counter

import brute
import numpy as np
import pytest

from starsift.llm import queries, repeats


def plain(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i] += 1
                gone[min(len(d), i + length)] -= 1
        mask = np.cumsum(gone)[: len(d)] > 0
        left = bytes(b for b, m in zip(d, mask) if not m)
        out.append((len(d), int(mask.sum()), int((np.diff(np.r_[False, mask].astype(int)) == 1).sum()), brute.sha(left)))
    return out


def digest(rows, key="doc_id"):
    return sorted(((r[key], r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=repr)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(((d.doc_id, *w) for d, w in zip(docs, plain([d.text for d in docs], 200))), key=repr)
    got = queries.QUERIES["op5_repeats"](spark, sf_dir).collect()
    assert digest(got) == want and any(w[2] for w in want)


def made(seed):
    """Passages in many contexts, periodic texts, shifted repeats within a document, edges of the length."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(30), text(12), "ab" * 90, text(60)]
    docs = []
    for i in range(120):
        p = rng.choice(passages)
        cut = rng.randrange(len(p) // 2)
        docs.append(text(rng.randrange(20)) + p[cut : cut + rng.randrange(20, 200)] + text(rng.randrange(20)) + (p if i % 7 == 0 else ""))
    return docs + ["the " * 200, "xyz" * 100, "a" * 63, "a" * 64, "a" * 65, "", None, text(400)] + docs[:3]


@pytest.mark.parametrize("limit", [repeats.LIMIT, 3])
def test_shapes(spark, monkeypatch, limit):
    monkeypatch.setattr(repeats, "LIMIT", limit)
    texts = made(1)
    rows = [(i if i != 5 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[9], rows[9]], "doc_id long, text string").selectExpr("doc_id", "text", "1 AS key", "2 AS spans", "3 AS n", "4 AS row")
    every = [*texts, texts[9], texts[9]]
    ids = [r[0] for r in rows] + [9, 9]
    got = repeats.drop_repeats(df, length=64).collect()
    assert digest(got) == sorted(((i, *w) for i, w in zip(ids, plain(every, 64))), key=repr)
    for r in got:
        assert r.kept_text is None or len(r.kept_text.encode()) <= r.n_bytes - r.n_removed


def test_awkward_rows(spark):
    got = repeats.drop_repeats(brute.awkward(spark)).collect()
    assert digest(got) == sorted(((r[0], *w) for r, w in zip(brute.AWKWARD, plain([r[1] for r in brute.AWKWARD], 200))), key=repr)
    assert repeats.drop_repeats(brute.empty(spark)).count() == 0


def test_long_texts_are_cut_with_overlap(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PASS", 500)
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh") for _ in range(3000))
    texts = [long, long[700:1500], "q" * 10 + long[1400:1470]]
    got = repeats.drop_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), length=64).collect()
    assert digest(got) == sorted((i, *w) for i, w in enumerate(plain(texts, 64)))
