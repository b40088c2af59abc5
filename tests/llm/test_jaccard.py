"""The n-gram Jaccard join against SQL and against all pairs that share a shingle."""

import random

import brute
import compare
import pytest
import test_documents

from starsift.llm import jaccard, queries


def want(docs, width=5):
    return sorted(((d, n, c) for d, n, c, _ in test_documents.components(docs, width)), key=repr)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql_and_plain_version(spark, sf):
    df = queries.QUERIES["op11_ngram_jaccard"](spark, sf)
    assert compare.difference(df, compare.connect(sf), queries.ORACLES["op11_ngram_jaccard"]) is None
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, df.collect()), key=repr) == want(docs)


def corpus():
    """Awkward rows, near copies with and without a common original, chains, templates with one slot, and shared passages."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**6)}"
    docs = [(i, t) for i, t, *_ in brute.AWKWARD] + [(8, "same text here")]
    base = [word() for _ in range(150)]
    docs.append((99, " ".join(base)))
    for i in range(100, 400):  # near copies of 99; most do not link with one another
        words = list(base)
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(150)] = word()
        docs.append((i, " ".join(words)))
    lone = [word() for _ in range(120)]
    for i in range(400, 600):  # no original: one place changed in each
        words = list(lone)
        words[rng.randrange(120)] = word()
        docs.append((i, " ".join(words)))
    chain = [word() for _ in range(100)]
    for i in range(600, 680):
        chain = chain[3:] + [word() for _ in range(3)]
        docs.append((i, " ".join(chain)))
    slot = [word() for _ in range(36)]
    docs += [(i, " ".join([*slot[:18], word(), *slot[18:]])) for i in range(700, 900)]
    passage = [word() for _ in range(60)]
    docs += [(i, " ".join([*(word() for _ in range(40)), *passage, *(word() for _ in range(40))])) for i in range(900, 1000)]
    for i in range(1000, 1200):  # pairs around the threshold
        words = [word() for _ in range(rng.randrange(5, 60))]
        docs.append((i, " ".join(words)))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = word()
        docs.append((i + 1000, " ".join(words).upper()))
    docs += [(3000 + i, "copy of one text with a few words") for i in range(150)]
    docs += [(4000 + i, "short text") for i in range(3)] + [(4010, "short  TEXT\t"), (4011, "short text now")]
    return docs


@pytest.mark.parametrize("width", [5, 2])
def test_hot_groups_and_awkward_rows(spark, monkeypatch, width):
    """Small runs, ranges and blocks, so that every path is taken."""
    monkeypatch.setattr(jaccard, "RUN_CHARS", 20_000)
    monkeypatch.setattr(jaccard, "RANGE_GRAMS", 4_000)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS node", "2 AS n", "3 AS id_", "4 AS component_id", "5 AS run")
    got = sorted(map(tuple, jaccard.jaccard_components(df, width=width).collect()), key=repr)
    assert got == want(docs, width)
    assert jaccard.jaccard_components(brute.empty(spark)).count() == 0


def test_words_with_equal_polynomials_differ():
    """A Thue-Morse word and its complement, which collide under a polynomial modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    assert jaccard.gram_set(one, 5).tolist() != jaccard.gram_set(two, 5).tolist()
    assert len(jaccard.gram_set("a b c d e f", 5)) == 2 and len(jaccard.gram_set("a b", 5)) == 1 and not len(jaccard.gram_set(" \n", 5))
