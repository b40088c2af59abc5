"""Quality rules and near duplicates against plain versions over whole texts."""

import re
from collections import Counter

import brute
import pytest

from starsift.llm import queries
from starsift.llm.minhash import near_duplicates
from starsift.llm.quality import quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def components(docs, width):
    sets = [shingles(t, width) for _, t in docs]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    links = set()
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j < i)
        links |= {(i, j) for j, n in shared.items() if 100 * n >= 80 * (len(s) + len(sets[j]) - n)}
    root = brute.best_component(len(docs), links)
    best = {}
    for i, (d, _) in enumerate(docs):
        best[root[i]] = min(x for x in (best.get(root[i]), d) if x is not None) if d is not None or root[i] in best else None
    return [(d, len(sets[i]), best[root[i]], d == best[root[i]]) for i, (d, _) in enumerate(docs)]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_near_duplicate_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.QUERIES["op9_near_duplicates"](spark, sf).collect()))
    want = sorted(components(docs, 2))
    assert got == want
    assert any(w[2] != w[0] for w in want)


def test_near_duplicates_hot_groups_and_awkward_rows(spark):
    """A large group of near copies without a common hub, exact copies, and rows that link with nothing."""
    import random

    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    docs = [(i, t) for i, t, *_ in brute.AWKWARD]
    for i in range(100, 420):
        words = list(base)
        for _ in range(rng.randrange(8)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    chain = list(base[::-1])
    for i in range(420, 470):  # each links with its neighbours only
        chain = chain[3:] + [f"c{i}a", f"c{i}b", f"c{i}c"]
        docs.append((i, " ".join(chain)))
    docs += [(i, "copy of one text with a few words") for i in range(500, 600)] + [(8, "same text here")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS node", "2 AS sig", "3 AS kept", "4 AS component_id")
    got = sorted(map(tuple, near_duplicates(df, width=2).drop("key").collect()), key=repr)
    want = components(docs, 2)
    # a component without an id keeps its row
    assert got == sorted([(d, n, c, d == c) for d, n, c, _ in want], key=repr)
    assert near_duplicates(brute.empty(spark)).count() == 0


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def failed(counts):
    return counts[0] < 20 or 100 * counts[4] > 30 * counts[0]


def test_quality_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = brute.rows(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), "doc_id")
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = brute.rows(queries.QUERIES["op10_quality"](spark, sf), "doc_id")
    assert set(got) == set(docs)
    for i, r in got.items():
        counts = base(docs[i].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == failed(counts) and not (r.base_failed and r.kept)
    judged = [(good[i], r.kept) for i, r in got.items() if i in good and not r.base_failed]
    assert sum(k for q, k in judged if q) >= 0.98 * sum(q for q, _ in judged)


def test_quality_score_equals_plain_multinomials(spark):
    """The ratio is checked on words that hash into different buckets, so plain counts give the same score."""
    import math

    docs = [(1, "a b " * 15), (2, "a c " * 15), (3, "z z " * 15), (4, "b a"), (5, None), (6, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    buckets = 1 << 20
    got = brute.rows(quality_rules(df, spark.createDataFrame([(1,), (1,), (2,), (99,)], "doc_id long"), buckets=1 << 12, prior=1.0), "doc_id")
    buckets = 1 << 12
    grams = {i: (t or "").split() + list(zip((t or "").split(), (t or "").split()[1:])) for i, t in docs}
    raw, target = Counter(g for x in grams.values() for g in x), Counter(g for i in (1, 2) for g in grams[i])
    for i, x in grams.items():
        want = sum(math.log((target[g] + 1) / (target.total() + buckets)) - math.log((raw[g] + 1) / (raw.total() + buckets)) for g in x) / max(1, len(x))
        assert got[i].score == pytest.approx(want)


def test_keeping_good_rows_evaluates_the_rules_once(spark):
    from starsift.llm.quality import keep_good

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trusted = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1").select("doc_id")
    plans = [f(docs, trusted)._jdf.queryExecution().optimizedPlan().toString() for f in (quality_rules, keep_good)]
    assert plans[1].count("xxhash64") <= plans[0].count("xxhash64") and plans[1].count("split(") <= plans[0].count("split(")
    kept = {r.doc_id for r in quality_rules(docs, trusted).filter("kept").collect()}
    assert sorted(kept) == sorted(r.doc_id for r in keep_good(docs, trusted).collect())


def test_quality_awkward_rows(spark):
    got = brute.rows(quality_rules(brute.awkward(spark), brute.awkward(spark).select("doc_id")), "doc_id")
    for i, t, *_ in brute.AWKWARD:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(t), i
        assert r.base_failed == failed(base(t))
    assert quality_rules(brute.empty(spark), brute.awkward(spark)).count() == 0
    assert quality_rules(brute.awkward(spark), brute.empty(spark)).count() == len(brute.AWKWARD)
