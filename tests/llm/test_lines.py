"""Line deduplication against plain SimHash and edit distance over all pairs of distinct lines."""

import random
import re

import brute
import numpy as np
from pyspark.sql import functions as F

from starsift.llm import lines, queries


def norm(line):
    return re.sub(r"[\W_]+", " ", line.lower()).strip()


def edits(a, b):
    row = np.arange(len(b) + 1)
    codes = np.array([ord(c) for c in b], np.int64)
    for i, c in enumerate(a, 1):
        step = np.minimum(row[1:] + 1, row[:-1] + (codes != ord(c)))
        new = np.r_[i, step]
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row[-1])


def plain(docs, hashes):
    """(lines, removed, text) of each document; ``hashes`` has Spark's hash of every word."""
    keys, first, texts = {}, {}, []
    for d, (i, t) in enumerate(docs):
        for p, line in enumerate((t or "").split("\n") if t is not None else []):
            if norm(line):
                k = keys.setdefault(norm(line), len(keys))
                place = (i is None, i or 0, p)
                first[k] = min(first.get(k, place), place)
    names = list(keys)
    sim = np.zeros((len(names), 64), bool)
    for k, n in enumerate(names):
        w = np.array([hashes[x] for x in set(n.split(" "))], np.int64).view(np.uint64)
        ones = ((w[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(axis=0)
        sim[k] = 2 * ones > len(w)
    f = sim.astype(np.float32)
    far = f.sum(1)[:, None] + f.sum(1) - 2 * f @ f.T
    links = [(a, b) for a, b in zip(*np.nonzero(np.triu(far <= 3, 1))) if edits(names[a], names[b]) <= int(0.2 * max(len(names[a]), len(names[b])) + 1e-9)]
    root = brute.best_component(len(names), links)
    best = {}
    for k, r in enumerate(root):
        best[r] = min(best.get(r, first[k]), first[k])
    out = []
    for i, t in docs:
        if t is None:
            out.append((i, 0, 0, None))
            continue
        kept = [line for p, line in enumerate(t.split("\n")) if not norm(line) or best[root[keys[norm(line)]]] == (i is None, i or 0, p)]
        out.append((i, len(t.split("\n")), len(t.split("\n")) - len(kept), "\n".join(kept)))
    return out


def word_hashes(spark, docs):
    words = {w for _, t in docs for line in (t or "").split("\n") for w in norm(line).split(" ")}
    return {r.w: r.h for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect()}


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((i, n, r, brute.sha(t)) for i, n, r, t in plain(docs, word_hashes(spark, docs)))
    assert sorted(map(tuple, queries.QUERIES["op3_lines"](spark, sf_dir).collect())) == want
    assert any(w[2] for w in want)


def test_near_lines_hot_lines_and_awkward_rows(spark):
    rng = random.Random(4)
    base = [f"word{rng.randrange(10**5)}" for _ in range(80)]

    def near():
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(80)] = f"other{rng.randrange(10**5)}"
        return " ".join(words)

    docs = [(i, t) for i, t, *_ in brute.AWKWARD]
    docs += [(100 + i, "\n".join(["Very common line, with words!", f"own line {i} {rng.random()} here", near(), ""])) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS key", "2 AS node", "3 AS n_lines", "4 AS pos", "5 AS row_")
    got = lines.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "key", "node", "pos", "row_", "n_lines", "n_removed"]
    want = plain(docs, word_hashes(spark, docs))
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 200
    assert lines.dedup_lines(brute.empty(spark)).count() == 0


def test_chance_meetings_stay_rare(spark):
    nodes = spark.range(300_000).select(F.col("id").alias("node"), F.xxhash64("id").alias("sim"))
    assert lines._posted(nodes).groupBy("band").count().filter("count > 1").count() < 1000


def test_links_are_those_of_the_plain_edit_distance(spark):
    rng = random.Random(5)
    docs = []
    for i in range(60):
        words = [f"w{rng.randrange(10**4)}" for _ in range(rng.randrange(1, 40))]
        other = list(words)
        for _ in range(rng.randrange(12)):
            at = rng.randrange(len(other) + 1)
            other[at : at + rng.randrange(2)] = [f"v{rng.randrange(10**4)}"] * rng.randrange(2)
        docs.append((i, " ".join(words), " ".join(other) or "x"))
    docs.append((60, "same words here", "same words here"))
    rows = [(2 * i + j, i, 0, (False, i, 0, j)) for i, *_ in docs for j in (0, 1)]
    frame = spark.createDataFrame([(i, f"{x}\n{y}") for i, x, y in docs], "doc_id long, text string")
    keyed = {r.doc_id: r.k for r in frame.select("doc_id", F.xxhash64("doc_id", "text").alias("k")).collect()}
    nodes = spark.createDataFrame([(n, (a, i, keyed[i], j)) for n, i, _, (a, _, _, j) in rows], "node long, one struct<nameless:boolean,id:long,key:long,pos:int>")
    pairs = spark.createDataFrame([(2 * i, 2 * i + 1) for i, *_ in docs], "a long, b long")
    got = {r.a // 2 for r in lines._links(pairs, nodes, frame, "doc_id", "text").collect()}
    want = {i for i, x, y in docs if edits(x, y) <= int(0.2 * max(len(x), len(y)) + 1e-9)}
    assert got == want and 10 < len(want) < 60
