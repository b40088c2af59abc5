"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes.

Terms are words in lower case and their first 4, 5 and 6 letters. Labels enter in three places only, all from at most
``EXAMPLES`` labelled documents: which terms are kept (chi-square), the examples themselves, and the map from votes to
probabilities. Document frequencies are those of all documents. The index is bounded by ``EXAMPLES`` and ``TERMS``, so each
task gets a copy; texts and vectors stay where they are.

The index keeps the postings of a term in blocks of examples with the largest weight of each. A block's bound is the sum of
the query's weights times these; blocks are scored in falling order of their bounds until no bound reaches the k-th best
score, so the k neighbours are exact.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.shared import per_batch, runs, stored

EXAMPLES, TERMS = 20_000, 4096
#: A term is kept if its chi-square, and that as a share of the examples (the squared phi), are at least so large.
CHI_SQUARE, PHI_SQUARE, LEAST_DOCS = 20.0, 0.02, 3
NEIGHBOURS, BLOCK, NEAR = 15, 64, 0.05
WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> tuple[str, ...]:
    """The word and its shorter beginnings, each marked with its kind."""
    return (f"={word}", *(f"{word[:k]}-" for k in (4, 5, 6) if len(word) > k))


def _select_terms(texts: DataFrame) -> list[str]:
    """Terms of the (label, text) rows whose presence tells most about the label, by chi-square, ties by name."""

    def work(batch: pa.RecordBatch):
        labels, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, z in runs(rows, 500_000):
            seen: dict[str, list[int]] = {}
            for y, t in zip(labels[a:z], rows[a:z]):
                for x in {x for w in set(WORD.findall((t or "").lower())) for x in terms_of(w)}:
                    c = seen.setdefault(x, [0, 0])
                    c[0] += 1
                    c[1] += y
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), *(pa.array([c[i] for c in seen.values()], pa.int64()) for i in (0, 1))], ["term", "n", "p"])

    count = per_batch(texts, work, "term string, n long, p long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    all_n, all_p = texts.agg(F.count("*"), F.sum("label")).first()
    if not all_n or not all_p or all_p == all_n:
        return []
    # n and p: documents with the term, and toxic ones among them
    gap = F.col("p") * all_n - F.col("n") * all_p
    chi = gap * gap * float(all_n) / (F.col("n") * (all_n - F.col("n")) * float(all_p) * (all_n - all_p))
    best = count.filter((F.col("n") >= LEAST_DOCS) & (F.col("n") < all_n)).withColumn("chi", chi).filter(F.col("chi") >= max(CHI_SQUARE, PHI_SQUARE * all_n))
    return [r.term for r in best.orderBy(F.col("chi").desc(), "term").limit(TERMS).collect()]


def vectors(docs: DataFrame, terms: list[str], id_col: str, text_col: str) -> DataFrame:
    """id_col, terms (ascending places in ``terms``), tf of every row."""

    def work(batches):
        place = {t: i for i, t in enumerate(terms)}
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, z in runs(texts):
                rows = []
                for t in texts[a:z]:
                    count: dict[int, int] = {}
                    for w in WORD.findall((t or "").lower()):
                        ids = known.get(w)
                        if ids is None:
                            ids = known[w] = tuple(place[x] for x in terms_of(w) if x in place)
                        for i in ids:
                            count[i] = count.get(i, 0) + 1
                    rows.append(sorted(count.items()))
                    if len(known) > 500_000:
                        known = {}
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, z - a), pa.array([[i for i, _ in r] for r in rows], pa.list_(pa.int32())), pa.array([[c for _, c in r] for r in rows], pa.list_(pa.int32()))],
                    [id_col, "terms", "tf"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(work, f"{id_col} {kind}, terms array<int>, tf array<int>")


class Index:
    """Block-max inverted index of unit vectors."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        self.n, self.block = len(rows), block
        self.blocks = max(1, -(-self.n // block))
        owner = np.repeat(np.arange(self.n), [len(t) for t, _ in rows])
        term = np.concatenate([t for t, _ in rows]) if rows else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in rows]) if rows else np.zeros(0)
        order = np.lexsort((owner, term))
        self.owner, term, self.weight = owner[order], term[order], weight[order]
        cell = term * self.blocks + self.owner // block
        self.start = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1))
        self.most = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(n_terms, self.blocks)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, leave_out: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k best with a cosine over 0, ties to the smaller place."""
        bound = weights @ self.most[terms]
        places, scores, least = np.zeros(0, np.int64), np.zeros(0), 0.0
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or bound[b] + 1e-9 < least:
                break
            score = np.zeros(self.block)
            for t, w in zip(terms, weights):
                s, e = self.start[t * self.blocks + b], self.start[t * self.blocks + b + 1]
                score[self.owner[s:e] - b * self.block] += w * self.weight[s:e]
            found = np.flatnonzero(score > 0)
            found = found[found + b * self.block != leave_out]
            places, scores = np.r_[places, found + b * self.block], np.r_[scores, score[found]]
            best = np.lexsort((places, -scores))[:k]
            places, scores = places[best], scores[best]
            least = scores[-1] if len(scores) == k else 0.0
        return places, scores


def _unit(terms, tf, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    terms = np.array(terms, np.int64)
    w = (1 + np.log(np.array(tf, float))) * idf[terms]
    return terms, w / np.linalg.norm(w) if len(w) else w


def _vote(labels: np.ndarray, scores: np.ndarray) -> float:
    weight = 1 / (NEAR + 1 - np.minimum(scores, 1))
    return float((weight * labels).sum() / weight.sum())


def _isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes and rising probabilities fitted to them (pool adjacent violators; one count of each label is added)."""
    values, inverse = np.unique(x, return_inverse=True)
    pools: list[list[float]] = []
    for i, (s, n) in enumerate(zip(np.bincount(inverse, y), np.bincount(inverse))):
        pools.append([s, n, i])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, n, last = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, last]
    out, first = np.zeros(len(values)), 0
    for s, n, last in pools:
        out[first : int(last) + 1] = (s + 0.5) / (n + 1)
        first = int(last) + 1
    return values, np.maximum.accumulate(out)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score (0 to 1), predicted, vote, evidence (nearest examples' ids, cosines and labels) for every row.

    ``labels`` has id_col and label (0 or 1; null rows are left out, of several labels of a document the largest counts).
    The examples are the ``EXAMPLES`` labelled documents first in hash order of their ids. A text without a known term
    (null and empty texts too) gets the share of label 1 among such examples, and no evidence. Rows are scored one by
    one, repeated ones alike; a null id is never an example; other columns are not read. Without labels all scores are
    0; an empty table gives no rows.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col("label").isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max("label").cast("int").alias("label"))
    sample = F.broadcast(stored(known.orderBy(F.xxhash64(id_col), id_col).limit(EXAMPLES), "labelled"))  # at most EXAMPLES rows
    terms = _select_terms(docs.select(id_col, text_col).join(sample, id_col).select("label", text_col))
    vector = stored(vectors(docs, terms, id_col, text_col), "vectors")

    n_docs = vector.count()
    idf = np.full(max(1, len(terms)), np.log(1.0 + n_docs))
    for term, n in vector.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most TERMS rows
        idf[term] = np.log((1 + n_docs) / (1 + n)) + 1
    rows = vector.join(sample, id_col).select(id_col, "terms", "tf", "label").dropDuplicates([id_col]).collect()  # at most EXAMPLES rows
    rows.sort(key=lambda r: r[0])
    some = [r for r in rows if r.terms]
    units = [_unit(r.terms, r.tf, idf) for r in some]
    ids, label = [r[0] for r in some], np.array([r.label for r in some], float)
    index = Index(units, len(idf))
    blank = [r.label for r in rows if not r.terms]
    base = (sum(blank) + 0.5) / (len(blank) + 1) if blank else (label.mean() if len(label) else 0.0)
    votes, truth = [], []
    for i, (t, w) in enumerate(units):
        at, score = index.nearest(t, w, NEIGHBOURS, leave_out=i)
        if len(at):
            votes.append(_vote(label[at], score)), truth.append(label[i])
    fit = _isotonic(np.array(votes), np.array(truth)) if votes else (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    shared = spark.sparkContext.broadcast((index, idf, ids, label, fit, base))

    def work(batch: pa.RecordBatch):
        index, idf, ids, label, fit, base = shared.value
        made, out = {}, []
        for t, c in zip(batch.column("terms").to_pylist(), batch.column("tf").to_pylist()):
            key = (tuple(t), tuple(c))
            if key not in made:
                at, score = index.nearest(*_unit(t, c, idf), NEIGHBOURS) if t else (np.zeros(0, np.int64), np.zeros(0))
                vote = _vote(label[at], score) if len(at) else None
                made[key] = (float(np.interp(vote, *fit)) if len(at) else base, vote, [{"id": ids[a], "cosine": float(s), "label": int(label[a])} for a, s in zip(at, score)])
            out.append(made[key])
        kinds = pa.float64(), pa.float64(), pa.list_(pa.struct([("id", batch.column(0).type), ("cosine", pa.float64()), ("label", pa.int32())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([o[i] for o in out], k) for i, k in enumerate(kinds))], [id_col, "score", "vote", "evidence"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = per_batch(vector, work, f"{id_col} {kind}, score double, vote double, evidence array<struct<id: {kind}, cosine: double, label: int>>")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
