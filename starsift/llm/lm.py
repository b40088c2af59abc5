"""Cross-entropy difference between a target and a background n-gram model.

Both models share one vocabulary (words in ASCII lower case) and one table of word pairs, and are interpolated in the same
way. Every distinct word and pair (64-bit hashes) has counts of its own, so the tables grow with the corpus. Documents are
dealt into chunks, one compressed row each. A chunk sends the n-grams it has, once each with their counts (mostly one byte),
to the ranges of n-grams they belong to; a range adds the counts up and answers each chunk in the order in which it asked.
A chunk has rows only for the ranges it has n-grams of, so rows never outnumber the n-grams sent. No table meets in
one place: a task holds one chunk or one range, and a common n-gram is one entry of a chunk. The background is all documents,
scaled to the target's number of tokens, so the two models are matched in mass and smoothing. A document never helps to
predict itself: its own counts are taken out of the models that hold them before it is scored.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.minhash import LOWER
from starsift.llm.shared import U, mix, runs, stored, word_hashes

#: Words that the smoothing reckons with at least; a vocabulary with more counts whole.
WORDS = 1 << 18
#: Share of the bigram estimate, and count added to each word.
LAMBDA, PRIOR = 0.7, 0.5
#: Characters of a chunk of documents, and of the corpus per range of n-grams.
CHUNK_CHARS, RANGE_CHARS = 8_000_000, 8_000_000


def _data(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER)


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs of words."""
    return mix(mix(first + U(0x9E3779B97F4A7C15)) ^ second)


def classes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Key of each token, and key of each token after the first with the one before it."""
    _, _, h = word_hashes(_data(text))
    return h, _joined(h[:-1], h[1:])


class _Grams:
    """The n-grams of some texts: distinct words and pairs in the order of their keys, and where each token has them."""

    def __init__(self, texts: list):
        h, d = [np.zeros(0, U)], [np.zeros(0, np.int64)]
        for a, z in runs(texts):
            data = [_data(t) for t in texts[a:z]]
            starts, _, some = word_hashes(b"\n".join(data))
            h.append(some)
            d.append(a + np.searchsorted(np.cumsum([len(x) + 1 for x in data]), starts, "right"))
        self.doc = np.concatenate(d)
        self.words, self.word = np.unique(np.concatenate(h), return_inverse=True)
        #: Tokens that have one of the same text before them.
        self.after = 1 + np.flatnonzero(self.doc[1:] == self.doc[:-1])
        codes, self.pair = np.unique(self.word[self.after - 1] * len(self.words) + self.word[self.after], return_inverse=True)
        self.pairs = _joined(self.words[codes // len(self.words)], self.words[codes % len(self.words)]) if len(codes) else np.zeros(0, U)

    def ranges(self, n: int) -> list[np.ndarray]:
        """Range of each word and of each pair."""
        return [(mix(x) % U(n)).astype(np.int64) for x in (self.words, self.pairs)]


def _packed(counts: np.ndarray) -> bytes:
    """Counts of one byte each; those from 255 on follow whole."""
    flat = counts.ravel()
    return np.minimum(flat, 255).astype(np.uint8).tobytes() + flat[flat >= 255].tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    """The target's and all documents' counts of ``n`` n-grams."""
    flat = np.frombuffer(data, np.uint8, 2 * n).astype(np.int64)
    flat[flat == 255] = np.frombuffer(data, np.int64, offset=2 * n)
    return flat.reshape(2, n)


def _dealt(marked: DataFrame) -> DataFrame:
    """One row per chunk: chunk_, chars_ and docs_, its documents as a compressed Arrow stream of id_, text_ and target_."""
    most = CHUNK_CHARS

    def packed(pieces, chars, chunk):
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, pieces[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            for piece in pieces:
                stream.write_batch(piece)
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((chunk, chars, out.getvalue().to_pybytes()), kinds)], ["chunk_", "chars_", "docs_"])

    def work(batches):
        chunk, pieces, chars = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            start = 0
            for i, t in enumerate(batch.column(1).to_pylist()):
                if chars and chars + len(t or "") > most:
                    if i > start:
                        pieces.append(batch.slice(start, i - start))
                    yield packed(pieces, chars, chunk)
                    chunk, pieces, chars, start = chunk + 1, [], 0, i
                chars += len(t or "") + 1
            pieces.append(batch.slice(start))
        if pieces:
            yield packed(pieces, chars, chunk)

    return marked.mapInArrow(work, "chunk_ long, chars_ long, docs_ binary")


def _opened(docs: bytes) -> tuple[pa.Array, list, np.ndarray]:
    """Ids, texts and target marks of a chunk."""
    t = pa.ipc.open_stream(docs).read_all()
    return t["id_"], t["text_"].to_pylist(), np.array([bool(x) for x in t["target_"].to_pylist()], bool)


def _asked(dealt: DataFrame, n: int) -> DataFrame:
    """chunk_, range_, and the keys and counts that the chunk has in the range; only ranges of which it has any."""
    names = ["chunk_", "range_", "words", "pairs", "word_counts", "pair_counts"]
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]

    def sent(chunk, docs):
        _, texts, marks = _opened(docs)
        g = _Grams(texts)
        into = marks[g.doc]
        counts = [np.stack([np.bincount(i, w, len(x)), np.bincount(i, None, len(x))]).astype(np.int64) for x, i, w in ((g.words, g.word, into), (g.pairs, g.pair, into[g.after]))]
        ranges = g.ranges(n)
        order = [np.argsort(r, kind="stable") for r in ranges]
        used = np.union1d(*ranges)
        starts, ends = ([np.searchsorted(r[o], used, side) for r, o in zip(ranges, order)] for side in ("left", "right"))
        rows = []
        for i, r in enumerate(used.tolist()):
            w, p = (o[a[i] : z[i]] for o, a, z in zip(order, starts, ends))
            rows.append((chunk, r, g.words[w].tobytes(), g.pairs[p].tobytes(), _packed(counts[0][:, w]), _packed(counts[1][:, p])))
            if len(rows) == 256:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def work(batches):
        for batch in batches:
            for chunk, docs in zip(batch.column(0), batch.column(1)):
                yield from sent(chunk.as_py(), docs.as_buffer())

    return dealt.select("chunk_", "docs_").mapInArrow(work, "chunk_ long, range_ long, words binary, pairs binary, word_counts binary, pair_counts binary")


def _summed(table: pa.Table) -> pa.Table:
    """Per row asked, the target's and all documents' counts of its keys; and one row without a chunk with the range's sums."""
    out, sums = [], []
    for keys, counts in (("words", "word_counts"), ("pairs", "pair_counts")):
        each = [np.frombuffer(x, U) for x in table[keys].to_pylist()]
        had = np.concatenate([_unpacked(x, len(k)) for x, k in zip(table[counts].to_pylist(), each)], axis=1)
        key = np.concatenate(each)
        order = np.argsort(key)
        new = np.ones(len(key), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        group = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        total = np.add.reduceat(had[:, order], starts, axis=1) if len(starts) else had
        answer = np.empty_like(had)
        answer[:, order] = total[:, group]
        ends = np.cumsum([len(x) for x in each])
        out.append([_packed(answer[:, e - len(x) : e]) for x, e in zip(each, ends)])
        sums.append((len(starts), *total.sum(axis=1).tolist()))
    none = [None] * len(each)
    cols = [table["chunk_"].to_pylist() + [None], table["range_"].to_pylist() + [None], *(x + [None] for x in out), *(none + [x] for x in sums[0])]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], ["chunk_", "range_", "words", "pairs", "n_words", "t", "n"])


def _entropies(g: _Grams, marks: np.ndarray, words: np.ndarray, pairs: np.ndarray, sizes: np.ndarray, totals: tuple, vocabulary: int) -> list[np.ndarray]:
    """Nats per token of each text under the target and the background, neither of which holds it."""
    own1, own2 = (np.take(*np.unique(d * len(x) + i, return_inverse=True, return_counts=True)[:0:-1]) for d, x, i in ((g.doc, g.words, g.word), (g.doc[g.after], g.pairs, g.pair)))
    out = []
    for c1, c2, total, inside, scale in ((words[0], pairs[0], totals[0], marks, 1.0), (words[1], pairs[1], totals[1], np.ones_like(marks), totals[0] / totals[1] if totals[0] else 1.0)):
        a = (c1[g.word] - own1 * inside[g.doc]) * scale
        n = ((total - sizes * inside) * scale)[g.doc]
        p = (a + PRIOR) / (n + PRIOR * vocabulary)
        b, before = (c2[g.pair] - own2 * inside[g.doc[g.after]]) * scale, a[g.after - 1]
        q = np.divide(b, before, out=np.zeros(len(b)), where=before > 0)
        p[g.after] = (1 - LAMBDA) * p[g.after] + LAMBDA * np.minimum(q, 1)
        out.append(np.divide(np.bincount(g.doc, -np.log(p), len(sizes)), sizes, out=np.zeros(len(sizes)), where=sizes > 0))
    return out


def cross_entropy_difference(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens, target_entropy, background_entropy, difference (negative: more like the target) for every row.

    ``target`` has the ids of the target's documents. A text without a word has 0 tokens and null entropies. Repeated
    rows are counted and scored one by one; a null id is never in the target; other columns are not read. With an empty
    target both models are uniform or the background alone, and an empty table gives no rows.
    """
    mark = target.select(F.col(id_col).alias("id_")).dropDuplicates().withColumn("target_", F.lit(True))
    rows = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    marked = rows.join(mark.hint("merge"), "id_", "left")  # never broadcast: ids have no bound
    dealt = stored(_dealt(marked), "dealt")
    chars = dealt.agg(F.sum("chars_")).first()[0] or 0
    n = docs.sparkSession.sparkContext.defaultParallelism + -(-chars // RANGE_CHARS)
    summed = _asked(dealt, n).groupBy("range_").applyInArrow(_summed, "chunk_ long, range_ long, words binary, pairs binary, n_words long, t long, n long")
    summed = stored(summed, "counts")
    found = summed.filter("chunk_ IS NULL").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_words", "t", "n")]).first()
    vocabulary, totals = max(WORDS, found[0]), (found[1], found[2])
    kind = docs.schema[id_col].dataType.simpleString()

    def score(asked: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts, marks = _opened(asked["docs_"][0].as_buffer())
        g = _Grams(texts)
        sizes = np.bincount(g.doc, minlength=len(texts))
        answers = answers.sort_by("range_")
        counts = []
        for name, into in zip(("words", "pairs"), g.ranges(n)):
            each = np.bincount(np.searchsorted(answers["range_"].to_numpy(), into), minlength=len(answers))
            got = [_unpacked(x.as_buffer(), k) for x, k in zip(answers[name], each.tolist())]
            counts.append(np.empty((2, len(into)), np.int64))
            if got:
                counts[-1][:, np.argsort(into, kind="stable")] = np.concatenate(got, axis=1)
        h = _entropies(g, marks, *counts, sizes, totals, vocabulary)
        empty = sizes == 0
        return pa.table([ids, pa.array(sizes), pa.array(h[0], mask=empty), pa.array(h[1], mask=empty)], [id_col, "n_tokens", "target_entropy", "background_entropy"])

    answers = summed.filter("chunk_ IS NOT NULL").select("chunk_", "range_", "words", "pairs")
    scored = dealt.select("chunk_", "docs_").groupBy("chunk_").cogroup(answers.groupBy("chunk_")).applyInArrow(score, f"{id_col} {kind}, n_tokens long, target_entropy double, background_entropy double")
    return scored.withColumn("difference", F.col("target_entropy") - F.col("background_entropy"))
