"""Token ids in a Simple-8b file format, written and read by Spark.

A shard holds some documents in ascending id order. Its payload has little-endian parts in this order::

    4 x uint64   documents, ids, words, escapes
    int64[]      token offset of each document in the shard
    uint32[]     word at which each block of 1,024 ids starts
    uint64[]     words: selector in the top 4 bits, then as many ids as the selector says in the other 60, first id lowest
    uint64[]     escapes: place in the shard, value; ids of 2**60 and more, which stand as 0 in their word

A block starts on a word of its own, so any document can be decoded from its blocks alone. Files are Parquet with one
shard a row, so that Spark's committer decides which attempt of a task counts, on any store.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.llm.chunks import Ids, kept
from starsift.llm.shared import per_batch, runs

BLOCK = 1024
#: Fixed values of the format: ids in a word and bits of each, by selector.
COUNTS = [240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
WIDTHS = [0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]
SHARD_IDS = 1 << 20
U = np.uint64


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    if not len(values) or int(values.max()) < 1 << 53:
        return np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    high = values >> U(32)
    return np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 32, np.frexp((values & U(0xFFFFFFFF)).astype(np.float64))[1]).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block, and escapes (place, value) of unsigned 64-bit ids."""
    values = values.astype(U)
    large = np.flatnonzero(values >> U(60))
    escapes = np.stack([large.astype(U), values[large]], axis=1).ravel()
    values[large] = 0
    n = len(values)
    blocks = -(-n // BLOCK)
    # Past a block's end stands more than any selector takes, so no word reaches over it.
    bits = np.full(blocks * BLOCK, 61, np.uint8)
    bits[:n] = _widths(values)
    apart = np.full((blocks, BLOCK + COUNTS[0]), 61, np.uint8)
    apart[:, :BLOCK] = bits.reshape(blocks, BLOCK)
    widest = apart.ravel()
    best = np.full(len(widest), 15, np.uint8)  # selector that takes most ids from here
    run = 1
    for s in range(14, -1, -1):
        while run < COUNTS[s]:  # widest id among the next ``run``
            step = min(run, COUNTS[s] - run)
            widest = np.maximum(widest[:-step], widest[step:])
            run += step
        fits = widest <= WIDTHS[s]
        best[: len(fits)][fits] = s
        if s and not (widest <= WIDTHS[s - 1]).any():  # longer runs need fewer bits still
            break
    best = best.reshape(blocks, BLOCK + COUNTS[0])[:, :BLOCK]
    after = (np.array(COUNTS)[best] + np.arange(BLOCK)).ravel() + np.repeat(np.arange(blocks) * BLOCK, BLOCK)
    begins, here = np.zeros(blocks * BLOCK, bool), np.arange(blocks) * BLOCK
    end = np.minimum(here + BLOCK, n)
    while len(here):  # one word further in every block
        begins[here] = True
        here = after[here]
        here, end = here[here < end], end[here < end]
    at = np.flatnonzero(begins)
    firsts = np.searchsorted(at, np.arange(blocks) * BLOCK).astype(np.uint32)
    chosen = best.ravel()[at] if n else np.zeros(0, np.uint8)
    words = chosen.astype(U) << U(60)
    for s in np.unique(chosen):
        if WIDTHS[s]:
            here = np.flatnonzero(chosen == s)
            ids = values[at[here, None] + np.arange(COUNTS[s])]
            words[here] |= np.bitwise_or.reduce(ids << (U(WIDTHS[s]) * np.arange(COUNTS[s], dtype=U)), axis=1)
    return words, firsts, escapes


def decode(words: np.ndarray, firsts: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ids again; all words of one selector are unpacked together."""
    chosen = (words >> U(60)).astype(np.int64)
    counts = np.array(COUNTS)[chosen]
    before = np.cumsum(counts) - counts
    block = np.searchsorted(firsts, np.arange(len(words)), side="right") - 1
    start = before - before[firsts[block]] + block * BLOCK if len(words) else before
    out = np.zeros(n, U)
    for s in np.unique(chosen):
        if WIDTHS[s]:
            here = np.flatnonzero(chosen == s)
            out[start[here, None] + np.arange(COUNTS[s])] = (words[here, None] >> (U(WIDTHS[s]) * np.arange(COUNTS[s], dtype=U))) & U((1 << WIDTHS[s]) - 1)
    out[escapes[0::2].astype(np.int64)] = escapes[1::2]
    return out


def to_shard(ids: list[np.ndarray]) -> bytes:
    lengths = np.array([len(i) for i in ids], np.int64)
    values = np.concatenate(ids) if ids else np.zeros(0, U)
    words, firsts, escapes = encode(values)
    head = np.array([len(ids), len(values), len(words), len(escapes) // 2], "<u8")
    parts = head, (np.cumsum(lengths) - lengths).astype("<i8"), firsts.astype("<u4"), words.astype("<u8"), escapes.astype("<u8")
    return b"".join(p.tobytes() for p in parts)


def from_shard(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a shard, and the offset of each document with the end appended."""
    docs, n, n_words, n_escapes = np.frombuffer(data, "<u8", 4).astype(np.int64).tolist()
    at = 32
    out = []
    for kind, count in (("<i8", docs), ("<u4", -(-n // BLOCK)), ("<u8", n_words), ("<u8", 2 * n_escapes)):
        out.append(np.frombuffer(data, kind, count, at))
        at += out[-1].nbytes
    return decode(out[2], out[1], out[3], n), np.r_[out[0], n]


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", chunking: str = "words") -> None:
    """Tokenise ``docs`` and write shards in ascending ``id_col`` order (nulls first; rows with equal ids in any order).

    A null text counts as empty: the end id alone. An empty table writes no shard. Other columns are not read. The rows
    are range-partitioned by id, so a task holds a run of ids whatever their number.
    """
    end = np.array([end_id], "<u4").tobytes()

    def work(batches):
        ids, part, seq = kept(Ids, path, chunking), TaskContext.get().partitionId(), 0
        keys, held, size = [], [], 0

        def shard():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()), pa.array([keys], pa.list_(batch.schema.field(0).type)), pa.array([to_shard(held)], pa.binary())],
                ["part", "seq", "n_ids", "ids", "payload"],
            )

        for batch in batches:
            own, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, z in runs(texts):
                for k, data in zip(own[a:z], ids(texts[a:z])):
                    held.append(np.frombuffer(data + end, "<u4")), keys.append(k)
                    size += len(held[-1])
                    if size >= SHARD_IDS:
                        yield shard()
                        keys, held, size, seq = [], [], 0, seq + 1
        if held:
            yield shard()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, text_col).repartitionByRange(F.col(id_col).asc_nulls_first()).sortWithinPartitions(F.col(id_col).asc_nulls_first())
    rows.mapInArrow(work, f"part int, seq int, n_ids long, ids array<{kind}>, payload binary").write.parquet(folder)


def read_ids(spark: SparkSession, folder: str, id_col: str = "doc_id", keep: bool = True) -> DataFrame:
    """One row per document of the shards in ``folder``: id_col, start, n_tokens, ids_crc32 and, with ``keep``, its ids.

    ``start`` counts the ids of all documents before it. Totals by part (as many as the writer had tasks) meet in the
    driver; all else stays in the tasks.
    """
    shards = spark.read.parquet(folder)
    kind = shards.schema["ids"].dataType.elementType.simpleString()
    # one row a shard: n_ids alone is read for the totals
    totals = sorted((r[0], r[1]) for r in shards.groupBy("part").agg(F.sum("n_ids")).collect())
    base, sums = 0, []
    for part, n in totals:
        sums.append((part, base))
        base += n
    bases = spark.createDataFrame(sums, "part int, base_ long")
    before = shards.select("part", "seq", "n_ids").alias("a").join(shards.select("part", "seq", "n_ids").alias("b"), (F.col("a.part") == F.col("b.part")) & (F.col("b.seq") < F.col("a.seq")), "left")
    before = before.groupBy("a.part", "a.seq").agg(F.coalesce(F.sum("b.n_ids"), F.lit(0)).alias("before_")).join(bases, "part")

    def work(batch: pa.RecordBatch):
        for part, seq, keys, data in zip(*(batch.column(c) for c in ("part", "seq", "ids", "payload"))):
            values, at = from_shard(data.as_py())
            values = values.astype("<u4") if values.size == 0 or values.max() < 1 << 32 else values
            cols = [
                pa.array([part.as_py()] * (len(at) - 1), pa.int32()), pa.array([seq.as_py()] * (len(at) - 1), pa.int32()),
                keys.values, pa.array(at[:-1]), pa.array(np.diff(at)), pa.array([zlib.crc32(values[s:e].tobytes()) for s, e in zip(at, at[1:])], pa.int64()),
            ]
            names = ["part", "seq", "key_", "at_", "n_tokens", "ids_crc32"]
            if keep:
                cols, names = [*cols, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.astype(np.int64)))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"part int, seq int, key_ {kind}, at_ long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep else "")
    found = per_batch(shards.select("part", "seq", "ids", "payload"), work, schema).join(before, ["part", "seq"])
    return found.select(F.col("key_").alias(id_col), (F.col("base_") + F.col("before_") + F.col("at_")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if keep else []))
