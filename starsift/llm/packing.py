"""Best-fit packing of tokenised documents into sequences, certified by dual-feasible-function bounds.

Documents are tokenised where they are read; from then on only (id, piece, length) rows move. Pieces as long as a sequence
fill one by themselves. The others are dealt over groups of about ``group_size`` pieces. Each group is packed by best-fit
decreasing and certified if its bin count equals its lower bound. If all bins together exceed the bound of all pieces
together, a gap is left that certified groups can share too: one may hold long pieces only, whose room another's short
ones would fill. So groups with a gap, and groups with a bin's worth of room, exchange the pieces of their bins that are not
full: those are dealt anew over half as many groups and packed again, until the whole is certified, one group is left, or
the exchange wins nothing. What is exchanged shrinks each round, and the better packing of two rounds is kept.
"""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.chunks import Ids, kept
from starsift.llm.shared import per_batch, runs, stored

GROUP_SIZE = 8192
ROUNDS = 4
FITTED = "id_ {0}, row_ long, piece int, length long, bin_ long, offset long, full boolean, bins long, bound long, room long"


def pieces_of(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", chunking: str = "spaced") -> DataFrame:
    """One row per piece: id_col, piece, start, length, ids_crc32. A document over ``capacity`` has its short piece first."""
    end = np.array([end_id], "<u4").tobytes()

    def work(batch: pa.RecordBatch):
        ids = kept(Ids, path, chunking)
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for a, z in runs(texts):
            row, piece, start, length, crc = [], [], [], [], []
            for k, data in enumerate(ids(texts[a:z])):
                data += end
                n = len(data) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for p, (s, e) in enumerate(zip(cuts, cuts[1:])):
                    row.append(k), piece.append(p), start.append(s), length.append(e - s), crc.append(zlib.crc32(data[4 * s : 4 * e]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, z - a).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                [id_col, "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return per_batch(docs.select(id_col, text_col), work, f"{id_col} {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in the bin, and whether that bin ends full, of each length."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some, n = 0, 0  # bit r of ``some``: a bin has r tokens of room
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        fits = some >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                some ^= 1 << left
        else:
            left, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - left
        room[left - size].append(b)
        some |= 1 << (left - size)
    full = np.zeros(n, bool)
    full[room[0]] = True
    return bins, offsets, full[bins]


def lower_bound(count: np.ndarray) -> int:
    """Largest bound over the dual feasible functions f_e: sizes over capacity - e count whole, sizes under e not at all.

    ``count`` has the number of pieces of each size from 0 to the capacity.
    """
    capacity = len(count) - 1
    total = np.cumsum(count * np.arange(capacity + 1))
    over = count[::-1].cumsum()[::-1]
    e = np.arange(capacity // 2 + 1)
    whole = np.where(e > 0, over[np.minimum(capacity - e + 1, capacity)], 0)
    middle = total[capacity - e] - np.where(e > 0, total[e - 1], 0)
    return int((whole - (-middle // capacity)).max())


def _fit(capacity: int):
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["length"].to_numpy()
        bins, offsets, full = best_fit_decreasing(lengths, capacity)
        out = group[["id_", "row_", "piece", "length"]].copy()
        out["bin_"], out["offset"], out["full"] = bins + (int(group["group_"].iloc[0]) << 32), offsets, full
        out["bins"], out["bound"] = int(bins.max()) + 1, lower_bound(np.bincount(lengths, minlength=capacity + 1))
        out["room"] = (int(bins.max()) + 1) * capacity - int(lengths.sum())
        return out

    return fit


def _round(items: DataFrame, groups: int, salt: int, capacity: int, kind: str) -> DataFrame:
    group = F.pmod(F.xxhash64("id_", "row_", "piece", F.lit(salt)), F.lit(groups))
    dealt = items.select("id_", "row_", "piece", "length", (F.lit(salt * (1 << 20)) + group).alias("group_"))
    return stored(dealt.groupBy("group_").applyInPandas(_fit(capacity), FITTED.format(kind)), "packed")


def pack(pieces: DataFrame, capacity: int, id_col: str = "doc_id", group_size: int = GROUP_SIZE, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to rows with ``length`` (1 to ``capacity``) and the piece's own columns.

    Repeated rows are packed one by one; a null id is an id like any other; no rows give no rows; ties go to the bin
    opened or left last. Every sequence holds at most ``capacity`` tokens, without gaps from 0.
    """
    kind = pieces.schema[id_col].dataType.simpleString()
    rows = stored(pieces.withColumn("row_", F.monotonically_increasing_id()), "pieces")
    short = rows.filter(F.col("length") < capacity)
    count = np.zeros(capacity + 1, np.int64)
    for length, n in short.groupBy("length").count().collect():  # at most ``capacity`` rows
        count[length] = n
    n, bound = int(count.sum()), lower_bound(count)
    done: list[DataFrame] = []
    if n:
        groups, kept = -(-n // group_size), 0
        now = _round(short.withColumnRenamed(id_col, "id_"), groups, 1, capacity, kind)
        for salt in range(2, rounds + 2):
            gap = (F.col("bins") > F.col("bound")) | (F.col("room") >= capacity)
            loose = now.filter(gap & ~F.col("full"))
            total = now.agg(F.countDistinct("bin_")).first()[0]
            size, before = loose.agg(F.count("*"), F.countDistinct("bin_")).first()
            if not size or groups == 1 or kept + total == bound:
                break
            fewer = max(1, min(groups // 2, -(-size // group_size)))
            again = _round(loose, fewer, salt, capacity, kind)
            if again.agg(F.countDistinct("bin_")).first()[0] >= before:
                break
            done.append(now.filter(~gap | F.col("full")))
            now, groups, kept = again, fewer, kept + total - before
        done.append(now)
    placed = [d.select("row_", F.col("bin_").alias("sequence_id"), "offset") for d in done]
    whole = rows.filter(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("row_"), "offset": F.lit(0).cast("long")})
    for p in placed:
        whole = whole.unionByName(short.join(p, "row_"))
    return whole.drop("row_")


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", chunking: str = "spaced", group_size: int = GROUP_SIZE, rounds: int = ROUNDS) -> DataFrame:
    """Tokenise, cut and pack. A null text counts as empty: one piece that holds only the end id."""
    return pack(pieces_of(docs, path, capacity, end_id, id_col, text_col, chunking), capacity, id_col, group_size, rounds)
