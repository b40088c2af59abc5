"""Removal of long repeated byte strings by a column-wise suffix construction over many documents.

A string of ``length`` bytes that starts in two places must be found wherever it starts, without sorting all suffixes in
one place. Three steps cut the collection down to what can repeat; none of them can miss a string:

1. Every window of ``length`` bytes has an anchor: its ``GRAM``-byte string of least hash (the leftmost). Equal windows
   have equal anchors at equal places, so windows are grouped by anchor, and anchors found once are dropped. A segment is
   the stretch of text that the consecutive windows of one anchor cover.
2. Equal segments of an anchor are counted, not copied. Where an anchor has one segment only, all its windows repeat.
3. The distinct segments of the other anchors are laid over each other at their anchor. They form the collections whose
   suffixes are sorted.

The construction takes one column a round, from right to left: it puts one symbol before each segment's suffix and moves
the suffixes to their new places, which the column of the Burrows-Wheeler transform says (a stable order by symbol keeps
the order of the rounds before), and takes the new common prefix of neighbours as one more than the least old one between
them. Since equal windows lie at equal places of their segments, suffixes of different columns never share ``length``
bytes: the transform falls into one section a column, and only the last is needed to make the next. Columns are read
from an external file written column by column, so memory is a few numbers a segment whatever their length. A window
repeats if a neighbour shares ``length`` bytes or its segment has copies.

An anchor with more than ``LIMIT`` distinct segments is not sorted in one task: its windows are counted one by one by
their hash, in an aggregate that splits freely.
"""

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.shared import U, _powers, mix, per_batch, stored

GRAM = 32
LIMIT = 1 << 14
#: Segments sorted together (several anchors share a construction).
BATCH = 1 << 13
#: Bytes of text per hashing pass; places in a pass take 21 bits of the packed minima.
PASS = 1 << 20
_RNG = np.random.default_rng(7)
SYMBOL = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
STEP = _RNG.integers(0, 2**63, 16, dtype=np.uint64) * U(2) + U(1)


def _grams(b: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the ``size`` bytes (a power of two) from each place."""
    h, span, k = SYMBOL[b], 1, 0
    while span < size:
        h = h[:-span] * STEP[k] + h[span:]
        h ^= h >> U(29)
        span, k = 2 * span, k + 1
    return mix(h)


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each run of ``span`` values."""
    m, have = values, 1
    while have < span:
        step = min(have, span - have)
        m = np.minimum(m[:-step], m[step:])
        have += step
    return m


def _string_hash(b: np.ndarray):
    """Function from starts and ends to hashes of those strings."""
    power, inverse = _powers(len(b) + 1)
    total = np.zeros(len(b) + 1, U)
    np.cumsum((b.astype(U) + U(1)) * power[: len(b)], out=total[1:])
    return lambda s, e: mix((total[e] - total[s]) * inverse[s] + (e - s).astype(U))


def _anchors(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
    """Document, first window, windows, anchor's place after the first window, anchor hash and segment hash."""
    span = length - GRAM + 1
    gram = _grams(b, GRAM)
    packed = (gram & ~U((1 << 21) - 1)) | np.arange(len(gram), dtype=U)
    at = (_least(packed, span) & U((1 << 21) - 1)).astype(np.int64)  # anchor of the window at each place
    doc = np.repeat(np.arange(len(starts)), ends - starts)
    inside = np.arange(len(at)) + length <= ends[doc[: len(at)]]
    new = np.r_[True, (at[1:] != at[:-1]) | ~inside[:-1] | (doc[1 : len(at)] != doc[: len(at) - 1])]
    first = np.flatnonzero(new & inside)
    cut = np.append(np.flatnonzero(new | ~inside), len(at))
    last = cut[np.searchsorted(cut, first, side="right")]
    return doc[first], first - starts[doc[first]], last - first, at[first] - first, gram[at[first]], _string_hash(b)(first, last - 1 + length)


def _passes(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(document, offset, bytes) lists of about ``PASS`` bytes; parts of a long text overlap by ``length - 1`` bytes."""
    docs, offsets, parts, size = [], [], [], 0
    for i, t in enumerate(texts):
        for o in range(0, max(1, len(t) - length + 1), PASS):
            part = t[o : o + PASS + length - 1]
            if size + len(part) > PASS + length and parts:
                yield docs, offsets, parts
                docs, offsets, parts, size = [], [], [], 0
            docs.append(i), offsets.append(o), parts.append(part)
            size += len(part)
    if parts:
        yield docs, offsets, parts


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """key, start, n, off, anchor, segment of every anchor of the (key, text) rows."""

    def work(batch: pa.RecordBatch):
        keys = batch.column(0).to_numpy()
        texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
        for rows, offsets, parts in _passes(texts, length):
            ends = np.cumsum([len(p) for p in parts])
            if ends[-1] < length:
                continue
            doc, first, n, off, anchor, segment = _anchors(np.frombuffer(b"".join(parts), np.uint8), ends - [len(p) for p in parts], ends, length)
            cols = keys[np.array(rows)[doc]], first + np.array(offsets)[doc], n.astype(np.int16), off.astype(np.int16), anchor.view(np.int64), segment.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["key", "start", "n", "off", "anchor", "segment"])

    return per_batch(docs, work, "key long, start long, n short, off short, anchor long, segment long")


def repeated_windows(texts: list[bytes], groups: np.ndarray, n: np.ndarray, off: np.ndarray, length: int) -> np.ndarray:
    """Segment by window: does another segment of its group hold the same window? Rounds go over columns, right to left."""
    m, left = len(texts), int(off.max())
    ends = n - 1 + length - off  # right end of each segment, counted from its anchor
    width = left + int(ends.max())
    found = np.zeros((m, int(n.max())), bool)
    with tempfile.TemporaryFile() as file:
        for s in range(0, width, 64):  # the external file holds the collection column by column
            block = np.zeros((min(64, width - s), m), np.uint16)
            for i, t in enumerate(texts):
                lo = left - int(off[i])
                a, e = max(s, lo), min(s + len(block), lo + len(t))
                if a < e:
                    block[a - s : e - s, i] = np.frombuffer(t, np.uint8, e - a, a - lo) + np.uint16(1)
            file.write(block.tobytes())
        order = np.argsort(groups, kind="stable")
        prefix = np.zeros(m, np.int64)  # with the suffix before it in the order
        own = groups[order]
        edge = np.r_[True, own[1:] != own[:-1]]
        group_rank = np.cumsum(edge) - 1
        for column in range(width - 1, -1, -1):
            file.seek(column * m * 2)
            symbol = np.frombuffer(file.read(m * 2), np.uint16)[order].astype(np.int64)
            move = np.argsort(group_rank * 257 + symbol, kind="stable")
            symbol = symbol[move]
            gap = move[1:] - move[:-1]
            same = (symbol[1:] == symbol[:-1]) & (symbol[1:] > 0) & ~edge[1:]
            fresh = np.zeros(m, np.int64)
            if same.any():
                i, j = move[:-1][same] + 1, move[1:][same]
                fresh[1:][same] = _range_least(prefix, i, j, int(gap[same].max())) + 1
            order, prefix = order[move], fresh
            start = column - left + off[order]  # window that starts here, of each segment
            fits = (start >= 0) & (start < n[order])
            long = prefix >= length
            hit = fits & (long | np.r_[long[1:], False])
            found[order[hit], start[hit]] = True
    return found


def _range_least(values: np.ndarray, i: np.ndarray, j: np.ndarray, widest: int) -> np.ndarray:
    """Least of values[i..j] for each pair, by runs of doubling length."""
    out, size = np.empty(len(i), values.dtype), j - i + 1
    run, table = 1, values
    while True:
        here = (size >= run) & (size < 2 * run)
        if here.any():
            out[here] = np.minimum(table[i[here]], table[j[here] - run + 1])
        if 2 * run > widest:
            return out
        table = np.minimum(table[:-run], table[run:])
        run *= 2


def _spans(windows: np.ndarray, length: int) -> list[int]:
    """Start, end, start, end ... of the bytes that the marked windows cover."""
    at = np.flatnonzero(windows)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length)
    return np.stack([np.r_[at[:1], at[cut + 1]], np.r_[at[cut], at[-1:]] + length], axis=1).ravel().tolist()


def _construct(length: int):
    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        n, off = t["n"].to_numpy().astype(np.int64), t["off"].to_numpy().astype(np.int64)
        groups = np.unique(t["anchor"].to_numpy(), return_inverse=True)[1]
        found = repeated_windows([x.as_py() for x in t["bytes"]], groups, n, off, length)
        spans = [_spans(w, length) for w in found]
        return pa.RecordBatch.from_arrays([t["anchor"].combine_chunks(), t["segment"].combine_chunks(), pa.array(spans, pa.list_(pa.int32()))], ["anchor", "segment", "spans"])

    def work(batches):
        """Rows come sorted by anchor; whole anchors are sorted together, about BATCH segments at a time."""
        held, size = [], 0
        for batch in batches:
            anchor = batch.column("anchor").to_numpy()
            starts = np.r_[0, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor)]
            for s, e in zip(starts, starts[1:]):
                piece = batch.slice(s, e - s)
                if size >= BATCH and held[-1].column("anchor")[0] != piece.column("anchor")[0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(piece)
                size += e - s
        if held:
            yield solve(held)

    return work


def _by_window(rows: DataFrame, length: int) -> DataFrame:
    """anchor, segment, spans of the segments of very common anchors, whose windows are counted by hash."""

    def windows(batch: pa.RecordBatch):
        for anchor, segment, off, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "segment", "off", "bytes"))):
            s = np.arange(len(data) - length + 1)
            h = mix(_string_hash(np.frombuffer(data, np.uint8))(s, s + length) + (s - off).astype(U)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([anchor] * len(s)), pa.array([segment] * len(s)), pa.array(s.astype(np.int32)), pa.array(h)], ["anchor", "segment", "place", "h"])

    each = stored(per_batch(rows.select("anchor", "segment", "off", "bytes"), windows, "anchor long, segment long, place int, h long"), "windows")
    twice = each.groupBy("anchor", "h").agg(F.count("*").alias("c")).filter(F.col("c") > 1).drop("c")
    hits = each.join(twice, ["anchor", "h"], "left_semi").groupBy("anchor", "segment").agg(F.sort_array(F.collect_list("place")).alias("places"))
    return hits.select("anchor", "segment", F.flatten(F.transform("places", lambda p: F.array(p, p + length))).alias("spans"))


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """key, spans (array of start and end) for (key, text) rows with bytes to remove; repeated keys are repeated rows."""
    every = stored(anchors(docs, length), "anchors")
    common = stored(every.groupBy("anchor").agg(F.count("*").alias("c")).filter(F.col("c") > 1).select("anchor"), "common")
    hits = stored(every.join(common, "anchor"), "hits")
    kinds = stored(hits.groupBy("anchor").agg(F.min("segment").alias("lo"), F.max("segment").alias("hi")).select("anchor", (F.col("lo") == F.col("hi")).alias("plain")), "kinds")
    whole = F.array(F.col("start"), F.col("start") + F.col("n") - 1 + length)
    known = hits.join(kinds, "anchor")
    plain = known.filter("plain").select("key", whole.alias("spans"))
    mixed = stored(known.filter("not plain").drop("plain"), "mixed")

    distinct = mixed.groupBy("anchor", "segment").agg(F.count("*").alias("c"), F.min(F.struct("key", "start", "n", "off")).alias("one"))
    wanted = distinct.select("one.*", "anchor", "segment", "c")
    at = wanted.groupBy("key").agg(F.collect_list(F.struct("start", "n", "off", "anchor", "segment", "c")).alias("parts"))

    def cut(batch: pa.RecordBatch):
        for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist()):
            data = text.encode("utf-8", "surrogatepass")
            cols = [[p[c] for p in parts] for c in ("anchor", "segment", "n", "off", "c")]
            kinds = pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.int64()
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols, kinds), pa.array([data[p["start"] : p["start"] + p["n"] - 1 + length] for p in parts], pa.binary())], ["anchor", "segment", "n", "off", "c", "bytes"])

    segments = per_batch(docs.join(at, "key").select("text", "parts"), cut, "anchor long, segment long, n short, off short, c long, bytes binary")
    segments = stored(segments.dropDuplicates(["anchor", "segment"]), "segments")
    size = segments.groupBy("anchor").agg(F.count("*").alias("size")).filter(F.col("size") > LIMIT).select("anchor")
    size = stored(size, "hot")
    usual = segments.join(size, "anchor", "left_anti")
    sorted_ = usual.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_construct(length), "anchor long, segment long, spans array<int>")
    counted = segments.filter("c > 1").select("anchor", "segment", F.array(F.lit(0), F.col("n") - 1 + length).cast("array<int>").alias("spans"))
    marks = sorted_.filter(F.size("spans") > 0).unionByName(counted)
    if not size.isEmpty():
        marks = marks.unionByName(_by_window(segments.join(size, "anchor"), length))
    marks = stored(marks.groupBy("anchor", "segment").agg(F.flatten(F.collect_list("spans")).alias("spans")), "marks")
    part = mixed.join(marks, ["anchor", "segment"]).select("key", F.transform("spans", lambda x: F.col("start") + x).alias("spans"))
    return plain.unionByName(part).groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _merge(spans: list[int] | None) -> np.ndarray:
    """Disjoint, sorted (start, end) rows."""
    s = np.array(spans or [], np.int64).reshape(-1, 2)
    if not len(s):
        return s
    s = s[np.argsort(s[:, 0], kind="stable")]
    top = np.maximum.accumulate(s[:, 1])
    new = np.r_[True, s[1:, 0] > top[:-1]]
    return np.stack([s[new, 0], np.r_[top[:-1][new[1:]], top[-1:]]], axis=1)


def drop_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string (UTF-8) that also starts anywhere else; one row a row.

    Gives id_col, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256; with ``keep`` also row (the input row
    as a struct), spans (start, end, ...) and kept_text (remaining bytes decoded; parts of a cut character are left out;
    null for null). Strings are judged on the input. A null or empty text has no bytes; texts shorter than ``length`` keep
    all; a repeated row is a document of its own, so both lose what they share; null ids are ids like others; an empty table
    gives no rows.
    """
    key = F.xxhash64(id_col, text_col)
    rows = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    spans = repeated_spans(rows.filter(F.octet_length("text") >= length), length)
    own = F.struct(*[F.col(c) for c in docs.columns if c != text_col]) if keep else F.struct(id_col)
    both = docs.select(own.alias("row"), F.col(text_col).alias("text"), key.alias("key")).join(spans, "key", "left")

    def finish(batch: pa.RecordBatch):
        texts, every = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
        out = []
        for text, spans in zip(texts, every):
            data, cut = (text or "").encode("utf-8", "surrogatepass"), _merge(spans)
            edges = [0, *cut.ravel().tolist(), len(data)]
            left = b"".join(data[s:e] for s, e in zip(edges[0::2], edges[1::2])) if len(cut) else data
            out.append((len(data), len(data) - len(left), len(cut), hashlib.sha256(left).hexdigest(), edges[1:-1], left))
        cols = [batch.column("row"), *(pa.array([o[i] for o in out], t) for i, t in enumerate([pa.int64(), pa.int64(), pa.int64(), pa.string()]))]
        names = ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if keep:
            cols += [pa.array([o[4] for o in out], pa.list_(pa.int64())), pa.array([o[5].decode("utf-8", "ignore") if t is not None else None for o, t in zip(out, texts)], pa.string())]
            names += ["spans", "kept_text"]
        yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"row {both.schema['row'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", spans array<long>, kept_text string" if keep else "")
    out = per_batch(both.select("row", "text", "spans"), finish, schema)
    return out.select(F.col(f"row.{id_col}").alias(id_col), *[c for c in out.columns if keep or c != "row"])
