"""Exact n-gram Jaccard join by vertical partitioning of one global n-gram order.

1. The global order puts rarer n-grams first: (number of sets that hold it, hash). Runs of texts send each distinct n-gram
   once to its hash range, with the set it stands in; ranges count them and answer only n-grams of several sets, since
   others can be in no overlap. An n-gram that many sets of one run hold goes out once with its count, and its sets wait at
   the run, so a frequent n-gram costs one entry a run.
2. A set of n n-grams that links with another shares one of its first n - ceil(n * percent / 100) + 1 n-grams with it, so
   only those are posted. In a list, a set stays only if the n-grams left to it suffice for the smallest partner there.
   Sets of one list belong to one cluster (components of stars, never pairs).
3. The order is cut into ``FRAGMENTS`` of like weight. Within a fragment each set has a segment; blocks of at most about
   ``BLOCK`` sets meet there, and each fragment's partial overlaps are counted by themselves, as one product of incidence
   matrices. Partial overlaps are summed per pair and compared with the sizes; a block pair answers with links that span
   what it found. No task needs whole sets, and no pair becomes a row.
4. Small clusters are one block. In larger ones all sets first meet ``HUBS`` sets that have the fewest n-grams for
   themselves; blocks that a hub already links are not compared again with one another.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.components import components
from starsift.llm.shared import U, mix, per_batch, runs, stored

WIDTH, PERCENT = 5, 80
FRAGMENTS, BLOCK, HUBS = 8, 128, 4
#: Characters of a run, and n-grams that one range counts.
RUN_CHARS, RANGE_GRAMS = 8_000_000, 1 << 21
#: Words whose hash a worker remembers.
WORD_ENTRIES = 500_000
STEP = U(0x9E3779B97F4A7C15)
#: Place of a set without words.
NONE = 0xFFFF


class WordHashes(dict):
    """64 bits of a cryptographic hash for each word."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) < WORD_ENTRIES:
            self[word] = value
        return value


_WORDS = WordHashes()


def gram_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles in ASCII lower case; fewer words make one, none make none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(_WORDS.__getitem__, words), U, len(words))
    if not len(hashes):
        return hashes
    size = max(1, len(hashes) - width + 1)
    out = mix(hashes[:size] + U(min(width, len(hashes))))
    for k in range(1, min(width, len(hashes))):
        out = mix(out * STEP + hashes[k : k + size])
    return np.unique(out)


def least_overlap(n: int, percent: int) -> int:
    """n-grams that a set of ``n`` shares with any set it links with, at least."""
    return -(-n * percent // 100)


ROUTE = ["a", "b", "c", "d", "e"]
LAYOUT = "range int, run long, kind int, ids array<{kind}>, a binary, b binary, c binary, d binary, e binary"


def _requests(docs: DataFrame, id_col: str, text_col: str, width: int, ranges: int) -> DataFrame:
    """Per run one row of kind 0 (ids, place of each row's set, digests and sizes of the sets, n-grams of several sets) and per
    range one of kind 1 (n-grams of one set, that set, n-grams of several sets, their counts)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in runs(texts, RUN_CHARS):
                run = (part << 32) + number
                number += 1
                places, digests, sets = [], {}, []
                for t in texts[lo:hi]:
                    s = gram_set(t, width)
                    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    if len(s) and d not in digests:
                        digests[d] = len(sets)
                        sets.append(s)
                    places.append(digests[d] if len(s) else NONE)
                every = np.concatenate([*sets, np.zeros(0, U)])
                owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets]).astype(np.uint16)
                order = np.argsort(every, kind="stable")
                every, owner = every[order], owner[order]
                first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]][: len(every)])
                count = np.diff(np.r_[first, len(every)])
                alone = first[count == 1]
                several = np.repeat(count > 1, count)
                columns = [every[alone], owner[alone], every[first[count > 1]], count[count > 1].astype(np.uint32)]
                cuts = [np.searchsorted((c >> U(40)) * U(ranges) >> U(24), np.arange(ranges + 1)) for c in (columns[0], columns[2])]
                rows = [(run % ranges, run, 0, batch.column(0).slice(lo, hi - lo).to_pylist(), np.array(places, np.uint16), b"".join(digests), np.array([len(s) for s in sets], np.uint32), every[several], owner[several])]
                for r in range(ranges):
                    own = [c[cut[r] : cut[r + 1]] for c, cut in zip(columns, (cuts[0], cuts[0], cuts[1], cuts[1]))]
                    if len(own[0]) or len(own[2]):
                        rows.append((r, run, 1, None, *own, None))
                yield _routed(rows, batch.schema.field(0).type)

    return docs.select(id_col, text_col).mapInArrow(work, LAYOUT.format(kind=kind))


def _routed(rows: list[tuple], kind: pa.DataType, names: list[str] = ["range", "run", "kind", "ids", *ROUTE]) -> pa.RecordBatch:
    data = [[x.tobytes() if isinstance(x, np.ndarray) else x for x in r] for r in rows]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.list_(kind), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*data), types)], names)


def _array(values: list, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(v or b"", kind) for v in values]


def _answers(table: pa.Table) -> pa.Table:
    """Counts of one range: n-grams of one set of a run and of several sets of all, that set and the number of sets; then
    n-grams of several sets of a run and their number of sets."""
    asks = pc.equal(table.column("kind"), 1)
    asked = table.filter(asks)
    single, owner = _array(asked.column("a").to_pylist(), "<u8"), _array(asked.column("b").to_pylist(), "<u2")
    several, count = _array(asked.column("c").to_pylist(), "<u8"), _array(asked.column("d").to_pylist(), "<u4")
    out = [table.filter(pc.invert(asks))]
    if asked.num_rows:
        grams = np.concatenate([*single, *several])
        weight = np.concatenate([*(np.ones(len(s), np.uint32) for s in single), *count])
        _, inverse = np.unique(grams, return_inverse=True)
        total = np.bincount(inverse, weight).astype(np.uint32)[inverse]
        parts = np.split(total, np.cumsum([len(x) for x in [*single, *several]])[:-1])
        rows = []
        for k, run in enumerate(asked.column("run").to_pylist()):
            held = parts[k] > 1
            rows.append((0, run, 1, None, single[k][held], owner[k][held], parts[k][held], several[k], parts[len(single) + k]))
        out.append(pa.Table.from_batches([_routed(rows, table.schema.field("ids").type.value_type)]))
    return pa.concat_tables([t.cast(table.schema) for t in out])


def _sets(percent: int, names: list[str]):
    def work(table: pa.Table) -> pa.Table:
        """Rows of one run: id, digest and size of its set, n-grams of its own and, of candidates, the shared ones in order."""
        column = {c: table.column(c).to_pylist() for c in ["kind", "ids", *ROUTE]}
        meta = column["kind"].index(0)
        place = np.frombuffer(column["a"][meta], "<u2")
        digests, sizes = column["b"][meta], np.frombuffer(column["c"][meta], "<u4").astype(np.int64)
        kept, kept_owner = np.frombuffer(column["d"][meta], "<u8"), np.frombuffer(column["e"][meta], "<u2")
        told = [i for i, k in enumerate(column["kind"]) if k == 1]
        grams, owner, count, several, several_count = (np.concatenate([np.zeros(0, t), *_array([column[c][i] for i in told], t)]) for c, t in zip(ROUTE, ("<u8", "<u2", "<u4", "<u8", "<u4")))
        order = np.argsort(several)
        kept_count = several_count[order][np.searchsorted(several[order], kept)] if len(kept) else np.zeros(0, np.uint32)
        grams, owner, count = np.r_[grams, kept], np.r_[owner, kept_owner], np.r_[count, kept_count]
        order = np.lexsort((grams, count, owner))
        grams, owner, count = grams[order].view(np.int64), owner[order], count[order]
        shared = np.bincount(owner, minlength=len(sizes))[: len(sizes)] if len(sizes) else sizes
        own = sizes - shared
        asks = own <= sizes + (-sizes * percent // 100)  # fewer than the prefix holds
        end = np.cumsum(shared)
        first = np.zeros(len(place), bool)
        real = np.flatnonzero(place != NONE)
        first[real[np.unique(place[real], return_index=True)[1]]] = True
        gives = [bool(f) and bool(asks[p]) for f, p in zip(first, place)]
        cells = [(grams[end[p] - shared[p] : end[p]], count[end[p] - shared[p] : end[p]]) if g else (grams[:0], count[:0]) for g, p in zip(gives, place)]
        offsets = np.cumsum([0] + [len(c[0]) for c in cells]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([c[k] for c in cells]).astype(t))) for k, t in ((0, np.int64), (1, np.int32))]
        known = [int(p) if p != NONE else None for p in place]
        return pa.Table.from_arrays(
            [
                pa.array(column["ids"][meta], table.schema.field("ids").type.value_type), pa.array([None if p is None else digests[16 * p : 16 * p + 16] for p in known], pa.binary()),
                pa.array([0 if p is None else int(sizes[p]) for p in known], pa.int64()), pa.array([0 if p is None else int(own[p]) for p in known], pa.int64()), *lists,
            ],
            names,
        )

    return work


def gram_sets(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """id_, node (digest of the set, null if empty), n, own (n-grams of no other set), grams and counts: the shared n-grams in
    the global order, for the first row of a set in its run and only if it may link with another."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    ranges = 1 + size // (6 * RANGE_GRAMS)
    kind = docs.schema[id_col].dataType.simpleString()
    routed = _requests(docs, id_col, text_col, width, ranges).groupBy("range").applyInArrow(_answers, LAYOUT.format(kind=kind))
    schema = f"id_ {kind}, node binary, n long, own long, grams array<long>, counts array<int>"
    return stored(routed.groupBy("run").applyInArrow(_sets(percent, [c.split()[0] for c in schema.split(", ")]), schema), "gram-sets")


def clusters(sets: DataFrame, percent: int) -> DataFrame:
    """node, root of the sets that share a list of posted n-grams with another that they can link with."""
    n, own = F.col("n"), F.col("own")
    prefix = n - F.ceil(n * percent / 100).cast("long") + 1 - own
    posted = sets.filter(F.size("grams") > 0).select("node", "n", "own", F.posexplode(F.slice("grams", F.lit(1), prefix.cast("int"))).alias("at", "gram"))
    left = F.col("n") - F.col("own") - F.col("at")
    reach = F.floor(left * (100 + percent) / percent) - F.col("n")  # largest partner that what is left still suffices for
    posted = posted.select("gram", "node", "n", reach.alias("reach")).filter(F.col("reach") * 100 >= F.col("n") * percent)
    bounds = posted.groupBy("gram").agg(F.min("n").alias("least"), F.max("reach").alias("most"), F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi")
    alive = posted.join(bounds.select("gram", "least", "most"), "gram").filter("least <= reach AND n <= most")
    hub = alive.groupBy("gram").agg(F.min("node").alias("hub"), F.max("node").alias("hi")).filter("hub <> hi").select("gram", "hub")
    return components(alive.join(hub, "gram").select(F.col("node").alias("a"), F.col("hub").alias("b")))


def _rank(counts: Column, gram: Column) -> Column:
    """Place in the global order as one number; ties of the cut-off bits are harmless, as pivots only cut."""
    return F.shiftleft(F.least(counts, F.lit(1 << 22)).cast("long"), 40) + F.shiftrightunsigned(gram, 24)


def pivots(members: DataFrame, fragments: int) -> list[int]:
    """Cuts of the global order into parts of like weight: at most ``fragments - 1`` numbers."""
    at = members.select(F.explode(F.zip_with("grams", "counts", lambda g, c: _rank(c, g))).alias("at"))
    found = at.agg(F.percentile_approx("at", [(i + 1) / fragments for i in range(fragments - 1)], 1000)).first()[0]
    return sorted(set(found or []))


def _packs(members: DataFrame, cuts: list[int]) -> DataFrame:
    """cluster, block, fragment, segments [(place, n-grams)] of every block and fragment."""

    def work(batch: pa.RecordBatch):
        grams, counts = batch.column("grams"), batch.column("counts")
        flat, many = grams.values.to_numpy(zero_copy_only=False), counts.values.to_numpy(zero_copy_only=False)
        rank = (np.minimum(many, 1 << 22).astype(np.int64) << 40) + (flat.view(U) >> U(24)).astype(np.int64)
        fragment = np.searchsorted(np.array(cuts, np.int64), rank, side="right")
        rows = []
        for r, (lo, hi) in enumerate(zip(grams.offsets.to_numpy()[:-1], grams.offsets.to_numpy()[1:])):
            edges = lo + np.searchsorted(fragment[lo:hi], np.arange(len(cuts) + 2))
            rows += [(r, f, flat[s:e].tobytes()) for f, (s, e) in enumerate(zip(edges, edges[1:])) if e > s]
        take = pa.array([r[0] for r in rows], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(take) for c in ("cluster", "block", "place")), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
            ["cluster", "block", "place", "fragment", "segment"],
        )

    cut = per_batch(members.select("cluster", "block", "place", "grams", "counts"), work, "cluster binary, block string, place int, fragment int, segment binary")
    return cut.groupBy("cluster", "block", "fragment").agg(F.collect_list(F.struct("place", "segment")).alias("segments"))


def _partial(x, y) -> tuple[bytes, bytes]:
    """Pairs (places in x and y, 16 bits each) with a common n-gram in this fragment, and how many they have."""
    sides = [(s.values.field("place").to_numpy(), _array(s.values.field("segment").to_pylist(), "<i8")) for s in ([x] if y is None else [x, y])]
    places, sizes = np.concatenate([p for p, _ in sides]), np.array([len(s) for _, ss in sides for s in ss])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, count = np.unique(np.concatenate([s for _, ss in sides for s in ss]), return_inverse=True, return_counts=True)
    used = count > 1
    rank = np.cumsum(used) - 1
    use = used[column]
    owner, column = owner[use], rank[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    n = len(sides[0][0])
    m, shift = (n, 0) if y is None else (len(sides[1][0]), n)
    both = np.zeros((n, m), np.float32)
    width = int(used.sum())
    for s in range(0, width, 4096):
        lo, hi = np.searchsorted(column, [s, s + 4096])
        part = np.zeros((len(sizes), min(4096, width - s)), np.float32)
        part[owner[lo:hi], column[lo:hi] - s] = 1
        both += part[:n] @ part[shift : shift + m].T
    if y is None:
        places, both = np.sort(places), both[np.ix_(np.argsort(places), np.argsort(places))]
    p, q = np.nonzero(np.triu(both, 1) if y is None else both)
    at = (places[p].astype(np.uint32) << np.uint32(16)) + places[q + shift].astype(np.uint32)
    return at.astype("<u4").tobytes(), both[p, q].astype("<u4").tobytes()


PARTIAL = "cluster binary, x string, y string, at binary, count binary"


def _counted(batch: pa.RecordBatch, y: str | None):
    found = [_partial(a, None if y is None else b) for a, b in zip(batch.column("segments"), batch.column(y or "segments"))]
    keep = pa.array([bool(f[0]) for f in found], pa.bool_())
    columns = [batch.column("cluster"), batch.column("x"), batch.column("y"), pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["cluster", "x", "y", "at", "count"]).filter(keep)


def _spanning(pairs: list[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
    """Some of the links that connect what all of them connect."""
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            parent[x] = y
            out.append((a, b))
    return out


def _linked(partial: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """a, b: spanning links of each block pair, from partial overlaps summed over the fragments."""
    names = members.groupBy("cluster", "block").agg(F.collect_list(F.struct("place", "node", "n")).alias("names"))
    summed = partial.groupBy("cluster", "x", "y").agg(F.collect_list(F.struct("at", "count")).alias("parts"))
    both = summed.join(names.select("cluster", F.col("block").alias("x"), F.col("names").alias("names_x")), ["cluster", "x"])
    both = both.join(names.select("cluster", F.col("block").alias("y"), F.col("names").alias("names_y")), ["cluster", "y"])

    def work(batch: pa.RecordBatch):
        pairs = []
        for parts, x, y in zip(batch.column("parts"), batch.column("names_x"), batch.column("names_y")):
            at, count = (np.concatenate(_array(parts.values.field(c).to_pylist(), "<u4")) for c in ("at", "count"))
            at, inverse = np.unique(at, return_inverse=True)
            overlap = np.bincount(inverse, count).astype(np.int64)
            side = []
            for s, place in ((x, at >> np.uint32(16)), (y, at & np.uint32(0xFFFF))):
                order = np.argsort(s.values.field("place").to_numpy())
                where = order[np.searchsorted(s.values.field("place").to_numpy()[order], place)]
                side.append((s.values.field("node"), where, s.values.field("n").to_numpy()[where]))
            fine = np.flatnonzero(100 * overlap >= percent * (side[0][2] + side[1][2] - overlap))
            a, b = (nodes.take(pa.array(where[fine])).to_pylist() for nodes, where, _ in side)
            pairs += _spanning(list(zip(a, b)))
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["a", "b"])

    return per_batch(both.select("parts", "names_x", "names_y"), work, "a binary, b binary")


def _within(packs: DataFrame) -> DataFrame:
    own = packs.select("cluster", F.col("block").alias("x"), F.col("block").alias("y"), "segments")
    return per_batch(own, lambda b: _counted(b, None), PARTIAL)


def _between(packs: DataFrame, pairs: DataFrame) -> DataFrame:
    left = pairs.join(packs.withColumnRenamed("block", "x"), ["cluster", "x"])
    right = packs.select("cluster", F.col("block").alias("y"), "fragment", F.col("segments").alias("others"))
    both = left.join(right, ["cluster", "y", "fragment"]).select("cluster", "x", "y", "segments", "others")
    return per_batch(both, lambda b: _counted(b, "others"), PARTIAL)


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds place: 0, 1, ... within a block."""
    return rows.withColumn("place", (F.row_number().over(Window.partitionBy("cluster", "block").orderBy("node")) - 1).cast("int"))


def confirmed(sets: DataFrame, grouped: DataFrame, percent: int) -> DataFrame:
    """a, b: links of the sets within clusters, spanning all of them; ``grouped`` is (node, root)."""
    placed = grouped.withColumnRenamed("root", "cluster")
    sizes = stored(placed.groupBy("cluster").agg(F.count("*").alias("size")), "sizes")
    parts = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK)).cast("string")
    dealt = stored(_numbered(placed.join(sizes, "cluster").withColumn("block", parts)), "places")
    content = sets.filter(F.size("grams") > 0).select("node", "n", "own", "grams", "counts")
    members = stored(dealt.join(content, "node").dropDuplicates(["node"]), "members")
    cuts = pivots(members, FRAGMENTS)
    small = F.col("size") <= BLOCK
    links = stored(_linked(_within(_packs(members.filter(small), cuts)), members.filter(small), percent), "links")
    large = members.filter(~small)
    if large.isEmpty():
        return links

    central = Window.partitionBy("cluster").orderBy(F.col("own") / F.col("n"), F.xxhash64("node"), "node")
    hubs = large.withColumn("rank_", F.row_number().over(central)).filter(F.col("rank_") <= HUBS).drop("rank_").withColumn("block", F.lit("hubs"))
    met = stored(large.unionByName(_numbered(hubs.drop("place"))), "met-members")
    packs = stored(_packs(met, cuts), "packs")
    pairs = large.select("cluster", F.col("block").alias("x"), F.lit("hubs").alias("y")).distinct()
    stars = stored(_linked(_between(packs, pairs), met, percent).filter("a <> b"), "stars")

    joined = dealt.filter(~small).drop("block", "place").join(components(stars), "node", "left")
    name = F.concat(F.coalesce(F.hex("root"), F.lit("")), F.lit(":"), F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK)).cast("string"))
    again = stored(_numbered(joined.withColumn("block", name)), "places-again")
    blocks = again.select("cluster", F.col("block").alias("x"), F.col("root").alias("root_x")).distinct()
    other = blocks.select("cluster", F.col("x").alias("y"), F.col("root_x").alias("root_y"))
    apart = F.col("root_x").isNull() | F.col("root_y").isNull() | (F.col("root_x") != F.col("root_y"))
    pairs = stored(blocks.join(other, "cluster").filter((F.col("x") <= F.col("y")) & apart).select("cluster", "x", "y"), "block-pairs")
    if pairs.isEmpty():
        return links.unionByName(stars)
    rest = again.select("node", "cluster", "block", "place").join(large.select("node", "n", "grams", "counts"), "node")
    rest = stored(rest, "members-again")
    packs = stored(_packs(rest, cuts), "packs-again")
    same = pairs.filter("x = y").select("cluster", F.col("x").alias("block"))
    partial = _within(packs.join(same, ["cluster", "block"], "left_semi")).unionByName(_between(packs, pairs.filter("x <> y")))
    return links.unionByName(stars).unionByName(stored(_linked(partial, rest, percent), "rest"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """id_col, n_shingles, component_id (smallest id reachable over links, its own included) for every row.

    Sets are of distinct ``width``-word shingles over words in ASCII lower case; fewer words make one shingle of all, and
    rows without a word (null and empty texts too) have none and link with nothing. Two rows link when
    ``100 * intersection >= percent * union``. Rows of equal sets are one node; repeated rows are linked like other copies.
    A null id takes its component's smallest id, null if there is no other. Other columns are not read; an empty table
    gives no rows. An n-gram is 64 bits of mixed cryptographic word hashes.
    """
    sets = gram_sets(docs, id_col, text_col, width, percent)
    links = confirmed(sets, clusters(sets, percent), percent)
    lowest = sets.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("id_").alias("one"))
    rooted = lowest.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stored(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("one").alias("component_"))
    named = rooted.join(smallest, "root").select("node", "component_")
    out = sets.select("id_", "node", "n").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id_")).otherwise(F.col("component_"))
    return out.select(F.col("id_").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
