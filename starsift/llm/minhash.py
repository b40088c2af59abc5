"""Near-duplicate documents by an inverted join on MinHash signature coordinates, confirmed on full shingle sets.

1. Equal sets are one node, whatever the number of their copies. A node's signature has ``COORDS`` coordinates, and
   ``CHECKS`` shorter ones that are compared but not posted.
2. A node is posted under its (coordinate, value) pairs. Nodes that agree in at least ``LEAST`` coordinates share one of
   the ``COORDS - LEAST + 1`` pairs that are rarest over all nodes, so only those are posted (prefix). Pairs that one node
   has alone, and nodes with fewer than ``LEAST`` shared pairs, are never merged (skip).
3. Lists are merged into clusters of nodes that match: first each node of a list meets the list's hubs, then, in lists
   that still hold several clusters, blocks of nodes meet blocks. A block pair returns a spanning set of its matches.
4. Links are confirmed on full sets within clusters. A cluster of one block is compared at once. In a larger one, nodes
   meet a few hubs first; what they link needs no more comparing among itself, and all other block pairs are compared.
   Each comparison returns links that span what it found. So no link between components is lost, no pairs of a group are
   spelled out, and a group of thousands of near copies costs a few checks a copy and those of its outliers.

At a similarity of 0.8, fewer than ``LEAST`` = 14 of 32 coordinates, or ``LEAST_CHECKS`` = 34 of 64 more, agree for about two
pairs in a million; a group loses a member only if that befalls all its links.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.components import components
from starsift.llm.shared import mix, per_batch, runs, stored, word_hashes

U = np.uint64
COORDS, LEAST, CHECKS, LEAST_CHECKS = 32, 14, 64, 34
#: Hubs of a list or cluster, and nodes in a block.
HUBS, BLOCK = 4, 128
#: Odd multipliers and offsets of the coordinates, from a fixed seed.
_RNG = np.random.default_rng(2024)
MULTIPLY = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
ADD = _RNG.integers(0, 2**63, 256, dtype=np.uint64)
#: a-z for A-Z, every other byte as it is.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; fewer words make one shingle, none make none."""
    _, _, words = word_hashes((text or "").encode("utf-8", "surrogatepass").translate(LOWER))
    if not len(words):
        return words
    out = words[: max(1, len(words) - width + 1)].copy()
    for k in range(1, min(width, len(words))):
        out = mix(out * U(0x9E3779B97F4A7C15) + words[k : k + len(out)])
    return np.unique(out)


def _node(shingles: np.ndarray) -> bytes:
    return np.array([mix(shingles).sum(), mix(shingles ^ U(0x5851F42D4C957F2D)).sum()], U).tobytes()


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """id_col, key (of the row), n_shingles, node (digest of the set, null if empty), sig, checks."""

    def work(batch: pa.RecordBatch):
        texts = batch.column(2).to_pylist()
        for a, z in runs(texts):
            sets = [shingle_set(t, width) for t in texts[a:z]]
            some = [s for s in sets if len(s)]
            sig = np.zeros((COORDS + CHECKS, len(some)), np.uint32)
            if some:
                every, at = np.concatenate(some), np.cumsum([0] + [len(s) for s in some[:-1]])
                for c in range(COORDS + CHECKS):
                    sig[c] = np.minimum.reduceat((every * MULTIPLY[c] + ADD[c]) >> U(32), at)
            rows, k = [], 0
            for s in sets:
                rows.append((sig[:COORDS, k].view(np.int32), _node(s), sig[COORDS:, k].astype(np.uint8).tobytes()) if len(s) else (None, None, None))
                k += len(s) > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, z - a), batch.column(1).slice(a, z - a), pa.array([len(s) for s in sets], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[2] for r in rows], pa.binary())],
                [id_col, "key", "n_shingles", "node", "sig", "checks"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.xxhash64(id_col, text_col).alias("key"), text_col)
    return per_batch(rows, work, f"{id_col} {kind}, key long, n_shingles long, node binary, sig array<int>, checks binary")


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _spanning(n: int, p: np.ndarray, q: np.ndarray) -> list[tuple[int, int]]:
    """Some of the links (p, q) that connect what all of them connect."""
    parent, out = list(range(n)), []

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(p.tolist(), q.tolist()):
        x, y = find(a), find(b)
        if x != y:
            parent[x] = y
            out.append((a, b))
    return out


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], ["a", "b"])


EDGES = "a binary, b binary"
SKETCH = ["n_shingles", "checks"]


def _met_hubs(lists: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Matches of each list's nodes with its hubs."""
    lowest = [F.min(F.struct(F.xxhash64("node", F.lit(h)).alias("h"), "node"))["node"].alias(f"hub{h}") for h in range(HUBS)]
    hubs = lists.groupBy("pair").agg(*lowest, F.count("*").alias("size_")).filter("size_ > 1")
    met = lists.join(hubs, "pair").select(F.col("node").alias("a"), F.explode(F.array_distinct(F.array(*[f"hub{h}" for h in range(HUBS)]))).alias("b"))
    met = met.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).dropDuplicates()
    side = [nodes.select(F.col("node").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in SKETCH)) for c in "ab"]

    def match(batch: pa.RecordBatch):
        (n1, c1), (n2, c2) = ((batch.column(f"n_shingles_{c}").to_numpy(), _bytes(batch.column(f"checks_{c}"), CHECKS)) for c in "ab")
        fine = (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & ((c1 == c2).sum(axis=1) >= LEAST_CHECKS)
        yield batch.select(["a", "b"]).filter(pa.array(fine))

    return per_batch(met.join(side[0], "a").join(side[1], "b"), match, EDGES)


def _met_blocks(lists: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Matches between different clusters within lists, block against block, as spanning sets."""
    placed = lists.join(roots, "node", "left").withColumn("root", F.xxhash64(F.coalesce("root", "node")))
    size = placed.groupBy("pair").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).filter("lo <> hi").select("pair", "blocks")
    rest = placed.join(size, "pair").join(nodes.select("node", *SKETCH), "node")
    dealt = rest.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    blocks = stored(dealt.groupBy("pair", "block", "blocks").agg(F.collect_list(F.struct("node", "root", *SKETCH)).alias("rows")), "blocks")
    def part(rows: pa.ListScalar):
        s = rows.values
        return s.field("node").to_pylist(), s.field("root").to_numpy(), s.field("n_shingles").to_numpy(), _bytes(s.field("checks"), CHECKS)

    def matches(x, y) -> pa.RecordBatch:
        """Between two blocks, or within x."""
        n1, r1, s1, c1 = part(x)
        n2, r2, s2, c2 = part(y) if y is not None else (n1, r1, s1, c1)
        fine = (r1[:, None] != r2) & (100 * np.minimum(s1[:, None], s2) >= percent * np.maximum(s1[:, None], s2))
        p, q = np.nonzero(fine if y is not None else np.triu(fine, 1))
        agree = (c1[p] == c2[q]).sum(axis=1) >= LEAST_CHECKS
        shift = len(n1) if y is not None else 0
        found = _spanning(len(n1) + len(n2), p[agree], q[agree] + shift)
        return _edges([(n1[a], n2[b - shift]) for a, b in found])

    def within(batch: pa.RecordBatch):
        for x in batch.column("rows"):
            yield matches(x, None)

    def between(batch: pa.RecordBatch):
        for x, y in zip(batch.column("x"), batch.column("y")):
            yield matches(x, y)

    several = blocks.filter("blocks > 1")
    left = several.select("pair", F.col("rows").alias("x"), F.explode(F.expr("sequence(block, blocks - 1)")).alias("other"), "block").filter("other > block")
    met = left.join(several.select("pair", F.col("block").alias("other"), F.col("rows").alias("y")), ["pair", "other"])
    return per_batch(blocks.select("rows"), within, EDGES).unionByName(per_batch(met.select("x", "y"), between, EDGES))


def _links(x: list[tuple[bytes, np.ndarray]], y: list[tuple[bytes, np.ndarray]] | None, percent: int) -> list[tuple[bytes, bytes]]:
    """Links within x, or between x and y, that span all of them; intersections are products of incidence matrices."""
    rows = x + (y or [])
    sizes = np.array([len(s) for _, s in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    _, column, count = np.unique(np.concatenate([s for _, s in rows]), return_inverse=True, return_counts=True)
    shared = count > 1
    rank = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], rank[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    n = len(x)
    both = np.zeros((n, len(rows)) if y is None else (n, len(y)), np.float32)
    width = int(shared.sum())
    for s in range(0, width, 4096):
        lo, hi = np.searchsorted(column, [s, s + 4096])
        part = np.zeros((len(rows), min(4096, width - s)), np.float32)
        part[owner[lo:hi], column[lo:hi] - s] = 1
        both += part[:n] @ (part if y is None else part[n:]).T
    shift = 0 if y is None else n
    other = sizes[shift:] if y is not None else sizes
    fine = 100 * both >= percent * (sizes[:n, None] + other - both)
    p, q = np.nonzero(np.triu(fine, 1) if y is None else fine)
    return [(rows[a][0], rows[b][0]) for a, b in _spanning(len(rows), p, q + shift)]


def _rows(column: pa.ListScalar) -> list[tuple[bytes, np.ndarray]]:
    s = column.values
    return [(n, np.frombuffer(b, "<u8")) for n, b in zip(s.field("node").to_pylist(), s.field("shingles").to_pylist())]


def _confirmed(sets: DataFrame, percent: int) -> DataFrame:
    """Links of the (node, cluster, shingles) rows, within clusters."""
    sizes = stored(sets.groupBy("cluster").agg(F.count("*").alias("size")), "sizes")
    entry = F.collect_list(F.struct("node", "shingles")).alias("x")

    def within(batch: pa.RecordBatch):
        for x in batch.column("x"):
            yield _edges(_links(_rows(x), None, percent))

    small = sets.join(sizes.filter(F.col("size") <= BLOCK), "cluster").groupBy("cluster").agg(entry)
    links = stored(per_batch(small.select("x"), within, EDGES), "links")
    wide = sizes.filter(F.col("size") > BLOCK)
    if wide.isEmpty():
        return links
    large = stored(sets.join(wide, "cluster"), "large")
    low = Window.partitionBy("cluster").orderBy(F.xxhash64("node"), "node")
    hubs = large.select("cluster", "node", "shingles").withColumn("k", F.row_number().over(low)).filter(F.col("k") <= HUBS)
    met = large.select("cluster", "node", "shingles").join(hubs.select("cluster", F.col("node").alias("hub"), F.col("shingles").alias("hub_shingles")), "cluster").filter(F.col("node") != F.col("hub"))

    def star(batch: pa.RecordBatch):
        keep = []
        for s, t in zip(batch.column("shingles"), batch.column("hub_shingles")):
            s, t = np.frombuffer(s.as_buffer(), "<u8"), np.frombuffer(t.as_buffer(), "<u8")
            shared = len(np.intersect1d(s, t, assume_unique=True))
            keep.append(100 * shared >= percent * (len(s) + len(t) - shared))
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("hub")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    stars = stored(per_batch(met.select("node", "hub", "shingles", "hub_shingles"), star, EDGES), "stars")
    # A node linked to hubs belongs to their component; the others are compared with all.
    placed = large.join(components(stars), "node", "left")
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK)).cast("int"))
    blocks = stored(dealt.groupBy("cluster", "root", "part").agg(entry).withColumn("block", F.struct(F.coalesce("root", F.lit(b"")), "part")), "set-blocks")
    y = blocks.select("cluster", F.col("root").alias("root_y"), F.col("block").alias("block_y"), F.col("x").alias("y"))
    apart = F.col("root").isNull() | F.col("root_y").isNull() | (F.col("root") != F.col("root_y"))
    pairs = blocks.join(y, "cluster").filter(apart & (F.col("block") <= F.col("block_y")))

    def across(batch: pa.RecordBatch):
        for x, y, same in zip(batch.column("x"), batch.column("y"), batch.column("same").to_pylist()):
            yield _edges(_links(_rows(x), None if same else _rows(y), percent))

    rest = per_batch(pairs.select("x", "y", (F.col("block") == F.col("block_y")).alias("same")), across, EDGES)
    return links.unionByName(stars).unionByName(stored(rest, "rest"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """id_col, key, n_shingles, component_id (smallest id reachable over links), kept (id is component_id) for every row.

    Sets are of distinct ``width``-word shingles over words in ASCII lower case. Rows without a word have no shingle and
    link with nothing. Repeated rows are linked like other copies; each row with the smallest id counts as kept. A null id
    gets its component's smallest id (null, and kept, if that has no other). ``key`` is the hash of id and text. Other
    columns are not read; an empty table gives no rows.
    """
    sketch = stored(sketches(docs, id_col, text_col, width), "sketch")
    nodes = sketch.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min(id_col).alias("one"), F.min("key").alias("key"), F.first("sig").alias("sig"), *(F.first(c).alias(c) for c in SKETCH))
    nodes = stored(nodes, "nodes")
    posted = nodes.select("node", F.posexplode("sig").alias("c", "value")).select("node", (F.shiftleft(F.col("c").cast("long"), 32) + F.col("value").cast("long").bitwiseAND(0xFFFFFFFF)).alias("pair"))
    common = stored(posted.groupBy("pair").agg(F.count("*").alias("df")).filter(F.col("df") > 1), "common")
    shared = posted.join(common, "pair").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "pair"))).alias("shared"))
    prefix = shared.filter(F.size("shared") >= LEAST).select("node", F.explode(F.expr(f"slice(shared, 1, size(shared) - {LEAST - 1})")).alias("p"))
    lists = stored(prefix.select("node", F.col("p.pair").alias("pair")), "postings")

    matches = stored(_met_hubs(lists, nodes, percent), "matches")
    clusters = components(matches)
    more = stored(_met_blocks(lists, nodes, clusters, percent), "more-matches")
    if not more.isEmpty():
        clusters = components(matches.unionByName(more))

    def full(batch: pa.RecordBatch):
        sets = [shingle_set(t, width).astype("<u8").tobytes() for t in batch.column(text_col).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("cluster"), pa.array(sets, pa.binary())], ["node", "cluster", "shingles"])

    wanted = nodes.select("node", "key").join(clusters.withColumnRenamed("root", "cluster"), "node")
    texts = docs.select(F.xxhash64(id_col, text_col).alias("key"), text_col).join(wanted, "key").select("node", "cluster", text_col)
    sets = stored(per_batch(texts, full, "node binary, cluster binary, shingles binary").dropDuplicates(["node"]), "sets")
    roots = components(_confirmed(sets, percent))

    lowest = nodes.select("node", "one").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = stored(lowest.groupBy("root").agg(F.min("one").alias("component_")), "smallest")
    named = lowest.join(smallest, "root").select("node", "component_")
    out = sketch.select(id_col, "key", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col(id_col)).otherwise(F.col("component_"))
    return out.select(id_col, "key", "n_shingles", component.alias("component_id")).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns; of repeated rows one stays."""
    kept = near_duplicates(docs, id_col, text_col, width, percent).filter("kept").select(F.col("key").alias("key_")).dropDuplicates()
    keyed = docs.withColumn("key_", F.xxhash64(id_col, text_col))
    first = Window.partitionBy("key_").orderBy("key_")
    return keyed.join(kept, "key_", "left_semi").withColumn("copy_", F.row_number().over(first)).filter("copy_ = 1").drop("key_", "copy_")
