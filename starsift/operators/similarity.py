"""Cosine search, centroids and scalable neighbour candidates."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.functions import vectors as vx
from starsift.operators.windows import top_n_by
from starsift.sources import durable


def semantic_search(
    df: DataFrame, query: Column, n: int = 5, threshold: float = 0.65, key: str = "vec_id",
    vector: str = "embedding", where: Column | None = None,
) -> DataFrame:
    """Exact scan: rows whose cosine with the query reaches the threshold, best ``n``."""
    rows = df if where is None else df.filter(where)
    sim = F.round(vx.cosine(F.col(vector), F.col("_q")), 6)
    return (
        rows.withColumn("_q", query)
        .withColumn("similarity", sim)
        .drop("_q")
        .filter(F.col("similarity") >= threshold)
        .orderBy(F.desc("similarity"), key)
        .limit(n)
    )


def centroids(df: DataFrame, cls: str, vector: str) -> DataFrame:
    """Mean vector per class, aggregated per dimension."""
    cells = df.select(cls, F.posexplode(vector).alias("dim", "x"))
    means = cells.groupBy(cls, "dim").agg(F.avg("x").alias("mean"))
    return means.groupBy(cls).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("dim", "mean"))), lambda c: c["mean"]).alias("centroid")
    )


#: Least rows of a cell, cells a row looks into first, and the most cells a fit makes.
CELL_ROWS, PROBES, MOST_CELLS = 1024, 2, 32
#: Most rows of a block of a cell, and about as many rows as meet a block at once: what a task holds.
BLOCK_ROWS, SIDE_ROWS = 32_768, 65_536
#: Products of a block that are looked at together, and pairs whose distance is worked out together.
CELLS_AT_ONCE, PAIRS_AT_ONCE = 1 << 23, 1 << 17
#: Bounds are loosened by this share of the lengths compared, so rounding cannot lose a neighbour.
SLACK = 1e-6


def _cell_centres(base: DataFrame, cells: int, width: int, seed: int) -> np.ndarray:
    """k-means centres of the vectors, fitted on all rows."""
    if cells == 1:
        return np.zeros((1, width))
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = base.select(array_to_vector(F.col("v").cast("array<double>")).alias("features"))
    return np.array(KMeans(k=cells, seed=seed, maxIter=10).fit(rows).clusterCenters())


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column of single-precision vectors."""
    if column.null_count or not pc.all(pc.equal(pc.list_value_length(column), width), min_count=0).as_py():
        raise ValueError(f"vectors must have {width} components")
    return column.flatten().to_numpy(zero_copy_only=False).astype("<f4").reshape(-1, width)


def _closest(ids: pa.Array, a: np.ndarray, bound: np.ndarray, others: pa.Array, b: np.ndarray, k: int):
    """Places (i, j) and distances of the ``k`` nearest rows of ``b`` to each row of ``a`` within its bound, ties by id.

    Pairs are picked by single-precision products, with room for their rounding; their distances are worked out in double.
    """
    order = pc.sort_indices(pa.table({"o": others}), sort_keys=[("o", "ascending")], null_placement="at_start").to_numpy()
    others, b = others.take(pa.array(order)), b[order]
    known = pc.unique(others)
    own = pc.fill_null(pc.index_in(ids, known, skip_nulls=True), -1).to_numpy()
    code = pc.fill_null(pc.index_in(others, known, skip_nulls=True), -2).to_numpy()
    wanted = k + int(np.bincount(code[code >= 0], minlength=1).max())  # a row's own id does not count
    # of copies of one vector, the first ids are enough
    copies = np.unique(np.ascontiguousarray(b).view(f"V{b.itemsize * b.shape[1]}").ravel(), return_inverse=True)[1].ravel()
    by_copy = np.argsort(copies, kind="stable")
    starts = np.searchsorted(copies[by_copy], copies[by_copy])
    kept = np.sort(by_copy[np.arange(len(b)) - starts < wanted])
    order, b, code = order[kept], b[kept], code[kept]
    kind = np.float32 if max(np.abs(a).max(), np.abs(b).max()) < 1e15 else np.float64
    wide_a, wide_b = a.astype(np.float64), b.astype(np.float64)
    aa, bb = (wide_a**2).sum(axis=1), (wide_b**2).sum(axis=1)
    # |a - b|^2 <= t is a.b - |b|^2 / 2 >= (|a|^2 - t) / 2
    left, right = np.c_[a, np.ones(len(a))].astype(kind), np.c_[b, -bb / 2].astype(kind)
    room = 4 * (a.shape[1] + 8) * np.finfo(kind).eps * (np.sqrt(aa) + np.sqrt(bb.max())) ** 2
    least = (aa - (bound * (1 + SLACK)) ** 2) / 2 - room
    out = []
    step = max(1, CELLS_AT_ONCE // len(b))
    for s in range(0, len(a), step):
        near = left[s : s + step] @ right.T
        floor = least[s : s + step].copy()
        if len(b) > wanted and not np.isfinite(floor).all():
            floor = np.maximum(floor, np.partition(near, -wanted, axis=1)[:, -wanted] - 2 * room[s : s + step])
        flat = np.flatnonzero(near >= np.nextafter(floor.astype(kind), kind(-np.inf))[:, None])
        i, j = flat // len(b) + s, flat % len(b)
        apart = own[i] != code[j]
        i, j = i[apart], j[apart]
        far = np.empty(len(i))
        for p in range(0, len(i), PAIRS_AT_ONCE):
            q = slice(p, p + PAIRS_AT_ONCE)
            far[q] = np.sqrt(((wide_a[i[q]] - wide_b[j[q]]) ** 2).sum(axis=1))
        best = np.lexsort((j, far, i))  # j is in the order of the ids
        i, j, far = i[best], j[best], far[best]
        first = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((i[first], order[j[first]], far[first]))
    return tuple(np.concatenate(x) for x in zip(*out))


def neighbours(
    df: DataFrame, key: str, vector: str, width: int, k: int = 5, group: str | None = None,
    cell_rows: int = CELL_ROWS, probes: int = PROBES, seed: int = 42,
) -> DataFrame:
    """Exact k nearest neighbours (euclidean, ties by id), optionally within a group.

    Vectors are clustered into cells of ``cell_rows`` rows or more, at most MOST_CELLS, so that a vector is sent to a
    bounded number of cells. The rows of a cell look into the ``probes`` nearest cells that hold rows of their group, and into
    further ones until these hold more than ``k``. The k-th distance found there is a bound: a row then looks into every
    other cell whose centre is not farther than the bound and the cell's radius. Rows travel as packed matrices; cells are
    cut into blocks of BLOCK_ROWS by hash, and some SIDE_ROWS rows meet a block in a task, so no task holds more. No row
    is dropped; one with a component that is not finite has no distances, so it gets no neighbours and is none.
    """
    grp = F.col(group).cast("string") if group else F.lit("")
    base = df.select(F.col(key).alias("id"), grp.alias("grp"), F.col(vector).cast("array<float>").alias("v"))
    spark, kind = df.sparkSession, dict(df.dtypes)[key]
    centres = _cell_centres(base, int(min(MOST_CELLS, max(1, base.count() // cell_rows))), width, seed)

    def distances(x: np.ndarray) -> np.ndarray:
        x = x.astype(float)
        return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2 * x @ centres.T, 0))

    def place(batches):
        for batch in batches:
            m = _matrix(batch.column("v"), width)
            batch = batch.filter(pa.array(np.isfinite(m).all(axis=1)))
            d = distances(m[np.isfinite(m).all(axis=1)])
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])], ["id", "grp", "v", "cell", "far"])

    placed = durable.stored(base.mapInArrow(place, f"id {kind}, grp string, v array<float>, cell int, far double"), "placed")
    # one row per group and cell: the groups are classes, the cells bounded by MOST_CELLS
    held: dict[str | None, dict[int, int]] = {}
    radius: dict[str | None, np.ndarray] = {}
    for r in placed.groupBy("grp", "cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect():
        held.setdefault(r.grp, {})[r.cell] = r.n
        radius.setdefault(r.grp, np.full(len(centres), -np.inf))[r.cell] = r.far
    blocks = {(g, c): -(-n // BLOCK_ROWS) for g, cells in held.items() for c, n in cells.items()}
    sides = {g: -(-sum(cells.values()) // SIDE_ROWS) for g, cells in held.items()}
    longest = float(np.sqrt((centres * centres).sum(axis=1).max()))
    between = distances(centres)

    def first(g, cell: int) -> set[int]:
        seen = have = 0
        out = set()
        for c in np.argsort(between[cell], kind="stable").tolist():
            if seen >= probes and have > k:
                break
            if n := held[g].get(c, 0):
                out.add(c)
                seen, have = seen + 1, have + n
        return out

    cuts = spark.createDataFrame([(g, c, b, sides[g]) for (g, c), b in blocks.items()], "g string, c int, blocks int, sides int")
    cut = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cells = [pa.array([table[c][0].as_py()], t) for c, t in (("grp", pa.string()), ("cell", pa.int32()), ("block", pa.int32()), ("sides", pa.int32()))]
        ids = table["id"].combine_chunks()
        m = _matrix(table["v"].combine_chunks(), width)
        bound = table["bound"].to_numpy().astype("<f8")
        lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.table([*cells, lists, pa.array([bound.tobytes()]), pa.array([m.tobytes()])], ["grp", "cell", "block", "sides", "ids", "bound", "m"])

    def packed(rows: DataFrame) -> DataFrame:
        of = rows.join(F.broadcast(cuts), rows.grp.eqNullSafe(F.col("g")) & (rows.cell == F.col("c")))
        of = of.select("id", "grp", "v", "cell", cut, "sides", "bound")
        return of.groupBy("grp", "cell", "block").applyInArrow(pack, f"grp string, cell int, block int, sides int, ids array<{kind}>, bound binary, m binary")

    def unpacked(row) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        ids, bound, m = row
        return ids.values, np.frombuffer(bound.as_buffer(), "<f8"), np.frombuffer(m.as_buffer(), "<f4").reshape(-1, width)

    def look(further: bool):
        """The rows of each block for each cell they look into: their first ones, or all others that can hold a neighbour
        nearer than their bound."""

        def work(batches):
            for batch in batches:
                for g, cell, block, n, *row in zip(*(batch.column(c) for c in ("grp", "cell", "block", "sides", "ids", "bound", "m"))):
                    g, cell, side = g.as_py(), cell.as_py(), (cell.as_py() + block.as_py()) % n.as_py()
                    ids, bound, m = unpacked(row)
                    d = distances(m)
                    reach = bound + SLACK * (1 + bound + longest + d.max(axis=1))
                    firsts = first(g, cell)
                    for c in sorted(held[g].keys() - firsts if further else firsts):
                        asked = np.flatnonzero(d[:, c] - radius[g][c] <= reach) if further else np.arange(len(m))
                        for b in range(blocks[g, c] if len(asked) else 0):
                            own = ids.take(pa.array(asked))
                            lists = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
                            cols = [pa.array([g], pa.string()), pa.array([c], pa.int32()), pa.array([b], pa.int32()), pa.array([side], pa.int32())]
                            yield pa.RecordBatch.from_arrays(
                                [*cols, lists, pa.array([bound[asked].tobytes()]), pa.array([m[asked].tobytes()])],
                                ["grp", "cell", "block", "side", "ids", "bound", "m"],
                            )

        return work

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        for row in zip(*(left[c] for c in ("ids", "bound", "m"))):
            ids, bound, a = unpacked(row)
            for other in zip(*(right[c] for c in ("ids", "bound", "m"))):
                others, _, b = unpacked(other)
                i, j, far = _closest(ids, a, bound, others, b, k)
                found.append(pa.table({"id": ids.take(pa.array(i)), "other": others.take(pa.array(j)), "distance": far}))
        none = pa.array([], left.schema.field("ids").type.value_type)
        return pa.concat_tables(found) if found else pa.table({"id": none, "other": none, "distance": pa.array([], pa.float64())})

    keys = ["grp", "cell", "block", "side"]
    unbounded = placed.withColumn("bound", F.lit(float("inf")))
    blocked = durable.stored(packed(unbounded), "blocks")
    data = blocked.withColumn("side", F.explode(F.sequence(F.lit(0), F.col("sides") - 1))).drop("sides")

    def best(rows: DataFrame, further: bool, found: DataFrame | None = None) -> DataFrame:
        asked = rows.mapInArrow(look(further), f"grp string, cell int, block int, side int, ids array<{kind}>, bound binary, m binary")
        pairs = asked.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(compare, f"id {kind}, other {kind}, distance double")
        pairs = pairs if found is None else pairs.unionByName(found.select("id", "other", "distance"))
        return top_n_by(pairs, ["id"], [F.asc("distance"), F.asc("other")], k).select("id", "other", "distance", "rank")

    found = best(blocked, False)
    if all(len(first(g, c)) == len(cells) for g, cells in held.items() for c in cells):
        return found  # no cell is left to look into
    found = durable.stored(found, "found")
    bound = found.filter(F.col("rank") == k).select("id", F.col("distance").alias("bound"))
    reached = placed.join(bound, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    return best(packed(reached), True, found)
