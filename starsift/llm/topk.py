"""Exact top-k by inner product as a Voronoi kNN join.

With M the largest vector norm, lifting x to (x, sqrt(M^2 - |x|^2)) and a query q to (q, 0) turns "largest inner product"
into "smallest distance", so the triangle inequality holds. Queries and data go to their nearest pivot. Each query group
keeps its radius, each data group the k nearest distances to its pivot; from these summaries alone comes a bound on the
k-th distance of any query of a group. Data is kept in blocks ordered by distance to the pivot, and a block is sent to a
query group only if the bound lets it hold a neighbour. Each pair of blocks is solved by itself; the k best are kept.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.shared import per_batch, stored

#: Groups of queries and of data: pivots are this many distinct vectors, chosen by the hash of their id.
PIVOTS = 16
BLOCK = 1024
QUERY_BLOCK = 256
#: Bounds are loosened by this share of the largest distance, so rounding cannot lose a neighbour.
SLACK = 1e-6


def quantised(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """id, v: floor(scale * x) of each component; vectors null or with null, NaN or infinite components take no part."""
    x = F.col(vector_col).cast("array<double>")
    fine = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.col(id_col).isNotNull()
    return df.filter(fine).select(F.col(id_col).alias("id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


def _lift(v: np.ndarray, top: float) -> np.ndarray:
    return np.c_[v, np.sqrt(np.maximum(top - (v * v).sum(axis=1), 0.0))]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column; shorter vectors are padded with zeros."""
    values, at = column.values.to_numpy(zero_copy_only=False).astype(np.float64), column.offsets.to_numpy()
    out = np.zeros((len(column), dims))
    sizes = np.diff(at)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(at[-1] - at[0]) - np.repeat(at[:-1] - at[0], sizes)] = values[at[0] : at[-1]]
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0))


def _grouped(df: DataFrame, pivots: np.ndarray, dims: int, top: float, query: bool) -> DataFrame:
    """id, v, group (nearest pivot), far (distance to it)."""

    def work(batch: pa.RecordBatch):
        v = _matrix(batch.column("v"), dims)
        lifted = np.c_[v, np.zeros(len(v))] if query else _lift(v, top)
        d = _distances(lifted, pivots)
        near = d.argmin(axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])], ["id", "v", "group", "far"])

    kind = df.schema["id"].dataType.simpleString()
    return per_batch(df, work, f"id {kind}, v array<long>, group int, far double")


def _blocks(df: DataFrame, dims: int, size: int, whole: str) -> DataFrame:
    """Rows of a group packed by ascending distance: group, lo, hi, ids, matrix (row-major integers of the kind ``whole``)."""

    def work(batches):
        for batch in batches:
            group, far = batch.column("group").to_numpy(), batch.column("far").to_numpy()
            edges = np.r_[np.flatnonzero(np.diff(group, prepend=group[:1] - 1)), len(group)] if len(group) else []
            cuts = [(s, min(s + size, e)) for a, e in zip(edges, edges[1:]) for s in range(a, e, size)]
            for s, e in cuts:
                m = _matrix(batch.column("v").slice(s, e - s), dims).astype(whole)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group[s]], pa.int32()), pa.array([far[s]]), pa.array([far[e - 1]]), pa.array([batch.column("id").slice(s, e - s).to_pylist()], pa.list_(batch.schema.field("id").type)), pa.array([m.tobytes()], pa.binary())],
                    ["group", "lo", "hi", "ids", "m"],
                )

    kind = df.schema["id"].dataType.simpleString()
    ordered = df.repartitionByRange("group", "far", "id").sortWithinPartitions("group", "far")
    return ordered.mapInArrow(work, f"group int, lo double, hi double, ids array<{kind}>, m binary")


def exact_top_k(queries: DataFrame, data: DataFrame, k: int, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for (id, v) frames: the k largest inner products, ties to the smaller id.

    A query's own id is left out. Repeated rows count once, vectors shorter than the longest count as padded with zeros,
    and a query with fewer than k candidates gets all. Copies of one vector are represented by their k + 1 smallest ids,
    which are the only ones that can be among the k. Components must be below 2**53 / (length * largest) in size, else
    an error is raised. No queries or no data give no rows.
    """
    same = Window.partitionBy("v").orderBy("id")
    rows = stored(data.dropDuplicates(["id", "v"]).withColumn("copy_", F.row_number().over(same)).filter(F.col("copy_") <= k + 1).drop("copy_"), "vectors")
    asked = stored(queries.dropDuplicates(["id", "v"]), "asked")
    kind, key = rows.schema["id"].dataType.simpleString(), asked.schema["id"].dataType.simpleString()
    schema = f"query_id {key}, vec_id {kind}, score long"
    norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    both = rows.select("v").unionByName(asked.select("v"))
    dims, top, widest = both.agg(F.max(F.size("v")), F.max(norm), F.max(F.array_max(F.transform("v", lambda c: F.abs(c))))).first()
    if not dims:
        return rows.sparkSession.createDataFrame([], schema).selectExpr("query_id", "1 AS rank", "vec_id", "score").limit(0)
    if dims * float(widest) ** 2 >= 2**53:
        raise ValueError("inner products of these components are not exact")
    chosen = rows.dropDuplicates(["v"]).orderBy(F.xxhash64("id"), "id").select("v").limit(pivots).collect()
    points = np.zeros((len(chosen), dims))
    for i, r in enumerate(chosen):
        points[i, : len(r.v)] = r.v
    points = _lift(points, top)
    near = stored(_grouped(rows, points, dims, top, False), "near")
    ask = stored(_grouped(asked, points, dims, top, True), "ask")

    first = Window.partitionBy("group").orderBy("far")
    summary = near.select("group", "far").withColumn("n_", F.row_number().over(first)).filter(F.col("n_") <= k + 1).select("group", "far").collect()
    radius = {r[0]: r[1] for r in ask.groupBy("group").agg(F.max("far")).collect()}
    between = _distances(points, points)
    slack = SLACK * (1 + float(between.max()) + max(radius.values(), default=0.0))
    pairs = []
    for i, u in radius.items():
        reach = sorted(between[i, r.group] + u + r.far for r in summary)
        bound = (reach[k] if len(reach) > k else float("inf")) + slack  # k + 1: one of them may be the query itself
        # |d(p_i,p_j) - d(s,p_j)| - u <= d(q,s) <= bound
        pairs += [(i, j, float(between[i, j] - u - bound), float(between[i, j] + u + bound)) for j in range(len(points))]
    need = F.broadcast(rows.sparkSession.createDataFrame(pairs, "ask_group int, group int, least double, most double"))  # pivots squared rows
    whole = "<i2" if widest < 2**15 else "<i4" if widest < 2**31 else "<i8"
    sent = _blocks(near, dims, block, whole).join(need, "group").filter((F.col("hi") >= F.col("least")) & (F.col("lo") <= F.col("most")))
    sent = sent.select("ask_group", "ids", "m")
    asking = _blocks(ask, dims, QUERY_BLOCK, whole).select(F.col("group").alias("ask_group"), F.col("ids").alias("q_ids"), F.col("m").alias("q_m"))

    def solve(batch: pa.RecordBatch):
        for ids, m, q_ids, q_m in zip(*(batch.column(c) for c in ("ids", "m", "q_ids", "q_m"))):
            ids, q_ids = np.array(ids.as_py()), np.array(q_ids.as_py())
            a, b = (np.frombuffer(x.as_py(), whole).reshape(-1, dims).astype(np.float64) for x in (q_m, m))
            score = a @ b.T
            score[q_ids[:, None] == ids] = -np.inf
            least = np.partition(score, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(a), -np.inf)
            q, c = np.nonzero((score >= least[:, None]) & (score > -np.inf))
            order = np.lexsort((ids[c], -score[q, c], q))
            q, c = q[order], c[order]
            keep = np.arange(len(q)) - np.searchsorted(q, q) < k
            q, c = q[keep], c[keep]
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[q]), pa.array(ids[c]), pa.array(score[q, c].astype(np.int64))], ["query_id", "vec_id", "score"])

    found = per_batch(asking.join(sent, "ask_group"), solve, schema)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
