"""Queries for vectors, similarity and topic models."""

from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import vectors as vx
from starsift.operators import similarity, topics
from starsift.queries.oracle import WD, sql_in
from starsift.queries.registry import query
from starsift.sources import adapters as ad


def _emb(s, d):
    return ad.table(s, d, "embeddings")


COS = """WITH q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0),
  c AS (SELECT vec_id, label, round(list_sum([cast(embedding[i] AS double) * q[i] FOR i IN range(1, 65)])
          / (sqrt(list_sum([cast(x AS double) * x FOR x IN embedding])) * sqrt(list_sum([cast(x AS double) * x FOR x IN q]))), 6) AS similarity
        FROM embeddings, q)"""


def _query_vector(s, d):
    return _emb(s, d).filter(F.col("vec_id") == 0).select("embedding").scalar()


@query("semantic_search", "K-05", COS + " SELECT vec_id, similarity FROM c WHERE similarity >= 0.1 ORDER BY similarity DESC, vec_id LIMIT 20")
def semantic_search(s, d):
    return similarity.semantic_search(_emb(s, d), _query_vector(s, d), 20, 0.1).select("vec_id", "similarity")


@query(
    "semantic_search_filtered",
    "K-05",
    COS + " SELECT vec_id, similarity FROM c WHERE label = 3 AND similarity >= -1 ORDER BY similarity DESC, vec_id LIMIT 5",
)
def semantic_search_filtered(s, d):
    return similarity.semantic_search(
        _emb(s, d), _query_vector(s, d), 5, -1.0, where=F.col("label") == 3
    ).select("vec_id", "similarity")


@query("vector_norms", "K-06", "SELECT vec_id, round(sqrt(list_sum([cast(x AS double) * x FOR x IN embedding])), 6) AS norm FROM embeddings")
def vector_norms(s, d):
    return _emb(s, d).select("vec_id", vx.norm(F.col("embedding")).alias("norm"))


@query("cosine_to_first", "K-06", COS + " SELECT vec_id, similarity FROM c")
def cosine_to_first(s, d):
    both = _emb(s, d).withColumn("q", _query_vector(s, d))
    return both.select("vec_id", vx.cosine(F.col("embedding"), F.col("q")).alias("similarity"))


@query(
    "centroids",
    "K-06",
    """WITH u AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings)
       SELECT label, cast(dim - 1 AS int) AS dim, round(avg(cast(x AS double)), 6) AS mean FROM u GROUP BY ALL""",
)
def centroids(s, d):
    c = similarity.centroids(_emb(s, d), "label", "embedding")
    return c.select("label", F.posexplode("centroid").alias("dim", "mean"))


@query(
    "near_neighbours",
    "K-05 L-25",
    """WITH p AS (SELECT a.vec_id AS id, b.vec_id AS other, sqrt(list_sum([pow(cast(z[1] AS double) - z[2], 2) FOR z IN list_zip(a.embedding, b.embedding)])) AS distance
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, other) AS rank FROM p)
    SELECT id, other, round(distance, 6) AS distance, cast(rank AS int) AS rank FROM r WHERE rank <= 5""",
)
def near_neighbours(s, d):
    return similarity.neighbours(_emb(s, d), "vec_id", "embedding", 64, 5)


_TERMS = f"[t FOR t IN regexp_extract_all(lower(text), '[{WD}]{{2,}}') IF t NOT IN {sql_in(fv.GENERAL_STOP_WORDS)}]"


@query(
    "tfidf_embedding",
    "K-01",
    f"""WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents), v AS (SELECT term FROM t GROUP BY 1 ORDER BY count(*) DESC, term LIMIT 384),
    h AS (SELECT DISTINCT doc_id FROM t JOIN v USING (term))
    SELECT doc_id, 384 AS width, CASE WHEN h.doc_id IS NULL THEN 0.0 ELSE 1.0 END AS norm FROM documents LEFT JOIN h USING (doc_id)""",
)
def tfidf_embedding(s, d):
    e = topics.embed_tfidf(ad.documents(s, d).select("doc_id", "text"), "doc_id", "text")
    # the vectors are single precision: compare their length to 4 places
    return e.select("doc_id", F.size("embedding").alias("width"), F.round(vx.norm(F.col("embedding")), 4).alias("norm"))


@query(
    "hashed_embedding",
    "K-01",
    f"""WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents), c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
    v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf, md5(term) AS h FROM c GROUP BY term),
    p AS (SELECT term, idf * CASE WHEN CAST('0x' || h[9:16] AS BIGINT) % 2 = 0 THEN 1 ELSE -1 END AS w, CAST(CAST('0x' || h[1:8] AS BIGINT) % 384 AS INTEGER) AS dimension FROM v),
    s AS (SELECT doc_id, dimension, sum(tf * w) AS x FROM c JOIN p USING (term) GROUP BY ALL),
    n AS (SELECT doc_id, dimension, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS value FROM s)
    SELECT doc_id, dimension, round(value, 6) AS value FROM n WHERE abs(value) >= 0.000005""",
)
def hashed_embedding(s, d):
    """Every cell of every text's embedding, and so every term's weight, against SQL."""
    e = topics.embed_hashed(ad.documents(s, d).select("doc_id", "text"), "doc_id", "text")
    cells = e.select("doc_id", F.posexplode("embedding").alias("dimension", "value"))
    return cells.filter(F.abs("value") >= 0.000005)


@query("reduced_vectors", "K-02")
def reduced_vectors(s, d):
    from pyspark.ml.functions import vector_to_array

    _, _, reduced = topics.reduce_pca(_emb(s, d), F.col("embedding").cast("array<double>"), 5)
    return reduced.select("vec_id", *[F.abs(vector_to_array("reduced")[i]).alias(f"c{i}") for i in range(5)])


@query("clustered_topics", "K-03")
def clustered_topics(s, d):
    _, _, reduced = topics.reduce_pca(_emb(s, d), F.col("embedding").cast("array<double>"), 5)
    _, assigned = topics.cluster_topics(reduced, k=10)
    return assigned.groupBy("topic_id").agg(F.count("*").alias("n"))


@query("topic_table", "K-04 M-07")
def topic_table(s, d):
    docs = ad.documents(s, d).select("doc_id", "text")
    assigned, names = topics.topic_model(docs, "doc_id", "text", k=10, dim=128)
    counted = assigned.groupBy("topic_id").agg(F.count("*").alias("n"))
    return counted.join(names.select("topic_id", "topic_name"), "topic_id", "left")
