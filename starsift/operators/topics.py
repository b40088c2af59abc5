"""Topics: LDA, TF-IDF embeddings with PCA and k-means, monthly topic trends."""

from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.feature import PCA, CountVectorizer, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import text as tx
from starsift.operators import corpus
from starsift.operators.sentiment import argmax
from starsift.operators.windows import month_edges
from starsift.sources import durable


def lda_fit(df: DataFrame, text: str, k: int = 5, features: int = 500, min_df: float = 3, max_df: float = 0.9,
            iterations: int = 20, seed: int = 42):
    """(vocabulary model, LDA model, rows with a ``topic_distribution`` array)."""
    tokens = df.withColumn("_t", tx.words(tx.prep_lda(F.col(text))))
    grams = tokens.withColumn("_g", F.concat("_t", tx.ngrams(F.col("_t"), 2))).drop("_t")
    cv = CountVectorizer(inputCol="_g", outputCol="_v", vocabSize=features, minDF=min_df, maxDF=max_df).fit(grams)
    # each pass of the fit reads the stored vectors alone; a checkpoint would make the grams twice and be read whole
    counted = durable.stored(cv.transform(grams).drop("_g"), "lda-rows")
    lda = LDA(k=k, maxIter=iterations, seed=seed, featuresCol="_v", topicDistributionCol="_d").fit(counted)
    out = lda.transform(counted).withColumn("topic_distribution", vector_to_array("_d")).drop("_v", "_d")
    return cv, lda, out


def lda_labels(cv, lda, words: int = 4) -> DataFrame:
    """Topic id and its name from the best words (vocabulary-sized, not data-sized)."""
    vocab = F.array(*[F.lit(w) for w in cv.vocabulary])
    terms = F.slice("termIndices", 1, words)
    return lda.describeTopics(words).select(
        F.col("topic"),
        F.array_join(F.transform(terms, lambda i: F.element_at(vocab, i + 1)), " | ").alias("topic_name"),
    )


def dominant_topic(df: DataFrame, distribution: str = "topic_distribution", name: str = "topic") -> DataFrame:
    """Index of the largest share, the first on ties."""
    return df.withColumn(name, argmax(F.col(distribution)))


def topic_month(df: DataFrame, topic: str, topics: list, month: str = "month") -> DataFrame:
    """Month by topic counts, missing cells 0; the topic list is the model's, so no extra job."""
    dated = df.filter(F.col(month).isNotNull() & F.col(topic).isNotNull())
    return dated.groupBy(month).pivot(topic, topics).agg(F.count(F.lit(1))).na.fill(0)


def topic_trend(df: DataFrame, topic: str, month: str = "month", edge: int = 3) -> DataFrame:
    """Percent change of the mean volume of the last months over the first months (+1).

    Months without a topic's reviews count as zero; with fewer than 2 * edge months the
    trend is null. ``months`` says how many there are.
    """
    counts = df.filter(F.col(month).isNotNull() & F.col(topic).isNotNull()).groupBy(topic, month).agg(
        F.count("*").alias("n")
    )
    edges = month_edges(counts, month)
    n_months = edges.agg(F.count("*").alias("n")).scalar()
    joined = counts.join(edges, month)
    first = F.coalesce(F.sum(F.when(F.col("from_first") <= edge, F.col("n"))), F.lit(0)) / edge
    last = F.coalesce(F.sum(F.when(F.col("from_last") <= edge, F.col("n"))), F.lit(0)) / edge
    return joined.groupBy(topic).agg(first.alias("first_mean"), last.alias("last_mean")).withColumn(
        "trend_pct",
        F.when(n_months >= 2 * edge, (F.col("last_mean") - F.col("first_mean")) * 100.0 / (F.col("first_mean") + 1)),
    ).withColumn("months", n_months)


def trending_topic(trend: DataFrame, topic: str) -> DataFrame:
    return trend.orderBy(F.desc(F.round("trend_pct", 6)), topic).limit(1)


def fit_vocabulary(df: DataFrame, key: str, text: str, max_features: int, max_n: int = 1, min_df: int = 1,
                   max_df: float = 1.0, stop_words=()) -> tuple[DataFrame, DataFrame]:
    """(term counts, indexed vocabulary with idf)."""
    counts = corpus.term_counts(df, key, text, max_n, stop_words)
    n_docs = df.agg(F.countDistinct(key).alias("n")).scalar()
    return counts, corpus.indexed_vocabulary(corpus.vocabulary(counts, n_docs, min_df, max_df, max_features))


def embed_tfidf(df: DataFrame, key: str, text: str, dim: int = 384, stop_words=tuple(fv.GENERAL_STOP_WORDS)) -> DataFrame:
    """Fixed-width TF-IDF embedding fitted once on the corpus; unused dimensions are zero."""
    counts, vocab = fit_vocabulary(df, key, text, dim, stop_words=stop_words)
    sparse = corpus.tfidf_vectors(df, counts, vocab, key, dim, sublinear=False, name="_e")
    return sparse.withColumn("embedding", vector_to_array("_e", "float32")).drop("_e")


def _place(term: Column) -> tuple[Column, Column]:
    """Hash of a term for its dimension, and its sign."""
    digest = F.md5(term)
    number = lambda a: F.conv(F.substring(digest, a, 8), 16, 10).cast("long")
    return number(1), F.when(number(9) % 2 == 0, 1.0).otherwise(-1.0)


def embed_hashed(df: DataFrame, key: str, text: str, dim: int = 384, stop_words=tuple(fv.GENERAL_STOP_WORDS)) -> DataFrame:
    """Fixed-width TF-IDF embedding that keeps every term: signed feature hashing.

    A term adds its weight, with its sign, to the dimension it hashes to, so the inner product of two rows is on average
    that of their whole TF-IDF vectors and no vocabulary is chosen, numbered or sent. Vectors have length one; a text
    without terms (or whose terms cancel) has zeros. ``key`` is unique; rows with a null key are left out.
    """
    df = df.filter(F.col(key).isNotNull())
    counts = corpus.by_term(corpus.document_counts(df, key, text, 1, stop_words))
    vocab = corpus.whole_vocabulary(counts, key, df.agg(F.count("*")).scalar())
    at, sign = _place(F.col("term"))
    placed = vocab.select("term", (at % dim).cast("int").alias("_at"), (sign * F.col("idf")).alias("_signed"))
    weights = counts.join(placed.hint("shuffle_hash"), "term").select(key, "_at", (F.col("tf") * F.col("_signed")).alias("_x"))
    cells = weights.repartition(key).groupBy(key, "_at").agg(F.sum("_x").alias("_v"))
    row = cells.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_at", "_v"))).alias("_cells"), F.sqrt(F.sum(F.col("_v") * F.col("_v"))).alias("_norm"))
    # the zeros before each cell and its value, then the zeros after the last one
    before = lambda i: F.when(i == 0, -1).otherwise(F.get("_cells", i - 1)["_at"])
    value = lambda c: F.coalesce(F.try_divide(c["_v"], "_norm"), F.lit(0.0))
    filled = F.flatten(F.transform("_cells", lambda c, i: F.concat(F.array_repeat(F.lit(0.0), c["_at"] - before(i) - 1), F.array(value(c)))))
    rest = F.array_repeat(F.lit(0.0), F.lit(dim - 1) - F.element_at("_cells", -1)["_at"])
    whole = F.coalesce(F.concat(filled, rest), F.array_repeat(F.lit(0.0), dim))
    return df.join(row, key, "left").withColumn("embedding", whole).drop("_cells", "_norm")


def reduce_pca(df: DataFrame, vector: Column, k: int = 5):
    """(centring model, PCA model, rows with a centred ``reduced`` vector)."""
    dense = df.withColumn("_x", array_to_vector(vector))
    centre = StandardScaler(inputCol="_x", outputCol="_c", withMean=True, withStd=False).fit(dense)
    centred = centre.transform(dense)
    pca = PCA(k=k, inputCol="_c", outputCol="reduced").fit(centred)
    return centre, pca, pca.transform(centred).drop("_x", "_c")


def cluster_topics(df: DataFrame, features: str = "reduced", k: int = 10, seed: int = 42):
    """(k-means model, rows with ``topic_id``)."""
    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol="topic_id").fit(df)
    return model, model.transform(df)


def topic_names(keywords: DataFrame, topic: str = "topic_id") -> DataFrame:
    """"Topic i: a, b, c" and the keyword list per topic."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "term", "weight")))
    g = keywords.groupBy(topic).agg(ordered.alias("_k"))
    first = F.array_join(F.transform(F.slice("_k", 1, 3), lambda r: r["term"]), ", ")
    return g.select(
        topic,
        F.concat(F.lit("Topic "), F.col(topic).cast("string"), F.lit(": "), first).alias("topic_name"),
        F.transform("_k", lambda r: F.struct(r["term"].alias("word"), r["weight"].alias("score"))).alias("keywords"),
    )


def topic_model(df: DataFrame, key: str, text: str, k: int = 10, dim: int = 512, components: int = 5):
    """Embed, reduce, cluster, then name the clusters: (assigned rows, topic table)."""
    embedded = durable.materialise(embed_tfidf(df, key, text, dim))
    _, _, reduced = reduce_pca(embedded, F.col("embedding"), components)
    _, assigned = cluster_topics(reduced, k=k)
    assigned = durable.materialise(assigned.drop("embedding", "reduced"))
    names = topic_names(corpus.topic_keywords(assigned, "topic_id", text))
    return assigned, names
