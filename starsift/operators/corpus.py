"""Terms, keywords, TF-IDF, RAKE, taxonomy and noun-phrase operators over a corpus.

Counting is always ``groupBy(document, term)`` first, so each task combines its
own documents' terms before anything is shuffled, and a term found everywhere
costs one row per document instead of one per occurrence.
"""

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsift import fixed_values as fv
from starsift.functions import text as tx
from starsift.operators.windows import top_n_by


def vector_tokens(c: Column, stop_words=()) -> Column:
    """Lower-cased runs of two or more word characters."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"[{fv.WORD}]{{2,}}"), F.lit(0))
    return F.filter(tokens, lambda t: ~t.isin(*stop_words)) if stop_words else tokens


def term_counts(
    df: DataFrame, key: str, text: str, max_n: int = 1, stop_words=(), tokens: Column | None = None
) -> DataFrame:
    """Occurrences ``tf`` of every 1..max_n-gram per key."""
    df = df.select(key, (vector_tokens(F.col(text), stop_words) if tokens is None else tokens).alias("_t"))
    grams = F.col("_t")
    for n in range(2, max_n + 1):
        grams = F.concat(grams, tx.ngrams(F.col("_t"), n))
    return df.select(key, F.explode(grams).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


#: Documents whose terms an Arrow helper counts at once.
SLICE = 256


def _counted(rows: pa.RecordBatch, max_n: int) -> pa.Table:
    """key, term, tf of rows (key, lists of tokens): the lists are flattened, joined to n-grams and counted as columns."""
    lists = rows.column(1)
    texts, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    words, at = pc.list_flatten(texts), pc.list_parent_indices(texts)
    terms, places = [words], [at]
    for n in range(2, max_n + 1):
        size = max(len(words) - n + 1, 0)
        whole = pc.equal(at.slice(0, size), at.slice(n - 1, size))
        grams = pc.binary_join_element_wise(*[words.slice(i, size) for i in range(n)], " ")
        terms.append(grams.filter(whole)), places.append(at.slice(0, size).filter(whole))
    table = pa.table({"doc": doc.take(pa.concat_arrays(places)), "term": pa.concat_arrays(terms)})
    counts = table.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")]).combine_chunks()
    key = pa.chunked_array([rows.column(0)]).take(counts["doc"])
    return pa.table([key, counts["term"], counts["count_all"].cast(pa.int64())], [rows.schema.names[0], "term", "tf"])


def document_counts(df: DataFrame, key: str, text: str, max_n: int = 1, stop_words=()) -> DataFrame:
    """What :func:`term_counts` gives, for keys of one document: its terms are counted where its text lies, a few documents
    at a time, without a hash table of all terms of a task. Rows of one key are put together first."""
    split = df.select(key, vector_tokens(F.col(text), stop_words).alias("_t"))
    texts = split.groupBy(key).agg(F.collect_list("_t").alias("_t"))
    schema = T.StructType([split.schema[key], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType(), False)])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                yield from _counted(batch.slice(start, SLICE), max_n).to_batches()

    return texts.mapInArrow(run, schema)


def vocabulary(
    counts: DataFrame,
    n_docs: Column,
    min_df: int = 1,
    max_df: float = 1.0,
    max_features: int | None = None,
) -> DataFrame:
    """Terms with document frequency, smooth idf and corpus count.

    ``max_features`` keeps the most frequent terms, ties by term.
    """
    vocab = (
        counts.groupBy("term")
        .agg(F.count("*").alias("df"), F.sum("tf").alias("corpus_count"))
        .filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))
        .withColumn("idf", F.log((1 + n_docs) / (1 + F.col("df"))) + 1)
    )
    if max_features is not None:
        vocab = vocab.orderBy(F.desc("corpus_count"), "term").limit(max_features)
    return vocab


def by_term(counts: DataFrame) -> DataFrame:
    """Counts laid by term, for a whole vocabulary and its lookup: texts are split and counts shuffled once for both.
    A term has at most one row a document."""
    return counts.repartition("term")


def whole_vocabulary(counts: DataFrame, key: str, n_docs: Column, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """term and idf of counts laid by term, to be joined with them where they lie."""
    # every column is read, so that Spark sees the exchange of the counts themselves and uses it again
    rows = F.count_if((F.col("tf") > 0) | (F.xxhash64(key) == 0))
    vocab = counts.groupBy("term").agg(rows.alias("df")).filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))
    return vocab.select("term", (F.log((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf(
    df: DataFrame,
    key: str,
    text: str,
    max_n: int = 1,
    min_df: int = 1,
    max_df: float = 1.0,
    max_features: int | None = None,
    sublinear: bool = False,
    stop_words=(),
) -> DataFrame:
    """L2-normalised weight per key and term: tf (or 1 + ln tf) times ln((1+n)/(1+df)) + 1. A key is one document."""
    n_docs = df.agg(F.countDistinct(key).alias("n")).scalar()
    if max_features is None:
        counts = by_term(document_counts(df, key, text, max_n, stop_words))
        return weigh(counts, whole_vocabulary(counts, key, n_docs, min_df, max_df).hint("shuffle_hash"), key, sublinear)
    counts = term_counts(df, key, text, max_n, stop_words)
    return weigh(counts, vocabulary(counts, n_docs, min_df, max_df, max_features), key, sublinear)


def weigh(counts: DataFrame, vocab: DataFrame, key: str, sublinear: bool = False) -> DataFrame:
    """Weights of counted terms under a given vocabulary (training or stored)."""
    keep = [c for c in ("idx",) if c in vocab.columns]
    tf = (1 + F.log("tf")) if sublinear else F.col("tf").cast("double")
    raw = counts.join(vocab.select("term", "idf", *keep), "term").withColumn("_w", tf * F.col("idf"))
    # the window holds one document's distinct terms, never a corpus-wide group
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", *keep, "tf", (F.col("_w") / norm).alias("weight"))


def tfidf_keywords(
    df: DataFrame, key: str, text: str, k: int = 10, max_features: int | None = None, min_df: int = 2, max_df: float = 0.85
) -> DataFrame:
    """Top ``k`` uni- and bigrams per document by sublinear TF-IDF (weights compared to 6 places)."""
    w = tfidf(df, key, text, 2, min_df, max_df, max_features, sublinear=True)
    score = F.round("weight", 6)
    return top_n_by(w.filter(F.col("weight") > 0), [key], [score.desc(), F.col("term").asc()], k).select(
        key, "rank", "term", "weight"
    )


def topic_keywords(
    df: DataFrame, topic: str, text: str, n: int = 8, max_features: int | None = None, stop_words=tuple(fv.GENERAL_STOP_WORDS)
) -> DataFrame:
    """Class-based TF-IDF: each topic is one document; best ``n`` terms per topic."""
    counts = term_counts(df, topic, text, 1, stop_words)
    n_topics = df.agg(F.countDistinct(topic).alias("n")).scalar()
    w = weigh(counts, vocabulary(counts, n_topics, max_features=max_features), topic)
    return top_n_by(
        w.filter(F.col("weight") > 0), [topic], [F.round("weight", 6).desc(), F.col("term").asc()], n
    ).select(topic, "rank", "term", "weight")


def indexed_vocabulary(vocab: DataFrame) -> DataFrame:
    """Number the terms 0.. in term order. The vocabulary is capped by ``max_features``,
    so ranking it in one task is bounded."""
    return vocab.withColumn("idx", F.row_number().over(Window.orderBy("term")) - 1)


def sparse_column(indices: Column, values: Column, size: int) -> Column:
    """ML sparse vectors from sorted index and value arrays, one Arrow batch at a time."""

    @F.pandas_udf(VectorUDT())
    def wrap(i: pd.Series, v: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"type": 0, "size": size, "indices": i, "values": v})

    return wrap(indices.cast("array<int>"), values)


def tfidf_vectors(df: DataFrame, counts: DataFrame, vocab: DataFrame, key: str, size: int, sublinear: bool = True,
                  name: str = "tfidf") -> DataFrame:
    """Sparse TF-IDF vector per row of ``df``; rows without known terms get an empty vector.

    ``vocab`` has at most ``size`` terms, so it is sent to the counts: nothing is shuffled by term, and rows that
    lie by key are not shuffled at all.
    """
    tf = (1 + F.log("tf")) if sublinear else F.col("tf").cast("double")
    met = counts.join(F.broadcast(vocab.select("term", "idx", "idf")), "term").withColumn("_w", tf * F.col("idf"))
    cells = met.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("idx", "_w"))).alias("_c"), F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm")
    )
    weights = F.transform("_c._w", lambda w: w / F.col("_norm"))
    cells = cells.select(key, F.col("_c.idx").alias("_i"), weights.alias("_v"))
    joined = df.join(cells, key, "left").withColumns(
        {"_i": F.coalesce("_i", F.array().cast("array<int>")), "_v": F.coalesce("_v", F.array().cast("array<double>"))}
    )
    return joined.withColumn(name, sparse_column(F.col("_i"), F.col("_v"), size)).drop(*({"_i", "_v"} - {name}))


def doc_keywords(df: DataFrame, key: str, tokens: Column, n: int = 20) -> DataFrame:
    """Most frequent tokens per document, ties by token."""
    counts = term_counts(df, key, "", tokens=tokens)
    return top_n_by(counts, [key], [F.desc("tf"), F.asc("term")], n)


def top_words(df: DataFrame, cls: Column, text: str, n: int = 20, stop_words=fv.REVIEW_STOP_WORDS) -> DataFrame:
    """Most frequent alphabetic words per class; rows with a null class are left out."""
    cleaned = F.transform(tx.words(F.lower(F.col(text))), lambda w: F.regexp_replace(w, r"^[.,!?\"'()\[\]]+|[.,!?\"'()\[\]]+$", ""))
    kept = F.filter(cleaned, lambda w: ~w.isin(*stop_words) & (F.length(w) > 2) & w.rlike(r"^\p{L}+$"))
    words = df.select(cls.alias("cls"), F.explode(kept).alias("word")).filter(F.col("cls").isNotNull())
    counts = words.groupBy("cls", "word").agg(F.count("*").alias("n"))
    return top_n_by(counts, ["cls"], [F.desc("n"), F.asc("word")], n)


RAKE_SPLIT = r"[\s\-–,.;:!?()\[\]{}\"']+"


def rake_phrases(c: Column, stop_words, min_words: int = 1, max_words: int = 4) -> Column:
    """Runs of words between stop words, sentence by sentence."""

    def phrases(sentence: Column) -> Column:
        tokens = F.filter(F.split(sentence, RAKE_SPLIT), lambda t: t != "")
        marked = F.transform(tokens, lambda t: F.when(t.isin(*stop_words), "\u0001").otherwise(t))
        return F.transform(F.split(F.array_join(marked, " "), "\u0001"), lambda p: F.trim(p))

    every = F.flatten(F.transform(tx.sentences(F.lower(c)), phrases))
    return F.filter(every, lambda p: (p != "") & F.size(F.split(p, " ")).between(min_words, max_words))


def rake(
    df: DataFrame, key: str, text: str, n: int = 15, stop_words=None, published: bool = False
) -> DataFrame:
    """Top phrases per document. A word scores freq / (freq + degree), or degree / freq
    plus one when ``published``; a phrase scores the sum over its words."""
    stop = stop_words or sorted(set(fv.GENERAL_STOP_WORDS) | set(fv.JOB_STOP_WORDS))
    found = df.select(key, F.explode(rake_phrases(F.col(text), stop)).alias("phrase"))
    phrases = found.groupBy(key, "phrase").agg(F.count("*").alias("_n")).withColumn("_w", F.split("phrase", " "))
    words = phrases.select(key, "phrase", "_n", (F.size("_w") - 1).alias("_d"), F.explode("_w").alias("word"))
    stats = words.groupBy(key, "word").agg(F.sum("_n").alias("freq"), F.sum(F.col("_n") * F.col("_d")).alias("degree"))
    score = (
        (F.col("freq") + F.col("degree")) / F.col("freq")
        if published
        else F.col("freq") / (F.col("freq") + F.col("degree") + 1e-9)
    )
    scored = words.join(stats, [key, "word"]).groupBy(key, "phrase").agg(F.sum(score).alias("score"))
    return top_n_by(scored, [key], [F.round("score", 6).desc(), F.col("phrase").asc()], n)


def taxonomy_terms(c: Column, terms) -> Column:
    """Taxonomy terms found in lower-cased text, sorted; one- and two-letter terms on word boundaries."""
    return F.array_compact(
        F.array(
            *[
                F.when(c.rlike(tx.word_pattern([t])) if len(t) <= 2 else F.contains(c, F.lit(t)), F.lit(t))
                for t in sorted(terms)
            ]
        )
    )


def match_taxonomy(df: DataFrame, text: str, taxonomy=fv.SKILLS, name: str = "found") -> DataFrame:
    """Map category -> matched terms, categories without a match left out."""
    low = df.withColumn("_low", F.lower(F.coalesce(F.col(text), F.lit(""))))
    entries = F.array(
        *[F.struct(F.lit(c).alias("key"), taxonomy_terms(F.col("_low"), t).alias("value")) for c, t in taxonomy.items()]
    )
    return low.withColumn(name, F.map_from_entries(F.filter(entries, lambda e: F.size(e["value"]) > 0))).drop("_low")


def tag_tokens(df: DataFrame, key: str, tokens: Column, tags: DataFrame, default: str = "NN") -> DataFrame:
    """Tokens and their tags as parallel arrays, from a token-to-tag table; empty arrays where there are no tokens."""
    t = df.select(key, F.posexplode_outer(tokens).alias("pos", "token"))
    # hashing the tags spares sorting the far larger token side
    tagged = t.join(tags.select("token", "tag").hint("shuffle_hash"), "token", "left").withColumn("tag", F.coalesce("tag", F.lit(default)))
    cell = F.when(F.col("pos").isNotNull(), F.struct("pos", "token", "tag"))
    rows = tagged.groupBy(key).agg(F.sort_array(F.collect_list(cell)).alias("_r"))
    return rows.select(key, F.col("_r.token").alias("tokens"), F.col("_r.tag").alias("tags"))


def noun_phrases(tokens: Column, tags: Column) -> Column:
    """Distinct multi-word chunks "determiner? adjective* noun+" in order of appearance."""
    code = F.array_join(
        F.transform(
            tags,
            lambda t: F.when(t == "DT", "D").when(t.startswith("JJ"), "J").when(t.startswith("NN"), "N").otherwise("o"),
        ),
        "",
    )
    chunk = "D?J*N+"
    pieces = F.zip_with(
        F.regexp_extract_all(code, F.lit(chunk), F.lit(0)),
        F.split(code, chunk),
        lambda m, gap: F.struct(F.length(gap).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("len")),
    )
    # the tokens ride in the fold's state so that they are evaluated once per document
    start = F.struct(F.lit(0).alias("pos"), tokens.alias("toks"), F.array().cast("array<string>").alias("out"))

    def step(acc, p):
        first = acc["pos"] + p["gap"]
        phrase = F.array_join(F.slice(acc["toks"], first + 1, p["len"]), " ")
        found = F.when(p["len"] >= 2, F.concat(acc["out"], F.array(phrase))).otherwise(acc["out"])
        return F.struct((first + p["len"]).alias("pos"), acc["toks"].alias("toks"), found.alias("out"))

    return F.array_distinct(F.aggregate(pieces, start, step, lambda acc: acc["out"]))


def lemmatize_tokens(df: DataFrame, key: str, tokens: Column, lemmas: DataFrame) -> DataFrame:
    """Token arrays with lemmas from a (token, lemma) table; unknown tokens stay."""
    t = df.select(key, F.posexplode(tokens).alias("pos", "token"))
    found = t.join(lemmas.select("token", "lemma").hint("shuffle_hash"), "token", "left")
    rows = found.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("pos", F.coalesce("lemma", "token").alias("lemma")))).alias("_r")
    )
    return rows.select(key, F.col("_r.lemma").alias("tokens"))


def _lemmatized(df: DataFrame, tokens: Column, tags: DataFrame | None, lemmas: DataFrame) -> DataFrame:
    """``df`` with ``_lemmas``, ``top_keywords`` and ``noun_phrases`` of its rows, whose digests are in ``_a`` and ``_b``.

    Tokens go to both tables in one shuffle and back to their rows in another; equal rows (one pair of digests) count once.
    """
    t = df.select("_a", "_b", F.posexplode(tokens).alias("pos", "token"))
    found = t.join(lemmas.select("token", "lemma").hint("shuffle_hash"), "token", "left")
    if tags is not None:
        found = found.join(tags.select("token", "tag").hint("shuffle_hash"), "token", "left")
    tag = F.lit("") if tags is None else F.coalesce("tag", F.lit("NN"))
    found = found.select("_a", "_b", "pos", "token", tag.alias("tag"), F.coalesce("lemma", "token").alias("lemma"))
    # laid by row once: the occurrences of a lemma, then the lemmas of a row, are put together where they lie
    found = found.repartition("_a", "_b").groupBy("_a", "_b", "lemma").agg(F.collect_set(F.struct("pos", "token", "tag")).alias("at"))
    cells = found.groupBy("_a", "_b").agg(F.collect_list(F.struct("lemma", "at")).alias("_c"))
    ranked = F.slice(F.sort_array(F.transform("_c", lambda c: F.struct((-F.size(c["at"])).alias("n"), c["lemma"].alias("lemma")))), 1, 10)
    every = F.flatten(F.transform("_c", lambda c: F.transform(c["at"], lambda x: F.struct(
        x["pos"].alias("pos"), c["lemma"].alias("lemma"), x["token"].alias("token"), x["tag"].alias("tag")))))
    rows = cells.select("_a", "_b", F.array_join(F.transform(ranked, lambda r: r["lemma"]), ", ").alias("top_keywords"), F.sort_array(every).alias("_r"))
    phrases = F.lit("") if tags is None else F.array_join(noun_phrases(F.col("_r.token"), F.col("_r.tag")), " | ")
    rows = rows.select("_a", "_b", F.col("_r.lemma").alias("_lemmas"), "top_keywords", phrases.alias("noun_phrases"))
    filled = {"_lemmas": F.coalesce("_lemmas", F.array().cast("array<string>")), "noun_phrases": F.coalesce("noun_phrases", F.lit(""))}
    return df.join(rows, ["_a", "_b"], "left").withColumns(filled).drop("_a", "_b")


def process_documents(
    df: DataFrame, key: str, text: str, tags: DataFrame | None = None, lemmas: DataFrame | None = None
) -> DataFrame:
    """The document table: processed text, keywords, skills, noun phrases and counts.

    ``tags`` (token, tag) and ``lemmas`` (token, lemma) have a token once. With ``lemmas``, keys may repeat or be null: a row is
    then known by two hashes of its key and text.
    """
    stop = sorted(set(fv.GENERAL_STOP_WORDS) | set(fv.JOB_STOP_WORDS))
    clean = tx.clean_job_text(F.col(text))
    tokens = tx.filter_tokens(tx.job_tokens(clean), stop)
    if lemmas is None:
        base = df.withColumn("_clean", clean).withColumn("_tokens", tokens).withColumn("_lemmas", F.col("_tokens"))
        top = doc_keywords(base, key, F.col("_lemmas"), 10).groupBy(key).agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))), lambda r: r["term"]), ", ").alias(
                "top_keywords"
            )
        )
        out = base.join(top, key, "left")
        if tags is None:
            out = out.withColumn("noun_phrases", F.lit(""))
        else:
            chunks = tag_tokens(base, key, F.col("_tokens"), tags).select(
                key, F.array_join(noun_phrases(F.col("tokens"), F.col("tags")), " | ").alias("noun_phrases")
            )
            out = out.join(chunks, key, "left").withColumn("noun_phrases", F.coalesce("noun_phrases", F.lit("")))
    else:
        rows = df.withColumns({"_a": F.xxhash64(key, text), "_b": F.xxhash64(text, key)})
        out = _lemmatized(rows, tokens, tags, lemmas).withColumn("_clean", clean)
    names = {
        "skills_languages": "languages", "skills_ml_ai": "ml_ai", "skills_frameworks": "frameworks",
        "skills_data": "data", "skills_cloud": "cloud_devops", "soft_skills": "soft_skills",
    }
    return match_taxonomy(out, "_clean", name="_skills").withColumns(
        {
            "processed_text": F.array_join("_lemmas", " "),
            "top_keywords": F.coalesce("top_keywords", F.lit("")),
            **{o: F.coalesce(F.array_join(F.try_element_at("_skills", F.lit(c)), ", "), F.lit("")) for o, c in names.items()},
            "token_count": F.size("_lemmas"),
            "sentence_count": F.size(tx.sentences(F.col("_clean"))),
            "skill_count": F.aggregate(F.map_values("_skills"), F.lit(0), lambda a, v: a + F.size(v)),
            "bigram_count": F.greatest(F.size("_lemmas") - 1, F.lit(0)),
        }
    ).drop("_clean", "_tokens", "_lemmas", "_skills")
