"""Queries for corpus text analytics, sentiment and summaries."""

from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import labels
from starsift.functions import sentiment as fs
from starsift.functions import text as tx
from starsift.operators import corpus, insights, sentiment, summaries, topics
from starsift.queries.features import SENTENCES
from starsift.queries.oracle import NSP, SP, WD, over, sql_in, sql_list, words
from starsift.queries.registry import query
from starsift.sources import adapters as ad
from starsift.sources import durable

JOB_STOP = sorted(set(fv.GENERAL_STOP_WORDS) | set(fv.JOB_STOP_WORDS))


def _docs(s, d):
    return ad.documents(s, d)


VT = f"regexp_extract_all(lower(text), '[{WD}]{{2,}}')"
JT = f"regexp_extract_all(lower(text), '[{WD}]+(?:[.''+#-][{WD}]+)*|[^{WD}{fv.SPACE}]')".replace("\\x85", "\\x{85}")
FT = (
    f"[t FOR t IN {JT} IF t NOT IN {sql_in(JOB_STOP)} AND length(t) BETWEEN 2 AND 40 "
    "AND regexp_matches(t, '[\\p{L}\\p{N}]') AND NOT regexp_matches(t, '^\\p{N}+$')]"
)


def _job_tokens():
    return tx.filter_tokens(tx.job_tokens(F.lower("text")), JOB_STOP)


@query("token_and_sentence_counts", "F-01", f"SELECT doc_id, len({JT}) AS tokens, len({SENTENCES}) AS sentences FROM documents")
def token_and_sentence_counts(s, d):
    return _docs(s, d).select(
        "doc_id",
        F.size(tx.job_tokens(F.lower("text"))).alias("tokens"),
        F.size(tx.sentences(F.col("text"))).alias("sentences"),
    )


@query("filtered_tokens", "F-02 B-20", f"SELECT doc_id, array_to_string({FT}, ' ') AS tokens FROM documents")
def filtered_tokens(s, d):
    return _docs(s, d).select("doc_id", F.array_join(_job_tokens(), " ").alias("tokens"))


@query(
    "ngrams",
    "F-03",
    f"""WITH t AS (SELECT doc_id, {VT} AS w FROM documents)
    SELECT doc_id, array_to_string([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))], '|') AS bigrams,
           array_to_string([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)], '|') AS trigrams FROM t""",
)
def ngrams(s, d):
    t = _docs(s, d).select("doc_id", corpus.vector_tokens(F.col("text")).alias("w"))
    return t.select(
        "doc_id",
        F.array_join(tx.ngrams(F.col("w"), 2), "|").alias("bigrams"),
        F.array_join(tx.ngrams(F.col("w"), 3), "|").alias("trigrams"),
    )


@query(
    "doc_keywords",
    "F-04 G-04",
    f"""WITH t AS (SELECT doc_id, unnest({FT}) AS term FROM documents), c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
    k AS (SELECT *, cast(row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, term) AS int) AS rank FROM c)
    SELECT * FROM k WHERE rank <= 20""",
)
def doc_keywords(s, d):
    return corpus.doc_keywords(_docs(s, d), "doc_id", _job_tokens(), 20)


@query(
    "top_words_by_class",
    "F-05",
    over(
        "reviews",
        f""", w AS (SELECT CASE WHEN star_rating >= 4 THEN 'positive' WHEN star_rating <= 2 THEN 'negative' END AS cls,
                   unnest([trim(x, '.,!?"''()[]') FOR x IN {words('lower(review_text)')}]) AS word FROM reviews),
        c AS (SELECT cls, word, count(*) AS n FROM w WHERE cls IS NOT NULL AND word NOT IN {sql_in(fv.REVIEW_STOP_WORDS)}
              AND length(word) > 2 AND regexp_matches(word, '^\\p{{L}}+$') GROUP BY ALL),
        k AS (SELECT *, cast(row_number() OVER (PARTITION BY cls ORDER BY n DESC, word) AS int) AS rank FROM c)
        SELECT * FROM k WHERE rank <= 20""",
    ),
)
def top_words_by_class(s, d):
    stars = F.col("star_rating")
    cls = F.when(stars >= 4, "positive").when(stars <= 2, "negative")
    return corpus.top_words(ad.text_reviews(s, d), cls, "review_text", 20)


_RAKE = "[ \\t\\n\\f\\r\\x0B\\-–,.;:!?()\\[\\]{{}}\"'']+".replace("{{}}", "{}")


@query(
    "rake_phrases",
    "F-06",
    f"""WITH s AS (SELECT doc_id, unnest({SENTENCES.replace('text', 'lower(text)')}) AS sent FROM documents),
    m AS (SELECT doc_id, array_to_string([CASE WHEN t IN {sql_in(JOB_STOP)} THEN chr(1) ELSE t END
                 FOR t IN regexp_split_to_array(sent, '{_RAKE}') IF t <> ''], ' ') AS marked FROM s),
    p AS (SELECT doc_id, unnest([trim(x) FOR x IN string_split(marked, chr(1))]) AS phrase FROM m),
    f AS (SELECT doc_id, phrase, string_split(phrase, ' ') AS w FROM p
          WHERE phrase <> '' AND len(string_split(phrase, ' ')) BETWEEN 1 AND 4),
    u AS (SELECT doc_id, len(w) - 1 AS deg, unnest(w) AS word FROM f),
    st AS (SELECT doc_id, word, count(*) / (count(*) + sum(deg) + 1e-9) AS ws FROM u GROUP BY ALL),
    dp AS (SELECT DISTINCT doc_id, phrase FROM f),
    du AS (SELECT doc_id, phrase, unnest(string_split(phrase, ' ')) AS word FROM dp),
    sc AS (SELECT doc_id, phrase, round(sum(ws), 6) AS score FROM du JOIN st USING (doc_id, word) GROUP BY ALL),
    k AS (SELECT *, cast(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, phrase) AS int) AS rank FROM sc)
    SELECT * FROM k WHERE rank <= 15""",
)
def rake_phrases(s, d):
    return corpus.rake(_docs(s, d), "doc_id", "text", 15)


_SKILLS = {c: sorted(t) for c, t in fv.SKILLS.items()}


def _skill_sql(c: str) -> str:
    tests = [
        f"CASE WHEN regexp_matches(low, '(^|[^{WD}]){tx.escape(t)}($|[^{WD}])') THEN '{t}' END"
        if len(t) <= 2
        else f"CASE WHEN contains(low, '{t}') THEN '{t}' END"
        for t in _SKILLS[c]
    ]
    return f"array_to_string([x FOR x IN [{', '.join(tests)}] IF x IS NOT NULL], ', ') AS {c}"


@query(
    "taxonomy_matches",
    "F-07",
    f"WITH t AS (SELECT doc_id, lower(text) AS low FROM documents) SELECT doc_id, {', '.join(_skill_sql(c) for c in _SKILLS)} FROM t",
)
def taxonomy_matches(s, d):
    found = corpus.match_taxonomy(_docs(s, d), "text")
    return found.select(
        "doc_id",
        *[F.coalesce(F.array_join(F.try_element_at("found", F.lit(c)), ", "), F.lit("")).alias(c) for c in _SKILLS],
    )


def _tags(s, d):
    """Token-to-tag table read off the corpus by word shape."""
    tokens = _docs(s, d).select(F.explode(tx.words(tx.clean_text_num(F.col("text")))).alias("token")).distinct()
    return tokens.select("token", _shape_tag().alias("tag"))


def _shape_tag():
    return (
        F.when(F.col("token").isin("the", "an", "and"), "DT").when(F.col("token").rlike("ing$"), "VBG")
        .when(F.col("token").rlike("er$"), "JJR").when(F.col("token").rlike("ly$"), "RB").otherwise("NN")
    )


def _job_tables(s, d):
    """(token, tag) and (token, lemma) of the tokens of the document table, read off the corpus by word shape."""
    tokens = tx.filter_tokens(tx.job_tokens(tx.clean_job_text(F.col("text"))), JOB_STOP)
    each = durable.stored(_docs(s, d).select(F.explode(tokens).alias("token")).distinct(), "job-tokens")
    plural = F.col("token").endswith("s") & (F.length("token") > 3)
    # tokens that a table leaves out are nouns and stay as they are
    tags = each.select("token", _shape_tag().alias("tag")).filter("tag <> 'NN'")
    return tags, each.filter(plural).withColumn("lemma", F.regexp_replace("token", "s$", ""))


_TAG = """CASE WHEN token IN ('the', 'an', 'and') THEN 'DT' WHEN ends_with(token, 'ing') THEN 'VBG'
               WHEN ends_with(token, 'er') THEN 'JJR' WHEN ends_with(token, 'ly') THEN 'RB' ELSE 'NN' END"""


def _clean_num_sql():
    from starsift.queries.cleaning import CLEAN_NUM

    return CLEAN_NUM


def _phrases_sql(tokens: str) -> str:
    """CTEs over w (doc_id, w: list of tokens) up to np (doc_id, phrases): the code of a chunk has one letter a token, so the lengths
    of the pieces between bars give its place."""
    return f"""cd AS (SELECT doc_id, w, array_to_string([CASE {_TAG.replace('token', 'x')} WHEN 'DT' THEN 'D' WHEN 'JJR' THEN 'J' WHEN 'NN' THEN 'N'
                 ELSE 'o' END FOR x IN w], '') AS code FROM {tokens}),
    pc AS (SELECT doc_id, w, string_split(regexp_replace(code, '(D?J*N+)', '|\\1|', 'g'), '|') AS ps FROM cd),
    pu AS (SELECT doc_id, w, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM pc),
    pp AS (SELECT doc_id, w, p, i, coalesce(sum(length(p)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pu),
    ph AS (SELECT doc_id, array_to_string(w[cast(before + 1 AS bigint):cast(before + length(p) AS bigint)], ' ') AS phrase, min(i) AS i FROM pp
           WHERE i % 2 = 0 AND length(p) >= 2 GROUP BY ALL),
    np AS (SELECT doc_id, string_agg(phrase, ' | ' ORDER BY i) AS phrases FROM ph GROUP BY 1)"""


@query(
    "noun_phrases",
    "F-08 F-14",
    f"""WITH w AS (SELECT doc_id, {words(_clean_num_sql())} AS w FROM documents), {_phrases_sql('w')}
    SELECT doc_id, coalesce(phrases, '') AS phrases, phrases IS NOT NULL AS has_phrases, coalesce(len(w), 0) AS tokens FROM w LEFT JOIN np USING (doc_id)""",
)
def noun_phrases(s, d):
    tagged = corpus.tag_tokens(_docs(s, d), "doc_id", tx.words(tx.clean_text_num(F.col("text"))), _tags(s, d))
    phrases = tagged.select("doc_id", F.size("tokens").alias("tokens"), corpus.noun_phrases(F.col("tokens"), F.col("tags")).alias("p"))
    return phrases.select("doc_id", F.array_join("p", " | ").alias("phrases"), (F.size("p") > 0).alias("has_phrases"), "tokens")


@query(
    "pos_features",
    "F-14",
    f"""WITH w AS (SELECT doc_id, {words('lower(' + _clean_num_sql() + ')')} AS w FROM documents),
    t AS (SELECT doc_id, len(w) AS n, unnest(w) AS token FROM w), g AS (SELECT doc_id, n, {_TAG} AS tag FROM t)
    SELECT doc_id, count(*) FILTER (WHERE tag = 'NN') AS noun_count, count(*) FILTER (WHERE tag = 'VBG') AS verb_count,
           count(*) FILTER (WHERE tag = 'JJR') AS adj_count, count(*) FILTER (WHERE tag = 'RB') AS adv_count,
           round(count(*) FILTER (WHERE tag = 'NN') / (any_value(n) + 1), 6) AS noun_ratio,
           round(count(*) FILTER (WHERE tag = 'VBG') / (any_value(n) + 1), 6) AS verb_ratio,
           round(count(*) FILTER (WHERE tag = 'JJR') / (any_value(n) + 1), 6) AS adj_ratio,
           round(count(*) FILTER (WHERE tag = 'RB') / (any_value(n) + 1), 6) AS adv_ratio
    FROM g GROUP BY doc_id
    UNION ALL SELECT doc_id, 0, 0, 0, 0, 0, 0, 0, 0 FROM w WHERE len(w) = 0""",
)
def pos_features(s, d):
    from starsift.operators import features

    docs = _docs(s, d).select("doc_id", tx.clean_text_num(F.col("text")).alias("clean_text"))
    tags = _tags(s, d).select(F.lower("token").alias("token"), "tag").groupBy("token").agg(F.first("tag").alias("tag"))
    return features.pos_features(docs, tags, "doc_id").drop("clean_text")


@query(
    "lemmatized_tokens",
    "F-13 B-17",
    f"""WITH w AS (SELECT doc_id, {words(_clean_num_sql())} AS w FROM documents)
    SELECT doc_id, array_to_string([CASE WHEN ends_with(t, 's') AND length(t) > 3 THEN left(t, length(t) - 1) ELSE t END FOR t IN w], ' ')
           AS lemmas FROM w WHERE len(w) > 0""",
)
def lemmatized_tokens(s, d):
    tokens = tx.words(tx.clean_text_num(F.col("text")))
    lemmas = (
        _docs(s, d).select(F.explode(tokens).alias("token")).distinct()
        .filter(F.col("token").endswith("s") & (F.length("token") > 3))
        .withColumn("lemma", F.regexp_replace("token", "s$", ""))
    )
    out = corpus.lemmatize_tokens(_docs(s, d), "doc_id", tokens, lemmas)
    return out.select("doc_id", F.array_join("tokens", " ").alias("lemmas"))


def _job_sql():
    from starsift.queries.cleaning import _JOB

    return _JOB


_RENAMED = [("languages", "skills_languages"), ("ml_ai", "skills_ml_ai"), ("frameworks", "skills_frameworks"),
            ("data", "skills_data"), ("cloud_devops", "skills_cloud"), ("soft_skills", "soft_skills")]


@query(
    "document_table",
    "F-09",
    f"""WITH j AS (SELECT doc_id, {_job_sql()} AS text FROM documents),
    t AS (SELECT doc_id, text, text AS low, {FT} AS w FROM j),
    m AS (SELECT doc_id, [CASE WHEN ends_with(x, 's') AND length(x) > 3 THEN left(x, length(x) - 1) ELSE x END FOR x IN w] AS lemmas FROM t),
    u AS (SELECT doc_id, unnest(lemmas) AS term FROM m), c AS (SELECT doc_id, term, count(*) AS tf FROM u GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, term) AS rank FROM c),
    top AS (SELECT doc_id, string_agg(term, ', ' ORDER BY rank) AS top_keywords FROM k WHERE rank <= 10 GROUP BY 1),
    s AS (SELECT doc_id, {', '.join(_skill_sql(c) for c in _SKILLS)} FROM t), {_phrases_sql('t')}
    SELECT t.doc_id, array_to_string(lemmas, ' ') AS processed_text, coalesce(top_keywords, '') AS top_keywords,
           {', '.join(f's.{a} AS {b}' for a, b in _RENAMED)}, len(w) AS token_count, len({SENTENCES}) AS sentence_count,
           {' + '.join(f"CASE WHEN s.{c} = '' THEN 0 ELSE len(string_split(s.{c}, ', ')) END" for c in _SKILLS)} AS skill_count,
           greatest(len(w) - 1, 0) AS bigram_count, coalesce(phrases, '') AS noun_phrases
    FROM t JOIN m USING (doc_id) JOIN s USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN np USING (doc_id)""",
)
def document_table(s, d):
    tags, lemmas = _job_tables(s, d)
    return corpus.process_documents(_docs(s, d).select("doc_id", "text"), "doc_id", "text", tags, lemmas).drop("text")


@query("document_noun_phrases", "F-09 F-08")
def document_noun_phrases(s, d):
    docs = _docs(s, d).select("doc_id", "text")
    return corpus.process_documents(docs, "doc_id", "text", tags=_tags(s, d)).select("doc_id", "noun_phrases")


def _tfidf_sql(max_features: int | None, min_df: int, max_df: float) -> str:
    most = "" if max_features is None else f"ORDER BY total DESC, term LIMIT {max_features}"
    return f"""t AS (SELECT doc_id, {VT} AS w FROM documents),
    g AS (SELECT doc_id, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS term FROM t),
    c AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL),
    n AS (SELECT count(*) AS n FROM documents),
    v AS (SELECT term, count(*) AS df, sum(tf) AS total FROM c GROUP BY 1
          HAVING count(*) >= {min_df} AND count(*) <= {max_df} * (SELECT n FROM n)
          {most}),
    r AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((1 + n.n) / (1 + df)) + 1) AS w FROM c JOIN v USING (term), n),
    x AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM r)"""


@query(
    "tfidf_keywords",
    "F-10 F-11",
    f"""WITH {_tfidf_sql(None, 2, 0.85)},
    k AS (SELECT *, cast(row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 6) DESC, term) AS int) AS rank FROM x)
    SELECT doc_id, rank, term, round(weight, 6) AS weight FROM k WHERE rank <= 10""",
)
def tfidf_keywords(s, d):
    return corpus.tfidf_keywords(_docs(s, d), "doc_id", "text", 10)


@query(
    "tfidf_feature_rows",
    "F-11",
    f"WITH {_tfidf_sql(None, 2, 0.95)} SELECT doc_id, count(*) AS terms, round(sum(weight), 5) AS total FROM x GROUP BY 1",
)
def tfidf_feature_rows(s, d):
    w = corpus.tfidf(_docs(s, d), "doc_id", "text", 2, 2, 0.95, None, sublinear=True)
    return w.groupBy("doc_id").agg(F.count("*").alias("terms"), F.round(F.sum("weight"), 5).alias("total"))


_VS = f"[t FOR t IN {VT} IF t NOT IN {sql_in(fv.GENERAL_STOP_WORDS)}]"


@query(
    "topic_keywords",
    "F-12 K-04",
    f"""WITH t AS (SELECT source, unnest({_VS}) AS term FROM documents),
    c AS (SELECT source, term, count(*) AS tf FROM t GROUP BY ALL), n AS (SELECT count(DISTINCT source) AS n FROM documents),
    v AS (SELECT term, count(*) AS df, sum(tf) AS total FROM c GROUP BY 1),
    r AS (SELECT source, term, tf * (ln((1 + n.n) / (1 + df)) + 1) AS w FROM c JOIN v USING (term), n),
    x AS (SELECT source, term, w / sqrt(sum(w * w) OVER (PARTITION BY source)) AS weight FROM r),
    k AS (SELECT *, cast(row_number() OVER (PARTITION BY source ORDER BY round(weight, 6) DESC, term) AS int) AS rank FROM x)
    SELECT source, rank, term, round(weight, 6) AS weight FROM k WHERE rank <= 8""",
)
def topic_keywords(s, d):
    return corpus.topic_keywords(_docs(s, d), "source", "text")


@query(
    "duplicate_text",
    "F-16 D-05",
    over(
        "numbered",
        """SELECT review_id FROM numbered WHERE lower(trim(review_text)) IN
             (SELECT lower(trim(review_text)) FROM numbered GROUP BY 1 HAVING count(*) > 2)""",
    ).replace("numbered)", "numbered)"),
)
def duplicate_text(s, d):
    return insights.duplicate_text(ad.numbered_reviews(s, d)).select("review_id")


@query(
    "duplicate_documents",
    "F-16",
    """SELECT doc_id FROM documents WHERE lower(trim(text)) IN
         (SELECT lower(trim(text)) FROM documents GROUP BY 1 HAVING count(*) > 1)""",
)
def duplicate_documents(s, d):
    return insights.duplicate_text(_docs(s, d), "text", 1).select("doc_id")


SUSPICIOUS = f""", dup AS (SELECT lower(trim(review_text)) AS t FROM numbered GROUP BY 1 HAVING count(*) > 2),
  f AS (SELECT *, len({words('review_text')}) < 6 AND star_rating = 5 AS f1,
          len(regexp_extract_all(review_text, '[A-Z]')) / greatest(length(review_text), 1) > 0.5 AND star_rating = 5 AS f2,
          NOT verified AND star_rating = 5 AND helpful_votes = 0 AS f3,
          lower(trim(review_text)) IN (SELECT t FROM dup) AS f4 FROM numbered),
  flagged AS (SELECT review_id, product_id, star_rating, verified, helpful_votes,
          cast(f1 AS int) + cast(f2 AS int) + cast(f3 AS int) + 2 * cast(f4 AS int) AS suspicion_score,
          array_to_string([x FOR x IN [CASE WHEN f1 THEN 'short_5star' END, CASE WHEN f2 THEN 'excessive_caps' END,
            CASE WHEN f3 THEN 'unverified_5star_no_votes' END, CASE WHEN f4 THEN 'duplicate_text' END] IF x IS NOT NULL], '; ')
            AS suspicion_reasons FROM f)"""


@query(
    "suspicious_reviews",
    "F-17 M-09",
    over("numbered", SUSPICIOUS + " SELECT *, suspicion_score >= 2 AS is_suspicious FROM flagged"),
)
def suspicious_reviews(s, d):
    return insights.suspicious_reviews(ad.numbered_reviews(s, d)).select(
        "review_id", "product_id", "star_rating", "verified", "helpful_votes", "suspicion_score", "suspicion_reasons",
        "is_suspicious",
    )


@query(
    "suspicious_rate",
    "F-17",
    over("numbered", SUSPICIOUS + " SELECT round(count(*) FILTER (WHERE suspicion_score >= 2) * 100.0 / count(*), 6) AS suspicious_pct FROM flagged"),
)
def suspicious_rate(s, d):
    return insights.suspicious_rate(insights.suspicious_reviews(ad.numbered_reviews(s, d)))


_ST = f"regexp_extract_all(lower(sentence), '[{WD}]+|[^{WD}{fv.SPACE}]')".replace("\\x85", "\\x{85}")
_DT = f"regexp_extract_all(lower(text), '[{WD}]+|[^{WD}{fv.SPACE}]')".replace("\\x85", "\\x{85}")
SUMMARY = f"""WITH w AS (SELECT source, unnest({_DT}) AS word FROM documents),
  c AS (SELECT source, word, count(*) AS n FROM w WHERE regexp_matches(word, '^[\\p{{L}}\\p{{N}}]+$') AND length(word) > 2
        AND word NOT IN {sql_in(fv.GENERAL_STOP_WORDS)} GROUP BY ALL),
  fr AS (SELECT source, word, n / max(n) OVER (PARTITION BY source) AS f FROM c),
  l AS (SELECT source, doc_id, {SENTENCES} AS ss FROM documents),
  s AS (SELECT source, doc_id, unnest(ss) AS sentence, generate_subscripts(ss, 1) - 1 AS pos FROM l),
  u AS (SELECT *, {_ST} AS toks FROM s WHERE len({words('sentence')}) BETWEEN 6 AND 45 AND NOT starts_with(sentence, '-')),
  e AS (SELECT source, doc_id, pos, unnest(toks) AS word FROM u),
  h AS (SELECT source, doc_id, pos, sum(f) AS f FROM e JOIN fr USING (source, word) GROUP BY ALL),
  sc AS (SELECT u.source, u.doc_id, u.pos, sentence, round(coalesce(h.f, 0) / greatest(len(toks), 1)
           + len([t FOR t IN toks IF t IN {sql_in(fv.OPINION_WORDS)}]) * 0.3
           - least(len([t FOR t IN toks IF t IN {sql_in(fv.PERSONAL_WORDS)}]) * 0.1, 0.4), 6) AS score
         FROM u LEFT JOIN h ON u.source = h.source AND u.doc_id = h.doc_id AND u.pos = h.pos),
  b AS (SELECT *, row_number() OVER (PARTITION BY source, doc_id ORDER BY score DESC, pos) AS r1 FROM sc),
  k AS (SELECT *, cast(row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS int) AS rank FROM b WHERE r1 = 1)"""


@query(
    "summary_sentences",
    "F-18 F-20 G-04",
    SUMMARY + " SELECT source, doc_id, rank, sentence, score FROM k WHERE rank <= 5",
)
def summary_sentences(s, d):
    docs = _docs(s, d)
    scored = summaries.score_sentences(docs, "source", "doc_id", "text")
    return summaries.summary_sentences(scored, docs, "source", "doc_id", "text", 5).select("source", "doc_id", "rank", "sentence", "score")


@query(
    "cohort_summaries",
    "F-18",
    SUMMARY + " SELECT source, string_agg(sentence, ' | ' ORDER BY rank) AS summary_text FROM k WHERE rank <= 5 GROUP BY 1",
)
def cohort_summaries(s, d):
    return summaries.summarize_cohorts(_docs(s, d), "source", "doc_id", "text", 5)


@query(
    "conversation_points",
    "F-19",
    f"""WITH c AS (SELECT conv_id, turn, {'trim(regexp_replace(regexp_replace(text, ' + chr(39) + '<br\\s*/?>' + chr(39) + ", ' ', 'g'), '" + SP + "+', ' ', 'g'))"} AS text
                   FROM conversations),
    l AS (SELECT conv_id, turn, {SENTENCES} AS p FROM c)
    SELECT conv_id, turn, array_to_string(list_filter(p, lambda x, i: list_position([lower(y) FOR y IN p], lower(x)) = i), ' / ')
           AS points FROM l""",
)
def conversation_points(s, d):
    return ad.table(s, d, "conversations").select(
        "conv_id", "turn", F.array_join(summaries.summary_points(F.col("text")), " / ").alias("points")
    )


@query(
    "cohort_rows",
    "F-20",
    over(
        "reviews",
        """, k AS (SELECT review_id, CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' END AS cohort
                   FROM reviews),
        r AS (SELECT *, cast(row_number() OVER (PARTITION BY cohort ORDER BY review_id) AS int) AS position FROM k WHERE cohort IS NOT NULL)
        SELECT cohort, position, review_id FROM r WHERE position <= 10""",
    ),
)
def cohort_rows(s, d):
    label = labels.compound_label(F.col("compound"))
    picked = ad.text_reviews(s, d).filter(label != "neutral")
    return summaries.cohorts(picked, label, [F.asc("review_id")], 10).select("cohort", "position", "review_id")


@query(
    "product_cohort_rows",
    "F-20",
    over(
        "reviews",
        """, r AS (SELECT product_id AS cohort, review_id, cast(row_number() OVER (PARTITION BY product_id ORDER BY review_id) AS int)
                  AS position FROM reviews)
        SELECT * FROM r WHERE position <= 30""",
    ),
)
def product_cohort_rows(s, d):
    return summaries.cohorts(ad.text_reviews(s, d), F.col("product_id"), [F.asc("review_id")], 30).select(
        "cohort", "position", "review_id"
    )


@query("lda_topics", "F-21 F-22")
def lda_topics(s, d):
    r = ad.text_reviews(s, d).select("review_id", "month", "review_text")
    cv, lda, rows = topics.lda_fit(r, "review_text", 5, iterations=10)
    named = topics.lda_labels(cv, lda)
    return topics.dominant_topic(rows).groupBy("topic").agg(F.count("*").alias("n")).join(named, "topic")


@query(
    "dominant_dimension",
    "F-22",
    "SELECT vec_id, cast(list_position(embedding, list_max(embedding)) - 1 AS int) AS topic FROM embeddings",
)
def dominant_dimension(s, d):
    return topics.dominant_topic(ad.table(s, d, "embeddings"), "embedding").select("vec_id", "topic")


@query(
    "topic_month",
    "F-23",
    over(
        "reviews",
        "SELECT month, " + ", ".join(f'count(*) FILTER (WHERE topic_id = {i}) AS "t{i}"' for i in range(6)) + " FROM reviews GROUP BY 1",
    ),
)
def topic_month(s, d):
    r = ad.text_reviews(s, d).withColumn("t", F.concat(F.lit("t"), F.col("topic_id").cast("string")))
    return topics.topic_month(r, "t", [f"t{i}" for i in range(6)])


TREND = """, c AS (SELECT topic_id, month, count(*) AS n FROM reviews GROUP BY ALL),
  m AS (SELECT month, row_number() OVER (ORDER BY month) AS a, row_number() OVER (ORDER BY month DESC) AS z
        FROM (SELECT DISTINCT month FROM reviews)),
  e AS (SELECT topic_id, coalesce(sum(n) FILTER (WHERE a <= 3), 0) / 3 AS first_mean, coalesce(sum(n) FILTER (WHERE z <= 3), 0) / 3 AS last_mean
        FROM c JOIN m USING (month) GROUP BY 1),
  trend AS (SELECT topic_id, round(first_mean, 6) AS first_mean, round(last_mean, 6) AS last_mean,
        round(CASE WHEN (SELECT count(*) FROM m) >= 6 THEN (last_mean - first_mean) * 100.0 / (first_mean + 1) ELSE NULL END, 6) AS trend_pct, (SELECT count(*) FROM m) AS months FROM e)"""


@query("topic_trend", "F-24 G-09", over("reviews", TREND + " SELECT * FROM trend"))
def topic_trend(s, d):
    return topics.topic_trend(ad.text_reviews(s, d), "topic_id")


@query("trending_topic", "F-24", over("reviews", TREND + " SELECT * FROM trend ORDER BY trend_pct DESC, topic_id LIMIT 1"))
def trending_topic(s, d):
    return topics.trending_topic(topics.topic_trend(ad.text_reviews(s, d), "topic_id"), "topic_id")


def _pairs(values: dict[str, float]) -> str:
    return ", ".join(f"('{w}', {v!r}::DOUBLE)" for w, v in values.items())


def _modified(back: int) -> str:
    """Valence after the word ``back`` places before: boost first, then negation."""
    boost = f"sign(own) * b{back} + CASE WHEN mixed AND c{back} THEN sign(sign(own) * b{back}) * {fs.CAPS_INCREMENT}::DOUBLE ELSE 0 END"
    v = f"v{back - 1} + coalesce({boost}, 0) * {fs.BOOSTER_DECAY[back - 1]}::DOUBLE"
    return f"({v}) * CASE WHEN n{back} THEN {fs.NEGATION_FACTOR}::DOUBLE ELSE 1 END AS v{back}"


_TOKENS = f"regexp_extract_all(review_text, '[{WD}](?:{NSP}*[{WD}])?')"
_NEGATING = sql_in([*sorted(fs.NEGATIONS), "didnt", "dont", "doesnt", "hadnt", "hasnt", "isnt", "wasnt"])
_BEFORE = ", ".join(f"lag(b, {k}) OVER p AS b{k}, lag(cap, {k}) OVER p AS c{k}, lag(neg, {k}) OVER p AS n{k}" for k in (1, 2, 3))
_LEXICON_SQL = f""", lex(w, v) AS (VALUES {_pairs(fs.LEXICON)}), boost(w, v) AS (VALUES {_pairs(fs.BOOSTERS)}),
       t AS (SELECT review_id, unnest({_TOKENS}) AS word, unnest(range(len({_TOKENS}))) AS i FROM reviews),
       d AS (SELECT review_id, i, lower(word) AS low, replace(lower(word), chr(39), '') AS plain,
                    upper(word) = word AND lower(word) <> word AS cap FROM t),
       e AS (SELECT d.*, CASE WHEN s.w IS NULL THEN coalesce(l.v, 0) ELSE 0 END AS own, CASE WHEN k.w IS NULL THEN coalesce(b.v, 0) ELSE 0 END AS b,
                    k.w IS NULL AND plain IN {_NEGATING} AS neg
             FROM d LEFT JOIN lex l ON l.w = low LEFT JOIN boost s ON s.w = low LEFT JOIN lex k ON k.w = plain LEFT JOIN boost b ON b.w = plain),
       f AS (SELECT review_id, i, own, cap, {_BEFORE}, min(CASE WHEN low = 'but' THEN i END) OVER r AS but,
                    bool_or(cap) OVER r AND bool_or(NOT cap) OVER r AS mixed
             FROM e WINDOW p AS (PARTITION BY review_id ORDER BY i), r AS (PARTITION BY review_id)),
       g0 AS (SELECT *, own + CASE WHEN mixed AND cap THEN sign(own) * {fs.CAPS_INCREMENT}::DOUBLE ELSE 0 END AS v0 FROM f),
       g1 AS (SELECT *, {_modified(1)} FROM g0), g2 AS (SELECT *, {_modified(2)} FROM g1), g3 AS (SELECT *, {_modified(3)} FROM g2),
       v AS (SELECT review_id, CASE WHEN own = 0 THEN 0::DOUBLE WHEN i < but THEN v3 * {fs.BUT_BEFORE}::DOUBLE
                                    WHEN i > but THEN v3 * {fs.BUT_AFTER}::DOUBLE ELSE v3 END AS v FROM g3),
       a AS (SELECT review_id, sum(v) AS total, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS p,
                    sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS n, count(*) FILTER (v = 0) AS z FROM v GROUP BY 1),
       m AS (SELECT review_id, star_rating, coalesce(len(review_text) - len(replace(review_text, '!', '')), 0) AS x,
                    coalesce(len(review_text) - len(replace(review_text, '?', '')), 0) AS q FROM reviews),
       s AS (SELECT review_id, star_rating, coalesce(total, 0) AS total, coalesce(p, 0) AS p, coalesce(n, 0) AS n, coalesce(z, 0) AS z,
                    least(x, 4) * {fs.EXCLAMATION}::DOUBLE
                    + CASE WHEN q < 2 THEN 0 WHEN q <= 3 THEN q * {fs.QUESTION}::DOUBLE ELSE {fs.QUESTION_MAX}::DOUBLE END AS emphasis
             FROM m LEFT JOIN a USING (review_id)),
       u AS (SELECT review_id, star_rating, total + emphasis * sign(total) AS total, p + CASE WHEN p > n THEN emphasis ELSE 0 END AS p,
                    n + CASE WHEN n > p THEN emphasis ELSE 0 END AS n, z FROM s),
       c AS (SELECT *, round_even(total / sqrt(total * total + {fs.ALPHA}::DOUBLE), 4) AS compound, nullif(p + n + z, 0) AS whole FROM u),
       o AS (SELECT *, CASE WHEN compound <= -0.05 THEN 'negative' WHEN compound <= 0.05 THEN 'neutral' ELSE 'positive' END AS label,
                    CASE WHEN star_rating > 0 AND star_rating <= 2 THEN 'negative' WHEN star_rating > 2 AND star_rating <= 3 THEN 'neutral'
                         WHEN star_rating > 3 AND star_rating <= 5 THEN 'positive' END AS stars FROM c)
       SELECT review_id, compound AS vader_compound, coalesce(round_even(p / whole, 3), 0) AS vader_positive,
              coalesce(round_even(n / whole, 3), 0) AS vader_negative, coalesce(round_even(z / whole, 3), 0) AS vader_neutral,
              label AS vader_label, CAST(coalesce(label = stars, false) AS INTEGER) AS sentiment_star_agree FROM o"""


@query("lexicon_sentiment", "F-25 C-30", over("reviews", _LEXICON_SQL))
def lexicon_sentiment(s, d):
    return sentiment.sentiment_features(ad.text_reviews(s, d), "review_text", stars="star_rating").select(
        "review_id", "vader_compound", "vader_positive", "vader_negative", "vader_neutral", "vader_label",
        "sentiment_star_agree",
    )


@query(
    "overall_sentiment",
    "F-26",
    over(
        "reviews",
        """SELECT review_id, CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END
                  AS overall_sentiment,
                  round(greatest(greatest(compound, 0), greatest(-compound, 0), 1 - abs(compound)), 6) AS sentiment_confidence
           FROM reviews""",
    ),
)
def overall_sentiment(s, d):
    c = F.col("compound")
    r = ad.text_reviews(s, d).select(
        "review_id", "compound", F.greatest(c, F.lit(0.0)).alias("pos"), F.greatest(-c, F.lit(0.0)).alias("neg"),
        (1 - F.abs(c)).alias("neu"),
    )
    return sentiment.overall_sentiment(r, "compound", "pos", "neg", "neu").select(
        "review_id", "overall_sentiment", "sentiment_confidence"
    )


def word_balance(c):
    """Share of positive minus negative words, scored natively."""
    low = F.lower(c)
    pos = sum((low.contains(w).cast("int") for w in fv.ASPECT_POSITIVE), F.lit(0))
    neg = sum((low.contains(w).cast("int") for w in fv.ASPECT_NEGATIVE), F.lit(0))
    return (pos - neg) / 4.0


def _hits(words_) -> str:
    return "len([w FOR w IN " + sql_list(words_) + " IF contains(low, w)])"


ASPECT_SQL = f""", t AS (SELECT review_id, review_text AS text, [a FOR a IN {sql_list(fv.DEFAULT_ASPECTS)} IF contains(lower(review_text), a)] AS aspects
                        FROM reviews),
  s AS (SELECT review_id, aspects, unnest({SENTENCES}) AS sent FROM t),
  l AS (SELECT review_id, aspects, lower(sent) AS low FROM s),
  sc AS (SELECT review_id, unnest(aspects) AS aspect, low, ({_hits(fv.ASPECT_POSITIVE)} - {_hits(fv.ASPECT_NEGATIVE)}) / 4.0 AS score FROM l),
  m AS (SELECT review_id, aspect, avg(score) FILTER (WHERE contains(low, aspect)) AS m FROM sc GROUP BY ALL)"""


@query(
    "aspect_sentiment",
    "F-27 F-28",
    over(
        "reviews",
        ASPECT_SQL
        + """ SELECT review_id, aspect, CASE WHEN m >= 0.05 THEN 'positive' WHEN m <= -0.05 THEN 'negative' ELSE 'neutral' END
              AS sentiment_label,
              round(CASE WHEN m IS NULL THEN 0.5 WHEN m >= 0.05 OR m <= -0.05 THEN least(0.95, 0.5 + abs(m)) ELSE 0.6 END, 6) AS confidence,
              round(coalesce(m, 0), 6) AS score FROM m""",
    ),
)
def aspect_sentiment(s, d):
    return sentiment.aspect_sentiment(
        ad.text_reviews(s, d), "review_id", "review_text", sentiment.aspect_candidates(F.col("review_text")),
        lambda sentences: F.transform(sentences, word_balance),
    )


@query(
    "aspect_candidates",
    "F-28",
    over("reviews", f"SELECT review_id, array_to_string([a FOR a IN {sql_list(fv.DEFAULT_ASPECTS)} IF contains(lower(review_text), a)], ',') AS aspects FROM reviews"),
)
def aspect_candidates(s, d):
    return ad.text_reviews(s, d).select(
        "review_id", F.array_join(sentiment.aspect_candidates(F.col("review_text")), ",").alias("aspects")
    )
