"""Queries for brand, feature and model mentions and entity tables."""

from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import text as tx
from starsift.operators import entities as en
from starsift.operators import sentiment
from starsift.queries.oracle import over, sql_in, words
from starsift.queries.registry import query
from starsift.sources import adapters as ad

def _text():
    return F.col("review_text")


def _with_entities(s, d):
    return ad.numbered_reviews(s, d).withColumn("entities", en.extract_entities(_text()))


def _alt(terms) -> str:
    return "|".join(sorted({t.lower() for t in terms}, key=lambda t: (-len(t), t)))


BRAND_RE, FEATURE_RE = f"\\b({_alt(fv.BRANDS)})\\b", f"\\b({_alt(fv.PRODUCT_FEATURES)})\\b"
MODEL_RE = "[A-Za-z]+-[0-9]{1,4}\\b|\\b[A-Za-z]+[0-9]{1,4}[A-Za-z]?\\b"


@query(
    "brand_entities",
    "J-01",
    over(
        "reviews",
        f""", m AS (SELECT review_id, review_text, unnest(regexp_extract_all(review_text, '(?i){BRAND_RE}')) AS text FROM reviews)
        SELECT review_id, text, 'BRAND' AS label, 0.95 AS confidence, strpos(review_text, text) - 1 AS start,
               strpos(review_text, text) - 1 + length(text) AS "end" FROM m""",
    ),
)
def brand_entities(s, d):
    rows = ad.text_reviews(s, d).select("review_id", F.inline(en.brand_entities(_text())))
    return rows.select("review_id", "text", "label", "confidence", "start", "end")


@query(
    "feature_mentions",
    "J-02 D-07",
    over(
        "reviews",
        f""", m AS (SELECT review_id, unnest(regexp_extract_all(lower(review_text), '{FEATURE_RE}')) AS text FROM reviews)
        SELECT review_id, text, count(*) AS n FROM m GROUP BY ALL""",
    ),
)
def feature_mentions(s, d):
    rows = ad.text_reviews(s, d).select("review_id", F.inline(en.feature_entities(_text())))
    return rows.groupBy("review_id", F.lower("text").alias("text")).agg(F.count("*").alias("n"))


@query(
    "spans_match_text",
    "J-02 J-03",
    "SELECT doc_id, len(regexp_extract_all(text, '[A-Z][a-z]+')) AS spans, len(regexp_extract_all(text, '[A-Z][a-z]+')) AS in_place FROM documents",
)
def spans_match_text(s, d):
    """Every span's offsets cut exactly its text out of the document."""
    found = ad.documents(s, d).withColumn("sp", en.spans(F.col("text"), "[A-Z][a-z]+"))
    ok = F.filter("sp", lambda e: F.substr("text", e["start"] + 1, e["end"] - e["start"]) == e["text"])
    return found.select("doc_id", F.size("sp").alias("spans"), F.size(ok).alias("in_place"))


@query(
    "model_entities",
    "J-03",
    """SELECT p_partkey, array_to_string(regexp_extract_all(t, '[A-Za-z]+-[0-9]{1,4}\\b|\\b[A-Za-z]+[0-9]{1,4}[A-Za-z]?\\b'), ' | ') AS models
       FROM (SELECT p_partkey, p_name || ' S' || p_size || ' and WH-' || (p_partkey % 9000) || ' by ' || p_type AS t FROM part)""",
)
def model_entities(s, d):
    t = F.concat("p_name", F.lit(" S"), "p_size", F.lit(" and WH-"), F.col("p_partkey") % 9000, F.lit(" by "), "p_type")
    models = F.transform(en.model_entities(t), lambda e: e["text"])
    return ad.table(s, d, "part").select("p_partkey", F.array_join(models, " | ").alias("models"))


@query(
    "model_numbers",
    "J-04",
    """SELECT p_partkey, CASE WHEN p_size >= 10 THEN 'S' || p_size || ' | ' ELSE '' END || 'Pro | Gen ' || (p_size % 10) || ' | v2.' || p_size AS models
       FROM part""",
)
def model_numbers(s, d):
    t = F.concat(
        F.lit("the S"), "p_size", F.lit(" Pro beats gear Gen "), F.col("p_size") % 10, F.lit(" with v2."), "p_size", F.lit(" now")
    )
    models = F.transform(en.model_numbers(t), lambda e: e["text"])
    return ad.table(s, d, "part").select("p_partkey", F.array_join(models, " | ").alias("models"))


@query(
    "merged_layers",
    "J-05 J-10 J-12",
    over(
        "numbered",
        f""", b AS (SELECT 'BRAND' AS label, count(*) AS n FROM (SELECT unnest(regexp_extract_all(review_text, '(?i){BRAND_RE}')) FROM numbered)),
        f AS (SELECT 'FEATURE' AS label, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(review_text), '{FEATURE_RE}')) FROM numbered))
        SELECT * FROM b UNION ALL SELECT * FROM f""",
    ),
)
def merged_layers(s, d):
    kept = _with_entities(s, d).select(en.filter_entities(F.col("entities")).alias("entities"))
    return en.entity_frequencies(kept, F.col("entities"))


@query(
    "resolved_overlaps",
    "J-06",
    over(
        "reviews",
        f""", m AS (SELECT review_id, unnest(regexp_extract_all(lower(review_text), '\\b({_alt(fv.BRANDS + fv.PRODUCT_FEATURES)})\\b')) AS text FROM reviews)
        SELECT review_id, count(DISTINCT text) AS n FROM m GROUP BY 1""",
    ),
)
def resolved_overlaps(s, d):
    r = ad.text_reviews(s, d).withColumn("e", en.resolve_overlaps(F.concat(en.feature_entities(_text()), en.brand_entities(_text()))))
    sizes = F.array(F.size("e").cast("bigint"))
    return r.select("review_id", F.explode(F.filter(sizes, lambda n: n > 0)).alias("n"))


def _aspect_sql(a: str) -> str:
    tests = ", ".join(f"CASE WHEN regexp_matches(low, '\\b{k}\\b') THEN '{k}' END" for k in fv.ENTITY_ASPECTS[a])
    return f"array_to_string([x FOR x IN [{tests}] IF x IS NOT NULL], ',') AS {a}"


@query(
    "aspect_map",
    "J-07",
    over("reviews", f", t AS (SELECT review_id, lower(review_text) AS low FROM reviews) SELECT review_id, {', '.join(_aspect_sql(a) for a in fv.ENTITY_ASPECTS)} FROM t"),
)
def aspect_map(s, d):
    m = ad.text_reviews(s, d).select("review_id", en.aspect_map(_text()).alias("m"))
    return m.select(
        "review_id",
        *[F.coalesce(F.array_join(F.try_element_at("m", F.lit(a)), ","), F.lit("")).alias(a) for a in fv.ENTITY_ASPECTS],
    )


@query(
    "entity_columns",
    "J-08",
    over(
        "reviews",
        f"""SELECT review_id, array_to_string(regexp_extract_all(review_text, '(?i){BRAND_RE}'), ' | ') AS brands,
                   len(regexp_extract_all(review_text, '(?i){BRAND_RE}')) AS brand_count,
                   len(regexp_extract_all(review_text, '(?i){BRAND_RE}')) > 0 AS has_brand,
                   coalesce(regexp_extract_all(review_text, '(?i){BRAND_RE}')[1], '') AS top_brand,
                   len(regexp_extract_all(review_text, '(?i){BRAND_RE}')) + len(regexp_extract_all(lower(review_text), '{FEATURE_RE}'))
                     AS entity_count FROM reviews""",
    ),
)
def entity_columns(s, d):
    r = ad.text_reviews(s, d).select("review_id", en.extract_entities(_text()).alias("entities"), en.aspect_map(_text()).alias("a"))
    return en.entity_columns(r, "entities", "a").select(
        "review_id", "brands", "brand_count", "has_brand", "top_brand", "entity_count"
    )


@query(
    "brand_pairs",
    "J-09",
    over(
        "reviews",
        """, p AS (SELECT review_id, unnest(['Bose', 'Sony']) AS b FROM reviews WHERE contains(review_text, 'Sony')
                   UNION ALL SELECT review_id, 'Anker' FROM reviews WHERE verified)
        SELECT x.b AS brand_1, y.b AS brand_2, count(*) AS co_mentions FROM p x JOIN p y ON x.review_id = y.review_id AND x.b < y.b
        GROUP BY 1, 2 ORDER BY co_mentions DESC, brand_1, brand_2 LIMIT 10""",
    ),
)
def brand_pairs(s, d):
    found = F.transform(en.brand_entities(_text()), lambda e: e["text"])
    listed = F.concat(found, F.when(F.col("verified"), F.array(F.lit("Anker"))).otherwise(F.array().cast("array<string>")))
    return en.brand_pairs(ad.text_reviews(s, d), listed, 10)


@query(
    "brand_frequencies",
    "J-10",
    over(
        "reviews",
        f""", b AS (SELECT DISTINCT review_id, unnest(regexp_extract_all(review_text, '(?i){BRAND_RE}')) AS b FROM reviews)
        SELECT b AS brand, count(*) AS n FROM b GROUP BY 1 ORDER BY n DESC, brand LIMIT 15""",
    ),
)
def brand_frequencies(s, d):
    return en.brand_frequencies(ad.text_reviews(s, d), F.transform(en.brand_entities(_text()), lambda e: e["text"]))


@query(
    "aspect_frequencies",
    "J-10 J-07",
    over(
        "reviews",
        ", t AS (SELECT lower(review_text) AS low FROM reviews), c AS ("
        + " UNION ALL ".join(
            f"SELECT '{a}' AS aspect, count(*) FILTER (WHERE regexp_matches(low, '\\b({'|'.join(k)})\\b')) AS n FROM t"
            for a, k in fv.ENTITY_ASPECTS.items()
        )
        + ") SELECT * FROM c WHERE n > 0",
    ),
)
def aspect_frequencies(s, d):
    return en.aspect_frequencies(ad.text_reviews(s, d), en.aspect_map(_text()))


@query(
    "dictionary_brand_mentions",
    "J-01 E-39",
    """WITH t AS (SELECT p_partkey, unnest(string_split(lower(p_name || ' ' || p_brand || ' or ' || p_brand), ' ')) AS t FROM part),
       b AS (SELECT DISTINCT p_brand AS brand FROM part)
       SELECT p_partkey, brand, count(*) AS mentions FROM t JOIN b ON t.t = lower(b.brand) GROUP BY 1, 2""",
)
def dictionary_brand_mentions(s, d):
    part = ad.table(s, d, "part")
    texts = part.select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", F.lit("or"), "p_brand").alias("t"))
    return en.brand_mentions(texts, "p_partkey", "t", part.select(F.col("p_brand").alias("brand")))


@query(
    "mapped_entity_labels",
    "J-11",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'BRAND' WHEN 'view' THEN 'GPE' ELSE event_type END AS label FROM events""",
)
def mapped_entity_labels(s, d):
    generic = F.when(F.col("event_type") == "click", "ORG").when(F.col("event_type") == "view", "LOC").otherwise(F.col("event_type"))
    return ad.table(s, d, "events").select("event_id", en.map_entity_label(generic).alias("label"))


@query(
    "densities",
    "J-13 F-29",
    over(
        "reviews",
        f""", t AS (SELECT review_id, greatest(len({words('review_text')}), 1) AS n,
                 len(regexp_extract_all(review_text, '(?i){BRAND_RE}')) + len(regexp_extract_all(lower(review_text), '{FEATURE_RE}')) AS e,
                 len(regexp_extract_all(lower(review_text), '{FEATURE_RE}')) AS a FROM reviews)
        SELECT review_id, round(e / n, 6) AS entity_density, round(a / n, 6) AS aspect_density FROM t""",
    ),
)
def densities(s, d):
    entities = F.col("entities")
    r = ad.text_reviews(s, d).withColumn("entities", en.extract_entities(_text()))
    cols = en.densities(_text(), entities, sentiment.aspects_from_entities(entities))
    return r.select("review_id", *[c.alias(n) for n, c in cols.items()])
