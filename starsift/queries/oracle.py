"""DuckDB forms of the adapter views, used as CTE prefixes of the oracle SQL."""

from starsift import fixed_values as fv
from starsift.sources import adapters as ad


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


_TEXT = (
    f"concat(({sql_list(ad.OPEN)})[1 + o_orderkey % 6], ' ', ({sql_list(ad.BODY)})[1 + o_custkey % 8], ' ', "
    f"({sql_list(ad.CLOSE)})[1 + (o_orderkey + o_custkey) % 5])"
)
_PRODUCT = "concat('P', lpad(cast(o_custkey % 40 AS varchar), 3, '0'))"

REVIEWS = f"""reviews AS (
  SELECT o_orderkey AS review_id, {_PRODUCT} AS product_id, concat('U', cast(o_custkey AS varchar)) AS user_id,
         cast(1 + (o_orderkey * 7 + o_custkey) % 5 AS int) AS star_rating,
         cast(least(o_orderkey % 9, o_custkey % 9) AS int) AS helpfulness_numerator,
         cast(o_orderkey % 9 AS int) AS helpfulness_denominator,
         cast(least(o_orderkey % 9, o_custkey % 9) AS int) AS helpful_votes,
         o_orderdate AS review_time, strftime(o_orderdate, '%Y-%m') AS month,
         o_orderstatus <> 'P' AS verified, cast(o_orderkey % 6 AS int) AS topic_id,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE (o_orderkey % 100) / 100.0 END AS predicted_helpfulness,
         ((o_orderkey * 37 + o_custkey) % 201 - 100) / cast(100 AS double) AS compound,
         {_TEXT} AS review_text
  FROM orders)"""

NUMBERED = """numbered AS (
  SELECT * REPLACE (concat(review_text, CASE WHEN review_id % 3 <> 0 THEN concat(' #', review_id) ELSE '' END) AS review_text)
  FROM reviews)"""

ASPECTS = f"""aspects AS (
  SELECT l_orderkey AS review_id, ({sql_list(ad.ASPECT_TERMS)})[l_linenumber] AS aspect_term,
         CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'N' THEN 'neutral' ELSE 'negative' END AS sentiment_label,
         cast(0.5 AS double) + abs(l_discount) * 4 AS confidence
  FROM lineitem)"""

TOPICS = "topics AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{n}')" for i, n in enumerate(ad.TOPIC_NAMES)
) + ") AS t(topic_id, name))"

RAW = f"""raw AS (
  SELECT o_orderkey AS "Id", {_PRODUCT} AS "ProductId", concat('U', cast(o_custkey AS varchar)) AS "UserId",
         CASE WHEN o_orderkey % 7 <> 0 THEN concat('Customer ', o_custkey) END AS "ProfileName",
         cast(least(o_orderkey % 9, o_custkey % 9) AS int) AS "HelpfulnessNumerator",
         cast(o_orderkey % 9 AS int) AS "HelpfulnessDenominator",
         CASE WHEN o_orderkey % 17 <> 3 THEN cast(1 + (o_orderkey * 7 + o_custkey) % 5 AS int) END AS "Score",
         cast(epoch(o_orderdate) AS bigint) AS "Time",
         CASE WHEN o_orderkey % 11 <> 0 THEN rtrim(({sql_list(ad.OPEN)})[1 + o_orderkey % 6], '.') END AS "Summary",
         CASE WHEN o_orderkey % 13 = 5 THEN NULL WHEN o_custkey % 25 = 1 THEN '{ad.NON_LATIN}'
              ELSE concat(({sql_list(ad.BODY)})[1 + o_custkey % 8],
                          CASE WHEN o_custkey % 10 = 0 THEN ' <b>Love</b> it \U0001f600 café  ' ELSE ' ' END,
                          ({sql_list(ad.CLOSE)})[1 + (o_orderkey + o_custkey) % 5]) END AS "Text"
  FROM orders)"""

SCRAPED = f"""scraped AS (
  SELECT o_orderkey AS row_id, {_PRODUCT} AS product_id, concat('Product ', cast(o_custkey % 40 AS varchar)) AS product_name,
         concat('U', cast(o_custkey AS varchar)) AS reviewer_name,
         CASE WHEN o_orderkey % 19 = 4 THEN 'n/a'
              ELSE concat(cast(1 + (o_orderkey * 7 + o_custkey) % 5 AS varchar), '.0') END AS star_rating,
         concat(' ', ({sql_list(ad.OPEN)})[1 + o_orderkey % 6], '  ') AS review_title,
         concat('  ', ({sql_list(ad.BODY)})[1 + o_custkey % 8], ' ' || chr(10) || ' ',
                ({sql_list(ad.CLOSE)})[1 + (o_orderkey + o_custkey) % 5]) AS review_text,
         CASE WHEN o_orderkey % 23 = 6 THEN 'unknown'
              ELSE concat('Reviewed in India on ', strftime(o_orderdate, '%-d %B %Y')) END AS review_date,
         o_orderdate AS order_ts, o_orderstatus <> 'P' AS verified,
         CASE o_orderkey % 4 WHEN 0 THEN '1,047 people found this helpful'
              WHEN 1 THEN concat(cast(o_custkey % 30 AS varchar), ' people found this helpful')
              WHEN 2 THEN 'One person found this helpful' ELSE '' END AS votes_label,
         concat('Rated ', cast((o_orderkey * 7 + o_custkey) % 7 AS varchar), '.5 out of 5 stars') AS stars_label,
         cast(o_custkey % 30 AS varchar) AS helpful_votes,
         CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'http://img/a._SY88.jpg'
              ELSE 'http://img/a._SY88.jpg|http://img/b.jpg' END AS image_urls,
         'http://shop/page' AS source_url
  FROM orders)"""

SCORES = """scores AS (
  SELECT doc_id, quality AS label, (n_chars % 100) / cast(100 AS double) AS score,
         cast((n_chars % 100) / cast(100 AS double) >= 0.5 AS int) AS prediction, lang, text
  FROM labels JOIN documents USING (doc_id))"""

VIEWS = {
    "reviews": REVIEWS,
    "numbered": REVIEWS + ",\n" + NUMBERED,
    "aspects": ASPECTS,
    "topics": TOPICS,
    "raw": RAW,
    "scraped": SCRAPED,
    "scores": SCORES,
}


def over(views: str, body: str) -> str:
    """``WITH <views>`` followed by further CTEs (leading comma) or the final SELECT."""
    return "WITH " + ",\n".join(VIEWS[v] for v in views.split()) + "\n" + body.strip()


# --- shared expression builders -------------------------------------------------

SP = f"[{fv.SPACE}]".replace("\\x85", "\\x{85}")
NSP = f"[^{fv.SPACE}]".replace("\\x85", "\\x{85}")
WD = fv.WORD


def words(x: str) -> str:
    return f"regexp_extract_all(coalesce({x}, ''), '{NSP}+')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SP}+', ' ', 'g'))"


def any_of(x: str, keywords) -> str:
    """Substring test written as an OR of contains()."""
    return "(" + " OR ".join(f"contains({x}, '{k}')" for k in keywords) + ")"


def any_word(x: str, keywords) -> str:
    return f"regexp_matches({x}, '\\b({'|'.join(keywords)})\\b')"


def clean(x: str) -> str:
    untagged = f"regexp_replace(coalesce({x}, ''), '<[^>]*>', ' ', 'g')"
    unlinked = f"regexp_replace({untagged}, 'https?://{NSP}+|www\\.{NSP}+', ' ', 'g')"
    symbols = f"regexp_replace({unlinked}, '[^\\x00-\\x7F\\x{{00C0}}-\\x{{017F}}]', '', 'g')"
    return collapse(symbols)
