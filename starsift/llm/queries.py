"""Driver queries of the training-data operators, on whole tables, and the SQL of those that SQL can express."""

from pyspark.sql import DataFrame, SparkSession

from starsift.llm.shared import documents

TOKENIZERS = "/opt/tokenizers"
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starsift.llm.pieces import encode_decode

    out = encode_decode(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"), keep=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starsift.llm.packing import pack_documents

    return pack_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op7_token_file")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starsift.llm.shared import folder
    from starsift.llm.simple8b import read_ids, write_ids

    place = folder(spark, "token-file")
    write_ids(documents(spark, sf_dir), place, vocabulary("word_bpe_49k.json"), end_id=2)
    return read_ids(spark, place, keep=False).select("doc_id", "start", "n_tokens", "ids_crc32")


OP8_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), q AS (SELECT vec_id AS query_id, v AS w FROM v WHERE vec_id % 20 = 0
), s AS (
  SELECT query_id, vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(v, w)]) AS BIGINT) AS score
  FROM q JOIN v ON vec_id <> query_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
"""


@query("op8_exact_top_k", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from starsift.llm.topk import exact_top_k, quantised

    rows = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return exact_top_k(rows.filter(F.col("id") % 20 == 0), rows, 20)


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)
), l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e
), r AS (SELECT DISTINCT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y
), c AS (SELECT x, min(y) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN c ON c.x = doc_id
"""


@query("op9_near_duplicates", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starsift.llm.minhash import near_duplicates

    return near_duplicates(documents(spark, sf_dir), width=2).drop("key")


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starsift.llm.quality import quality_rules

    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")
    return quality_rules(documents(spark, sf_dir), trusted)


OP5_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), v AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM d
), k AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS k FROM v
), t AS (SELECT doc_id, i FROM k WHERE k IN (SELECT k FROM k GROUP BY 1 HAVING count(*) > 1)
), g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
    SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM t)
), r AS (SELECT doc_id, min(i) AS s, max(i) + 200 AS e FROM g GROUP BY doc_id, run
), b AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM r
), o AS (SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n_removed, max(e) AS last, string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS kept
  FROM b JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN o USING (doc_id)
"""


@query("op5_repeats", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starsift.llm.repeats import drop_repeats

    return drop_repeats(documents(spark, sf_dir), keep=False)


@query("op3_lines")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from starsift.llm.lines import dedup_lines

    kept = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op4_lm_scores")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starsift.llm.lm import cross_entropy_difference

    target = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")
    return cross_entropy_difference(documents(spark, sf_dir), target)


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from starsift.llm.toxicity import toxicity

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out).select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity(documents(spark, sf_dir), labels)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "vote", "evidence")


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


OP13_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), h AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:n], ''), '') AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


@query("op13_fill_in_middle", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starsift.llm.infill import fill_in_middle

    return fill_in_middle(documents(spark, sf_dir), keep=False)


OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)
), l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e
), r AS (SELECT DISTINCT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y
), c AS (SELECT x, min(y) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM documents LEFT JOIN n USING (doc_id) JOIN c ON c.x = doc_id
"""


@query("op11_ngram_jaccard", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starsift.llm.jaccard import jaccard_components

    return jaccard_components(documents(spark, sf_dir))


def _op12_sql() -> str:
    """The repair as a recursive walk from each conversation's end; costs stand before audits as eight digits, so least() picks both."""

    def add(value: str, cost: str, edit: str) -> str:
        return f"printf('%08d', CAST({value}[1:8] AS INTEGER) + {cost}) || '{edit}' || {value}[9:]"

    after = {0: 2, 1: 2, 2: 3, 3: 2}  # state once the wanted role stands: nothing, s, u, a

    def row(q: int) -> str:
        keep = {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}[q]
        kept = ", ".join(f"CASE WHEN lower(x) = '{r}' THEN {add(f'v{to}', 't', 'K')} END" for r, to in keep)
        return f"least({add(f'v{q}', '2', 'D')}, CASE WHEN x <> '-' THEN {add(f'v{after[q]}', '1 + t', 'R')} END, {kept}) AS v{q}"

    def insert(inner: str) -> str:
        return f"SELECT conv_id, sig, n, {', '.join(f'least(v{q}, ' + add(f'v{after[q]}', '5', 'I') + f') AS v{q}' for q in range(4))} FROM ({inner})"

    walk = f"SELECT conv_id, sig, n - 1 AS n, {', '.join(map(row, range(4)))} FROM (SELECT *, sig[n] AS x, CASE WHEN sig[n] BETWEEN 'A' AND 'Z' THEN 5 ELSE 0 END AS t FROM w WHERE n > 0)"
    return f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    [unicode(x) FOR x IN string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')] AS b FROM conversations
), h AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, b), lambda x, y: list_reduce(list_prepend(xor(x, y), range(8)), lambda p, i: xor(p >> 1, 3988292384 * (p & 1)))), 4294967295) % 20 AS hit FROM c
), d AS (
  SELECT conv_id, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role, CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE hit WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE hit <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text), copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM d
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault,
    CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS r, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM o
), s AS (
  SELECT conv_id, string_agg(CASE fault WHEN '' THEN r WHEN 'truncated' THEN upper(r) ELSE '-' END, '' ORDER BY i) AS sig, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id
), w AS (
  SELECT conv_id, sig, length(sig) AS n, '00000000' AS v0, '00000010II' AS v1, '00000005I' AS v2, '00000000' AS v3 FROM s
  UNION ALL {insert(insert(walk))}
), a AS (SELECT conv_id, CAST(v0[1:8] AS BIGINT) AS cost, v0[9:] AS audit FROM w WHERE n = 0
), e AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM a
), g AS (
  SELECT e.conv_id, j, audit[j] AS edit, length(replace(audit[1:j], 'D', '')) AS place, o.role, o.text
  FROM e LEFT JOIN o ON o.conv_id IS NOT DISTINCT FROM e.conv_id AND audit[j] <> 'I' AND o.i = length(replace(audit[1:j], 'I', ''))
), l AS (SELECT *, max(CASE WHEN place = 1 AND edit = 'K' AND role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS lead FROM g
), p AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY j)) AS sha
  FROM l WHERE edit <> 'D' GROUP BY conv_id
)
SELECT q.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM q.conv_id
"""


@query("op12_conversation_repair", _op12_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starsift.llm.turns import damaged, repair

    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(damaged(rows), every=rows, keep=False)
