"""Quality rules: base counts, then a hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words and word pairs hash into ``buckets``. A multinomial over buckets is counted from all trusted documents and one from
all documents. A document's score is the mean, over its n-grams, of ln p_target - ln p_raw; it is kept if no base rule
fails and the score reaches ``threshold``. Everything is DataFrame functions. The driver sees ``buckets`` weights, a
number that no input changes, and puts them into the plan as one constant.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
#: Added to every bucket's count.
PRIOR = 1.0
#: Nats per n-gram; documents under it are rejected.
THRESHOLD = -0.05
SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _zip(column: str, step: int) -> Column:
    """Hash of each entry with the one ``step`` places on."""
    n = F.greatest(F.size(column) - step, F.lit(0))
    return F.zip_with(F.slice(column, 1, n), F.slice(column, step + 1, n), lambda a, b: F.xxhash64(a, b))


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds words_, h1_, h2_ (word and word-pair hashes) and the base counts to ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = docs.withColumns({"words_": words_of(text), "lines_": lines, "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")})
    df = df.withColumns({
        "h1_": F.transform("words_", lambda w: F.xxhash64(w)),
        "n_words": F.size("words_").cast("long"),
        "word_chars": F.length(F.array_join("words_", "")).cast("long"),
        "n_dup_lines": (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long"),
    }).drop("words_", "lines_")
    df = df.withColumn("h2_", _zip("h1_", 1))
    df = df.withColumn("h4_", _zip("h2_", 2)).withColumn("h8_", _zip("h4_", 4))
    return df.withColumn("n_repeat_words", _repeat_words("h8_")).drop("h4_", "h8_")


def _repeat_words(hashes: str) -> Column:
    """Words in windows found twice or more: sorted by hash, equal neighbours give the starts; sorted again, their union."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.zip_with(placed, F.slice(placed, 2, F.size(hashes)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    starts = F.array_sort(F.array_distinct(F.flatten(F.array_compact(twice))))
    union = F.aggregate(
        starts, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda s, x: F.struct(x.alias("last"), (s["n"] + F.least(x - s["last"], F.lit(WINDOW))).alias("n")), lambda s: s["n"],
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(union).cast("long")


def weights(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS, prior: float = PRIOR) -> DataFrame:
    """One row ``w``: ln p_target - ln p_raw of every bucket, over all documents."""
    mark = trusted.select(F.col(id_col)).dropDuplicates().withColumn("trusted_", F.lit(1))
    df = docs.select(id_col, text_col).join(mark.hint("merge"), id_col, "left")  # trusted ids have no bound, so none are broadcast
    df = df.select("trusted_", words_of(F.coalesce(F.col(text_col), F.lit(""))).alias("words_"))
    df = df.select("trusted_", F.transform("words_", lambda w: F.xxhash64(w)).alias("h1_"))
    df = df.select("trusted_", F.explode(F.concat("h1_", _zip("h1_", 1))).alias("h"))
    count = df.groupBy(F.pmod("h", F.lit(buckets)).alias("id")).agg(F.count("trusted_").alias("t"), F.count("*").alias("r"))
    every = docs.sparkSession.range(buckets).join(count, "id", "left").select("id", *(F.coalesce(c, F.lit(0)).alias(c) for c in "tr"))
    rows = every.agg(F.sort_array(F.collect_list(F.struct("id", "t", "r"))).alias("rows"), F.sum("t").alias("all_t"), F.sum("r").alias("all_r"))
    share = lambda c, n: F.log((c + prior) / (n + prior * buckets))
    return rows.select(F.transform("rows", lambda x: share(x["t"], F.col("all_t")) - share(x["r"], F.col("all_r"))).alias("w"))


def judged(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, prior: float = PRIOR, threshold: float = THRESHOLD) -> DataFrame:
    """row (the input row as a struct), base counts, base_failed, kept and score of every row."""
    values = weights(docs, trusted, id_col, text_col, buckets, prior).first()["w"]
    table = F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")  # folded into one constant
    df = base_counts(docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(text_col).alias("text_")), "text_")
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, h: s + F.get(table, F.pmod(h, F.lit(buckets)).cast("int")))
    score = (total("h1_") + total("h2_")) / F.greatest(F.size("h1_") + F.size("h2_"), F.lit(1))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    df = df.withColumn("score", score).withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.col("score") >= threshold)
    return df.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "score")


def quality_rules(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, prior: float = PRIOR, threshold: float = THRESHOLD) -> DataFrame:
    """id_col, base counts, base_failed, score and kept for every row; ``trusted`` has the ids of the target's documents.

    A null or empty text has no words and fails. Repeated rows are judged one by one; a null id is never trusted; other
    columns are not read. With no trusted document all scores are near 0, and an empty table gives no rows.
    """
    out = judged(docs.select(id_col, text_col), trusted, id_col, text_col, buckets, prior, threshold)
    return out.select(F.col(f"row.{id_col}").alias(id_col), *out.columns[1:])


def keep_good(docs: DataFrame, trusted: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    once = F.array(F.struct("row", "kept"))  # rows that come out of an array: no filter is pushed into the rules, which would repeat them
    return judged(docs, trusted, **settings).select(F.inline(once)).filter("kept").select("row.*")
