"""Training-data pipeline: quality rules, line dedup, near-duplicate removal, repeated strings, packing.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``, in the columns of ``documents``; the last
returns packed pieces. ``n_chars`` follows the text. SQL cannot express the SimHash, suffix and tokenizer stages, so there
is no oracle; tests hold every stage against a plain version on its own input.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.llm.lines import dedup_lines
from starsift.llm.minhash import drop_near_duplicates
from starsift.llm.packing import pack_documents
from starsift.llm.quality import keep_good
from starsift.llm.queries import vocabulary
from starsift.llm.repeats import drop_repeats
from starsift.llm.shared import documents, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")
    return keep_good(docs.select(COLUMNS), trusted)


def _with_text(docs: DataFrame) -> DataFrame:
    """Documents of which text is left, with its length."""
    return docs.filter(F.col("text").rlike("[^\\x20\\x09-\\x0D]")).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document without any other line goes with them."""
    return _with_text(dedup_lines(docs.select(COLUMNS)))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity of 0.8 or more) the smallest id stays."""
    return drop_near_duplicates(docs.select(COLUMNS))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes and more that stand in several places go; a document without other text goes with them."""
    return _with_text(drop_repeats(docs.select(COLUMNS)).select("doc_id", F.col("kept_text").alias("text"), "row.lang", "row.source"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2,048 ids."""
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near), ("repeat_removal", repeats), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
