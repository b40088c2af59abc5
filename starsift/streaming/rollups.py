"""Incremental rollups, deduplication and alerts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starsift import fixed_values as fv
from starsift.functions import labels
from starsift.functions import text as tx
from starsift.operators import rollups


def stream_monthly(reviews: DataFrame) -> DataFrame:
    """Running monthly sentiment; its state is one row per month and product."""
    return rollups.monthly_sentiment(reviews)


def stream_dedupe(reviews: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark delay; state expires after it.

    The state holds a key's 32-byte digest, however long its texts are. Null and empty values differ.
    """
    digest = F.unhex(F.sha2(F.to_json(F.struct(*keys)), 256))
    return reviews.withColumn("_digest", digest).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def stream_defects(
    reviews: DataFrame, ts: str, delay: str, window: str = "30 days", text: str = "review_text", warn: float = 5.0, crit: float = 10.0
) -> DataFrame:
    """Defect rate and alert per product and tumbling window; later rows than the delay are dropped."""
    hit = tx.contains_any(F.lower(F.col(text)), fv.DEFECT_KEYWORDS)
    per = (
        reviews.withWatermark(ts, delay)
        .groupBy(F.window(ts, window), "product_id")
        .agg(F.count(F.lit(1)).alias("total_reviews"), F.count_if(hit).alias("defect_mentions"))
    )
    rate = F.col("defect_mentions") * 100.0 / F.col("total_reviews")
    return per.select(
        F.col("window.start").alias("window_start"),
        "product_id",
        "total_reviews",
        "defect_mentions",
        rate.alias("defect_rate_pct"),
        labels.alert_level(rate, warn, crit).alias("alert"),
    )


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str) -> StreamingQuery:
    """Drain the source into ``out``. Append mode keeps one folder per batch; complete mode
    keeps the latest state under ``state``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{out}/state" if mode == "complete" else f"{out}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(target)

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
