"""Resumable ingest of review files."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starsift import schemas


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 100, **options) -> DataFrame:
    return (
        spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).options(**options).load(path)
    )


def csv_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return file_stream(
        spark, path, schemas.RAW_REVIEW, "csv", files_per_trigger, header=True, multiLine=True, escape='"'
    )


def ingest_available(
    stream: DataFrame, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Process every file not seen yet, then stop.

    Offsets live in the checkpoint, and each batch replaces its own ``batch=<id>``
    folder, so a batch repeated after a failure leaves one copy of its rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
