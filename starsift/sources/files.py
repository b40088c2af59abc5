"""Reading and writing review files and stored tables."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsift import schemas

CORRUPT = "_corrupt_record"


def read_reviews_csv(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    """Review CSV with quoted multi-line text; only the wanted columns are parsed."""
    df = spark.read.csv(path, schema=schemas.RAW_REVIEW, header=True, multiLine=True, escape='"')
    return df.select(*cols) if cols else df


def read_upload(spark: SparkSession, path: str, schema: str = schemas.RAW_REVIEW) -> DataFrame:
    """Permissive CSV read that keeps malformed lines in a corrupt-record column."""
    full = T.StructType.fromDDL(schema).add(CORRUPT, T.StringType())
    return spark.read.csv(
        path, schema=full, header=True, multiLine=True, escape='"', mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
    )


def validate(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and quarantined rows (malformed, or a required column is null)."""
    bad = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in required))
    if CORRUPT in df.columns:
        bad = bad | F.col(CORRUPT).isNotNull()
    good = df.filter(~bad)
    return (good.drop(CORRUPT) if CORRUPT in df.columns else good), df.filter(bad)


def save_reviews(df: DataFrame, path: str) -> None:
    """CSV and Parquet copies; Parquet is laid out by month when there is one."""
    df.write.mode("overwrite").option("escape", '"').csv(f"{path}/csv", header=True)
    writer = df.write.mode("overwrite")
    (writer.partitionBy("month") if "month" in df.columns else writer).parquet(f"{path}/parquet")


def spread(df: DataFrame, key: str, partitions: int | None) -> DataFrame:
    """Hash the rows over ``partitions`` tasks; None leaves the scan as it is.

    A table stored as one row group is one task however it is split. The caller
    knows its files and says so; nothing here looks at the table's size.
    """
    return df if partitions is None else df.repartition(partitions, key)


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def load_summaries(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four summary tables; a missing one is an empty frame of its schema."""
    return {
        name: spark.read.schema(schemas.TABLES[name]).parquet(f"{folder}/{name}")
        if exists(spark, f"{folder}/{name}")
        else schemas.empty(spark, name)
        for name in schemas.SUMMARIES
    }


def create_tables(spark: SparkSession, database: str) -> None:
    """Create every stored table that does not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, ddl in schemas.TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl}) USING parquet")


def rebuild(df: DataFrame, path: str) -> None:
    """Replace a table: compute into a staging folder first, then overwrite from it.

    A failure while computing leaves the old table untouched, and the input may
    itself read the table being replaced.
    """
    staging = f"{path.rstrip('/')}__staging"
    df.write.mode("overwrite").parquet(staging)
    df.sparkSession.read.schema(df.schema).parquet(staging).write.mode("overwrite").parquet(path)
