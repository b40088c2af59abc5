"""Tables made of parts, switched together by a log of commits.

``folder/data/`` holds the rows of each part of each table in a place of its own that is never written again, ``folder/log`` one
row per table and part that a commit sets (or removes: no place). All rows of a commit are one file, written last, so a
commit is either whole or not there: what fails on the way leaves the version before it in use, and a reader that began
with one version goes on with it. A commit costs what it changes, whatever is stored already. Commits of one version by
two writers are both kept; where they set the same part, the greater place counts.
"""

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "version long, table string, part string, place string, schema string"


def log(spark: SparkSession, folder: str) -> DataFrame:
    """Every change committed so far, without rows if there is none."""
    try:
        return spark.read.schema(LOG).parquet(f"{folder}/log")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def latest(spark: SparkSession, folder: str) -> int:
    """Number of the newest version; 0 before the first."""
    return log(spark, folder).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def current(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """table, part, place, schema, version (that set it) of every part that a version has."""
    rows = log(spark, folder)
    if version is not None:
        rows = rows.filter(F.col("version") <= version)
    newest = F.max_by(F.struct("place", "schema", "version"), F.struct("version", "place"))
    return rows.groupBy("table", "part").agg(newest.alias("n")).select("table", "part", "n.*").filter("place IS NOT NULL")


def commit(spark: SparkSession, folder: str, part: str, tables: dict[str, DataFrame], only: bool = False) -> int:
    """Store the rows of ``part`` in each table and commit them as the next version, whose number is returned.

    A part that is there already is replaced, so a repeated batch leaves one copy. ``only`` removes every other part of
    these tables in the same commit, which rebuilds them; the rows may come from the tables that they replace.
    """
    rows = []
    for name, df in tables.items():
        place = f"{folder}/data/{name}-{uuid.uuid4().hex}"
        df.write.parquet(place)
        rows.append((name, part, place, df.schema.json()))
    changes = spark.createDataFrame(rows, "table string, part string, place string, schema string")
    if only:
        others = current(spark, folder).filter(F.col("table").isin(list(tables)) & (F.col("part") != part)).select("table", "part")
        changes = changes.unionByName(others, allowMissingColumns=True)
    return _append(spark, folder, changes)


def remove(spark: SparkSession, folder: str, part: str) -> int:
    """Take ``part`` out of every table."""
    gone = current(spark, folder).filter(F.col("part") == part).select("table", "part")
    return _append(spark, folder, gone.withColumns({"place": F.lit(None).cast("string"), "schema": F.lit(None).cast("string")}))


def _append(spark: SparkSession, folder: str, changes: DataFrame) -> int:
    version = latest(spark, folder) + 1
    changes.select(F.lit(version).cast("long").alias("version"), "table", "part", "place", "schema").coalesce(1).write.mode("append").parquet(f"{folder}/log")
    return version


def read(spark: SparkSession, folder: str, table: str, version: int | None = None) -> DataFrame:
    """All rows of a table, its parts together; ``LookupError`` if the version has no such table.

    Parts must agree in their columns. The driver sees the places, as it does the files of any scan.
    """
    found = current(spark, folder, version).filter(F.col("table") == table).orderBy("part").collect()
    if not found:
        raise LookupError(f"no table {table} in {folder}" + (f" at version {version}" if version is not None else ""))
    newest = max(found, key=lambda r: r.version)
    return spark.read.schema(T.StructType.fromJson(json.loads(newest.schema))).parquet(*[r.place for r in found])


def unused(spark: SparkSession, folder: str, since: int) -> DataFrame:
    """Places that no version from ``since`` on reads; what to delete and when is the caller's choice."""
    rows = log(spark, folder).filter("place IS NOT NULL").select("place", "version")
    kept = current(spark, folder, since).select("place").unionByName(rows.filter(F.col("version") > since).select("place"))
    return rows.join(kept, "place", "left_anti").select("place", "version")
