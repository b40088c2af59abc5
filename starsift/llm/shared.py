"""Helpers that every operator here uses: shared storage, Arrow batches and word hashes."""

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from starsift.sources.durable import checkpoint_folder

#: Texts are worked on in runs of about this many characters, so that a batch of long texts stays small.
RUN_CHARS = 2_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def folder(spark: SparkSession, name: str) -> str:
    """A new place in the folder named by ``spark.checkpoint.dir``, which the driver and all executors share."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the folder named by ``spark.checkpoint.dir`` and read it back.

    Every later use reads the files, so work is done once and a lost executor costs only its running tasks.
    """
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_batch(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on each Arrow batch of each partition."""

    def run(batches):
        for batch in batches:
            yield from work(batch)

    return df.mapInArrow(run, schema)


def runs(texts: list, chars: int = RUN_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive [start, end) runs of about ``chars`` characters; a longer text is a run of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


U = np.uint64
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS[:] = [np.cumprod(np.r_[U(1), np.full(size, b, U)]) for b in (_BASE, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of every word (run without bytes 0x20 and 0x09-0x0D) of ``data``."""
    b = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(b) + 2, bool)
    inside[1:-1] = (b != 32) & ((b < 9) | (b > 13))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    power, inverse = _powers(len(b) + 1)
    total = np.zeros(len(b) + 1, U)
    np.cumsum((b.astype(U) + U(1)) * power[: len(b)], out=total[1:])
    return starts, ends, mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U))
