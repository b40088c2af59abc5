"""Small plain versions that the operators are held against, and a table with awkward rows."""

import hashlib
import zlib

import numpy as np

AWKWARD = [
    (1, "", "x", "s", 0), (2, None, "x", "s", 0), (3, " ", None, None, None), (4, "a  b   c ", "x", "s", 1), (5, "ab\tc\nd\r\n\x0b\x0c e\x1c f\x85g", "x", "s", 1),
    (6, "▁x ▁ y<|endoftext|> Ünḯcödé 日本語 🙂\x00", "x", "s", 1), (7, "the quick brown fox " * 4000, "x", "s", 1), (8, "same text here", "x", "s", 1),
    (9, "same text here", "x", "s", 1), (10, "x" * 30000, "x", "s", 1), (11, "\n\n\n", "x", "s", 1), (12, "Word", "x", "s", 1), (None, "no id here", "x", "s", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark):
    """Null, empty, very long, tied and repeated rows, with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(AWKWARD, SCHEMA)
    extra = {c: F.lit(7) for c in ("start", "length", "piece", "row_", "id_", "ids", "count", "group_", "score", "kept", "h", "n", "words")}
    return df.withColumns(extra)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def best_component(n, links):
    """Smallest index reachable from each of n."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
