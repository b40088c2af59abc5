"""Quoted CSV whose records span lines, read by many tasks a file.

The multi-line reader needs one task a file, since a line break says nothing about where a record starts. Here a file is cut
into splits after line breaks. There a reader is in one of two states: at the start of a record, or inside quotes. A first
pass finds what each split does to either state, windows over these small rows give the state in which every split starts,
and a second pass hands out the records that start in a split. Spark's own parser then reads each record, so values, types,
pruned columns and the bad-record column are those of its CSV reader.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a split; a task holds one.
SPLIT_BYTES = 64 << 20
#: Bytes read at a time in search of a line break or of the end of a record.
STEP_BYTES = 1 << 20
#: Bytes of records in an Arrow batch.
BATCH_BYTES = 8 << 20
#: The rest of a quoted field up to its closing quote (doubled quotes are content) or to the end of the data.
REST = rb'(?:[^"]++|"")*+(?:"|(?P<open>\Z))'
INSIDE = re.compile(REST)
#: A quoted field, which starts where a field does, or a line break outside quotes.
TOKEN = re.compile(rb'(?<![^,\n])"' + REST + rb"|\n")


def _open(path: str):
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def _aligned(file, cut: int, size: int) -> int:
    """First place at or after ``cut`` that follows a line break; 0 and the end stay."""
    if cut <= 0 or cut >= size:
        return max(0, min(cut, size))
    at = cut - 1
    while at < size:
        found = file.read_at(min(STEP_BYTES, size - at), at).find(b"\n")
        if found >= 0:
            return at + found + 1
        at += STEP_BYTES
    return size


def _split(file, size: int, start: int, end: int) -> tuple[bytes, int]:
    """The bytes of a split between its aligned ends, and the place where they end."""
    start, end = _aligned(file, start, size), _aligned(file, end, size)
    return (file.read_at(end - start, start) if end > start else b""), end


def ends_inside(data: bytes, inside: bool) -> bool:
    """Whether ``data`` leaves a reader inside quotes that began inside them, or at a record's start."""
    at = 0
    if inside:
        rest = INSIDE.match(data)
        if rest["open"] is not None:
            return True
        at = rest.end()
    last = None
    for last in TOKEN.finditer(data, at):
        pass
    return last is not None and last["open"] is not None


def records(data: bytes, inside: bool) -> Iterator[bytes]:
    """The records that start in ``data``, the last one as far as it goes; line breaks between them are left out."""
    start = at = 0
    if inside:
        rest = INSIDE.match(data)
        if rest["open"] is not None:
            return
        start, at = None, rest.end()
    for token in TOKEN.finditer(data, at):
        if data[token.start()] == 10:
            if start is not None:
                yield data[start : token.start()]
            start = token.end()
    if start is not None and start < len(data):
        yield data[start:]


def _whole(file, data: bytes, end: int, size: int) -> bytes:
    """A record that the split's end leaves open, with the rest of it."""
    more = bytearray(data)
    tail = None
    while end < size and tail is None:
        step = file.read_at(min(max(STEP_BYTES, len(more)), size - end), end)  # doubled, as all is looked through again
        end += len(step)
        more += step
        # quotes that look closed at the end of what is read may be the first of a doubled pair
        if more.endswith(b'"') and end < size:
            continue
        tail = next((t.start() for t in TOKEN.finditer(more) if more[t.start()] == 10), None)
    return bytes(more if tail is None else more[:tail])


def _effects(batches):
    """path, size, start, end, and the state after the split for each state before it."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            with _open(row["path"]) as file:
                data, _ = _split(file, row["size"], row["start"], row["end"])
            row |= {"from_start": ends_inside(data, False), "from_inside": ends_inside(data, True)}
        yield pa.RecordBatch.from_pylist(rows)


def _records(header: bool):
    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                with _open(row["path"]) as file:
                    data, end = _split(file, row["size"], row["start"], row["end"])
                    open_ = ends_inside(data, row["inside"])
                    found = records(data, row["inside"])
                    if header and row["start"] == 0:
                        next(found, None)
                    before = None
                    for record in found:
                        if before is not None:
                            held.append(before)
                            size += len(before)
                        before = record
                        if size >= BATCH_BYTES:
                            yield _batch(held)
                            held, size = [], 0
                    if before is not None:
                        held.append(_whole(file, before, end, row["size"]) if open_ else before)
                    yield _batch(held)

    return work


def _batch(held: list[bytes]) -> pa.RecordBatch:
    lines = (x.removesuffix(b"\r").decode("utf-8", "replace") for x in held)
    return pa.RecordBatch.from_arrays([pa.array([x for x in lines if x], pa.string())], ["record"])


def _cuts(spark: SparkSession, path: str, split_bytes: int) -> tuple[DataFrame, int]:
    """path, size, start, end of every split, and how many there are."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size")).filter("size > 0")
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))
    cuts = files.withColumn("start", F.explode(starts)).withColumn("end", F.least(F.col("start") + split_bytes, "size"))
    return cuts, max(1, cuts.count())


def _states(cuts: DataFrame) -> DataFrame:
    """path, size, start, end, inside (whether the split starts inside quotes).

    A split either keeps the state, turns it round, or ends in one state whatever it began in. The state at a split is that
    after the last split of the third kind, turned round once for each turning split since.
    """
    effects = cuts.mapInArrow(_effects, "path string, size long, start long, end long, from_start boolean, from_inside boolean")
    ordered = Window.partitionBy("path").orderBy("start")
    fixed = F.col("from_start") == F.col("from_inside")
    turned = effects.withColumn("turns", F.sum(F.when(F.col("from_start") & ~F.col("from_inside"), 1).otherwise(0)).over(ordered))
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(fixed, F.struct("from_start", "turns")), ignorenulls=True).over(earlier)
    state = turned.withColumns({"last": last, "so_far": F.coalesce(F.lag("turns").over(ordered), F.lit(0))})
    odd = (F.col("so_far") - F.coalesce("last.turns", F.lit(0))) % 2 == 1
    return state.select("path", "size", "start", "end", (F.coalesce("last.from_start", F.lit(False)) != odd).alias("inside"))


def read_csv(spark: SparkSession, path: str, schema: str, cols: list[str] | None = None, corrupt: str | None = None, header: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Comma-separated UTF-8 files with doubled quotes inside quoted fields, as the multi-line reader gives them.

    Only ``cols`` are converted and returned, if given. ``corrupt`` names a column that holds a malformed record whole and
    is null otherwise. Fields may hold line breaks; a record ends at a line break outside quotes. A quote opens a field only
    where the field starts, and one that is never closed takes the rest of its file. Empty lines are no records; an empty
    file gives no rows. Files are listed when the frame is built; compressed files cannot be split and are not read here.
    """
    names = T.StructType.fromDDL(schema).names
    wanted = [*(cols or names), *([corrupt] if corrupt else [])]
    full = T.StructType([f if f.name in wanted else T.StructField(f.name, T.StringType()) for f in T.StructType.fromDDL(schema)])
    if corrupt:
        full = full.add(corrupt, T.StringType())
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
    options = {"escape": '"', "mode": "PERMISSIVE"} | ({"columnNameOfCorruptRecord": corrupt} if corrupt else {})
    cuts, n = _cuts(spark, path, split_bytes)
    found = _states(cuts.repartition(n)).repartition(n).mapInArrow(_records(header), "record string")
    return found.select(F.from_csv("record", ddl, options).alias("r")).select(*[F.col(f"r.`{c}`").alias(c) for c in wanted])
