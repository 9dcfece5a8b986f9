"""Shared helpers: words as arrays, stored tables, numbered rows and prefix sums.

Text is handled as the bytes of a whole Arrow batch. A word is a run of bytes outside 0x20 and
0x09-0x0D, and never crosses the end of its document. Words, shingles and windows are named by 64-bit
hashes that every task computes alike.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyframe.llm import files
from tallyframe.session import shared_path, tune

U64 = np.uint64
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=U64)
# words longer than this are hashed one by one
_LONG = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings: small Arrow batches, so that a task holds few long documents at a time."""
    tune(spark)
    # workers import this package; where it is not installed they find it beside the driver's copy
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    return spark


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a table below the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    for made in _made.get():
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


_made: ContextVar[tuple[list[str], ...]] = ContextVar("made", default=())


@contextmanager
def passing_tables() -> Iterator[list[str]]:
    """Collect the folders of the tables stored inside, for a caller that deletes them once its own result is stored."""
    made: list[str] = []
    token = _made.set((*_made.get(), made))
    try:
        yield made
    finally:
        _made.reset(token)


def remove(table: DataFrame) -> None:
    """Delete a table that ``store`` has written and that no later step reads."""
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        files.remove_folder(folder)


def col(name: str) -> Column:
    """A column by its whole name, which may hold dots and backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def row_hash(docs: DataFrame) -> Column:
    """A hash of 64 bits of all columns but ``text``: equal for rows that are equal in them."""
    rest = []
    for f in docs.schema.fields:
        # a hash passes over nulls, and maps have none
        nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
        rest += [F.to_json(F.struct(col(f.name)), _JSON)] if nested else [col(f.name).isNull(), col(f.name)] if f.name != "text" else []
    return F.xxhash64(*rest)


# -- numbers ---------------------------------------------------------------------------------------


def u64(x: int) -> np.uint64:
    """The lowest 64 bits of a Python integer."""
    return U64(x & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """Fixed odd multipliers, one per position of a window."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + u64(seed)) | U64(1)


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the intervals, one interval after the other."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    skip = np.cumsum(lengths) - lengths
    return np.repeat(np.asarray(starts, dtype=np.int64) - skip, lengths) + np.arange(total)


# -- text ------------------------------------------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a batch and the offsets of the documents; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each document the index of its first word (one more at the end)."""
    inside = ~blank[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    loads = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = ends - starts
    out = mix(size.astype(U64) + U64(0x51ED270B2F1A3C57))
    live = np.flatnonzero((size > 0) & (size <= _LONG))
    at, left = starts[live], size[live]
    while len(live):
        out[live] = mix(out[live] * U64(0x9E3779B97F4A7C15) ^ (loads[at] & _MASKS[np.minimum(left, 8)]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(size > _LONG):
        out[k] = U64(xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes()))
    return out


def window_hash(names: np.ndarray, width: int, seed: int) -> np.ndarray:
    """The hash of every run of ``width`` names; windows may cross documents, the caller leaves those out."""
    n = len(names) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = np.zeros(n, dtype=U64)
    for k, m in enumerate(odd_numbers(width, seed)):
        out += names[k : k + n] * m
    return mix(out)


def rechunk(batches: Iterable[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Join small batches until they hold about ``max_bytes``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.nbytes
        if size >= max_bytes:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


# -- rows in order ---------------------------------------------------------------------------------


def number_rows(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """Store the rows in a global order and give each its ``part`` and its place ``seq`` within the part.

    The order is a range partitioning, so no task holds more than its range, whatever the keys are.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.withColumns({
        "part": F.spark_partition_id(),
        "seq": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    })
    return store(placed, label)


def running_total(rows: DataFrame, value: str, by: Sequence[str] = (), out: str = "before") -> DataFrame:
    """Add the sum of ``value`` over all earlier rows (of the group ``by``) to the rows of ``number_rows``.

    Sums per part and group are scanned first (a row per part of the group), then rows within their part.
    """
    inner = Window.partitionBy("part", *by).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part", *by).agg(F.sum(value).alias("_sum"))
    outer = Window.partitionBy(*(by or [F.lit(0)])).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", *by, F.coalesce(F.sum("_sum").over(outer), F.lit(0)).alias("_base"))
    same = [F.col("l.part") == F.col("r.part"), *(F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by)]
    on = same[0]
    for c in same[1:]:
        on = on & c
    joined = rows.alias("l").join(bases.alias("r"), on).select("l.*", "r._base")
    return joined.withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(inner), F.lit(0))).drop("_base")
