"""Token ids as flat unsigned integer files with 64-bit document offsets.

A folder holds for every part ``P``

* ``P.bin``  the ids of its documents, end id included, as little-endian unsigned integers of 16 or 32 bits;
* ``P.idx``  one more than its documents little-endian signed 64-bit integers: where each document starts,
  counted over the whole folder, and where the last one ends;
* ``P.docs`` (Parquet) the identifiers and lengths of its documents, in the order of the file.

Parts are ranges of the document order. Every part is encoded and written by itself; the start of a part is
the prefix sum of the ids of the parts before it, which needs one row per part.

Defined cases: a null text is empty and has the end id alone; documents of one identifier stay in the order of
their texts, a null identifier comes first; an empty table gives no part and no row; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import files
from tallyframe.llm.common import prepare, ranges, rechunk, store, text_bytes
from tallyframe.llm.encoding import encoder
from tallyframe.session import shared_path

# bytes of text that are encoded at once
TEXT_BYTES = 4 << 20
# ids that are read and checked at once
READ_IDS = 1 << 22


@dataclass(frozen=True)
class TokenFolder:
    """A written folder: its place, the type of its ids, and (part, documents, ids, base) of every part."""

    path: str
    dtype: str
    parts: tuple[tuple[int, int, int, int], ...]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """Append the end id to every document."""
    out = np.full(len(ids) + len(counts), end_id, dtype=ids.dtype)
    out[ranges(np.cumsum(counts + 1) - counts - 1, counts)] = ids
    return out


def _writer(folder: str, tokenizer: str, end_id: int, special: bool, name):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, special)
        out = None
        part, total, n_docs = 0, 0, 0
        docs: list[pa.Table] = []
        for batch in rechunk(batches, TEXT_BYTES):
            if out is None:
                part = name(batch)
                out = files.FlatWriter(f"{folder}/{part:08d}.bin")
            ids, counts = encode(*text_bytes(batch.column("text")))
            out.write(with_end(ids, counts, end_id))
            docs.append(pa.table({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts + 1, pa.int64())}))
            n_docs += batch.num_rows
            total += int(counts.sum()) + len(counts)
        if out is None:
            return
        out.close()
        fs, path = files.resolve(f"{folder}/{part:08d}.docs")
        with fs.open_output_stream(f"{path}.tmp-{out.temp[-32:]}") as f:
            pq.write_table(pa.concat_tables(docs), f, compression="zstd")
        fs.move(f"{path}.tmp-{out.temp[-32:]}", path)
        yield pa.RecordBatch.from_pydict(
            {"part": np.array([part]), "n_docs": np.array([n_docs]), "n_tokens": np.array([total])}, schema=_PARTS
        )

    return write


_PARTS = pa.schema([("part", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def _part_of(batch: pa.RecordBatch) -> int:
    return batch.column("part")[0].as_py()


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, special: bool = True
) -> TokenFolder:
    """Encode ``text`` and write the folder in ascending order of ``doc_id``."""
    spark = prepare(docs.sparkSession)
    folder = folder or shared_path(spark, "tokens")
    order = ["doc_id", F.xxhash64("text"), "text"]
    ranged = (
        docs.select("doc_id", "text").repartitionByRange(*order[:2]).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
    )
    written = ranged.mapInArrow(
        _writer(folder, tokenizer, end_id, special, _part_of), "part long, n_docs long, n_tokens long"
    )
    parts, base = [], 0
    for r in store(written, "token-parts").orderBy("part").toLocalIterator():
        parts.append((r.part, r.n_docs, r.n_tokens, base))
        base += r.n_tokens
    made = TokenFolder(folder, encoder(tokenizer, special).dtype, tuple(parts))
    write_offsets(spark, made)
    return made


def parts_frame(spark: SparkSession, made: TokenFolder) -> DataFrame:
    """One row, and one task, per part."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("part", "n_docs", "n_tokens", "base")])
    rows = spark.createDataFrame([tuple(map(int, p)) for p in made.parts], schema)
    return rows.repartition(max(len(made.parts), 1), "part")


def write_offsets(spark: SparkSession, made: TokenFolder) -> None:
    """The 64-bit offsets of every part, from its base and the lengths of its documents."""
    folder = made.path

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base in zip(batch.column("part").to_pylist(), batch.column("base").to_pylist(), strict=True):
                fs, path = files.resolve(f"{folder}/{part:08d}.docs")
                with fs.open_input_file(path) as f:
                    lengths = pq.read_table(f, columns=["n_tokens"]).column(0).to_numpy()
                files.write_flat(f"{folder}/{part:08d}.idx", (base + np.append(0, np.cumsum(lengths))).astype("<i8"))
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64())})

    parts_frame(spark, made).mapInArrow(write, "part long").write.format("noop").mode("overwrite").save()


def read_tokens(spark: SparkSession, made: TokenFolder) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    folder, dtype = made.path, made.dtype

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("part").to_pylist():
                yield from read_part(folder, dtype, part)

    schema = "doc_id {}, start long, n_tokens long, ids_crc32 long"
    kind = "long"
    if made.parts:
        fs, path = files.resolve(f"{folder}/{made.parts[0][0]:08d}.docs")
        with fs.open_input_file(path) as f:
            kind = {"string": "string", "large_string": "string", "int32": "int"}.get(
                str(pq.read_schema(f).field("doc_id").type), "long"
            )
    return parts_frame(spark, made).mapInArrow(read, schema.format(kind))


def read_part(folder: str, dtype: str, part: int) -> Iterator[pa.RecordBatch]:
    offsets = files.read_flat(f"{folder}/{part:08d}.idx", "<i8")
    base = int(offsets[0])
    fs, path = files.resolve(f"{folder}/{part:08d}.docs")
    with fs.open_input_file(path) as f:
        names = pq.read_table(f, columns=["doc_id"]).column(0).combine_chunks()
    first = 0
    while first < len(names):
        # as many documents as fit into one read, one at least
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + READ_IDS, side="right")) - 1)
        last = min(last, len(names), first + (1 << 16))
        ids = files.read_flat(
            f"{folder}/{part:08d}.bin", dtype, int(offsets[first]) - base, int(offsets[last] - offsets[first])
        )
        cuts = offsets[first : last + 1] - offsets[first]
        crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                names.slice(first, last - first), pa.array(offsets[first:last].astype(np.int64)),
                pa.array(np.diff(cuts).astype(np.int64)), pa.array(crc, pa.int64()),
            ],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )
        first = last
