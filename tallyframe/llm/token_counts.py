"""Token counts of flat token files that have no index, by a scan for the end-of-document id.

A file is cut into blocks of a fixed number of ids. Each block is searched by itself, in one vector
comparison, for the places of the end id. A document that crosses blocks is put together by a prefix scan
over one row per block: how many documents end before the block, and where the last of them ends.

Defined cases: two end ids in a row make a document of one token (its end id); ids behind the last end id make a
document with ``closed`` false; an empty file has no document; an empty list of files gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.llm import files
from tallyframe.llm.common import prepare, store
from tallyframe.llm.encoding import encoder
from tallyframe.llm.token_files import _part_of, _writer
from tallyframe.session import shared_path

BLOCK_IDS = 1 << 20


def file_blocks(sizes: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``file, block`` for every block of files given as ``file, n_ids``."""
    last = F.expr(f"(n_ids - 1) div {int(block_ids)}")
    return sizes.where("n_ids > 0").select("file", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))


def _search(end_id: int, dtype: str, block_ids: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True):
                ids = files.read_flat(file, dtype, block * block_ids, block_ids)
                ends = np.flatnonzero(ids == end_id).astype(np.int64) + block * block_ids
                yield pa.RecordBatch.from_pydict({
                    "file": [file], "block": pa.array([block], pa.int64()),
                    "n_ends": pa.array([len(ends)], pa.int64()), "upto": pa.array([block * block_ids + len(ids)], pa.int64()),
                    "last_end": pa.array([int(ends[-1]) if len(ends) else None], pa.int64()),
                    "ends": pa.array([ends], pa.list_(pa.int64())),
                })

    return search


def count_tokens(sizes: DataFrame, end_id: int, dtype: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``file, ordinal, n_tokens, closed`` of every document of the files ``file, n_ids``."""
    blocks = file_blocks(sizes, block_ids).repartition("file", "block")
    found = store(
        blocks.mapInArrow(
            _search(end_id, dtype, block_ids),
            "file string, block long, n_ends long, upto long, last_end long, ends array<bigint>",
        ),
        "token-blocks",
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scan = found.select("file", "block", "n_ends", "upto", "last_end").select(
        "file", "block",
        F.coalesce(F.sum("n_ends").over(earlier), F.lit(0)).alias("ordinal"),
        F.coalesce(F.max("last_end").over(earlier), F.lit(-1)).alias("carried"),
        F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("is_last"),
    )
    # the arrays of the blocks grow with the input: they are never the side that is sent to all tasks
    stitched = found.hint("merge").join(scan, ["file", "block"])
    # where the document before each end stopped: the carried end, then all ends of the block but the last
    before = F.concat(F.array("carried"), F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))))
    closed = stitched.where("n_ends > 0").select(
        "file", "ordinal", F.posexplode(F.zip_with("ends", before, lambda a, b: a - b)).alias("i", "n_tokens")
    ).select(
        "file", (F.col("ordinal") + F.col("i")).alias("ordinal"),
        F.col("n_tokens"), F.lit(True).alias("closed"),
    )
    rest = F.col("upto") - 1 - F.coalesce("last_end", "carried")
    tail = stitched.where(F.col("is_last") & (rest > 0)).select(
        "file", (F.col("ordinal") + F.col("n_ends")).alias("ordinal"), rest.alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.unionByName(tail)


def write_unindexed(docs: DataFrame, tokenizer: str, end_id: int) -> tuple[str, DataFrame]:
    """One flat file per input partition, in the order the rows come; the folder and ``part, n_docs, n_tokens``.

    Beside each file lies the list of the identifiers it holds, which the scan never reads.
    """
    spark = prepare(docs.sparkSession)
    folder = shared_path(spark, "flat-tokens")
    placed = docs.select("doc_id", "text").withColumn("part", F.spark_partition_id())
    write = _writer(folder, tokenizer, end_id, False, _part_of)
    return folder, store(placed.mapInArrow(write, "part long, n_docs long, n_tokens long"), "flat-parts")


def read_names(spark: SparkSession, folder: str, parts: DataFrame) -> DataFrame:
    """``file, ordinal, doc_id`` from the lists beside the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("part").to_pylist():
                fs, path = files.resolve(f"{folder}/{part:08d}.docs")
                with fs.open_input_file(path) as f:
                    names = pq.read_table(f, columns=["doc_id"]).column(0).combine_chunks().cast(pa.int64())
                for at in range(0, len(names), 1 << 16):
                    own = names.slice(at, 1 << 16)
                    yield pa.RecordBatch.from_pydict({
                        "file": pa.array([f"{folder}/{part:08d}.bin"] * len(own)),
                        "ordinal": pa.array(np.arange(at, at + len(own))), "doc_id": own,
                    })

    return parts.repartition("part").mapInArrow(read, "file string, ordinal long, doc_id long")


def document_token_counts(docs: DataFrame, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode ``docs`` to unindexed files, scan those, and name the documents: ``doc_id, n_tokens``.

    The end id must not come from a text, so the strings of special tokens are encoded as ordinary text.
    """
    folder, parts = write_unindexed(docs, tokenizer, end_id)
    sizes = parts.select(
        F.concat(F.lit(f"{folder}/"), F.lpad(F.col("part").cast("string"), 8, "0"), F.lit(".bin")).alias("file"),
        F.col("n_tokens").alias("n_ids"),
    )
    counts = count_tokens(sizes, end_id, encoder(tokenizer, False).dtype, block_ids)
    names = read_names(docs.sparkSession, folder, parts)
    return names.join(counts.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")

