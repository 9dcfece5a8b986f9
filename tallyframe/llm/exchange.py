"""Questions of many tasks to one table of hashed names, without a row per name.

Documents are stored once with a ``batch``, the number of the partition that wrote them. The tasks of a batch ask about
distinct names: sorted arrays of hashes, cut into buckets of the hash range, travel as one row per bucket. A bucket
sees a name at most once per asking row, however often it stands in the documents, so a name that is everywhere
costs one entry per row. The answers of a batch are put together in one flat file that its later readers map.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import files
from tallyframe.llm.common import U64, store
from tallyframe.session import shared_path

# entries that a bucket is meant to hold
BUCKET_ENTRIES = 1_000_000


def with_batches(docs: DataFrame, label: str) -> DataFrame:
    """Store documents with the number of the partition that wrote them as ``batch``."""
    return store(docs.withColumn("batch", F.spark_partition_id()), label)


def batch_runs(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Stretches of rows of one batch with about ``max_bytes``, one row at least."""
    held: list[pa.RecordBatch] = []
    size, now = 0, None

    def out() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for b in batches:
        if not b.num_rows:
            continue
        ids = b.column("batch").to_numpy()
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        for a, e in zip(cuts[:-1], cuts[1:], strict=True):
            if held and (now != ids[a] or size >= max_bytes):
                yield int(now), out()
                held, size = [], 0
            now = ids[a]
            held.append(b.slice(a, e - a))
            size += max(1, b.nbytes * (e - a) // b.num_rows)
    if held:
        yield int(now), out()


def n_buckets(entries: int) -> int:
    return max(1, -(-int(entries) // BUCKET_ENTRIES))


def bucket_cuts(names: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of the hash range starts in sorted names, one more at the end."""
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], dtype=U64)
    return np.concatenate([[0], np.searchsorted(names, edges), [len(names)]]).astype(np.int64)


def bucket_rows(
    batch: int, names: np.ndarray, payload: dict[str, np.ndarray], buckets: int, kind: pa.DataType = pa.int32()
) -> pa.RecordBatch | None:
    """One row per bucket that has names: ``bucket, batch, names`` and the payload arrays, all as bytes."""
    cuts = bucket_cuts(names, buckets)
    some = [k for k in range(buckets) if cuts[k + 1] > cuts[k]]
    if not some:
        return None
    columns = {"bucket": pa.array(some, pa.int32()), "batch": pa.array([batch] * len(some), kind)}
    for c, values in {"names": names, **payload}.items():
        columns[c] = pa.array([np.ascontiguousarray(values[cuts[k] : cuts[k + 1]]).tobytes() for k in some], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def gathered(parts: Iterator[pa.RecordBatch], kinds: dict[str, str]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """All rows of a bucket: the batches of the rows, the length of each, and the joined arrays."""
    who, sizes = [], []
    blobs: dict[str, list[bytes]] = {c: [] for c in kinds}
    for part in parts:
        who += part.column("batch").to_pylist()
        for c in kinds:
            blobs[c] += part.column(c).to_pylist()
    arrays = {c: np.frombuffer(b"".join(x), dtype=kinds[c]) for c, x in blobs.items()}
    sizes = [len(x) // 8 for x in blobs["names"]]
    return np.array(who, dtype=np.int64), np.array(sizes, dtype=np.int64), arrays


def replies(
    who: np.ndarray, names: np.ndarray, payload: dict[str, np.ndarray], kind: pa.DataType = pa.int32()
) -> Iterator[pa.RecordBatch]:
    """One row per batch from arrays that hold an entry per name and asking batch."""
    if not len(who):
        return
    order = np.argsort(who, kind="stable")
    cuts = np.flatnonzero(np.append(True, who[order][1:] != who[order][:-1]))
    ends = np.append(cuts[1:], len(who))
    for a, b in zip(cuts, ends, strict=True):
        own = order[a:b]
        columns = {"batch": pa.array([int(who[own[0]])], kind), "names": pa.array([names[own].tobytes()], pa.binary())}
        for c, values in payload.items():
            columns[c] = pa.array([values[own].tobytes()], pa.binary())
        yield pa.RecordBatch.from_pydict(columns)


def deliver(answers: DataFrame, kinds: dict[str, str], label: str) -> str:
    """Write the answers of each batch as flat files sorted by name; return their folder.

    ``answers`` has ``batch`` and one binary column per array; ``kinds`` gives the type of each array. Entries that agree
    in ``names`` (and ``check``, if there is one) are one.
    """
    folder = shared_path(answers.sparkSession, label)
    long = answers.schema["batch"].dataType.simpleString() == "bigint"
    kind = pa.int64() if long else pa.int32()

    def write(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[str, list[bytes]] = {c: [] for c in kinds}
        for part in parts:
            for c in kinds:
                blobs[c] += part.column(c).to_pylist()
        arrays = {c: np.frombuffer(b"".join(x), dtype=kinds[c]) for c, x in blobs.items()}
        # a batch may have asked for a name more than once
        parts_of_name = [arrays[c] for c in ("names", "check") if c in arrays]
        order = np.lexsort(parts_of_name[::-1])
        new = np.zeros(len(order), dtype=bool)
        new[:1] = True
        for x in parts_of_name:
            new[1:] |= x[order][1:] != x[order][:-1]
        order = order[new]
        batch = key[0].as_py()
        for c, values in arrays.items():
            files.write_flat(f"{folder}/{batch:08d}.{c}", values[order])
        yield pa.RecordBatch.from_pydict({"batch": pa.array([batch], kind)})

    columns = [F.col(c) for c in kinds]
    answers.select("batch", *columns).groupBy("batch").applyInArrow(write, f"batch {'long' if long else 'int'}").write.format("noop").mode(
        "overwrite"
    ).save()
    return folder


class Answers:
    """The delivered arrays of a batch; the last batch stays mapped."""

    def __init__(self, folder: str, kinds: dict[str, str]):
        self.folder, self.kinds = folder, kinds
        self.batch: int | None = None
        self.arrays: dict[str, np.ndarray] = {}

    def of(self, batch: int) -> dict[str, np.ndarray]:
        if batch != self.batch:
            found = {}
            for c, kind in self.kinds.items():
                try:
                    found[c] = files.read_flat(f"{self.folder}/{batch:08d}.{c}", kind)
                except FileNotFoundError:
                    # nothing was answered to this batch
                    found[c] = np.zeros(0, dtype=kind)
            self.batch, self.arrays = batch, found
        return self.arrays


def look_up(sorted_names: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each name in the sorted names, and whether it is there."""
    if not len(sorted_names):
        return np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_names, names), len(sorted_names) - 1)
    return at, sorted_names[at] == names
