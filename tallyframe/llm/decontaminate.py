"""Benchmark decontamination by spaced-seed hashing.

Text becomes tokens: runs of letters and digits (every byte from 0x80 counts as a letter), lower-cased for A-Z and the
Latin letters of 0xC3; a character of a script written without blanks (``ALONE``) is a token of its own. A window of ``WINDOW`` tokens is cut into ``GROUPS`` groups of positions. Each mask ignores as
many groups as substitutions are tolerated, so two windows that differ in at most that many positions agree
under some mask, whichever positions differ. Windows of documents and of benchmark items are joined on their masked
hashes, and every hit is verified: the two windows must differ in at most ``MAX_SUBSTITUTIONS`` positions.

Items of fewer than ``WINDOW`` tokens are searched whole and exactly: windows of the lengths that occur among them (at
most ``WINDOW - 1``) are joined with them on a hash of all their tokens, and verified token by token.

Document windows pass a Bloom filter of the benchmark hashes first. Its size follows the benchmark up to
``MAX_BITS``, a fixed bound; beyond that it lets more windows through to the join, which decides.

Defined cases: a null or empty text has no window; an item without tokens is never reported; equal items under one identifier count once, differing texts under one identifier are all searched; rows of
one document identifier are reported together; an empty benchmark reports nothing; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import U64, mix, odd_numbers, prepare, ranges, rechunk, span_hash, store, text_bytes, u64

WINDOW = 13
MAX_SUBSTITUTIONS = 2
GROUPS = 4
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28
TEXT_BYTES = 2 << 20

_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[48:58] = True
_TOKEN[65:91] = True
_TOKEN[97:123] = True
_TOKEN[128:] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_LATIN_UPPER = np.zeros(256, dtype=bool)
_LATIN_UPPER[0x80:0x9F] = True
_LATIN_UPPER[0x97] = False
# Code points of Thai, Lao and Tibetan, Myanmar, Khmer, Kana and other signs of Japanese, and Han
ALONE = [
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3000, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF),
    (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF),
]


def characters_alone(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last bytes of the characters that are tokens of their own."""
    first = np.flatnonzero(data >= 0xE0)
    wide = data[first] >= 0xF0
    code = np.where(wide, data[first] & 0x07, data[first] & 0x0F).astype(np.int64)
    for k in (1, 2, 3):
        at = np.minimum(first + k, len(data) - 1)
        code = np.where(wide | (k < 3), code << 6 | (data[at] & 0x3F), code)
    alone = np.zeros(len(first), dtype=bool)
    for a, b in ALONE:
        alone |= (code >= a) & (code <= b)
    return first[alone], (first + np.where(wide, 3, 2))[alone]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit name per token, and for each text the index of its first token (one more at the end)."""
    inside = _TOKEN[data]
    low = _FOLD[data]
    if len(low):
        low[1:] += ((data[:-1] == 0xC3) & _LATIN_UPPER[data[1:]]).astype(np.uint8) * np.uint8(32)
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    left = np.zeros(len(data), dtype=bool)
    left[1:] = inside[:-1]
    left[cuts] = False
    right = np.zeros(len(data), dtype=bool)
    right[:-1] = inside[1:]
    right[cuts[cuts > 0] - 1] = False
    first, last = characters_alone(data)
    left[first] = False
    right[last] = False
    left[last[last + 1 < len(data)] + 1] = False
    right[first[first > 0] - 1] = False
    starts = np.flatnonzero(inside & ~left)
    return span_hash(low, starts, np.flatnonzero(inside & ~right) + 1), np.searchsorted(starts, offsets)


def masks(window: int = WINDOW, groups: int = GROUPS, ignored: int = MAX_SUBSTITUTIONS) -> list[list[int]]:
    """For every mask the groups it looks at; group ``g`` holds the positions of the g-th even share of the window."""
    return [list(c) for c in combinations(range(groups), groups - ignored)]


def masked_hashes(names: np.ndarray) -> np.ndarray:
    """One row per mask, one column per window."""
    n = len(names) - WINDOW + 1
    factors = odd_numbers(WINDOW, 5)
    edges = [round(g * WINDOW / GROUPS) for g in range(GROUPS + 1)]
    sums = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        s = np.zeros(n, dtype=U64)
        for k in range(a, b):
            s += names[k : k + n] * factors[k]
        sums.append(s)
    out = []
    for m, seen in enumerate(masks()):
        s = np.full(n, u64((m + 1) * 0x9E3779B97F4A7C15), dtype=U64)
        for g in seen:
            s = s + sums[g]
        out.append(mix(s))
    return np.array(out)


def _windows(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Starts of the windows that lie in one text, and the text of each."""
    sizes = np.diff(first)
    return ranges(first[:-1], np.maximum(sizes - WINDOW + 1, 0))


def _passes(hashes: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter lets through."""
    n_bits = len(filled) * 8
    a, _ = _bits(hashes, n_bits)
    near = np.flatnonzero((filled[a >> 3] >> (a & 7).astype(np.uint8)) & 1)
    _, b = _bits(hashes[near], n_bits)
    return near[((filled[b >> 3] >> (b & 7).astype(np.uint8)) & 1).astype(bool)]


def _bits(hashes: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (hashes & U64(n_bits - 1)).astype(np.int64), ((hashes >> U64(32)) & U64(n_bits - 1)).astype(np.int64)


def _emit(batch: pa.RecordBatch, column: str, filled: np.ndarray | None) -> pa.RecordBatch:
    """Windows with the masked hashes that the filter lets through: ``row, pos, hashes, names``."""
    names, first = tokens(*text_bytes(batch.column(column)))
    at = _windows(names, first)
    if len(at):
        hashes = masked_hashes(names)[:, at]
        if filled is None:
            passed = np.ones(hashes.shape, dtype=bool)
        else:
            passed = np.zeros(hashes.shape, dtype=bool)
            for m, row in enumerate(hashes):
                passed[m, _passes(row, filled)] = True
        some = np.flatnonzero(passed.any(axis=0))
        at, hashes, passed = at[some], hashes[:, some].T, passed[:, some].T
    else:
        hashes, passed = np.zeros((0, len(masks())), dtype=U64), np.zeros((0, len(masks())), dtype=bool)
    row = np.searchsorted(first, at, side="right") - 1
    window = names[at[:, None] + np.arange(WINDOW)] if len(at) else np.zeros((0, WINDOW), dtype=U64)
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(pa.array(row)), pa.array((at - first[row]).astype(np.int64)),
            pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(passed.sum(axis=1))).astype(np.int32)),
                pa.array(np.ascontiguousarray(hashes[passed]).view(np.int64)),
            ),
            pa.ListArray.from_arrays(
                pa.array((np.arange(len(at) + 1) * WINDOW).astype(np.int32)),
                pa.array(np.ascontiguousarray(window).reshape(-1).view(np.int64)),
            ),
        ],
        names=["key", "pos", "hashes", "names"],
    )


def seeds(texts: DataFrame, key: str, filled: np.ndarray | None = None) -> DataFrame:
    """``key, pos, names, hash`` of the windows of ``text``; ``filled`` is the filter they must pass."""
    kind = texts.schema[key].dataType.simpleString()
    shared = texts.sparkSession.sparkContext.broadcast(filled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rechunk(batches, TEXT_BYTES):
            yield _emit(batch, "text", shared.value)

    found = texts.select(key, "text").mapInArrow(
        run, f"key {kind}, pos long, hashes array<bigint>, names array<bigint>"
    )
    return found.select("key", "pos", "names", F.explode("hashes").alias("hash"))


def _whole(batch: pa.RecordBatch, lengths: list[int], filled: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Windows of the given lengths, or without a filter the whole texts of these lengths: ``key, pos, names, hash``."""
    if not lengths:
        return
    names, first = tokens(*text_bytes(batch.column("text")))
    sizes = np.diff(first)
    for n in lengths:
        at = ranges(first[:-1], np.maximum(sizes - n + 1, 0)) if filled is not None else first[:-1][sizes == n]
        factors = odd_numbers(n, 11)
        hashes = np.full(len(at), u64(n * 0x9E3779B97F4A7C15), dtype=U64)
        for k in range(n):
            hashes += names[at + k] * factors[k]
        hashes = mix(hashes)
        if filled is not None:
            some = _passes(hashes, filled)
            at, hashes = at[some], hashes[some]
        row = np.searchsorted(first, at, side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(row)), pa.array((at - first[row]).astype(np.int64)),
                pa.ListArray.from_arrays(
                    pa.array((np.arange(len(at) + 1) * n).astype(np.int32)),
                    pa.array(np.ascontiguousarray(names[at[:, None] + np.arange(n)]).reshape(-1).view(np.int64)),
                ),
                pa.array(hashes.view(np.int64)),
            ],
            names=["key", "pos", "names", "hash"],
        )


def short_seeds(texts: DataFrame, key: str, lengths: list[int], filled: np.ndarray | None = None) -> DataFrame:
    """``key, pos, names, hash`` of windows of ``text`` (with a filter) or of the whole texts of these lengths."""
    kind = texts.schema[key].dataType.simpleString()
    shared = texts.sparkSession.sparkContext.broadcast(filled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rechunk(batches, TEXT_BYTES):
            yield from _whole(batch, lengths, shared.value)

    return texts.select(key, "text").mapInArrow(run, f"key {kind}, pos long, names array<bigint>, hash long")


def benchmark_filter(bench: DataFrame) -> np.ndarray:
    """A Bloom filter of the benchmark's hashes, two bits each; at most ``MAX_BITS / 8`` bytes."""
    n = bench.count()
    n_bits = MIN_BITS
    while n_bits < min(MAX_BITS, 256 * n):
        n_bits *= 2
    low = F.col("hash").bitwiseAND(F.lit(n_bits - 1))
    high = F.shiftrightunsigned("hash", 32).bitwiseAND(F.lit(n_bits - 1))
    bits = bench.select(F.explode(F.array(low, high)).alias("bit"))
    cells = bits.groupBy(F.expr("bit div 64").alias("cell")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("value")
    ).toArrow()
    filled = np.zeros(n_bits // 64, dtype="<i8")
    if cells.num_rows:
        filled[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    return filled.view(np.uint8)


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, first_word, last_word, n_windows, n_equal``: overlaps with items of ``WINDOW`` tokens or more.

    Words are counted in tokens of the document; ``n_equal`` is the best agreement of a window, of ``WINDOW``.
    """
    prepare(docs.sparkSession)
    items = store(benchmark.select("item_id", "text").distinct(), "benchmark-items")
    bench = store(seeds(items, "item_id").dropDuplicates(["key", "names", "hash"]), "benchmark-seeds")
    hits = seeds(docs, "doc_id", benchmark_filter(bench))
    met = hits.alias("d").join(bench.alias("b"), F.col("d.hash") == F.col("b.hash")).select(
        F.col("d.key").alias("doc_id"), F.col("b.key").alias("item_id"), F.col("d.pos").alias("pos"),
        F.aggregate(
            F.zip_with("d.names", "b.names", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda a, b: a + b
        ).alias("n_equal"),
    )
    close = met.where(F.col("n_equal") >= WINDOW - MAX_SUBSTITUTIONS)
    # a window meets one item under several masks
    once = close.groupBy("doc_id", "item_id", "pos").agg(F.max("n_equal").alias("n_equal"))
    return once.groupBy("doc_id", "item_id").agg(
        F.min("pos").alias("first_word"), (F.max("pos") + WINDOW).alias("last_word"),
        F.count("*").alias("n_windows"), F.max("n_equal").cast("long").alias("n_equal"),
    )


def find_short(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """As ``find_overlaps`` for the items of fewer than ``WINDOW`` tokens, which a document must hold whole and verbatim.

    ``n_equal`` is the length of the item.
    """
    prepare(docs.sparkSession)
    items = benchmark.select("item_id", "text").distinct()
    bench = store(
        short_seeds(items, "item_id", list(range(1, WINDOW))).dropDuplicates(["key", "names"]), "benchmark-short"
    )
    lengths = sorted(r[0] for r in bench.select(F.size("names")).distinct().collect())
    met = short_seeds(docs, "doc_id", lengths, benchmark_filter(bench)).alias("d").join(
        bench.alias("b"), (F.col("d.hash") == F.col("b.hash")) & (F.col("d.names") == F.col("b.names"))
    )
    once = met.select(
        F.col("d.key").alias("doc_id"), F.col("b.key").alias("item_id"), F.col("d.pos").alias("pos"),
        F.size("b.names").cast("long").alias("width"),
    ).distinct()
    return once.groupBy("doc_id", "item_id").agg(
        F.min("pos").alias("first_word"), F.max(F.col("pos") + F.col("width")).alias("last_word"),
        F.count("*").alias("n_windows"), F.max("width").alias("n_equal"),
    )


def find_all(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The overlaps with items of any length, columns as in ``find_overlaps``."""
    both = find_overlaps(docs, benchmark).unionByName(find_short(docs, benchmark))
    # differing texts under one identifier may be long and short
    return both.groupBy("doc_id", "item_id").agg(
        F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"),
        F.sum("n_windows").alias("n_windows"), F.max("n_equal").alias("n_equal"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any overlap, whole and with all their columns."""
    hit = find_all(docs, benchmark).select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_hit"]), "left_anti")
