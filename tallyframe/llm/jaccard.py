"""Exact n-gram Jaccard join by partitioning the universe of shingles.

A text is the set of its shingles, named by 64-bit hashes. Two sets of sizes a and b with Jaccard similarity of at least
4/5 have sizes within that ratio and differ in at most ``(a + b) / 9`` elements. Sizes are cut into bands so that such
sets lie in one band or in neighbouring bands; a *space* joins a band with itself and the next.

Each space cuts the range of hashes into ``m`` segments. What a set holds in a segment is a *subset*; in the first ``t``
segments the set is also indexed by its one-deletion neighbourhood, the subset without each of its elements. If all
``m`` subsets of two sets are to differ, and those of the first ``t`` by more than one element, the sets must differ in
``m + t`` elements. So with ``m + t`` above the largest difference, similar sets share an index entry. Empty subsets
would be shared by everyone; a set leaves them out if the segments it has beyond its own largest difference pay
for them (each counts as much as its segment), else it indexes them too. ``m`` and ``t`` are allocated per
space by cost: entries, plus a charge for subsets of one element, plus one for sets that cannot pay.

Sets that share an entry become candidates, each with the first set of the entry. Candidates that pass exact bounds (sizes,
and a histogram of the hashes whose difference cannot exceed that of the sets) are verified on the whole sets. Entries of
three or more sets that verified links leave in several components are then compared across components, on the whole sets
and in blocks. Links inside a component need not be known: the components are those of all links.

Equal sets are one node, named by 128 bits of hash, so copies cost nothing beyond the first per task.

Defined cases: a null text or one without words has an empty set, no node and no link; a text of fewer words than a
shingle has all its words as its one shingle; rows of one identifier are separate documents; a null identifier counts as
the largest; an empty table gives no row; further columns are ignored, or kept by ``keep_one``.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import exchange as ex
from tallyframe.llm import files
from tallyframe.llm.common import LOWER, U64, col, mix, passing_tables, prepare, rechunk, row_hash, span_hash, store, text_bytes, u64, window_hash, words
from tallyframe.llm.components import components

SHINGLE = 5
TEXT_BYTES = 4 << 20
# the charge of a subset of one element, in entries, and of a set that cannot pay for its empty subsets
ONE_COST, POOR_COST = 0.25, 50.0
# shingles of a block of the comparison across components, and of the small groups of one task
BLOCK_ELEMENTS = 1_000_000
TASK_ELEMENTS = 2_000_000
MAX_FILTER_BITS = 1 << 28
# bits of the table that tells rows which stay from rows that may be copies, 64 a row
MAX_DOUBT_BITS = 1 << 25
# entries per bucket of the index
BUCKET_ENTRIES = 2_000_000
# entries that a task gathers before it cuts them into buckets
HELD_ENTRIES = 1_000_000


# -- sets ------------------------------------------------------------------------------------------


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of every text and where each text's start (one more at the end)."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    names = span_hash(data, starts, ends)
    sizes = np.diff(first)
    grams = window_hash(names, SHINGLE, 3)
    sets = []
    for a, n in zip(first[:-1].tolist(), sizes.tolist(), strict=True):
        if n >= SHINGLE:
            sets.append(np.sort(grams[a : a + n - SHINGLE + 1]))
        elif n:
            # fewer words than a shingle: never equal to a shingle of full length
            sets.append(window_hash(names[a : a + n], n, 100 + n))
        else:
            sets.append(np.zeros(0, dtype=U64))
    bounds = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, dtype=U64)
    doc = np.repeat(np.arange(len(sets)), np.diff(bounds))
    new = np.append(True, (flat[1:] != flat[:-1]) | (doc[1:] != doc[:-1])) if len(flat) else np.zeros(0, dtype=bool)
    return flat[new], np.append(0, np.cumsum(new))[bounds]


def node_name(elements: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None


def histogram_size(n: int) -> int:
    """Cells of a set's histogram: a power of two near an eighth of its size."""
    return 1 << max(4, int(max(n, 1) // 8).bit_length())


def histogram(elements: np.ndarray) -> bytes:
    cells = histogram_size(len(elements))
    counts = np.bincount((elements & U64(cells - 1)).astype(np.int64), minlength=cells)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def may_link(n_a: int, n_b: int, hist_a: bytes, hist_b: bytes) -> bool:
    """False only if the two sets cannot be similar enough."""
    if 5 * min(n_a, n_b) < 4 * max(n_a, n_b):
        return False
    a, b = np.frombuffer(hist_a, dtype=np.uint8), np.frombuffer(hist_b, dtype=np.uint8)
    if len(a) != len(b):
        short, long = (a, b) if len(a) < len(b) else (b, a)
        # a count that was cut off says nothing about its cell
        folded = long.reshape(-1, len(short)).astype(np.int64)
        cut = (folded == 255).any(axis=0) | (short == 255)
        apart = np.abs(folded.sum(axis=0) - short.astype(np.int64))[~cut].sum()
    else:
        apart = np.abs(a.astype(np.int64) - b.astype(np.int64)).sum()
    return 9 * int(apart) <= n_a + n_b


# -- index -----------------------------------------------------------------------------------------


@lru_cache(maxsize=None)
def band_starts(upto: int = 1 << 40) -> tuple[int, ...]:
    """First size of every band: sizes within the ratio 5/4 are in one band or in neighbours."""
    out = [1]
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4 + 1))
    return tuple(out)


@lru_cache(maxsize=None)
def allocate(space: int) -> tuple[int, int]:
    """Segments ``m`` of a space and how many of them, ``t``, have deletion neighbourhoods."""
    low, after = band_starts()[space], band_starts()[space + 1]
    need = 9 * (after - 1) // 4 // 9 + 1
    best = None
    for t in sorted({0, 1, 2, *(int(need * f) for f in (0.01, 0.02, 0.05, 0.1, 0.2))}):
        for spare in sorted({0, 1, 2, 3, 4, 6, 8, *(int(need * f) for f in (0.03, 0.06, 0.1, 0.15, 0.2, 0.3))}):
            m = need + spare
            if t > m:
                continue
            mean = low / m
            empty, one = np.exp(-mean), mean * np.exp(-mean)
            # what a set of the smallest size can spend, and what its empty subsets cost it
            purse = m + t - (low + min(after * 5 // 4, low * 5 // 4)) // 9 - 1
            cost = (m + t) * empty + t * one
            risk = 0.5 * np.exp(-max(purse - cost, 0.0) ** 2 / (2 * max(cost, 0.25))) if purse >= cost else 1.0
            total = m * (1 - empty) + t * mean + ONE_COST * m * one + POOR_COST * risk
            if best is None or total < best[0]:
                best = (total, m, t)
    return best[1], best[2]


def entries(elements: np.ndarray, space: int, upper: bool) -> np.ndarray:
    """The index entries of one set in a space; ``upper`` if the set is of the space's second band."""
    n = len(elements)
    m, t = allocate(space)
    after = band_starts()[space + 1]
    largest = (n + (min(n, after - 1) if upper else n * 5 // 4)) // 9
    segment = (((elements >> U64(32)) * U64(m)) >> U64(32)).astype(np.int64)
    head = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    where = segment[head]
    size = np.diff(np.append(head, n))
    spread = mix(elements)
    sums = np.add.reduceat(spread, head)
    salt = u64((space + 1) * 0x9E3779B97F4A7C15)

    def name(total: np.ndarray, at: np.ndarray) -> np.ndarray:
        return mix(total + mix(at.astype(U64) + salt))

    out = [name(sums, where)]
    deleted = np.flatnonzero(where < t)
    # an empty segment costs its weight, a single element in a neighbourhood segment one
    empties = m - len(where)
    empty_near = t - len(deleted)
    cost = empties + empty_near + int((size[deleted] == 1).sum())
    rich = m + t - cost > largest
    for k in deleted:
        if size[k] > 1 or not rich:
            own = slice(head[k], head[k] + size[k])
            out.append(name(sums[k] - spread[own], np.full(size[k], where[k])))
    if not rich:
        gaps = np.setdiff1d(np.arange(m), where)
        out.append(name(np.zeros(len(gaps), dtype=U64), gaps))
    return np.unique(np.concatenate(out))


def spaces_of(n: int) -> list[tuple[int, bool]]:
    """The spaces a set takes part in, and whether as one of the second band."""
    starts = band_starts()
    band = bisect_right(starts, n) - 1
    out = [(band, False)]
    if band and n <= (starts[band] - 1) * 5 // 4:
        out.append((band - 1, True))
    return out


def _batches(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple]:
    for batch in rechunk(batches, TEXT_BYTES):
        elements, bounds = shingle_sets(*text_bytes(batch.column(column)))
        yield batch, elements, bounds


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, elements, bounds in _batches(batches, "_text"):
        sets = [elements[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_row"), pa.array(np.diff(bounds).astype(np.int64)),
                pa.array([node_name(s) for s in sets], pa.binary()), pa.array([histogram(s) for s in sets], pa.binary()),
            ],
            names=["_row", "n_shingles", "node", "histogram"],
        )


def _index_rows(
    names: list[np.ndarray], place: list[np.ndarray], nodes: list[bytes], sizes: list[int], buckets: int
) -> pa.RecordBatch:
    """One row per bucket that has entries, with the nodes that these entries name and no others."""
    entry, who = np.concatenate(names), np.concatenate(place)
    order = np.argsort(entry)
    entry, who = entry[order], who[order]
    listed, size = np.frombuffer(b"".join(nodes), dtype="<u8").reshape(-1, 2), np.array(sizes, dtype="<u4")
    cuts = ex.bucket_cuts(entry, buckets)
    out: dict[str, list] = {c: [] for c in ("bucket", "names", "place", "nodes", "sizes")}
    for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        own = who[cuts[k] : cuts[k + 1]]
        named, at = np.unique(own // 2, return_inverse=True)
        kind = np.uint16 if 2 * len(named) < 1 << 16 else np.uint32
        out["bucket"].append(k)
        out["names"].append(entry[cuts[k] : cuts[k + 1]].tobytes())
        out["place"].append((2 * at + own % 2).astype(kind).tobytes())
        out["nodes"].append(listed[named].tobytes())
        out["sizes"].append(size[named].tobytes())
    binary = {c: pa.array(v, pa.binary()) for c, v in out.items() if c != "bucket"}
    return pa.RecordBatch.from_pydict({"bucket": pa.array(out["bucket"], pa.int32()), **binary})


def _index(buckets: int):
    """Rows of a bucket: entries, the place of their set in the row's list, and the nodes and sizes of that list.

    A row lists what its own entries name, so the index takes 30 bytes an entry at most, however many buckets there are.
    Entries are gathered over ``HELD_ENTRIES`` before they are cut, which keeps rows long.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        names: list[np.ndarray] = []
        place: list[np.ndarray] = []
        nodes: list[bytes] = []
        sizes: list[int] = []
        held = 0
        for _, elements, bounds in _batches(batches):
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                own = elements[a:b]
                node = node_name(own)
                if node is None or node in seen:
                    continue
                seen.add(node)
                for space, upper in spaces_of(len(own)):
                    found = entries(own, space, upper)
                    names.append(found)
                    place.append(np.full(len(found), 2 * len(nodes) + upper, dtype=np.uint32))
                    held += len(found)
                nodes.append(node)
                sizes.append(len(own))
                if held >= HELD_ENTRIES:
                    yield _index_rows(names, place, nodes, sizes, buckets)
                    names, place, nodes, sizes, held = [], [], [], [], 0
            # copies that a task sees far apart are indexed twice, which changes nothing but the time
            if len(seen) > 1_000_000:
                seen.clear()
        if nodes:
            yield _index_rows(names, place, nodes, sizes, buckets)

    return index


def _candidates(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each entry's first set with the others, and the members of entries of three sets or more.

    Only a set of the lower band of a space can be missed elsewhere, so an entry needs one of those.
    """
    names, who, upper, node_list, size_list, base = [], [], [], [], [], 0
    for part in parts:
        for n, p, x, s in zip(*(part.column(c).to_pylist() for c in ("names", "place", "nodes", "sizes")), strict=True):
            n = np.frombuffer(n, dtype="<u8")
            p = np.frombuffer(p, dtype="<u2" if len(p) == 2 * len(n) else "<u4").astype(np.int64)
            names.append(n)
            who.append(p // 2 + base)
            upper.append(p % 2 == 1)
            node_list.append(np.frombuffer(x, dtype="<u8").reshape(-1, 2))
            size_list.append(np.frombuffer(s, dtype="<u4").astype(np.int64))
            base += len(node_list[-1])
    names, who, upper = np.concatenate(names), np.concatenate(who), np.concatenate(upper)
    # one number per node, however many rows list it
    nodes = np.concatenate(node_list)
    order = np.lexsort((nodes[:, 1], nodes[:, 0]))
    new = np.append(True, (nodes[order][1:] != nodes[order][:-1]).any(axis=1))
    number = np.zeros(len(nodes), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    nodes, sizes = nodes[order][new], np.concatenate(size_list)[order][new]
    who = number[who]
    order = np.lexsort((who, upper, names))
    names, who, upper = names[order], who[order], upper[order]
    same = np.append(False, (names[1:] == names[:-1]) & (who[1:] == who[:-1]))
    names, who, upper = names[~same], who[~same], upper[~same]
    head = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
    count = np.diff(np.append(head, len(names)))
    group = np.repeat(np.arange(len(head)), count)
    useful = (count > 1) & ~upper[head]
    # the first set of an entry is of the lower band, the smallest by name
    leader = who[head][group]
    star = useful[group] & (leader != who)
    fit = 5 * np.minimum(sizes[leader], sizes[who]) >= 4 * np.maximum(sizes[leader], sizes[who])
    pairs = np.unique(np.stack([leader[star & fit], who[star & fit]]), axis=1)
    for at in range(0, pairs.shape[1], 1 << 16):
        a, b = nodes[pairs[0, at : at + (1 << 16)]], nodes[pairs[1, at : at + (1 << 16)]]
        yield pa.RecordBatch.from_pydict({
            "entry": pa.array([None] * len(a), pa.int64()), "a": pa.array([x.tobytes() for x in a], pa.binary()),
            "b": pa.array([x.tobytes() for x in b], pa.binary()),
        })
    large = np.flatnonzero((useful & (count > 2))[group])
    for at in range(0, len(large), 1 << 16):
        own = large[at : at + (1 << 16)]
        yield pa.RecordBatch.from_pydict({
            "entry": pa.array(names[own].view(np.int64)), "a": pa.array([x.tobytes() for x in nodes[who[own]]], pa.binary()),
            "b": pa.array([None] * len(own), pa.binary()),
        })


# -- verification ----------------------------------------------------------------------------------


def _wanted_filter(nodes: DataFrame) -> np.ndarray:
    """A bit per wanted node in a table of bounded size; a set bit lets some unwanted nodes pass as well."""
    n = nodes.count()
    bits = 1 << 16
    while bits < min(MAX_FILTER_BITS, 32 * n):
        bits *= 2
    at = F.pmod(F.xxhash64("node"), F.lit(bits))
    cells = nodes.select(at.alias("bit")).groupBy(F.expr("bit div 64").alias("cell")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("value")
    ).toArrow()
    out = np.zeros(bits // 64, dtype="<i8")
    if cells.num_rows:
        out[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    return out.view(np.uint8)


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, elements`` of the wanted nodes, from the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(_wanted_filter(wanted))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        seen: set[bytes] = set()
        for _, elements, bounds in _batches(batches):
            nodes, sets = [], []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                node = node_name(elements[a:b])
                if node is None or node in seen:
                    continue
                # the seed of Spark's own hash function
                at = xxhash.xxh64_intdigest(node, 42) & (len(bits) * 8 - 1)
                if bits[at >> 3] >> (at & 7) & 1:
                    seen.add(node)
                    nodes.append(node)
                    sets.append(elements[a:b].tobytes())
            if len(seen) > 1_000_000:
                seen.clear()
            if nodes:
                yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.binary()), "elements": pa.array(sets, pa.binary())})

    return docs.select("text").mapInArrow(make, "node binary, elements binary").dropDuplicates(["node"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
        kept = [
            i for i, (x, y) in enumerate(pairs) if _similar(np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8"))
        ]
        yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("n_a", "n_b", "hist_a", "hist_b"))
        kept = [i for i, row in enumerate(zip(*columns, strict=True)) if may_link(*row)]
        yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))


def verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, label: str) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough. ``nodes``: ``node, n_shingles, histogram``."""
    a = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("histogram").alias("hist_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("histogram").alias("hist_b"))
    close = store(pairs.join(a, "a").join(b, "b").mapInArrow(_bounded, "a binary, b binary"), f"{label}-close")
    wanted = close.select(F.col("a").alias("node")).union(close.select("b")).distinct()
    sets = _sets_of(docs, wanted)
    first = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    met = close.join(first, "a").join(second, "b").select("a", "b", "x", "y")
    return store(met.mapInArrow(_links, "a binary, b binary"), label)


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = np.concatenate([x, y])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= 80 * (len(both) - shared)


def _runs(table: pa.Table) -> tuple[pa.Table, list[tuple[int, int]]]:
    """Rows sorted by group and pair of blocks, and the stretch of each pair."""
    table = table.combine_chunks().sort_by([("group", "ascending"), ("bi", "ascending"), ("bj", "ascending")])
    groups = table["group"].combine_chunks().dictionary_encode().indices.to_numpy()
    bi, bj = table["bi"].to_numpy(), table["bj"].to_numpy()
    new = (groups[1:] != groups[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(groups)]
    return table, list(zip(cuts[:-1], cuts[1:], strict=True))


def _prospects(key: tuple, table: pa.Table) -> pa.Table:
    """The rows that have a set of another component within the bounds, by sizes and histograms alone."""
    table, stretches = _runs(table)
    hists, sizes = table["histogram"].to_pylist(), table["n_shingles"].to_numpy()
    roots = table["root"].combine_chunks().dictionary_encode().indices.to_numpy()
    block, bi, bj = (table[c].to_numpy() for c in ("block", "bi", "bj"))
    # a histogram that was cut off bounds nothing; such a set is left to the exact check
    cut_off = np.array([255 in h for h in hists], dtype=bool)
    some = np.zeros(len(hists), dtype=bool)
    for lo, hi in stretches:
        cells = min(len(h) for h in hists[lo:hi])
        folded = np.stack([
            np.frombuffer(h, dtype=np.uint8).reshape(-1, cells).sum(axis=0, dtype=np.int32) for h in hists[lo:hi]
        ])
        right = lo + np.flatnonzero(block[lo:hi] == bj[lo])
        for i in lo + np.flatnonzero(block[lo:hi] == bi[lo]):
            others = right[right > i] if bi[lo] == bj[lo] else right
            others = others[
                (roots[others] != roots[i])
                & (5 * np.minimum(sizes[others], sizes[i]) >= 4 * np.maximum(sizes[others], sizes[i]))
            ]
            apart = np.abs(folded[others - lo] - folded[i - lo]).sum(axis=1)
            near = others[(9 * apart <= sizes[others] + sizes[i]) | cut_off[others] | cut_off[i]]
            some[near] = True
            some[i] |= len(near) > 0
    return table.select(["group", "node"]).filter(pa.array(some))


def _across(key: tuple, table: pa.Table) -> pa.Table:
    """Links between components of a group, of two blocks of it; pairs that links found here connect are left out."""
    table, stretches = _runs(table)
    nodes = table["node"].to_pylist()
    sets = [np.frombuffer(x, dtype="<u8") for x in table["elements"].to_pylist()]
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    roots = table["root"].combine_chunks().dictionary_encode().indices.to_numpy()
    block, bi, bj = (table[c].to_numpy() for c in ("block", "bi", "bj"))
    a, b = [], []
    for lo, hi in stretches:
        # the difference of two histograms cannot exceed that of the sets
        cells = np.stack([np.bincount((x & U64(255)).astype(np.int64), minlength=256) for x in sets[lo:hi]]).astype(np.int32)
        if cells.max() < 1 << 15:
            cells = cells.astype(np.int16)
        # roots as they merge; equal roots are equal numbers
        now = roots[lo:hi].copy()
        right = lo + np.flatnonzero(block[lo:hi] == bj[lo])
        for i in lo + np.flatnonzero(block[lo:hi] == bi[lo]):
            others = right[right > i] if bi[lo] == bj[lo] else right
            others = others[5 * np.minimum(sizes[others], sizes[i]) >= 4 * np.maximum(sizes[others], sizes[i])]
            others = others[now[others - lo] != now[i - lo]]
            if len(others):
                apart = np.abs(cells[others - lo] - cells[i - lo]).sum(axis=1, dtype=np.int64)
                others = others[9 * apart <= sizes[others] + sizes[i]]
            for k in others:
                if now[k - lo] != now[i - lo] and _similar(sets[i], sets[k]):
                    now[now == now[k - lo]] = now[i - lo]
                    a.append(nodes[i])
                    b.append(nodes[k])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def across_components(members: DataFrame, roots: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links ``a, b`` between components, of entries ``entry, node`` whose sets are still in several.

    Entries with the same smallest root are one group, in which a set stands once, whatever the number of its entries.
    The sets of a group's largest component need not be compared with each other: all others meet everything, in pairs of
    blocks of about ``BLOCK_ELEMENTS`` shingles that are tasks of their own. Small groups share a task.
    """
    placed = store(
        members.join(roots, "node", "left").select("entry", "node", F.coalesce("root", "node").alias("root")),
        "jaccard-members",
    )
    open_entries = store(
        placed.groupBy("entry").agg(F.min("root").alias("group"), F.max("root").alias("hi"))
        .where(F.col("group") != F.col("hi")).select("entry", "group"),
        "jaccard-open",
    )
    grouped = store(
        placed.join(open_entries, "entry").select("group", "node", "root").distinct().join(
            nodes.select("node", "n_shingles", "histogram"), "node"
        ),
        "jaccard-groups",
    )
    parts = grouped.groupBy("group", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    blocks = lambda weight: F.greatest(F.ceil(weight / F.lit(float(BLOCK_ELEMENTS))), F.lit(1)).cast("int")
    shape = store(
        parts.groupBy("group").agg(
            F.max(F.struct("n", "root", "weight")).alias("main"), F.sum("weight").alias("weight")
        ).select(
            "group", F.col("main.root").alias("main"), "weight",
            blocks(F.col("weight") - F.col("main.weight")).alias("n_rest"), blocks(F.col("main.weight")).alias("n_blocks_main"),
        ),
        "jaccard-shape",
    )
    small = (F.col("n_rest") == 1) & (F.col("n_blocks_main") == 1)
    weight = shape.agg(F.sum(F.when(small, F.col("weight")))).first()[0] or 0
    n_tasks = int(weight) // TASK_ELEMENTS + 1
    rest = F.col("root") != F.col("main")
    n_all = F.col("n_rest") + F.col("n_blocks_main")
    rows = grouped.join(shape, "group").withColumn(
        "block",
        F.when(rest, F.pmod(F.xxhash64("node"), F.col("n_rest"))).otherwise(
            F.col("n_rest") + F.pmod(F.xxhash64("node"), F.col("n_blocks_main"))
        ).cast("int"),
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(rest, n_all - 1).otherwise(F.col("n_rest") - 1))))
    # two blocks of a small group: its rest with itself, and with the largest component
    ends = [F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj")]
    tasks = rows.select(
        "group", "node", "root", "n_shingles", "histogram", "block", *ends,
        F.when(small, F.pmod(F.xxhash64("group"), F.lit(n_tasks))).otherwise(
            F.xxhash64("group", F.least("block", "other"), F.greatest("block", "other"))
        ).alias("task"),
    )
    # most groups share an entry by chance: what the bounds rule out needs no whole set
    near = store(
        tasks.groupBy("task").applyInArrow(_prospects, "group binary, node binary").distinct(), "jaccard-prospects"
    )
    sets = store(_sets_of(docs, near.select("node").distinct()), "jaccard-sets")
    slim = tasks.select("group", "node", "root", "block", "bi", "bj", "task").join(near, ["group", "node"], "left_semi")
    return store(slim.join(sets, "node").groupBy("task").applyInArrow(_across, "a binary, b binary"), "jaccard-more")


# -- the join --------------------------------------------------------------------------------------


def link_documents(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``_row`` (the columns ``keep``), ``n_shingles, node, root``: documents of one root are linked, directly or not."""
    prepare(docs.sparkSession)
    inner = docs.select(F.struct(*map(col, keep)).alias("_row"), F.col("text").alias("_text"))
    described = T.StructType([
        inner.schema["_row"], T.StructField("n_shingles", T.LongType()), T.StructField("node", T.BinaryType()),
        T.StructField("histogram", T.BinaryType()),
    ])
    slim = store(inner.mapInArrow(_describe, described), "jaccard-documents")
    nodes = store(
        slim.where(F.col("node").isNotNull()).groupBy("node").agg(
            F.first("n_shingles").alias("n_shingles"), F.first("histogram").alias("histogram")
        ),
        "jaccard-nodes",
    )
    total = nodes.agg(F.sum("n_shingles")).first()[0] or 0
    # about 0.55 entries per shingle
    buckets = max(1, -(-int(total * 0.55) // BUCKET_ENTRIES))
    found = store(
        docs.select("text").mapInArrow(
            _index(buckets), "bucket int, names binary, place binary, nodes binary, sizes binary"
        ).groupBy("bucket").applyInArrow(_candidates, "entry long, a binary, b binary"),
        "jaccard-candidates",
    )
    first = verify(found.where("entry is null").select("a", "b").distinct(), nodes, docs, "jaccard-links")
    roots = store(components(first, "jaccard-roots"), "jaccard-first")
    members = found.where("entry is not null").select("entry", F.col("a").alias("node"))
    more = across_components(members, roots, nodes, docs)
    roots = components(first.unionByName(more), "jaccard-roots")
    return slim.drop("histogram").join(roots, "node", "left").select(
        "_row", "n_shingles", "node", F.coalesce("root", "node").alias("root")
    )


def similar_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    linked = link_documents(docs, ["doc_id"]).select(F.col("_row.doc_id").alias("doc_id"), "n_shingles", "root")
    least = linked.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component_id"))
    joined = linked.join(least, "root", "left")
    return joined.select(
        "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _copies(linked: DataFrame) -> DataFrame:
    """``_tie, _rest, keep`` of the rows that a component may lose: all but its first, and its first too if rows equal that one."""
    rows = store(
        linked.where(F.col("root").isNotNull()).groupBy("root", "_row").agg(F.count("*").alias("n")), "jaccard-named"
    )
    first = F.struct(F.col("_row.doc_id").isNull(), "_row.doc_id", "_row._tie", "_row._rest")
    chosen = rows.groupBy("root").agg(F.min_by(F.struct("_row._tie", "_row._rest"), first).alias("best"))
    keep = (F.col("_row._tie") == F.col("best._tie")) & (F.col("_row._rest") == F.col("best._rest"))
    return rows.join(chosen, "root").select("_row._tie", "_row._rest", keep.alias("keep"), "n").where(
        ~F.col("keep") | (F.col("n") > 1)
    ).drop("n")


def _with_doubt(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Add ``_doubt``: true for all rows whose ``_tie, _rest`` are named and for some others, by a table of bits of bounded size."""
    bits, n = 1 << 16, named.count()
    while bits < min(MAX_DOUBT_BITS, 32 * n):
        bits *= 2
    bit = F.pmod(F.xxhash64("_tie", "_rest"), F.lit(bits))
    cells = named.select(bit.alias("_bit")).groupBy(F.expr("_bit div 64").alias("_cell")).agg(
        F.expr("bit_or(shiftleft(1L, cast(_bit % 64 as int)))").alias("_value")
    )
    met = rows.withColumn("_bit", bit).withColumn("_cell", F.expr("_bit div 64")).join(F.broadcast(cells), "_cell", "left")
    filled = F.expr("shiftrightunsigned(_value, cast(_bit % 64 as int)) & 1L") == 1
    return met.withColumn("_doubt", F.coalesce(filled, F.lit(False))).drop("_bit", "_cell", "_value")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: that of the smallest ``doc_id``.

    Documents without words are no copies of each other and stay, whole. ``docs`` is read several times and must read alike:
    its texts are neither stored nor, but for those of the copies, shuffled. Rows are named by a hash of the text and one of the rest.
    """
    names = [F.xxhash64("text").alias("_tie"), row_hash(docs).alias("_rest")]
    with passing_tables() as passing:
        linked = link_documents(docs.select("doc_id", "text", *names), ["doc_id", "_tie", "_rest"])
        copies = store(_copies(linked), "jaccard-copies")
    # the names of the copies are what is left of the join; its tables are read no more
    for folder in passing[:-1]:
        files.remove_folder(folder)
    rows = _with_doubt(docs.select(F.struct(*map(col, docs.columns)).alias("_row"), *names), copies)
    doubt = F.col("_doubt") & F.coalesce(F.col("_row.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # of equal rows with words one stays at most
    single = rows.where(doubt).dropDuplicates(["_tie", "_rest"])
    left = rows.where(~doubt).select("_row").unionByName(
        single.join(copies.where(~F.col("keep")), ["_tie", "_rest"], "left_anti").select("_row")
    )
    return left.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))
