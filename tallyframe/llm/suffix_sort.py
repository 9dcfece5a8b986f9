"""Repeated byte strings, found by a distributed merge sort of suffixes that knows their common prefixes.

A string of ``window`` bytes that stands in two places makes the suffixes there neighbours in a suffix array. Not every
suffix is needed: each window has an anchor, the first of its leading positions whose eight bytes have the least hash. Equal
windows have their anchors at the same place, so the suffixes at anchors do (one in 64 positions at the default width).
The windows of one anchor start at neighbouring positions; what they cover together is the anchor's *scope*.

1. **Distinguishing prefixes.** All windows of an anchor hold the ``right`` bytes from the anchor on. Spark counts the names
   of these prefixes; a suffix whose prefix occurs once has no equal window and travels no further.
2. **Sorted runs.** A stretch of text (some megabytes) sorts its remaining suffixes. They are read in pieces, named by 64-bit
   hashes, with the name of the scope as the last piece. Equal suffixes of a run become one. Runs are cut by ranges of the
   first piece and travel front-coded: the number of pieces shared with the suffix before, and the other pieces.
3. **Merge.** The runs of a range meet in a loser tree. Every suffix carries the number of pieces it shares with the last one
   put out; if two differ in it, the one that shares more is the smaller and no piece is looked at, otherwise comparison starts
   behind the shared pieces. The common prefixes of neighbours come out with the order. Neighbours that share all pieces
   have the same scope: all its windows are repeated. Neighbours that share the prefix only (at the edges of a passage)
   have some windows in common.
4. **Edges.** Only the windows of such suffixes are named one by one and counted, which decides them.

A prefix with more than ``HOT`` occurrences skips the sort, as its suffixes would meet in one task, and is decided
by its windows, whose names cost one entry per stretch. The result is the same. Names of pieces, prefixes and scopes have 64 bits,
those of windows 96; among 10^9 scopes two share a name with a probability of 3 %.

Defined cases: a null or empty text has no bytes; a text shorter than the window loses nothing; windows never cross
documents; a text of any length is one unit of its stretch; rows of equal text or identifier, and null identifiers, are
documents of their own, so repeated rows lose all windows; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import exchange as ex
from tallyframe.llm.common import U64, mix, prepare, ranges, rechunk, store, text_bytes, u64

WINDOW = 400
PIECES = 7
# text bytes of a stretch
STRETCH = 4 << 20
# suffixes that a range of the merge is meant to hold
RANGE = 50_000
# occurrences of a prefix beyond which its windows decide
HOT = 1_000_000

_BASES = (u64(0xA0761D6478BD642F), u64(0xE7037ED1A0B428DB))
_LOW = U64(0xFFFFFFFF)
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(base: int, inverse: bool, n: int) -> np.ndarray:
    """Powers of a base (or of its inverse) up to ``n``; kept for the next stretch."""
    held = _powers.get((base, inverse))
    if held is None or len(held) <= n:
        b = int(_BASES[base])
        step = u64(pow(b, -1, 1 << 64)) if inverse else _BASES[base]
        held = np.cumprod(np.append(U64(1), np.full(n, step, dtype=U64)))
        _powers[base, inverse] = held
    return held


class Stretch:
    """Bytes of some documents, their anchors, and names of any span of bytes."""

    def __init__(self, texts: pa.Array, window: int):
        self.data, self.offsets = text_bytes(texts)
        self.window, n = window, len(self.data)
        # leading positions of a window that can hold its anchor
        self.width = max(1, window * 8 // 25)
        self.right = window - self.width + 1
        self.sums: dict[int, np.ndarray] = {}
        starts = ranges(self.offsets[:-1], np.maximum(np.diff(self.offsets) - window + 1, 0))
        if not len(starts):
            self.at = self.low = self.high = starts
            return
        padded = np.append(self.data, np.zeros(8, dtype=np.uint8))
        grams = mix(np.ndarray((n,), dtype="<u8", buffer=padded, strides=(1,)) + U64(0x51ED270B2F1A3C57))
        least = (grams & ~_LOW) | np.arange(n, dtype=U64)
        span = 1
        while 2 * span <= self.width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = self.width - span
        if rest:
            least = np.minimum(least[: len(least) - rest], least[rest:])
        anchor = (least[starts] & _LOW).astype(np.int64)
        head = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)))
        self.at, self.low, self.high = anchor[head], starts[head], starts[np.append(head[1:], len(starts)) - 1]

    def names(self, a: np.ndarray, b: np.ndarray, base: int = 0) -> np.ndarray:
        """Hashes of the bytes from ``a`` to ``b``."""
        if base not in self.sums:
            values = mix(self.data.astype(U64) + U64(77 + base)) * _power(base, False, len(self.data))[: len(self.data)]
            self.sums[base] = np.append(U64(0), np.cumsum(values))
        total = (self.sums[base][b] - self.sums[base][a]) * _power(base, True, len(self.data))[a]
        return mix(total + mix((b - a).astype(U64)))

    def prefixes(self) -> np.ndarray:
        return self.names(self.at, self.at + self.right)

    def scopes(self, some: np.ndarray) -> np.ndarray:
        low, high = self.low[some], self.high[some] + self.window
        return mix(self.names(low, high) + mix((self.at[some] - low).astype(U64) + U64(1)))

    def suffixes(self, some: np.ndarray) -> np.ndarray:
        """One row per suffix: the names of its pieces and of its scope."""
        cuts = self.right * np.arange(PIECES + 1) // PIECES
        at = self.at[some]
        return np.column_stack([*(self.names(at + a, at + b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)), self.scopes(some)])

    def windows(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, name and check of every window of the given anchors."""
        p = ranges(self.low[some], self.high[some] - self.low[some] + 1)
        return p, self.names(p, p + self.window), self.names(p, p + self.window, 1).astype(np.uint32)


def _with_stretches(stretch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in rechunk(batches, stretch):
            number += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(np.full(batch.num_rows, number))], names=["doc_id", "text", "batch"]
            )

    return run


def _stretches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[int, pa.RecordBatch, Stretch]]:
    for number, batch in ex.batch_runs(batches, 1 << 40):
        yield number, batch, Stretch(batch.column("text"), window)


# -- 1. prefixes that occur more than once ----------------------------------------------------------


def _ask_prefixes(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, text in _stretches(batches, window):
            names, counts = np.unique(text.prefixes(), return_counts=True)
            rows = ex.bucket_rows(number, names, {"counts": counts.astype("<i8")}, buckets, pa.int64())
            if rows is not None:
                yield rows

    return run


_PREFIX = {"names": "<u8", "hot": "u1"}


def _repeated_prefixes(hot: int):
    def run(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, sizes, got = ex.gathered(parts, {"names": "<u8", "counts": "<i8"})
        order = np.argsort(got["names"], kind="stable")
        names, who = got["names"][order], np.repeat(who, sizes)[order]
        head = np.append(True, names[1:] != names[:-1])
        total = np.add.reduceat(got["counts"][order], np.flatnonzero(head))[np.cumsum(head) - 1]
        told = total > 1
        yield from ex.replies(who[told], names[told], {"hot": (total[told] > hot).astype(np.uint8)}, pa.int64())

    return run


def _candidates(text: Stretch, answers: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Anchors whose prefix is repeated: those to sort, and those of hot prefixes."""
    at, hit = ex.look_up(answers["names"], text.prefixes())
    hot = hit.copy()
    hot[hit] = answers["hot"][at[hit]] > 0
    return np.flatnonzero(hit & ~hot), np.flatnonzero(hot)


# -- 2. sorted runs --------------------------------------------------------------------------------


def _sorted_runs(window: int, folder: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ex.Answers(folder, _PREFIX)
        for number, _, text in _stretches(batches, window):
            some, _ = _candidates(text, known.of(number))
            if not len(some):
                continue
            rows = text.suffixes(some)
            rows = rows[np.lexsort(rows.T[::-1])]
            same = rows[1:] == rows[:-1]
            shared = np.append(0, np.where(same.all(axis=1), PIECES + 1, np.argmin(same, axis=1)))
            # equal suffixes become one
            head = np.flatnonzero(shared <= PIECES)
            several = np.diff(np.append(head, len(rows))) > 1
            rows, shared = rows[head], shared[head]
            cuts = ex.bucket_cuts(rows[:, 0], buckets)
            out = []
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = cuts[k], cuts[k + 1]
                lcp = shared[a:b].copy()
                lcp[0] = 0
                left = np.arange(PIECES + 1) >= lcp[:, None]
                out.append((k, number, rows[a:b][left].tobytes(), lcp.astype(np.uint8).tobytes(), several[a:b].astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _RUN.types, strict=True)], schema=_RUN
            )

    return run


_RUN = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("pieces", pa.binary()), ("shared", pa.binary()), ("several", pa.binary())])


# -- 3. merge --------------------------------------------------------------------------------------


def merge_runs(runs: list[tuple[list[int], list[int]]], width: int) -> Iterator[tuple[int, int, int]]:
    """Merge front-coded sorted runs (``shared`` counts, remaining pieces) with a loser tree.

    Yields the run of each row in order, the number of pieces it shares with the row before, and its last piece.
    """
    size = 1 << max(0, len(runs) - 1).bit_length()
    rows: list[list[int] | None] = [None] * size
    # pieces in common with the last row put out (while building: with nothing)
    known = [0] * size
    place, pos = [0] * size, [0] * size

    def advance(r: int) -> None:
        shared, pieces = runs[r] if r < len(runs) else ((), ())
        if place[r] == len(shared):
            rows[r] = None
            return
        keep = known[r] = shared[place[r]]
        end = pos[r] + width - keep
        rows[r] = (rows[r] or [])[:keep] + pieces[pos[r] : end]
        place[r] += 1
        pos[r] = end

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser then knows what it shares with the winner."""
        x, y = rows[a], rows[b]
        if x is None or y is None:
            return (a, b) if y is None else (b, a)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        d = known[a]
        while d < width and x[d] == y[d]:
            d += 1
        won = (a, b) if d == width or x[d] < y[d] else (b, a)
        known[won[1]] = d
        return won

    for r in range(size):
        advance(r)
    losers, winners = [0] * size, [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    winner = winners[1]
    while rows[winner] is not None:
        yield winner, known[winner], rows[winner][-1]
        advance(winner)
        node = (size + winner) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


_SCOPE = {"names": "<u8", "whole": "u1", "edge": "u1"}


def _merge(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tell every stretch which of its scopes are repeated as a whole, and which have windows to look at."""
    who, runs, flags = [], [], []
    for part in parts:
        who += part.column("batch").to_pylist()
        for pieces, shared, several in zip(*(part.column(c).to_pylist() for c in ("pieces", "shared", "several")), strict=True):
            runs.append((list(shared), np.frombuffer(pieces, dtype="<u8").tolist()))
            flags.append(np.frombuffer(several, dtype=np.uint8))
    merged = list(merge_runs(runs, PIECES + 1))
    run = np.array([m[0] for m in merged])
    shared = np.array([m[1] for m in merged])
    names = np.array([m[2] for m in merged], dtype=U64)
    # rows of a run come out in its own order
    several = np.zeros(len(run), dtype=np.uint8)
    several[np.argsort(run, kind="stable")] = np.concatenate(flags)
    scope = np.cumsum(shared <= PIECES) - 1
    group = np.cumsum(shared < PIECES) - 1
    whole = (np.bincount(scope) + np.bincount(scope, weights=several))[scope] > 1
    edge = np.bincount(group, weights=shared <= PIECES)[group] > 1
    told = np.flatnonzero(whole | edge)
    yield from ex.replies(
        np.array(who, dtype=np.int64)[run[told]], names[told],
        {"whole": whole[told].astype(np.uint8), "edge": edge[told].astype(np.uint8)}, pa.int64(),
    )


# -- 4. windows at the edges -----------------------------------------------------------------------


def _decided(text: Stretch, prefixes: dict[str, np.ndarray], scopes: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Anchors whose windows are all repeated, and those whose windows are to be looked up."""
    some, hot = _candidates(text, prefixes)
    at, hit = ex.look_up(scopes["names"], text.scopes(some))
    some, at = some[hit], at[hit]
    return some[scopes["whole"][at] > 0], np.append(some[scopes["edge"][at] > 0], hot)


def _ask_windows(window: int, by_prefix: str, by_scope: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes, scopes = ex.Answers(by_prefix, _PREFIX), ex.Answers(by_scope, _SCOPE)
        for number, _, text in _stretches(batches, window):
            _, edge = _decided(text, prefixes.of(number), scopes.of(number))
            if not len(edge):
                continue
            _, names, check = text.windows(edge)
            order = np.lexsort((check, names))
            names, check = names[order], check[order]
            head = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (check[1:] != check[:-1])))
            several = (np.diff(np.append(head, len(names))) > 1).astype(np.uint8)
            yield ex.bucket_rows(number, names[head], {"check": check[head], "several": several}, buckets, pa.int64())

    return run


_WINDOW = {"names": "<u8", "check": "<u4"}


def _repeated_windows(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    who, sizes, got = ex.gathered(parts, _WINDOW | {"several": "u1"})
    order = np.lexsort((got["check"], got["names"]))
    names, check, who = got["names"][order], got["check"][order], np.repeat(who, sizes)[order]
    group = np.cumsum(np.append(True, (names[1:] != names[:-1]) | (check[1:] != check[:-1]))) - 1
    told = (np.bincount(group) + np.bincount(group, weights=got["several"][order]))[group] > 1
    yield from ex.replies(who[told], names[told], {"check": check[told]}, pa.int64())


def _strip(window: int, by_prefix: str, by_scope: str, by_window: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes, scopes, windows = ex.Answers(by_prefix, _PREFIX), ex.Answers(by_scope, _SCOPE), ex.Answers(by_window, _WINDOW)
        for number, batch, text in _stretches(batches, window):
            whole, edge = _decided(text, prefixes.of(number), scopes.of(number))
            p, names, check = text.windows(edge)
            hit = _member(windows.of(number), names, check)
            n = len(text.data)
            marks = np.bincount(np.append(text.low[whole], p[hit]), minlength=n + 1).astype(np.int64)
            marks -= np.bincount(np.append(text.high[whole], p[hit]) + window, minlength=n + 1)
            gone = np.cumsum(marks)[:n] > 0
            head = gone & ~np.append(False, gone[:-1])
            firsts = text.offsets[:-1][text.offsets[:-1] < n]
            head[firsts] = gone[firsts]
            removed = np.diff(np.append(0, np.cumsum(gone))[text.offsets])
            upto = np.append(0, np.cumsum(~gone))[text.offsets]
            kept = text.data[~gone].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(np.diff(text.offsets)), pa.array(removed),
                    pa.array(np.diff(np.append(0, np.cumsum(head))[text.offsets])),
                    pa.array([kept[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)], pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def _member(answers: dict[str, np.ndarray], names: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Whether each window is among the answers, by name and check."""
    low = np.searchsorted(answers["names"], names, side="left")
    size = np.searchsorted(answers["names"], names, side="right") - low
    met = np.zeros(len(names), dtype=bool)
    for k in range(int(size.max(initial=0))):
        more = np.flatnonzero(size > k)
        met[more] |= answers["check"][low[more] + k] == check[more]
    return met


def remove_repeats(docs: DataFrame, window: int = WINDOW, stretch: int = STRETCH, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: the bytes that no repeated string of ``window`` bytes covers."""
    prepare(docs.sparkSession)
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    columns = docs.select("doc_id", "text")
    stored = store(columns.mapInArrow(_with_stretches(stretch), f"doc_id {doc_id}, text string, batch long"), "suffix-documents")
    size = stored.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = max(1, window * 8 // 25)
    suffixes = 2 * size // (width + 1)
    asked = stored.mapInArrow(_ask_prefixes(window, ex.n_buckets(suffixes)), "bucket int, batch long, names binary, counts binary")
    told = asked.groupBy("bucket").applyInArrow(_repeated_prefixes(hot), "batch long, names binary, hot binary")
    by_prefix = ex.deliver(told, _PREFIX, "suffix-prefixes")
    # about a third of all suffixes are left
    runs = stored.mapInArrow(
        _sorted_runs(window, by_prefix, max(1, suffixes // 3 // RANGE)), "bucket int, batch long, pieces binary, shared binary, several binary"
    )
    merged = runs.groupBy("bucket").applyInArrow(_merge, "batch long, names binary, whole binary, edge binary")
    by_scope = ex.deliver(merged, _SCOPE, "suffix-scopes")
    asked = stored.mapInArrow(
        _ask_windows(window, by_prefix, by_scope, ex.n_buckets(size // 16)), "bucket int, batch long, names binary, check binary, several binary"
    )
    told = asked.groupBy("bucket").applyInArrow(_repeated_windows, "batch long, names binary, check binary")
    by_window = ex.deliver(told, _WINDOW, "suffix-windows")
    return stored.mapInArrow(
        _strip(window, by_prefix, by_scope, by_window), f"doc_id {doc_id}, n_bytes long, n_removed long, n_spans long, kept binary"
    )
