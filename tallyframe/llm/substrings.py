"""Repeated word sequences across documents, found by recompression.

A text is a sequence of word names. Rounds rename it: first every run of equal symbols becomes one symbol, then every
neighbouring pair whose left symbol is of the one kind and whose right symbol is of the other. Names and kinds are hashes
of what a symbol stands for, so all tasks name equal runs and pairs alike. What a symbol looks like depends on a few
neighbours only; the words it depends on are its *reach*. Two equal stretches of words therefore hold the same symbols
wherever the whole reach lies inside.

Each window of ``WINDOW`` words takes as its anchor the symbol of the highest round whose reach it holds (the smallest
name if there are several), or itself if it holds none. Equal windows have equal anchors. Spark joins anchors over all
documents; windows whose anchor stands in one document alone cannot repeat elsewhere. The others are verified: their
own hashes are joined, which gives the smallest document of each window.

Windows are told apart by 96 bits of hash. Both joins move distinct names per batch of documents, so a passage of a
third of all documents costs one entry per batch. A batch is a partition of the input.

Defined cases: a null or empty text has no words and keeps none; a text of fewer words than a window loses nothing;
rows of one identifier are separate documents of which neither is smaller; a null identifier counts as the largest;
an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import exchange as ex
from tallyframe.llm.common import U64, mix, prepare, ranges, span_hash, text_bytes, u64, window_hash, words

WINDOW = 13
ROUNDS = 3
TEXT_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max
FAR = 1 << 40


def rename(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per round the symbols' names and reach: ``name, first word, word after the last``."""
    n = len(names)
    low, high = np.arange(n, dtype=np.int64), np.arange(1, n + 1, dtype=np.int64)
    out = []
    for level in range(rounds):
        if not len(names):
            break
        # runs
        same = (names[1:] == names[:-1]) & (doc[1:] == doc[:-1])
        head = np.flatnonzero(np.append(True, ~same))
        tail = np.append(head[1:], len(names)) - 1
        size = (tail - head + 1).astype(U64)
        # a symbol is a whole run only if both neighbours are seen to differ
        first = np.append(True, doc[head][1:] != doc[head][:-1])
        last = np.append(doc[tail][1:] != doc[tail][:-1], True)
        run_low = np.where(first, -FAR, low[np.maximum(head - 1, 0)])
        run_high = np.where(last, FAR, high[np.minimum(tail + 1, len(names) - 1)])
        names = np.where(size > U64(1), mix(names[head] * u64(0x9FB21C651E98DF25) + size), names[head])
        doc, low, high = doc[head], run_low, run_high
        # pairs
        kind = (mix(names + u64(0x632BE59BD9B4E019 * (level + 1))) & U64(1)).astype(bool)
        joined = np.append(~kind[:-1] & kind[1:] & (doc[1:] == doc[:-1]), False)
        second = np.append(False, joined[:-1])
        left = np.append(True, doc[1:] != doc[:-1])
        right = np.append(doc[1:] != doc[:-1], True)
        before = np.where(left, -FAR, np.append(0, low[:-1]))
        after = np.where(right, FAR, np.append(high[1:], 0))
        pair = mix(names * u64(0xD6E8FEB86659FD93) + mix(np.append(names[1:], U64(0)) + u64(level + 1)))
        # a symbol that could be the right one of a pair depends on its left neighbour, and the other way round
        new_low = np.where(joined, low, np.where(kind, np.minimum(before, low), low))
        new_high = np.where(joined, np.append(high[1:], 0), np.where(kind, high, np.maximum(after, high)))
        keep = ~second
        names = np.where(joined, pair, names)[keep]
        low, high, doc = new_low[keep], new_high[keep], doc[keep]
        out.append((names, low, high))
    return out


def anchors(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every window and the name of its anchor."""
    sizes = np.diff(first)
    starts = ranges(first[:-1], np.maximum(sizes - WINDOW + 1, 0))
    best = np.zeros(len(names), dtype=U64)
    done = np.ones(len(names), dtype=bool)
    done[starts] = False
    doc = np.repeat(np.arange(len(sizes)), sizes)
    weights = np.cumprod(np.full(len(names) + 1, u64(0xA0761D6478BD642F | 1), dtype=U64))
    inverse = np.cumprod(np.full(len(names) + 1, u64(pow(0xA0761D6478BD642F | 1, -1, 1 << 64)), dtype=U64))
    sums = np.concatenate([[U64(0)], np.cumsum(names * weights[:-1])]).astype(U64)
    for level, (symbol, low, high) in reversed(list(enumerate(rename(names, doc)))):
        near = np.flatnonzero((high - low <= WINDOW) & (low >= 0))
        lo, hi = low[near], high[near]
        # the words of the reach belong to the name: it tells more passages apart
        key = mix((sums[hi] - sums[lo]) * inverse[lo] + mix(symbol[near] + u64(level)))
        found = np.full(len(names), np.iinfo(np.uint64).max, dtype=U64)
        for back in range(WINDOW):
            at = lo - back
            fit = np.flatnonzero((hi - at <= WINDOW) & (at >= 0))
            at = at[fit]
            inside = ~done[at]
            np.minimum.at(found, at[inside], key[fit][inside])
        new = found != np.iinfo(np.uint64).max
        best[new] = found[new]
        done |= new
    left = np.flatnonzero(~done)
    if len(left):
        best[left] = window_hash(names, WINDOW, 29)[left]
    return starts, best[starts]


def _distinct(names: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct names and whether each stands in more than one document."""
    new = np.append(True, (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])) if len(names) else np.zeros(0, dtype=bool)
    names, doc = names[new], doc[new]
    order = np.argsort(names, kind="stable")
    names, doc = names[order], doc[order]
    head = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(names) else np.zeros(0, dtype=np.int64)
    tail = np.append(head[1:], len(names)) - 1
    # documents stand in ascending places, so a name of one document has it at both ends
    return names[head], doc[head] != doc[tail] if len(head) else np.zeros(0, dtype=bool)


def _named(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = text_bytes(batch.column("text"))
    starts, ends, first = words(data, offsets)
    return data, starts, ends, first, span_hash(data, starts, ends)


def _ask_anchors(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in ex.batch_runs(batches, TEXT_BYTES):
            _, _, _, first, names = _named(batch)
            at, anchor = anchors(names, first)
            distinct, several = _distinct(anchor, np.searchsorted(first, at, side="right") - 1)
            rows = ex.bucket_rows(number, distinct, {"several": several.astype(np.uint8)}, buckets)
            if rows is not None:
                yield rows

    return ask


def _shared_anchors(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tell every batch which of its anchors stand in two documents or more."""
    who, sizes, got = ex.gathered(parts, {"names": "<u8", "several": "u1"})
    order = np.argsort(got["names"], kind="stable")
    names = got["names"][order]
    head = np.append(True, names[1:] != names[:-1])
    group = np.cumsum(head) - 1
    # rows of a bucket come from different documents
    shared = (np.bincount(group) > 1) | (np.bincount(group, weights=got["several"][order]) > 0)
    told = order[shared[group]]
    yield from ex.replies(np.repeat(who, sizes)[told], got["names"][told], {})


_WINDOW_KINDS = {"names": "<u8", "check": "<u4", "least": "<i8"}


def _doc_ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy()


def _ask_windows(folder: str, buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ex.Answers(folder, {"names": "<u8"})
        for number, batch in ex.batch_runs(batches, TEXT_BYTES):
            _, _, _, first, names = _named(batch)
            at, anchor = anchors(names, first)
            _, hit = ex.look_up(known.of(number)["names"], anchor)
            at = at[hit]
            if not len(at):
                continue
            ids = _doc_ids(batch)[np.searchsorted(first, at, side="right") - 1]
            window, check = window_hash(names, WINDOW, 1)[at], window_hash(names, WINDOW, 2)[at].astype(np.uint32)
            order = np.lexsort((ids, check, window))
            window, check, ids = window[order], check[order], ids[order]
            head = np.append(True, (window[1:] != window[:-1]) | (check[1:] != check[:-1]))
            tail = np.append(np.flatnonzero(head)[1:], len(window)) - 1
            several = ids[head] != ids[tail]
            rows = ex.bucket_rows(
                number, window[head], {"check": check[head], "least": ids[head], "several": several.astype(np.uint8)}, buckets
            )
            if rows is not None:
                yield rows

    return ask


def _least_documents(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tell every batch the smallest document of each of its windows, where that is smaller than one of its own."""
    who, sizes, got = ex.gathered(parts, _WINDOW_KINDS | {"several": "u1"})
    order = np.lexsort((got["check"], got["names"]))
    names, check, least = got["names"][order], got["check"][order], got["least"][order]
    head = np.append(True, (names[1:] != names[:-1]) | (check[1:] != check[:-1]))
    start = np.flatnonzero(head)
    group = np.cumsum(head) - 1
    smallest = np.minimum.reduceat(least, start)[group]
    told = np.flatnonzero((smallest < least) | (got["several"][order] > 0))
    yield from ex.replies(
        np.repeat(who, sizes)[order][told], names[told], {"check": check[told], "least": smallest[told]}
    )


def _look_up(answers: dict[str, np.ndarray], window: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each window in the answers, and whether it is there; entries of one name differ in their check."""
    place, met = ex.look_up(answers["names"], window)
    todo = np.flatnonzero(met)
    todo = todo[answers["check"][place[todo]] != check[todo]]
    while len(todo):
        place[todo] = np.minimum(place[todo] + 1, len(answers["names"]) - 1)
        same = answers["names"][place[todo]] == window[todo]
        hit = same & (answers["check"][place[todo]] == check[todo])
        ended = ~same | (~hit & (place[todo] == len(answers["names"]) - 1))
        met[todo[ended]] = False
        todo = todo[~hit & ~ended]
    return place, met


def _strip(folder: str):
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ex.Answers(folder, _WINDOW_KINDS)
        for number, batch in ex.batch_runs(batches, TEXT_BYTES):
            data, starts, ends, first, names = _named(batch)
            sizes = np.diff(first)
            at = ranges(first[:-1], np.maximum(sizes - WINDOW + 1, 0))
            doc = np.searchsorted(first, at, side="right") - 1
            answers = known.of(number)
            window, check = window_hash(names, WINDOW, 1)[at], window_hash(names, WINDOW, 2)[at].astype(np.uint32)
            place, met = _look_up(answers, window, check)
            repeated = np.zeros(len(at), dtype=bool)
            if met.any():
                repeated[met] = answers["least"][place[met]] < _doc_ids(batch)[doc[met]]
            marks = np.zeros(len(names) + 1, dtype=np.int64)
            marks[: len(names)] += np.bincount(at[repeated], minlength=len(names))[: len(names)]
            marks -= np.bincount(at[repeated] + WINDOW, minlength=len(names) + 1)
            kept = np.cumsum(marks[:-1]) == 0
            left = np.flatnonzero(kept)
            lengths = ends[left] - starts[left] + 1
            padded = np.append(data, np.uint8(32))
            out = padded[ranges(starts[left], lengths)]
            out[np.cumsum(lengths) - 1] = 32
            upto = np.append(0, np.cumsum(lengths))[np.searchsorted(left, first)]
            raw = out.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes.astype(np.int64)),
                    pa.array((sizes - np.diff(np.append(0, np.cumsum(kept))[first])).astype(np.int64)),
                    pa.array([
                        raw[a : b - 1].decode("utf-8", "surrogatepass") if b > a else ""
                        for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)
                    ], pa.large_string()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "text"],
            )

    return strip


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, text``: the words that no window of a smaller document covers, blank between."""
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    stored = ex.with_batches(docs.select("doc_id", "text"), "substring-documents")
    # a word and its blank take about six characters; a sixth of the windows bring a new anchor
    characters = stored.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = ex.n_buckets(characters // 24)
    request = "bucket int, batch int, names binary, several binary"
    shared = stored.mapInArrow(_ask_anchors(buckets), request).groupBy("bucket").applyInArrow(
        _shared_anchors, "batch int, names binary"
    )
    folder = ex.deliver(shared, {"names": "<u8"}, "substring-anchors")
    request = "bucket int, batch int, names binary, check binary, least binary, several binary"
    least = stored.mapInArrow(_ask_windows(folder, buckets), request).groupBy("bucket").applyInArrow(
        _least_documents, "batch int, names binary, check binary, least binary"
    )
    folder = ex.deliver(least, _WINDOW_KINDS, "substring-windows")
    return stored.mapInArrow(_strip(folder), f"doc_id {kind}, n_words long, n_removed long, text string")

