"""Language-model scores from a class-based bigram model (Brown et al.).

The probability of a token after another is P(its class | class of the other) * P(token | its class).

* Counts. Every distinct word of every training text is counted, whatever their number.
* Classes. A word starts in the class of its spelling, a hash of its last two bytes. Every word that occurs
  ``MIN_COUNT`` times in the training texts is then exchanged between classes, however many there are: half a turn counts
  the classes beside these words over all training texts, and moves each word of one half of the vocabulary to the class
  under which the observed neighbours are likeliest, one half at a time so that neighbours do not swap places for ever.
  Full turns follow until one raises the log-likelihood of the training texts by less than ``TOLERANCE`` a token; a
  turn that lowers it is undone. The likelihood is bounded, so the exchange ends.
* Smoothing. Transitions are mixed with the frequencies of the classes. In a class the number of its words that were
  seen once is set aside for the words of its spelling never seen, and shared among as many of them as the words seen once and
  twice let expect (Chao's estimate). The result is mixed with the add-one unigram model.

Texts are hashed once for the counts and the turns. Which exchanged words a batch of documents has never changes: each bucket of the
hash range notes once which of its words every batch asked for, each batch gets their names once, and its training tokens are
stored as 32-bit places among them, in flat files that the turns map. A half turn then passes one byte a word from the buckets to a batch, and places and counts of
neighbours back. Tables of a half turn are deleted once the next one is stored. Counts and classes of words travel as arrays, one
row per bucket and asking batch; each batch gets the counts and classes of its own words in a file, and no task holds a table of all words.

Tokens are words with A-Z in lower case and one end per text. A text's first token follows an end. Defined cases: a null or
empty text is an end alone; without any training text every count is 0 and the score is the base score; rows of one
identifier are separate documents; a null identifier is never held out; an empty table gives no row; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import exchange as ex
from tallyframe.llm import files
from tallyframe.llm.common import LOWER, U64, mix, prepare, ranges, remove, span_hash, store, text_bytes, u64, words
from tallyframe.llm.language import held_out
from tallyframe.session import shared_path

CLASSES = 96
# more than 1: words seen once never leave the class of their spelling
MIN_COUNT = 4
# gain of a full turn, in nats a training token, under which the exchange is finished
TOLERANCE = 1e-3
TEXT_BYTES = 4 << 20
# weight of the class frequencies in a transition, as a number of tokens
PRIOR = 4.0
# share of the add-one unigram model
BASE_SHARE = 0.05
END = u64(0x5851F42D4C957F2D)
# the last class holds the end of a text and nothing else
END_CLASS = CLASSES - 1
# exchanged words of a batch, with their places in the bucket; their classes change with every half turn
WORD_KINDS = {"names": "<u8", "at": "<i4"}
CLASS_KINDS = {"classes": "u1"}
ASKED_KINDS = {"batches": "<i4", "sizes": "<i4", "at": "<i4"}
CLASS_ROW = "bucket int, names binary, classes binary"


def read_tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names and spelling classes of all tokens of a batch, and where each document's tokens start."""
    data, offsets = text_bytes(batch.column("text"))
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    sizes = np.diff(first)
    at = ranges(np.cumsum(sizes + 1) - sizes - 1, sizes)
    names = np.full(len(starts) + len(sizes), END, dtype=U64)
    names[at] = span_hash(data, starts, ends)
    spelled = np.full(len(names), END_CLASS, dtype=np.uint8)
    tail = data[ends - 1].astype(U64) if len(ends) else np.zeros(0, dtype=U64)
    tail = np.where(ends - starts > 1, tail * U64(256) + data[np.maximum(ends - 2, 0)], tail) if len(ends) else tail
    spelled[at] = (mix(tail + U64(7)) % U64(END_CLASS)).astype(np.uint8)
    return names, spelled, np.append(0, np.cumsum(sizes + 1))


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in columns), strict=True)


def _ask_counts(buckets: int, most: int = 2_000_000):
    """Per batch the distinct words with their training counts and spelling classes."""

    def merged(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        names, counts, spelled = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(names, kind="stable")
        names, counts, spelled = names[order], counts[order], spelled[order]
        head = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        return names[head], np.add.reduceat(counts, head), spelled[head]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, size = None, 0

        def out() -> pa.RecordBatch | None:
            names, counts, spelled = merged(held)
            return ex.bucket_rows(now, names, {"counts": counts.astype("<i8"), "spelled": spelled}, buckets)

        for number, names, counts, spelled in _rows(batches, "batch", "names", "counts", "spelled"):
            if held and (number != now or size > most):
                yield out()
                held, size = [], 0
            now = number
            names = np.frombuffer(names, dtype=U64)
            held.append((names, np.frombuffer(counts, dtype="<i8"), np.frombuffer(spelled, dtype=np.uint8)))
            size += len(names)
            if len(held) >= 8:
                held = [merged(held)]
                size = len(held[0][0])
        if held:
            yield out()

    return ask


def _add_counts(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per asking batch with the counts of its words, and one of the bucket's whole table."""
    who, sizes, got = ex.gathered(parts, {"names": "<u8", "counts": "<i8", "spelled": "u1"})
    order = np.argsort(got["names"], kind="stable")
    names = got["names"][order]
    head = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
    group = np.cumsum(np.append(True, names[1:] != names[:-1])) - 1
    totals = np.add.reduceat(got["counts"][order], head)
    for row in ex.replies(np.repeat(who, sizes)[order], names, {"counts": totals[group]}):
        yield row.append_column("spelled", pa.array([None], pa.binary()))
    seen = totals > 0
    yield pa.RecordBatch.from_pydict({
        "batch": pa.array([None], pa.int32()), "names": pa.array([names[head][seen].tobytes()], pa.binary()),
        "counts": pa.array([totals[seen].tobytes()], pa.binary()),
        "spelled": pa.array([got["spelled"][order][head][seen].tobytes()], pa.binary()),
    })


@dataclass
class Classes:
    """Exchanged words with their classes, one row per bucket; all other words have the class of their spelling."""

    table: DataFrame
    # full turns that led to them
    turns: int

    @cached_property
    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        rows = self.table.toArrow()
        names = np.frombuffer(b"".join(rows["names"].to_pylist()), dtype=U64)
        classes = np.frombuffer(b"".join(rows["classes"].to_pylist()), dtype=np.uint8)
        order = np.argsort(names)
        return names[order], classes[order]

    @property
    def names(self) -> np.ndarray:
        """All exchanged words on the driver, for inspection; no query reads them there."""
        return self._sorted[0]

    def of(self, names: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        return own_classes(*self._sorted, names, spelled)


def own_classes(known: np.ndarray, classes: np.ndarray, names: np.ndarray, spelled: np.ndarray) -> np.ndarray:
    """Class of each name: that of the sorted known names, or else of its spelling."""
    at, hit = ex.look_up(known, names)
    return np.where(hit, classes[at] if len(known) else 0, spelled).astype(np.int64)


def _ask_classes(buckets: int, most: int = 2_000_000):
    """Per batch its distinct words."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        now, size = None, 0
        for number, names in _rows(batches, "batch", "names"):
            if held and (number != now or size > most):
                yield ex.bucket_rows(now, np.unique(np.concatenate(held)), {}, buckets)
                held, size = [], 0
            now = number
            held.append(np.frombuffer(names, dtype=U64))
            size += len(held[-1])
            if len(held) >= 8:
                held = [np.unique(np.concatenate(held))]
                size = len(held[0])
        if held:
            yield ex.bucket_rows(now, np.unique(np.concatenate(held)), {}, buckets)

    return ask


def _link(folder: str):
    """To each asking batch those of its words that are exchanged; the bucket keeps in files which they are."""

    def link(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(0, dtype=U64)
        asked: dict[int, list[np.ndarray]] = {}
        for batch, names, own in _rows(parts, "batch", "names", "classes"):
            names = np.frombuffer(names, dtype=U64)
            if own is not None:
                known = names
            else:
                asked.setdefault(batch, []).append(names)
        found: list[tuple[int, np.ndarray]] = []
        for batch in sorted(asked):
            # a batch may have asked for a word more than once
            at, hit = ex.look_up(known, np.concatenate(asked.pop(batch)))
            at = np.unique(at[hit]).astype("<i4")
            if len(at):
                found.append((batch, at))
        if not found:
            return
        files.write_flat(f"{folder}/{key[0].as_py():08d}.batches", np.array([b for b, _ in found], dtype="<i4"))
        files.write_flat(f"{folder}/{key[0].as_py():08d}.sizes", np.array([len(at) for _, at in found], dtype="<i4"))
        files.write_flat(f"{folder}/{key[0].as_py():08d}.at", np.concatenate([at for _, at in found]))
        for batch, at in found:
            yield pa.RecordBatch.from_pydict({
                "batch": pa.array([batch], pa.int32()), "names": pa.array([known[at].tobytes()], pa.binary()),
                "at": pa.array([at.tobytes()], pa.binary()),
            })

    return link


def _tell_classes(folder: str):
    """To each batch the classes of its words of a bucket, in the order of their names."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = ex.Answers(folder, ASKED_KINDS)
        for bucket, classes in _rows(batches, "bucket", "classes"):
            own = asked.of(bucket)
            ends = np.cumsum(own["sizes"], dtype=np.int64)
            told = np.frombuffer(classes, dtype=np.uint8)[own["at"]]
            for batch, a, e in zip(own["batches"].tolist(), (ends - own["sizes"]).tolist(), ends.tolist(), strict=True):
                yield pa.RecordBatch.from_pydict({
                    "batch": pa.array([batch], pa.int32()), "bucket": pa.array([bucket], pa.int32()),
                    "classes": pa.array([told[a:e].tobytes()], pa.binary()),
                })

    return tell


def _write_classes(folder: str):
    """One file per batch: buckets are ranges of names, so their classes in turn are those of the sorted names."""

    def write(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(_rows(parts, "bucket", "classes"))
        files.write_flat(f"{folder}/{key[0].as_py():08d}.classes", np.frombuffer(b"".join(c for _, c in rows), dtype=np.uint8))
        yield pa.RecordBatch.from_pydict({"batch": pa.array([key[0].as_py()], pa.int32())})

    return write


class _Stretches:
    """The tokens that a task writes, stretch behind stretch in one flat file."""

    def __init__(self, folder: str):
        self.file, self.out, self.end = f"{folder}/{TaskContext.get().partitionId():08d}.tokens", None, 0

    def add(self, tokens: np.ndarray) -> dict[str, pa.Array]:
        """Write the tokens of a stretch; returns the columns that say where they are."""
        self.out = self.out or files.FlatWriter(self.file)
        self.out.write(tokens.astype("<i4"))
        start, self.end = self.end, self.end + len(tokens)
        return {"file": pa.array([self.file]), "start": pa.array([start], pa.int64()), "n": pa.array([len(tokens)], pa.int64())}

    def close(self) -> None:
        if self.out:
            self.out.close()


STRETCH = "batch int, file string, start long, n long"


def _tokens(folder: str):
    """Distinct words of a stretch of a batch with their training counts, and its training tokens as places among them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = _Stretches(folder)
        for number, batch in ex.batch_runs(batches, TEXT_BYTES):
            names, spelled, first = read_tokens(batch)
            distinct, where, places = np.unique(names, return_index=True, return_inverse=True)
            learnt = np.repeat(~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool), np.diff(first))
            places = places[learnt]
            counts = np.bincount(places, minlength=len(distinct)).astype("<i8")
            yield pa.RecordBatch.from_pydict({"batch": pa.array([number], pa.int32())} | written.add(places) | {
                "names": pa.array([distinct.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary()),
                "spelled": pa.array([spelled[where].tobytes()], pa.binary()),
            })
        written.close()

    return read


def token_table(docs: DataFrame) -> tuple[DataFrame, str]:
    """The stretches of all texts, and the folder that has their training tokens."""
    folder = shared_path(docs.sparkSession, "class-places")
    return store(docs.mapInArrow(_tokens(folder), f"{STRETCH}, names binary, counts binary, spelled binary"), "class-tokens"), folder


def _codes(word_folder: str, folder: str):
    """Training tokens as places among the exchanged words of their batch; behind these, the class of any other word's spelling."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of, written = ex.Answers(word_folder, WORD_KINDS), _Stretches(folder)
        for number, file, start, n, names, spelled in _rows(batches, "batch", "file", "start", "n", "names", "spelled"):
            if not n:
                continue
            known = words_of.of(number)["names"]
            at, hit = ex.look_up(known, np.frombuffer(names, dtype=U64))
            codes = np.where(hit, at, len(known) + np.frombuffer(spelled, dtype=np.uint8).astype(np.int64)).astype("<i4")
            places = files.read_flat(file, "<i4", start, n)
            yield pa.RecordBatch.from_pydict({"batch": pa.array([number], pa.int32())} | written.add(codes[places]))
        written.close()

    return code


NEIGHBOURS = "part int, at binary, sizes binary, cells binary, n binary, many binary, total binary"


def _neighbours(word_folder: str, folder: str, half: int, buckets: int, most: int = 8_000_000):
    """Transitions between classes, and for the words of a half of the vocabulary the classes before and after them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of, classes_of = ex.Answers(word_folder, WORD_KINDS), ex.Answers(folder, CLASS_KINDS)
        matrix = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        pieces: list[np.ndarray] = []
        held, now = 0, None

        def out() -> Iterator[pa.RecordBatch]:
            cells = np.concatenate(pieces)
            cells.sort()
            first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
            n = np.diff(np.append(first, len(cells)))
            cells = cells[first]
            word, cell = np.divmod(cells, cells.dtype.type(2 * CLASSES))
            cell = cell.astype(np.uint8)
            head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(head, len(word))).astype(np.uint8)
            word = word[head].astype(np.int64)
            at = words_of.of(now)["at"][word]
            cuts = np.searchsorted(word, ex.bucket_cuts(words_of.of(now)["names"], buckets))
            ends = np.append(head, len(cells))[cuts]
            # a byte a count; those that do not fit stand behind one another
            few = np.minimum(n, 255).astype(np.uint8)
            for k in np.flatnonzero(np.diff(cuts)):
                own, inner = slice(cuts[k], cuts[k + 1]), slice(ends[k], ends[k + 1])
                row = {
                    "at": at[own], "sizes": sizes[own], "cells": cell[inner], "n": few[inner],
                    "many": n[inner][few[inner] == 255].astype("<i8"),
                }
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([int(k)], pa.int32())} | {c: pa.array([x.tobytes()], pa.binary()) for c, x in row.items()}
                    | {"total": pa.array([None], pa.binary())}
                )

        stretches = ((number, x) for number, found in _rows(batches, "batch", "stretches") for x in found)
        for number, stretch in stretches:
            if pieces and (number != now or held > most):
                yield from out()
                pieces, held = [], 0
            if number != now:
                names = np.asarray(words_of.of(number)["names"])
                class_of = np.append(classes_of.of(number)["classes"], np.arange(CLASSES)).astype(np.int32)
                # the end of a text is never among the exchanged words, so each has a token after it
                its_turn = np.append(names % U64(2) == U64(half), np.zeros(CLASSES, dtype=bool))
                kind = np.uint32 if len(names) * 2 * CLASSES < 1 << 32 else np.uint64
            now = number
            codes = files.read_flat(stretch["file"], "<i4", stretch["start"], stretch["n"])
            own = class_of[codes]
            # the token before the first of a text is an end, and so is the token before it in the array
            before = np.append(np.int32(END_CLASS), own[:-1])
            matrix += np.bincount(before * CLASSES + own, minlength=CLASSES * CLASSES)
            turn = np.flatnonzero(its_turn[codes])
            if len(turn):
                place = codes[turn].astype(kind) * kind(2 * CLASSES)
                pieces.append(place + before[turn].astype(kind))
                pieces.append(place + (CLASSES + own[turn + 1]).astype(kind))
                held += 2 * len(turn)
        # one row per class, so that the sums of the classes are made in different tasks
        none = pa.array([None] * CLASSES, pa.binary())
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array(-1 - np.arange(CLASSES), pa.int32())} | {c: none for c in ("at", "sizes", "cells", "n", "many")}
            | {"total": pa.array([row.tobytes() for row in matrix.reshape(CLASSES, CLASSES)], pa.binary())}
        )
        if pieces:
            yield from out()

    return count


def _sum_rows(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES, dtype=np.int64)
    for part in parts:
        for x in part.column("total").to_pylist():
            total += np.frombuffer(x, dtype=np.int64)
    yield pa.RecordBatch.from_pydict({"class": pa.array([-1 - key[0].as_py()]), "total": pa.array([total.tobytes()], pa.binary())})


def _move(matrix: np.ndarray, rows: int = 4096):
    """The classes of a bucket after each word with neighbours went where these are likeliest."""
    smooth = matrix + 0.1
    forward = np.log(smooth) - np.log(smooth.sum(axis=0))[None, :]
    backward = np.log(smooth.T) - np.log(smooth.sum(axis=1))[None, :]
    forward[:, END_CLASS] = backward[:, END_CLASS] = -1e9

    def move(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, now = b"", np.zeros(0, dtype=np.uint8)
        found: list[tuple] = []
        for names, classes, at, sizes, cells, n, many in _rows(parts, "names", "classes", "at", "sizes", "cells", "n", "many"):
            if classes is not None:
                known, now = names, np.frombuffer(classes, dtype=np.uint8)
                continue
            n = np.frombuffer(n, dtype=np.uint8).astype(np.int64)
            n[n == 255] = np.frombuffer(many, dtype="<i8")
            slot = np.repeat(np.frombuffer(at, dtype="<i4"), np.frombuffer(sizes, dtype=np.uint8))
            found.append((slot, np.frombuffer(cells, dtype=np.uint8), n))
        new = now.copy()
        if found:
            # the words of each row are in order
            bases = np.append(np.arange(0, len(now), rows), len(now))
            cuts = [np.searchsorted(slot, bases) for slot, _, _ in found]
            for j, base in enumerate(bases[:-1].tolist()):
                own = [tuple(x[c[j] : c[j + 1]] for x in f) for f, c in zip(found, cuts, strict=True)]
                slot, cells, n = (np.concatenate(x) for x in zip(*own, strict=True))
                here = min(rows, len(now) - base)
                place = (slot.astype(np.int64) - base) * (2 * CLASSES) + cells
                table = np.bincount(place, weights=n, minlength=here * 2 * CLASSES).reshape(here, 2 * CLASSES)
                # log P(class | class before) + log P(class after | class), up to what does not depend on the class
                gain = table[:, :CLASSES] @ forward + table[:, CLASSES:] @ backward
                old = now[base : base + here]
                best = gain.argmax(axis=1)
                # a tie, or a word without neighbours, stays
                stay = gain[np.arange(here), best] <= gain[np.arange(here), old]
                new[base : base + here] = np.where(stay, old, best)
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array([key[0].as_py()], pa.int32()), "names": pa.array([known], pa.binary()), "classes": pa.array([new.tobytes()], pa.binary()),
        })

    return move


@dataclass
class Model:
    """What scoring needs beside the counts of words; its size is fixed by ``CLASSES``."""

    log_next: np.ndarray
    mass: np.ndarray
    # mass of one word that was never seen
    unseen: np.ndarray
    n_tokens: int
    n_types: int


def _score(shared, folder: str, word_folder: str, class_folder: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        known = ex.Answers(folder, {"names": "<u8", "counts": "<i8"})
        words_of, classes_of = ex.Answers(word_folder, WORD_KINDS), ex.Answers(class_folder, CLASS_KINDS)
        for number, batch in ex.batch_runs(batches, TEXT_BYTES):
            names, spelled, first = read_tokens(batch)
            distinct, where, inverse = np.unique(names, return_index=True, return_inverse=True)
            answers = known.of(number)
            at, hit = ex.look_up(answers["names"], distinct)
            counts = np.where(hit, answers["counts"][at], 0) if len(answers["names"]) else np.zeros(len(distinct), dtype=np.int64)
            classes = own_classes(words_of.of(number)["names"], classes_of.of(number)["classes"], distinct, spelled[where])
            base = (counts + 1) / (model.n_tokens + model.n_types + 1)
            emit = np.where(counts > 0, counts, model.unseen[classes]) / model.mass[classes]
            own = classes[inverse]
            before = np.append(END_CLASS, own[:-1])
            base_log = np.log10(base)[inverse]
            share = BASE_SHARE if model.n_tokens else 1.0
            both = np.log10(share * base[inverse] + (1.0 - share) * emit[inverse] * model.log_next[before, own])
            starts = first[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(first)),
                    pa.array(np.add.reduceat((counts > 0)[inverse].astype(np.int64), starts)),
                    pa.array(np.full(batch.num_rows, model.n_tokens, dtype=np.int64)),
                    pa.array(np.add.reduceat(base_log, starts)), pa.array(np.add.reduceat(both, starts)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return score


def learn_classes(docs: DataFrame, words_seen: DataFrame, n_tokens: int, buckets: int = 1) -> tuple[Classes, np.ndarray]:
    """Exchange words between classes; returns them and the counts of class transitions.

    ``words_seen`` has a row per bucket: ``names`` (sorted), ``counts`` and ``spelled``.
    """
    known, matrix, _, _ = exchange_classes(*token_table(docs), words_seen, n_tokens, buckets)
    return known, matrix


def likelihood(matrix: np.ndarray) -> float:
    """Natural logarithm of the likelihood of the training texts, up to what does not depend on the classes."""

    def total(n: np.ndarray) -> float:
        n = n[n > 0]
        return float((n * np.log(n)).sum())

    return total(matrix) - total(matrix.sum(axis=0)) - total(matrix.sum(axis=1))


def exchange_classes(
    tokens: DataFrame, token_folder: str, words_seen: DataFrame, n_tokens: int, buckets: int
) -> tuple[Classes, np.ndarray, str, str]:
    """As ``learn_classes`` from ``token_table``, which is deleted; also the folders of each batch's words and their classes."""
    spark = tokens.sparkSession

    def exchanged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for names, counts, spelled in zip(*(b.column(c).to_pylist() for c in ("names", "counts", "spelled")), strict=True):
                names = np.frombuffer(names, dtype=U64)
                own = np.flatnonzero((np.frombuffer(counts, dtype="<i8") >= MIN_COUNT) & (names != END))
                names, classes = names[own], np.frombuffer(spelled, dtype=np.uint8)[own]
                rows = ex.bucket_rows(0, names, {"classes": classes}, buckets)
                if rows is not None:
                    yield rows.select(["bucket", "names", "classes"])

    table = store(words_seen.mapInArrow(exchanged, CLASS_ROW), "class-table")
    no = {kind: F.lit(None).cast(kind) for kind in ("int", "binary")}
    asked = tokens.select("batch", "names").mapInArrow(_ask_classes(buckets), "bucket int, batch int, names binary")
    asked_folder = shared_path(spark, "class-questions")
    linked = asked.withColumn("classes", no["binary"]).unionByName(table.withColumn("batch", no["int"])).groupBy("bucket").applyInArrow(
        _link(asked_folder), "batch int, names binary, at binary"
    )
    word_folder = ex.deliver(linked, WORD_KINDS, "class-words")
    code_folder = shared_path(spark, "class-codes")
    # a row per batch names its stretches
    coded = store(
        tokens.mapInArrow(_codes(word_folder, code_folder), STRETCH).groupBy("batch").agg(
            F.sort_array(F.collect_list(F.struct("file", "start", "n"))).alias("stretches")
        ),
        "class-stretches",
    )
    remove(tokens)
    files.remove_folder(token_folder)
    # these rows are small, whatever their batches are: as many tasks as batches count the neighbours
    codes = coded.repartition(max(coded.count(), 1))

    def deliver() -> str:
        folder = shared_path(spark, "class-of-words")
        told = table.select("bucket", "classes").mapInArrow(_tell_classes(asked_folder), "batch int, bucket int, classes binary")
        told.groupBy("batch").applyInArrow(_write_classes(folder), "batch int").write.format("noop").mode("overwrite").save()
        return folder

    def moved(counted: DataFrame, matrix: np.ndarray) -> DataFrame:
        seen = counted.where("part >= 0").withColumnRenamed("part", "bucket").drop("total")
        seen = seen.withColumns({c: no["binary"] for c in ("names", "classes")})
        old = table.withColumns({c: no["binary"] for c in ("at", "sizes", "cells", "n", "many")})
        new = store(seen.unionByName(old).groupBy("bucket").applyInArrow(_move(matrix), CLASS_ROW), "class-table")
        remove(counted)
        return new

    def count(half: int) -> tuple[DataFrame, np.ndarray]:
        counted = store(codes.mapInArrow(_neighbours(word_folder, folder, half, buckets), NEIGHBOURS), "class-neighbours")
        total = counted.where("part < 0").select("part", "total").groupBy("part").applyInArrow(_sum_rows, "class long, total binary").toArrow()
        matrix = np.zeros((CLASSES, CLASSES))
        for c, n in zip(total["class"].to_pylist(), total["total"].to_pylist(), strict=True):
            matrix[c] = np.frombuffer(n, dtype=np.int64)
        return counted, matrix

    # the tables of a half turn go once the next one is stored, but for those of the best turn
    before, turns, best = None, 0, None
    while True:
        folder = deliver()
        counted, matrix = count(0)
        now = likelihood(matrix)
        if best is None or now > before:
            if best is not None:
                files.remove_folder(best[2])
                remove(best[0].table)
            best = Classes(table, turns), matrix, folder
        # a turn that lost likelihood is undone by returning the best
        if before is not None and now - before < TOLERANCE * max(n_tokens, 1):
            for used in (counted, coded):
                remove(used)
            for used in (asked_folder, code_folder):
                files.remove_folder(used)
            known, matrix, folder = best
            return known, matrix, word_folder, folder
        before = now
        table = moved(counted, matrix)
        folder = deliver()
        between, table = table, moved(*count(1))
        files.remove_folder(folder)
        remove(between)
        turns += 1


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    spark = prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    stored = ex.with_batches(
        docs.select("doc_id", "text", held_out(F.col("doc_id"), 7, 2).alias("held_out")), "class-documents"
    )
    characters = stored.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = ex.n_buckets(characters // 24)
    # texts are read and hashed once for the counts and all turns
    tokens, token_folder = token_table(stored)
    added = store(
        tokens.select("batch", "names", "counts", "spelled").mapInArrow(_ask_counts(buckets), "bucket int, batch int, names binary, counts binary, spelled binary")
        .groupBy("bucket").applyInArrow(_add_counts, "batch int, names binary, counts binary, spelled binary"),
        "class-counts",
    )
    folder = ex.deliver(added.where("batch is not null"), {"names": "<u8", "counts": "<i8"}, "class-answers")
    table = added.where("batch is null").select("names", "counts", "spelled")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for counts in b.column("counts").to_pylist():
                counts = np.frombuffer(counts, dtype="<i8")
                yield pa.RecordBatch.from_pydict({"tokens": [int(counts.sum())], "types": [len(counts)]})

    n_tokens, n_types = table.mapInArrow(totals, "tokens long, types long").agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))
    ).first()
    _, matrix, word_folder, class_folder = exchange_classes(tokens, token_folder, table, n_tokens, buckets)

    def per_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for counts, spelled in zip(*(b.column(c).to_pylist() for c in ("counts", "spelled")), strict=True):
                spelled, counts = np.frombuffer(spelled, dtype=np.uint8), np.frombuffer(counts, dtype="<i8")
                few = [np.bincount(spelled[counts == k], minlength=CLASSES).astype(np.int64) for k in (1, 2)]
                yield pa.RecordBatch.from_pydict({"class": pa.array(np.arange(CLASSES)), "once": pa.array(few[0]), "twice": pa.array(few[1])})

    sums = table.mapInArrow(per_class, "class long, once long, twice long").groupBy("class").agg(
        F.sum("once").alias("once"), F.sum("twice").alias("twice")
    ).toArrow()
    # every training token stands once after another or an end
    tokens, once, twice = matrix.sum(axis=0), np.zeros(CLASSES), np.zeros(CLASSES)
    once[sums["class"].to_numpy()], twice[sums["class"].to_numpy()] = sums["once"].to_numpy(), sums["twice"].to_numpy()
    # a class without single words sets a half aside; the end of a text is never unseen once there is one
    unseen = np.maximum(once, 0.5)
    mass = tokens + unseen
    # words of a class that are still to be seen, one at least
    waiting = np.maximum(once * (once - 1) / (2 * (twice + 1)), 1.0)
    prior = mass / mass.sum()
    following = (matrix + PRIOR * prior[None, :]) / (matrix.sum(axis=1, keepdims=True) + PRIOR)
    shared = spark.sparkContext.broadcast(Model(following, mass, unseen / waiting, int(n_tokens), int(n_types)))
    return stored.mapInArrow(
        _score(shared, folder, word_folder, class_folder),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
