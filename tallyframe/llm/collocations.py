"""Phrase collocations by best-first branch and bound over growing phrases.

A candidate is a phrase of 2 to 5 words with 100 occurrences or more. Its score is that of its weakest cut, 1000 a n / (l r).
As the right part of a cut occurs at least as often as the phrase, a phrase that starts with the word w scores at most
1000 n / f(w), however it goes on; the same holds for its last word. So words of few occurrences promise the highest scores.

**Frontier.** Words are taken in order of that bound, the rarest first. A wave takes up the words of at most F occurrences and
grows phrases from two to five words, to the right of such a word and to the left of one. A phrase grows only while the
part that is already counted is frequent, because no phrase occurs more often than its parts. Any phrase not seen has a
word of more than F occurrences at one end, so its score is at most 1000 n / (F + 1). A language is settled once its 2000th
surviving score is above that, so that no tie can be missing, or once all its words are taken up. Until it has 2000
survivors, the share of its text that is taken up grows fourfold; with 2000, the next F follows from their last score, and
that wave settles it. No candidate is left out on the way: the bound alone ends the search.

**Counting.** Texts are cut into words once. A stretch (some megabytes of one language) keeps the places of its words in its own
sorted word list. Names of words and phrases are 64-bit hashes that include the language. The stretches ask for the counts of their
distinct phrases by bucket of the hash range; a phrase that is everywhere costs one entry per stretch, and a bucket is a
bounded share of all entries. Answers name frequent phrases only; one stretch is asked to report each phrase. It has
the counts of all parts and of both extensions at hand, since they occur in it too. A phrase drops out if some longer candidate
holds it as often as it occurs; then the phrase with one more word to the left or right does so already.

With 64-bit names, two of 10^9 counted phrases share a name with a probability of 3 %, which adds up their counts.

Defined cases: a null text is empty; a null lang counts as ``und``; a lang is taken as it is, also the empty string; words of
any length count; repeated rows and null or repeated identifiers count as documents of their own; phrases of equal score and
frequency are ordered by their UTF-8 bytes; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.llm import exchange as ex
from tallyframe.llm.common import LOWER, U64, mix, prepare, rechunk, span_hash, store, text_bytes, window_hash, words

LONGEST = 5
LEAST = 100
TOP = 2000
# text bytes per task step; a stretch is the part of one language
STRETCH = 8 << 20
# share of all word occurrences that the first wave takes up, and its growth
FIRST_SHARE, GROWTH = 0.125, 4
# bins of word counts per doubling
BINS = 4

_PIECE = np.zeros(256, dtype=bool)
_PIECE[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_SPLIT = _PIECE.copy()
_SPLIT[[0x20, 0x09]] = True
_KINDS = {"names": "<u8", "counts": "<i8", "teller": "u1"}
_TOKENS = "lang string, batch long, n_words long, places binary, names binary, counts binary, blob binary, sizes binary"


def _stretch(lang: str, texts: pa.Array) -> dict[str, bytes | int | str] | None:
    """Words of some texts of one language, as places in their sorted list; the first word of a piece is negative."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, first = words(data, offsets, _SPLIT)
    if not len(starts):
        return None
    piece = np.cumsum(_PIECE[data], dtype=np.int64)[starts]
    head = np.append(True, piece[1:] != piece[:-1])
    head[first[:-1][first[:-1] < len(starts)]] = True
    spelled = mix(span_hash(data, starts, ends) + U64(xxhash.xxh3_64_intdigest(lang.encode())))
    names, at, places, counts = np.unique(spelled, return_index=True, return_inverse=True, return_counts=True)
    places = places.astype(np.int32)
    places[head] = ~places[head]
    return {
        "lang": lang, "n_words": len(starts), "places": places.tobytes(), "names": names.tobytes(),
        "counts": counts.astype("<i8").tobytes(), "sizes": (ends[at] - starts[at]).astype("<i8").tobytes(),
        "blob": b"".join([data[a:b].tobytes() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]),
    }


def _tokens(stretch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in rechunk(batches, stretch):
            langs = batch.column("lang").dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                row = _stretch(lang, batch.column("text").filter(pc.equal(langs.indices, code)))
                if row is not None:
                    number += 1
                    yield pa.RecordBatch.from_pylist([row | {"batch": number}], schema=_TOKENS_ARROW)

    return run


_TOKENS_ARROW = pa.schema(
    [("lang", pa.string()), ("batch", pa.int64()), ("n_words", pa.int64())]
    + [(c, pa.binary()) for c in ("places", "names", "counts", "blob", "sizes")]
)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _ask_words(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            names, counts = np.frombuffer(row["names"], dtype="<u8"), np.frombuffer(row["counts"], dtype="<i8")
            yield ex.bucket_rows(row["batch"], names, {"counts": counts}, buckets, pa.int64())

    return ask


def _frequent(least: int):
    """Total counts of a bucket's frequent names, told to every stretch that has them; the first one reports."""

    def run(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, sizes, got = ex.gathered(parts, {"names": "<u8", "counts": "<i8"})
        order = np.argsort(got["names"], kind="stable")
        names, who = got["names"][order], np.repeat(who, sizes)[order]
        head = np.append(True, names[1:] != names[:-1])
        total = np.add.reduceat(got["counts"][order], np.flatnonzero(head))[np.cumsum(head) - 1]
        told = np.flatnonzero(total >= least)
        yield from ex.replies(
            who[told], names[told], {"counts": total[told], "teller": head[told].astype(np.uint8)}, pa.int64()
        )

    return run


def _count(asked: DataFrame, least: int, label: str) -> str:
    told = asked.groupBy("bucket").applyInArrow(_frequent(least), "batch long, names binary, counts binary, teller binary")
    return ex.deliver(told, _KINDS, label)


def _told(answers: dict[str, np.ndarray], names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count of each name (0: not frequent) and whether this stretch reports it."""
    at, hit = ex.look_up(answers["names"], names)
    counts, teller = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=bool)
    counts[hit], teller[hit] = answers["counts"][at[hit]], answers["teller"][at[hit]] > 0
    return counts, teller


def _word_counts(folder: str):
    """``lang, bin, occurrences``: how often words of similar frequency stand in the text, each word counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ex.Answers(folder, _KINDS)
        for row in _rows(batches):
            answers = known.of(row["batch"])
            counts = answers["counts"][answers["teller"] > 0]
            if len(counts):
                bins, at = np.unique(np.floor(BINS * np.log2(counts)).astype(np.int32), return_inverse=True)
                sums = np.zeros(len(bins), dtype=np.int64)
                np.add.at(sums, at, counts)
                most = np.zeros(len(bins), dtype=np.int64)
                np.maximum.at(most, at, counts)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([row["lang"]] * len(bins)), "bin": pa.array(bins), "occurrences": pa.array(sums), "most": pa.array(most),
                })

    return run


class _Grown:
    """The words of a stretch, and which of its phrases are counted in a wave."""

    def __init__(self, row: dict, known: list[ex.Answers]):
        self.answers = [k.of(row["batch"]) for k in known]
        places = np.frombuffer(row["places"], dtype=np.int32)
        head = places < 0
        self.places = np.where(head, ~places, places)
        names = np.frombuffer(row["names"], dtype="<u8")
        self.spelled = names[self.places]
        self.f = _told(self.answers[0], names)[0][self.places]
        rare = self.f == 0
        # a phrase stays inside one run of frequent words of one piece
        self.run = np.cumsum(head | rare | np.append(False, rare[:-1]))
        self.taken = (self.f > 0) & (self.f <= row["most"])

    def names(self, m: int) -> np.ndarray:
        return window_hash(self.spelled, m, m) if m > 1 else self.spelled

    def inside(self, m: int) -> np.ndarray:
        n = max(len(self.run) - m + 1, 0)
        return (self.run[:n] == self.run[m - 1 :]) & (self.f[:n] > 0) & (self.taken[:n] | self.taken[m - 1 :])

    def counts(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Per position the count of the phrase of ``m`` words (0: not frequent or not counted), and whether to report it."""
        counts, teller = np.zeros(len(self.run), dtype=np.int64), np.zeros(len(self.run), dtype=bool)
        at = np.flatnonzero(self.inside(m))
        counts[at], teller[at] = _told(self.answers[m - 1], self.names(m)[at])
        return counts, teller

    def alive(self, m: int) -> np.ndarray:
        """Positions of the phrases of ``m`` words whose counted parts are frequent."""
        live = self.inside(m)
        n = len(live)
        if m > 2:
            part = self.counts(m - 1)[0] > 0
            live &= (~self.taken[:n] | part[:n]) & (~self.taken[m - 1 :] | part[1 : n + 1])
        return np.flatnonzero(live)


def _ask_phrases(folders: list[str], m: int, buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [ex.Answers(f, _KINDS) for f in folders]
        for row in _rows(batches):
            grown = _Grown(row, known)
            names, counts = np.unique(grown.names(m)[grown.alive(m)], return_counts=True)
            rows = ex.bucket_rows(row["batch"], names, {"counts": counts.astype("<i8")}, buckets, pa.int64())
            if rows is not None:
                yield rows

    return ask


_BEST = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
_FOUND = "lang string, phrase string, a long, l long, r long, n long, score long"


def _survivors(folders: list[str]):
    """Scored phrases that no longer one covers, for which this stretch reports."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [ex.Answers(f, _KINDS) for f in folders]
        for row in _rows(batches):
            grown = _Grown(row, known)
            tables = {1: (grown.f, None)} | {m: grown.counts(m) for m in range(2, LONGEST + 1)}
            size = np.frombuffer(row["sizes"], dtype="<i8")
            upto = np.append(0, np.cumsum(size))
            out: dict[str, list] = {c: [] for c in ("phrase", "a", "l", "r", "score")}
            for m in range(2, LONGEST + 1):
                counts, teller = tables[m]
                names = grown.names(m)
                at = np.flatnonzero(teller[: len(names)])
                at = at[grown.taken[at] & grown.taken[at + m - 1]]
                at = at[np.unique(names[at], return_index=True)[1]]
                a = counts[at]
                if m < LONGEST:
                    longer = np.append(tables[m + 1][0], 0)
                    covered = (longer[at] == a) | ((at > 0) & (longer[at - 1] == a))
                    at, a = at[~covered], a[~covered]
                cuts = [(tables[k][0][at].tolist(), tables[m - k][0][at + k].tolist()) for k in range(1, m)]
                for i, (p, n_a) in enumerate(zip(at.tolist(), a.tolist(), strict=True)):
                    score, _, left, right = min(
                        (1000 * n_a * row["n"] // (l[i] * r[i]), k, l[i], r[i]) for k, (l, r) in enumerate(cuts)
                    )
                    spelled = [row["blob"][upto[w] : upto[w + 1]] for w in grown.places[p : p + m].tolist()]
                    for c, v in zip(out, (b" ".join(spelled).decode(errors="replace"), n_a, left, right, score), strict=True):
                        out[c].append(v)
            k = len(out["a"])
            if k:
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([row["lang"]] * k), "phrase": pa.array(out["phrase"], pa.string()),
                    **{c: pa.array(out[c], pa.int64()) for c in "alr"}, "n": pa.array([row["n"]] * k, pa.int64()),
                    "score": pa.array(out["score"], pa.int64()),
                })

    return run


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)


def _share(bins: DataFrame, totals: DataFrame, share: float) -> DataFrame:
    """``lang, n, share_f, top_f``: the count up to which words cover a share of the text, and the highest count."""
    order = Window.partitionBy("lang").orderBy("bin")
    upto = bins.withColumn("upto", F.sum("occurrences").over(order)).join(totals, "lang")
    # the lowest bin always belongs to it
    inside = (F.col("upto") <= F.col("n") * share) | (F.col("upto") == F.col("occurrences"))
    return upto.groupBy("lang", "n").agg(
        F.max(F.when(inside, F.col("most"))).alias("share_f"), F.max("most").alias("top_f")
    )


def mine_phrases(
    docs: DataFrame, least: int = LEAST, top: int = TOP, first_share: float = FIRST_SHARE, stretch: int = STRETCH
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of every language with ``least`` occurrences."""
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    tokens = store(texts.mapInArrow(_tokens(stretch), _TOKENS), "phrase-tokens")
    sizes = tokens.agg(F.sum("n_words"), F.sum(F.octet_length("names"))).first()
    if not sizes[0]:
        return spark.createDataFrame([], _BEST)
    totals = store(tokens.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrase-totals")
    request = "bucket int, batch long, names binary, counts binary"
    by_word = _count(tokens.select("batch", "names", "counts").mapInArrow(_ask_words(ex.n_buckets(sizes[1] // 8)), request), least, "phrase-words")
    bins = store(
        tokens.select("lang", "batch").mapInArrow(_word_counts(by_word), "lang string, bin int, occurrences long, most long")
        .groupBy("lang", "bin").agg(F.sum("occurrences").alias("occurrences"), F.max("most").alias("most")),
        "phrase-bins",
    )
    share, done = first_share, []
    # occurrences up to which words are taken up, per language that is not settled
    frontier = store(_share(bins, totals, share).select("lang", "n", F.col("share_f").alias("most"), "top_f"), "phrase-frontier")
    while frontier.limit(1).count():
        taken = tokens.join(frontier.select("lang", "n", "most"), "lang").select(
            "lang", "batch", "places", "names", "blob", "sizes", "n", "most"
        )
        words_taken = tokens.join(frontier.select("lang"), "lang").agg(F.sum("n_words")).first()[0]
        buckets = ex.n_buckets(words_taken // 4)
        folders = [by_word]
        for m in range(2, LONGEST + 1):
            asked = taken.select("batch", "places", "names", "most").mapInArrow(_ask_phrases(list(folders), m, buckets), request)
            folders.append(_count(asked, least, f"phrase-counts-{m}"))
        best = store(_ranked(taken.mapInArrow(_survivors(list(folders)), _FOUND), top), "phrase-best")
        last = best.groupBy("lang").agg(F.count("*").alias("found"), F.min("score").alias("last"))
        share *= GROWTH
        state = frontier.join(last, "lang", "left").join(_share(bins, totals, share).select("lang", "share_f"), "lang")
        full = F.coalesce(F.col("found"), F.lit(0)) == top
        bound = F.expr("cast(1000 as decimal(20, 0)) * n div (most + 1)")
        wider = F.when(full, F.expr("cast(1000 as decimal(20, 0)) * n div last")).otherwise(F.greatest("share_f", F.col("most") + 1))
        state = store(
            state.withColumns({
                "settled": (F.col("most") >= F.col("top_f")) | (full & (F.col("last") > bound)), "wider": F.least(wider.cast("long"), "top_f"),
            }), "phrase-state",
        )
        done.append(best.join(state.where("settled").select("lang"), "lang"))
        frontier = state.where("not settled").select("lang", "n", F.col("wider").alias("most"), "top_f")
    if not done:
        return spark.createDataFrame([], _BEST)
    return reduce(DataFrame.unionByName, done).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
