"""Language identification with hyperdimensional letter n-gram profiles.

Every letter, and the blank between words, has a random vector of -1 and 1 in ``DIM`` dimensions, made from its code
point. An n-gram binds its letters: the vector of letter k is rotated by its distance from the end, and the vectors
are multiplied. A text bundles its n-grams by adding their vectors. The vectors of a language's training texts, each of
length one, add up to the language's prototype. A text gets the language whose prototype is nearest by cosine; the
score is that cosine, 0 if it is negative.

Prototypes are sums of integers, so neither order nor partitioning of the rows changes them. They are sent to all
tasks: one vector per language, and language codes are a closed list (``MAX_LANGUAGES``, checked).

Defined cases: a text that is null or has no letter gets ``und`` and score 0; equal cosines go to the first language in
code-point order; training rows without language or letters teach nothing; without any training row every text is
``und``; equal rows count each; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import U64, col, mix, prepare

DIM = 1024
GRAM = 3
SCALE = 1 << 20
MAX_LANGUAGES = 20_000
UNKNOWN = "und"
# a text of this many characters whose profile is this far from every language is in none of them
LONG_TEXT, LEAST_SCORE = 200, 0.1
# cells of the table of counts that is held at once
CELLS = 1 << 21
GRAMS_AT_ONCE = 8192

_LETTERS: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """For every code point whether it is a letter; made once per process."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """The vectors of code points, a row each."""
    dims = np.arange(DIM, dtype=U64)
    return np.where(mix(mix(codes.astype(U64)[:, None] + U64(17)) + dims) & U64(1), 1, -1).astype(np.int8)


def gram_vectors(codes: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Bound vectors of n-grams that are rows of indexes into ``codes``."""
    base = letter_vectors(codes)
    out = base[grams[:, -1]].copy()
    for k in range(GRAM - 1):
        out *= np.roll(base, GRAM - 1 - k, axis=1)[grams[:, k]]
    return out


def bundle(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The bundled vector of every text, and whether it has a letter."""
    n = len(texts)
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer((" ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    doc = np.repeat(np.arange(n), [len(t) + 1 for t in lowered])
    letter = is_letter()[codes]
    sums = np.zeros((n, DIM), dtype=np.float64)
    has = np.zeros(n, dtype=bool)
    has[doc[letter]] = True
    # a blank stands before the first word and after each word; other signs fall away
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    row = doc[keep]
    sequence = np.where(letter, codes, 32)[keep]
    if not len(sequence):
        return sums, has
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    sequence, row = np.insert(sequence, starts, 32), np.insert(row, starts, row[starts])
    present = np.zeros(0x110000, dtype=bool)
    present[sequence] = True
    letters = np.flatnonzero(present)
    number = np.zeros(0x110000, dtype=np.int64)
    number[letters] = np.arange(len(letters))
    sequence = number[sequence]
    m = len(sequence) - GRAM + 1
    if m <= 0:
        return sums, has
    gram = np.zeros(m, dtype=np.int64)
    for k in range(GRAM):
        gram = gram * len(letters) + sequence[k : k + m]
    inside = row[:m] == row[GRAM - 1 :]
    gram, row = gram[inside], row[:m][inside]
    size = len(letters) ** GRAM
    if size <= 1 << 22:
        seen = np.zeros(size, dtype=bool)
        seen[gram] = True
        distinct = np.flatnonzero(seen)
        order = np.zeros(size, dtype=np.int64)
        order[distinct] = np.arange(len(distinct))
        gram = order[gram]
    else:
        distinct, gram = np.unique(gram, return_inverse=True)
    parts = []
    rest = distinct
    for _ in range(GRAM):
        parts.append(rest % len(letters))
        rest = rest // len(letters)
    grams = np.stack(parts[::-1], axis=1)
    bounds = np.searchsorted(row, np.arange(n + 1))
    step = max(1, CELLS // max(len(distinct), 1))
    for d in range(0, n, step):
        e = min(n, d + step)
        own = slice(bounds[d], bounds[e])
        counts = np.bincount(
            (row[own] - d) * len(distinct) + gram[own], minlength=(e - d) * len(distinct)
        ).reshape(e - d, len(distinct)).astype(np.float32)
        for g in range(0, len(distinct), GRAMS_AT_ONCE):
            vectors = _cached_vectors(letters, grams, g, d == 0)
            sums[d:e] += counts[:, g : g + GRAMS_AT_ONCE] @ vectors
    return sums, has


_HELD: dict[int, np.ndarray] = {}


def _cached_vectors(letters: np.ndarray, grams: np.ndarray, g: int, first: bool) -> np.ndarray:
    """The vectors of one stretch of n-grams; a batch of one stretch makes them once."""
    if g == 0 and not first and len(grams) <= GRAMS_AT_ONCE:
        return _HELD[0]
    _HELD[0] = gram_vectors(letters, grams[g : g + GRAMS_AT_ONCE]).astype(np.float32)
    return _HELD[0]


def unit(sums: np.ndarray) -> np.ndarray:
    length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
    return sums / np.where(length > 0, length, 1.0)


def _groups(batches: Iterator[pa.RecordBatch], most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text, one row at least."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "lang": pa.array(list(sums), pa.string()), "vector": pa.array(list(sums.values()), pa.list_(pa.int64())),
        })

    for batch in _groups(batches):
        vectors, has = bundle(batch.column("text").to_pylist())
        whole = np.rint(unit(vectors) * SCALE).astype(np.int64)
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs[has])):
            own = whole[has & (langs == lang)].sum(axis=0)
            sums[lang] = sums[lang] + own if lang in sums else own
        if len(sums) > 1000:
            yield out()
            sums.clear()
    if sums:
        yield out()


def learn_prototypes(training: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in code-point order and their prototypes, from ``text, lang``."""
    prepare(training.sparkSession)
    parts = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang").mapInArrow(
        _learn, "lang string, vector array<bigint>"
    )
    sums = parts.select("lang", F.posexplode("vector").alias("dim", "value")).groupBy("lang", "dim").agg(
        F.sum("value").alias("value")
    )
    whole = sums.groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda s: s["value"]).alias("vector")
    )
    found = whole.orderBy("lang").limit(MAX_LANGUAGES + 1).toArrow()
    if found.num_rows > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} language values")
    vectors = np.array(found["vector"].to_pylist(), dtype=np.float64).reshape(-1, DIM)
    return found["lang"].to_pylist(), unit(vectors)


def predict(
    docs: DataFrame, languages: list[str], prototypes: np.ndarray, keep: list[str], text: str = "text"
) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``; only the text decides."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast((languages, prototypes))
    inner = docs.select(F.struct(*map(col, keep)).alias("_row"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, known = shared.value
        for batch in _groups(batches):
            sums, has = bundle(batch.column("_text").to_pylist())
            if names:
                near = unit(sums) @ known.T
                best = near.argmax(axis=1)
                score = np.clip(near[np.arange(len(best)), best], 0.0, 1.0)
                pred = [names[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
            else:
                pred, score = [UNKNOWN] * len(has), np.zeros(len(has))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(pred, pa.string()), pa.array(np.where(has, score, 0.0))],
                names=["_row", "lang_pred", "score"],
            )

    schema = T.StructType([inner.schema["_row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return inner.mapInArrow(run, schema).select(*(F.col("_row").getField(c).alias(c) for c in keep), "lang_pred", "score")


def held_out(key: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is left out of training; a null key is not."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document, learnt from those not held out."""
    out = held_out(F.col("doc_id"))
    languages, prototypes = learn_prototypes(docs.where(~out))
    return predict(docs.withColumn("held_out", out), languages, prototypes, ["doc_id", "held_out"])


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents with a language, whole and with all their columns, learnt from the rows not held out.

    A document is rejected if its text is null or has no letter, or if it is long enough to tell and unlike every
    language. Short texts are kept: their cosine says little. Where no row has a language, nothing can be told
    from profiles and only texts without letters go.
    """
    columns = docs.columns
    languages, prototypes = learn_prototypes(docs.where(~held_out(F.col("doc_id"))))
    named = predict(docs.select(F.struct(*map(col, columns)).alias("_all")), languages, prototypes, ["_all"], text="_all.text")
    lettered = F.col("_all.text").rlike(r"\p{L}")
    unlike = (F.char_length("_all.text") >= LONG_TEXT) & (F.col("score") < LEAST_SCORE)
    rejected = F.col("lang_pred") == UNKNOWN
    if not languages:
        rejected, unlike = ~lettered, F.lit(False)
    return named.where(~F.coalesce(rejected | unlike, F.lit(True))).select(*(F.col("_all").getField(c).alias(c) for c in columns))
