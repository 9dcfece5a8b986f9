import collections
import math
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import class_model as cm
from tests.llm.helpers import LOW, documents, vocabulary, words_of


def grammar(seed, n=300):
    """Texts in which a word's class decides the class of the next."""
    rng = np.random.default_rng(seed)
    words = vocabulary(rng, 240)
    groups = np.array_split(words, 4)
    rows = []
    for i in range(n):
        k, out = int(rng.integers(4)), []
        for _ in range(int(rng.integers(1, 80))):
            out.append(str(rng.choice(groups[k])))
            k = (k + 1) % 4 if rng.random() < 0.9 else int(rng.integers(4))
        rows.append((i, " ".join(out).capitalize()))
    return rows


def brute(rows):
    tokens = [[*words_of((t or "").translate(LOW)), None] for _, t in rows]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = collections.Counter(x for w, o in zip(tokens, out, strict=True) if not o for x in w)
    n, v = sum(c.values()), len(c)
    return [
        (i, o, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        for (i, _), w, o in zip(rows, tokens, out, strict=True)
    ]


def result(df):
    return df.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [tuple(r)[:5] for r in got] == [r[:5] for r in want]
    assert all(math.isclose(r[5], w[5], rel_tol=1e-9) for r, w in zip(got, want, strict=True))


@pytest.mark.parametrize("entries", [1_000_000, 20])
def test_counts_and_base_scores(spark, monkeypatch, entries):
    monkeypatch.setattr(cm.ex, "BUCKET_ENTRIES", entries)
    rows = grammar(1, 120)
    same(result(cm.score_documents(documents(spark, rows))), brute(rows))


def test_scores_match_a_slow_twin(spark, monkeypatch):
    """Transitions, emissions and smoothing counted token by token over the classes that were learnt."""
    rows = grammar(4, 90) + [(1000, None), (1001, ""), (1002, "never seen Zzz"), (None, "one more")]
    kept, real = {}, cm.exchange_classes

    def spy(*args):
        kept["classes"], *rest = real(*args)
        return kept["classes"], *rest

    monkeypatch.setattr(cm, "exchange_classes", spy)
    got = result(cm.score_documents(documents(spark, rows)))
    tokens = [(i, [*words_of((t or "").translate(LOW)), None], i is not None and zlib.crc32(str(i).encode()) % 7 == 2) for i, t in rows]
    vocabulary_ = sorted({x for _, w, _ in tokens for x in w if x is not None})
    names, spelled, first = cm.read_tokens(pa.RecordBatch.from_pydict({"text": vocabulary_}))
    own = kept["classes"].of(names[first[:-1]], spelled[first[:-1]]).tolist()
    spelling = dict(zip(vocabulary_, spelled[first[:-1]].tolist(), strict=True)) | {None: cm.END_CLASS}
    cls = dict(zip(vocabulary_, own, strict=True)) | {None: cm.END_CLASS}
    assert any(cls[x] != spelling[x] for x in vocabulary_)
    k = range(cm.CLASSES)
    seen, pairs = collections.Counter(), collections.Counter()
    for _, w, out in tokens:
        for before, x in zip([None, *w], w, strict=False):
            if not out:
                seen[x] += 1
                pairs[cls[before], cls[x]] += 1
    n, v = sum(seen.values()), len(seen)
    once, twice = (collections.Counter(spelling[x] for x, c in seen.items() if c == m) for m in (1, 2))
    aside = [max(once[c], 0.5) for c in k]
    mass = [sum(pairs[a, c] for a in k) + aside[c] for c in k]
    share = [aside[c] / max(once[c] * (once[c] - 1) / (2 * (twice[c] + 1)), 1.0) for c in k]
    row = [sum(pairs[a, c] for c in k) for a in k]
    want = {}
    for i, w, _ in tokens:
        total = 0.0
        for before, x in zip([None, *w], w, strict=False):
            a, c = cls[before], cls[x]
            step = (pairs[a, c] + cm.PRIOR * mass[c] / sum(mass)) / (row[a] + cm.PRIOR)
            emit = (seen[x] if seen[x] else share[c]) / mass[c]
            total += math.log10(cm.BASE_SHARE * (seen[x] + 1) / (n + v + 1) + (1 - cm.BASE_SHARE) * emit * step)
        want[i] = total
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], rel=1e-9)


def test_junk_falls_further_by_score_than_by_the_base(spark):
    """Letter strings never seen stand out at least as clearly as by the add-one model."""
    rng = np.random.default_rng(6)
    held = [i for i in range(5000, 6000) if zlib.crc32(str(i).encode()) % 7 == 2]
    junk = [(i, " ".join("".join(rng.choice(list("qxzjkvw"), size=6)) for _ in range(20))) for i in held[:20]]
    got = result(cm.score_documents(documents(spark, grammar(3, 250) + junk)))
    a = {k: [(r.base_score / r.n_tokens, r.score / r.n_tokens) for r in got if r.held_out and (r.doc_id >= 5000) == k] for k in (False, True)}
    mean = lambda rows, j: sum(r[j] for r in rows) / len(rows)
    assert len(a[True]) == 20 and mean(a[False], 1) - mean(a[True], 1) > mean(a[False], 0) - mean(a[True], 0)


def test_classes_beat_the_base_on_held_out_texts(spark):
    rows = grammar(2)
    got = [r for r in result(cm.score_documents(documents(spark, rows))) if r.held_out]
    assert len(got) > 20
    base, model = (sum(getattr(r, c) for r in got) / sum(r.n_tokens for r in got) for c in ("base_score", "score"))
    assert model > base + 0.25


def test_exchange_gathers_the_classes_of_the_grammar(spark):
    """Exchanged words of one group of the grammar end up together more often than by spelling."""
    rows = grammar(3)
    df = documents(spark, rows).selectExpr("doc_id", "text", "0 as batch", "false as held_out")
    rng = np.random.default_rng(3)
    group = {w: g for g, part in enumerate(np.array_split(vocabulary(rng, 240), 4)) for w in part}
    spark_words = collections.Counter(w for _, t in rows for w in words_of(t.translate(LOW)))
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(sorted(spark_words))]})
    names, spelled, _ = cm.read_tokens(batch)
    order = np.argsort(names[:-1])
    counts = np.array([spark_words[w] for w in sorted(spark_words)])
    table = spark.createDataFrame(
        [(names[:-1][order].tobytes(), counts[order].astype("<i8").tobytes(), spelled[:-1][order].tobytes())],
        "names binary, counts binary, spelled binary",
    )
    known, matrix = cm.learn_classes(df, table, int(counts.sum()) + len(rows))
    assert matrix.sum() == counts.sum() + len(rows)

    def purity(classes):
        by = collections.defaultdict(collections.Counter)
        for w, n, k in zip(sorted(spark_words), names[:-1], classes, strict=True):
            at, hit = cm.ex.look_up(known.names, np.array([n]))
            if hit[0]:
                by[int(k)][group[w]] += 1
        return sum(max(c.values()) for c in by.values()) / sum(sum(c.values()) for c in by.values())

    assert purity(known.of(names[:-1], spelled[:-1])) > purity(spelled[:-1]) + 0.1


def test_reruns_and_partitioning_agree(spark):
    rows = grammar(4, 80)
    a, b = (sorted(tuple(r) for r in result(cm.score_documents(documents(spark, rows, parts=p)))) for p in (1, 4))
    assert [r[:5] for r in a] == [r[:5] for r in b]
    assert all(math.isclose(x[6], y[6], rel_tol=1e-9) for x, y in zip(a, b, strict=True))


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (3, "a B"), (3, "a B"), (None, "b c"), (4, "z" * 100_000), (5, "w " * 30_000), (6, "one")]
    df = documents(spark, rows).selectExpr("*", "1 as batch", "2 as held_out", "3 as names")
    got = result(cm.score_documents(df))
    same(got, brute(rows))
    assert all(r.score < 0 for r in got)


def test_no_training_text(spark):
    rows = [(i, "a b c") for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    got = result(cm.score_documents(documents(spark, rows)))
    same(got, brute(rows))
    assert all(r.score == r.base_score == 0.0 and r.train_tokens == 0 for r in got)
    assert result(cm.score_documents(documents(spark, []))) == []


def learnt(spark, rows, **kw):
    """Classes learnt from all rows, with the counts of the words."""
    df = documents(spark, rows).selectExpr("doc_id", "text", "0 as batch", "false as held_out")
    counted = collections.Counter(w for _, t in rows for w in words_of(t.translate(LOW)))
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(counted)]})
    names, spelled, _ = cm.read_tokens(batch)
    names, spelled, counts = names[:-1], spelled[:-1], np.array(list(counted.values()))
    order = np.argsort(names)
    table = spark.createDataFrame(
        [(names[order].tobytes(), counts[order].astype("<i8").tobytes(), spelled[order].tobytes())],
        "names binary, counts binary, spelled binary",
    )
    return names, counts, cm.learn_classes(df, table, int(counts.sum()) + len(rows), **kw)


def test_rare_words_are_exchanged_in_a_large_corpus_too(spark):
    rows = grammar(5, 40) + [(1000 + i, "the " * 100_000) for i in range(40)]
    names, counts, (known, _) = learnt(spark, rows)
    assert 10 < ((counts >= 4) & (counts < 16)).sum()
    assert set(known.names) == set(names[counts >= cm.MIN_COUNT])


def test_classes_of_many_buckets(spark):
    rows = grammar(6, 120)
    one, many = (learnt(spark, rows, **kw)[2] for kw in ({}, {"buckets": 7}))
    assert (one[1] == many[1]).all() and (one[0].names == many[0].names).all()
    spelled = np.zeros(len(one[0].names), dtype=np.uint8)
    assert (one[0].of(one[0].names, spelled) == many[0].of(one[0].names, spelled)).all()


def test_no_full_turn_is_left_that_gains(spark):
    """One more turn by hand, both halves, raises the log-likelihood by less than the tolerance."""
    rows = grammar(7)
    names, counts, (known, matrix) = learnt(spark, rows)
    batch = pa.RecordBatch.from_pydict({"text": [t for _, t in rows]})
    tokens, spelled, _ = cm.read_tokens(batch)
    at, hit = cm.ex.look_up(known.names, tokens)
    classes = np.asarray(known.of(known.names, np.zeros(len(known.names), dtype=np.uint8))).copy()

    def count():
        own = np.where(hit, classes[at], spelled).astype(int)
        before = np.append(cm.END_CLASS, own[:-1])
        m = np.zeros((cm.CLASSES, cm.CLASSES))
        np.add.at(m, (before, own), 1)
        return own, before, m

    def gain_of(m):
        x = lambda n: (n[n > 0] * np.log(n[n > 0])).sum()
        return x(m) - x(m.sum(axis=0)) - x(m.sum(axis=1))

    start = count()[2]
    assert (start == matrix).all()
    for half in (0, 1):
        own, before, m = count()
        table = np.zeros((len(classes), 2 * cm.CLASSES))
        np.add.at(table, (at[hit], before[hit]), 1)
        where = np.flatnonzero(hit)
        np.add.at(table, (at[where], cm.CLASSES + own[where + 1]), 1)
        m = m + 0.1
        likely = table[:, : cm.CLASSES] @ np.log(m / m.sum(axis=0))
        likely += table[:, cm.CLASSES :] @ np.log(m / m.sum(axis=1, keepdims=True)).T
        likely[:, cm.END_CLASS] = -np.inf
        turn = known.names % 2 == half
        classes[turn] = likely.argmax(axis=1)[turn]
    assert gain_of(count()[2]) - gain_of(start) < 1e-3 * len(tokens)


def test_half_turns_pass_no_names_and_no_tokens(spark, monkeypatch):
    """A half turn tells a batch one byte a word, stores two bytes a cell, and reads the tokens from flat files."""
    rows = grammar(8, 120)
    told, stored, real = [], [], (cm.store, cm.exchange_classes)

    def store(df, label):
        out = real[0](df, label)
        if label == "class-neighbours":
            size = "+".join(f"coalesce(sum(octet_length({c})), 0)" for c, t in out.dtypes if t == "binary")
            stored.append(out.where("part >= 0").selectExpr(f"({size}) as size", "sum(octet_length(cells)) as cells", "sum(octet_length(sizes)) as words").first())
        assert label != "class-stretches" or "binary" not in dict(out.dtypes).values()
        return out

    def spy(*args):
        out = real[1](*args)
        told.append(out[2:])
        return out

    monkeypatch.setattr(cm, "store", store)
    monkeypatch.setattr(cm, "exchange_classes", spy)
    assert len(result(cm.score_documents(documents(spark, rows, parts=3)))) == 120
    words, classes = (Path(f.removeprefix("file:")) for f in told[0])
    assert {f.suffix for f in classes.iterdir()} - {".crc"} == {".classes"}
    for f in classes.glob("*.classes"):
        assert 8 * f.stat().st_size == (words / f"{f.stem}.names").stat().st_size > 0
    assert len(stored) > 2 and all(r.size <= 2 * r.cells + 5 * r.words for r in stored)


def test_counts_of_neighbours_beyond_a_byte(spark):
    """Pairs that occur more often than a byte holds are counted whole."""
    rows = [(i, "aa bb " * 300 + "cc dd cc dd") for i in range(5)]
    names, counts, (known, matrix) = learnt(spark, rows, buckets=3)
    assert set(known.names) == set(names) and matrix.sum() == counts.sum() + 5
    batch = pa.RecordBatch.from_pydict({"text": [t for _, t in rows]})
    tokens, spelled, _ = cm.read_tokens(batch)
    own = known.of(tokens, spelled)
    want = np.zeros((cm.CLASSES, cm.CLASSES))
    np.add.at(want, (np.append(cm.END_CLASS, own[:-1]), own), 1)
    assert (matrix == want).all() and want.max() >= 1495
