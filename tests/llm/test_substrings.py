import numpy as np
import pytest

from tallyframe.llm import substrings as sub
from tests.llm.helpers import documents, prose, vocabulary, words_of


def brute(rows):
    first = {}
    key = lambda i: (i is None, i or 0)
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - 12):
            seen = first.setdefault(tuple(w[k : k + 13]), i)
            if key(i) < key(seen):
                first[tuple(w[k : k + 13])] = i
    out = []
    for i, t in rows:
        w = words_of(t)
        gone = set()
        for k in range(len(w) - 12):
            if key(first[tuple(w[k : k + 13])]) < key(i):
                gone.update(range(k, k + 13))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=lambda r: (key(r[0]), r[1:]))


def result(df):
    rows = df.select("doc_id", "n_words", "n_removed", "text").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def corpus(seed, words, n=80):
    rng = np.random.default_rng(seed)
    shared = [prose(rng, int(rng.integers(10, 70)), words) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = [prose(rng, int(rng.integers(0, 40)), words)]
        for _ in range(int(rng.integers(0, 4))):
            parts += [str(rng.choice(shared)), prose(rng, int(rng.integers(0, 30)), words)]
        texts.append("  ".join(parts))
    texts += [texts[0], texts[1].replace("  ", "\n"), " ".join(["run"] * 40), " ".join(["run"] * 25), " ".join(["a", "b"] * 30), " ".join(["a", "b"] * 9)]
    return [(int(i) * 3, t) for i, t in zip(rng.permutation(len(texts)), texts, strict=True)]


@pytest.mark.parametrize("size", [3, 12, 300])
@pytest.mark.parametrize("entries", [1_000_000, 30])
def test_windows_match_all_pairs(spark, monkeypatch, size, entries):
    """Few words give runs, periodic stretches and many windows without a long symbol."""
    monkeypatch.setattr(sub.ex, "BUCKET_ENTRIES", entries)
    rows = corpus(size, vocabulary(np.random.default_rng(size), size))
    got = result(sub.remove_repeats(documents(spark, rows)))
    assert got == brute(rows) and sum(r[2] for r in got) > 500


def test_batches_of_one_document(spark, monkeypatch):
    monkeypatch.setattr(sub, "TEXT_BYTES", 1)
    rows = corpus(7, vocabulary(np.random.default_rng(7), 50), 30)
    assert result(sub.remove_repeats(documents(spark, rows))) == brute(rows)


@pytest.mark.parametrize("size", [2, 3, 20])
def test_equal_windows_have_equal_anchors(size):
    rng = np.random.default_rng(size)
    names = np.array([11, 12, 13, *range(100, 200)], dtype=np.uint64)[:size]
    passages = [rng.choice(names, size=int(n)) for n in rng.integers(13, 60, size=6)] + [np.repeat(names[:1], 30)]
    docs = []
    for _ in range(60):
        parts = [rng.choice(names, size=int(rng.integers(0, 20)))]
        for _ in range(3):
            parts += [passages[int(rng.integers(7))], rng.choice(names, size=int(rng.integers(0, 9)))]
        docs.append(np.concatenate(parts))
    flat = np.concatenate(docs)
    first = np.append(0, np.cumsum([len(d) for d in docs]))
    starts, anchor = sub.anchors(flat, first)
    known = {}
    for s, a in zip(starts, anchor, strict=True):
        assert known.setdefault(flat[s : s + 13].tobytes(), a) == a
    assert len(set(known.values())) <= len(known)


def test_long_passages_have_high_symbols():
    """In ordinary text nearly every window holds a symbol of several words."""
    rng = np.random.default_rng(9)
    names = rng.integers(0, 1 << 62, size=5000).astype(np.uint64)
    _, anchor = sub.anchors(names, np.array([0, 5000]))
    assert len(np.unique(anchor)) < 0.5 * len(anchor)


def test_defined_cases(spark):
    w = " ".join(f"w{k}" for k in range(13))
    rows = [
        (1, None), (2, ""), (3, w), (3, w), (4, w), (4, f"x {w} y"), (None, w), (5, " ".join(f"w{k}" for k in range(12))),
        (6, w.replace("w0", "W0")), (7, "z" * 100_000), (8, w + " " + "q " * 40_000), (9, w.replace(" ", "\t\n")), (10, "é " + w),
    ]
    df = documents(spark, rows).selectExpr("*", "1 as batch", "2 as names", "3 as n_words")
    assert result(sub.remove_repeats(df)) == brute(rows)


def test_empty_table(spark):
    assert result(sub.remove_repeats(documents(spark, []))) == []
