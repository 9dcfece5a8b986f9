import numpy as np
import pytest

from tallyframe.llm import suffix_sort as su
from tests.llm.helpers import documents, prose, vocabulary


def brute(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    counts = {}
    for x in texts:
        for p in range(len(x) - window + 1):
            counts[x[p : p + window]] = counts.get(x[p : p + window], 0) + 1
    out = []
    for (i, _), x in zip(rows, texts, strict=True):
        gone = np.zeros(len(x) + 1, dtype=bool)
        for p in range(len(x) - window + 1):
            if counts[x[p : p + window]] > 1:
                gone[p : p + window] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((i, len(x), int(gone.sum()), spans, bytes(b for b, g in zip(x, gone, strict=False) if not g)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def result(df):
    rows = df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    return sorted(((*r[:4], bytes(r[4])) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def corpus(seed, words, n=60):
    rng = np.random.default_rng(seed)
    shared = [prose(rng, int(rng.integers(3, 90)), words) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = [prose(rng, int(rng.integers(0, 40)), words)]
        for _ in range(int(rng.integers(0, 4))):
            parts += [str(rng.choice(shared)), prose(rng, int(rng.integers(0, 30)), words)]
        texts.append(" ".join(parts))
    near = texts[0].replace("a", "é", 1)
    return list(enumerate([*texts, texts[0], texts[1] + "x", near, "run" * 60, "run" * 25, "x" * 300, "ab" * 90]))


@pytest.mark.parametrize("seed,window,hot", [(1, 20, 10**6), (2, 57, 10**6), (3, 100, 4), (4, 33, 0)])
def test_windows_match_brute_force(spark, monkeypatch, seed, window, hot):
    monkeypatch.setattr(su, "RANGE", 50)
    monkeypatch.setattr(su.ex, "BUCKET_ENTRIES", 300)
    rows = corpus(seed, vocabulary(np.random.default_rng(seed), 200, "abcdeé"))
    got = result(su.remove_repeats(documents(spark, rows), window, stretch=3000, hot=hot))
    assert got == brute(rows, window) and sum(r[2] for r in got) > 500


def test_default_window(spark):
    rng = np.random.default_rng(5)
    words = vocabulary(rng, 400)
    passage = prose(rng, 300, words)
    rows = [(i, prose(rng, 200, words) + passage[i * 7 : 500 + i * 40] + prose(rng, 50, words)) for i in range(20)]
    rows += [(50, passage[:400]), (51, "§" + passage[:400]), (52, passage[:399]), (53, passage[1:400] + "§")]
    got = result(su.remove_repeats(documents(spark, rows)))
    assert got == brute(rows, 400) and sum(r[2] for r in got) > 5000


@pytest.mark.parametrize("runs", [1, 2, 3, 8, 13])
def test_loser_tree(runs):
    rng = np.random.default_rng(runs)
    width, coded, rows = 4, [], []
    for r in range(runs):
        own = sorted({tuple(x) for x in rng.integers(0, 3, size=(int(rng.integers(0, 30)), width)).tolist()})
        shared = [0] + [next(k for k in range(width) if a[k] != b[k]) for a, b in zip(own, own[1:], strict=False)]
        coded.append((shared[: len(own)], [v for x, k in zip(own, shared, strict=False) for v in x[k:]]))
        rows += [(x, r) for x in own]
    rows.sort()
    want = []
    for k, (x, r) in enumerate(rows):
        last = rows[k - 1][0] if k else ()
        same = next((j for j in range(len(last)) if last[j] != x[j]), len(last))
        want.append((same, x[-1]))
    assert [m[1:] for m in su.merge_runs(coded, width)] == want


def test_equal_windows_have_equal_anchors():
    import pyarrow as pa

    rng = np.random.default_rng(9)
    text = "".join(rng.choice(list("abc"), size=3000))
    both = su.Stretch(pa.array([text, "xyz" + text[500:2500] + "q"]), 100)
    doc = both.at >= 3000
    first = set((both.at[~doc] - 0).tolist())
    inner = both.at[doc & (both.low >= 3003) & (both.high + 100 <= 3003 + 2000)] - 3003 + 500
    assert len(inner) > 20 and set(inner.tolist()) <= first


def test_defined_cases(spark):
    w = "0123456789" * 3
    rows = [
        (1, None), (2, ""), (3, w), (3, w), (None, w + "tail"), (5, "short"), (6, "é" * 40), (7, "z" * 50_000), (8, "q" + "é" * 41),
        (9, "퟿\U0001f600 other text without any repeat"), (None, None),
    ]
    df = documents(spark, rows).selectExpr("*", "1 as batch", "2 as names", "3 as kept", "4 as `a.b`")
    assert result(su.remove_repeats(df, 30)) == brute(rows, 30)


def test_empty_table(spark):
    assert result(su.remove_repeats(documents(spark, []))) == []
