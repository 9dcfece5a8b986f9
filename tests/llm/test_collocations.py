import re

import numpy as np
import pytest

from tallyframe.llm import collocations as co
from tests.llm.helpers import LOW, documents


def brute(rows, least=100, top=2000):
    by_lang = {}
    for _, text, lang, *_ in rows:
        pieces = [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW))]
        by_lang.setdefault("und" if lang is None else lang, []).extend(pieces)
    out = []
    for lang, pieces in by_lang.items():
        f = {}
        for p in pieces:
            for m in range(1, co.LONGEST + 1):
                for k in range(len(p) - m + 1):
                    f[tuple(p[k : k + m])] = f.get(tuple(p[k : k + m]), 0) + 1
        n = sum(len(p) for p in pieces)
        cands = {q: a for q, a in f.items() if len(q) > 1 and a >= least}
        covered = {
            q[i:j] for q, a in cands.items() for i in range(len(q)) for j in range(i + 2, len(q) + 1) if j - i < len(q) and a >= f[q[i:j]]
        }
        best = []
        for q, a in cands.items():
            if q not in covered:
                score, _, l, r = min((1000 * a * n // (f[q[:k]] * f[q[k:]]), k, f[q[:k]], f[q[k:]]) for k in range(1, len(q)))
                best.append((-score, -a, " ".join(q).encode(), l, r))
        for rank, (s, a, q, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, q.decode(), -a, l, r, n, -s))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, n=150):
    """Words of very different frequency, with fixed phrases among them."""
    rng = np.random.default_rng(seed)
    vocabulary = np.array([f"w{k}é" if k % 7 == 0 else f"w{k}" for k in range(120)])
    odds = 1 / np.arange(1, 121)
    phrases = [" ".join(rng.choice(vocabulary, size=int(rng.integers(2, 8)))) for _ in range(25)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(int(rng.integers(1, 25))):
            parts.append(str(rng.choice(phrases)) if rng.random() < 0.5 else " ".join(rng.choice(vocabulary, size=4, p=odds / odds.sum())))
            parts.append(str(rng.choice([" ", " ", ". ", ",", "\n", "\t", ": "])))
        rows.append((i, "".join(parts), str(rng.choice(["en", "de"], p=[0.8, 0.2])), "s"))
    return rows


@pytest.mark.parametrize("seed,least,top,share", [(1, 8, 12, 0.125), (2, 5, 2000, 0.5), (3, 20, 5, 0.01)])
def test_best_phrases_match_counts_of_all(spark, monkeypatch, seed, least, top, share):
    monkeypatch.setattr(co.ex, "BUCKET_ENTRIES", 500)
    rows = corpus(seed)
    want = brute(rows, least, top)
    got = co.mine_phrases(documents(spark, rows), least, top, share, stretch=4000)
    assert result(got) == want and len(want) > 5


def test_defined_cases(spark):
    rows = [
        (1, None, "en", "s"), (2, "", None, "s"), (None, "a b a b a b", None, "s"), (3, "A b\tc. A b\x0bc A B,c", "und", None),
        (3, "A b\tc. A b\x0bc A B,c", "und", None), (4, "x y " * 9000, "", "s"), (5, ("long" * 9000 + " tail ") * 4, "", "s"),
        (6, "Émile Zola! " * 4, "fr", "s"), (7, "a b c d e f g " * 5, "de", "s"), (8, ".,;:!?\n\r", "xx", "s"),
    ]
    df = documents(spark, rows).selectExpr("*", "1 as batch", "2 as names", "3 as rank", "4 as `a.b`")
    assert result(co.mine_phrases(df, least=3)) == brute(rows, 3)


def test_empty_table(spark):
    assert result(co.mine_phrases(documents(spark, []))) == []
    assert result(co.mine_phrases(documents(spark, [(1, None), (2, " . ")]))) == []
