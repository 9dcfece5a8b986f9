import re

import numpy as np
import pytest

from tallyframe.llm import decontaminate as dc
from tests.llm.helpers import documents, prose, vocabulary

ITEMS = "item_id long, text string"


def toks(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def brute(docs, items):
    out = {}
    for i, t in docs:
        w = toks(t)
        for k, x in items:
            y = toks(x)
            for p in range(len(w) - 12):
                n = max((sum(a == b for a, b in zip(w[p : p + 13], y[q : q + 13], strict=True)) for q in range(len(y) - 12)), default=0)
                if n >= 11:
                    lo, hi, m, best = out.get((i, k), (p, 0, 0, 0))
                    out[i, k] = (min(lo, p), max(hi, p + 13), m + 1, max(best, n))
    return sorted((i, k, *v) for (i, k), v in out.items())


def result(df):
    return sorted(tuple(r) for r in df.select("doc_id", "item_id", "first_word", "last_word", "n_windows", "n_equal").collect())


def corpus(seed):
    rng = np.random.default_rng(seed)
    words = vocabulary(rng, 120)
    items = [(k, prose(rng, int(rng.integers(8, 45)), words)) for k in range(15)]
    docs = [(i, prose(rng, int(rng.integers(0, 150)), words)) for i in range(40)]
    for i in range(60):
        w = items[int(rng.integers(15))][1].split()
        for _ in range(int(rng.integers(0, 5))):
            w[int(rng.integers(len(w)))] = str(rng.choice(words))
        text = f"{prose(rng, 30, words)} {' '.join(w)}! {prose(rng, 30, words)}"
        docs.append((100 + i, text.upper() if i % 5 == 0 else text.replace(" ", ", ") if i % 5 == 1 else text))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_every_overlap_within_the_tolerance_is_found(spark, seed):
    docs, items = corpus(seed)
    bench = spark.createDataFrame(items, ITEMS)
    got = result(dc.find_overlaps(documents(spark, docs), bench))
    assert got == brute(docs, items) and len(got) > 30


def test_a_full_filter_lets_the_join_decide(spark, monkeypatch):
    monkeypatch.setattr(dc, "MIN_BITS", 64)
    monkeypatch.setattr(dc, "MAX_BITS", 64)
    docs, items = corpus(3)
    got = result(dc.find_overlaps(documents(spark, docs), spark.createDataFrame(items, ITEMS)))
    assert got == brute(docs, items)


def test_any_two_positions_may_differ():
    rng = np.random.default_rng(4)
    names = rng.integers(0, 1 << 62, size=13).astype(np.uint64)
    base = dc.masked_hashes(names)[:, 0]
    for i in range(13):
        for j in range(13):
            other = names.copy()
            other[[i, j]] += np.uint64(1)
            assert (dc.masked_hashes(other)[:, 0] == base).any()


def test_defined_cases(spark):
    item = "a b c d e f g h i j k l m n"
    docs = [(1, None), (2, ""), (3, item), (3, item), (4, "z " * 60_000 + item), (5, item[:-4]), (None, item), (6, "É" + item), (7, "é" + item)]
    items = [(1, item), (1, item), (1, "q " * 13), (2, "too short"), (3, None), (4, "é" + item)]
    df = documents(spark, docs).selectExpr("*", "1 as pos", "2 as hash", "3 as item_id")
    got = dc.find_overlaps(df, spark.createDataFrame(items, ITEMS).selectExpr("*", "7 as doc_id")).collect()
    # the letter before an item makes its first word another one, which is one substitution
    assert {(r.doc_id, r.item_id) for r in got} == {(d, k) for d in (3, 4, None, 6, 7) for k in (1, 4)}
    kept = dc.remove_contaminated(df, spark.createDataFrame(items, ITEMS))
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 5]


def test_empty_tables(spark):
    docs, items = documents(spark, [(1, "a " * 20)]), spark.createDataFrame([(1, "a " * 20)], ITEMS)
    assert dc.find_overlaps(docs, items.limit(0)).count() == 0
    assert dc.find_overlaps(docs.limit(0), items).count() == 0
    assert dc.remove_contaminated(docs, items.limit(0)).count() == 1


def test_short_items_are_found_whole(spark):
    """Every item under 13 tokens that a document holds verbatim, against a search over all places."""
    docs, items = corpus(5)
    items = [(k, t) for k, t in items if len(toks(t)) > 12]
    items += [(100 + n, " ".join(docs[40 + n][1].split()[n : 2 * n + 1])) for n in range(12)] + [(100, "a b c"), (200, " ,")]
    docs += [(500, items[0][1] + " " + items[-4][1]), (500, items[-4][1]), (501, "A, b. C! a b c"), (502, None)]
    want = {(d, k, *r) for d, k, *r in brute([x for x in docs if x[0] != 500], items)}
    for d, t in docs:
        w = toks(t)
        for k, x in items:
            y = toks(x)
            at = [p for p in range(len(w) - len(y) + 1) if w[p : p + len(y)] == y] if 0 < len(y) < 13 else []
            if at and d != 500:
                want.add((d, k, at[0], at[-1] + len(y), len(at), len(y)))
    df, bench = documents(spark, docs), spark.createDataFrame(items, ITEMS)
    got = result(dc.find_all(df, bench))
    assert sorted(r for r in got if r[0] != 500 and r[1] != 100) == sorted(r for r in want if r[1] != 100)
    assert len({r[1] for r in got if r[1] > 100}) > 10 and (501, 100, 0, 6, 2, 3) in got
    # rows of one document identifier are reported together
    assert {r[1] for r in got if r[0] == 500} >= {items[0][0], items[-4][0]}
    kept = {r.doc_id for r in dc.remove_contaminated(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {r[0] for r in got}


def test_scripts_without_blanks(spark):
    item = "你好世界今天天气很好我们去公园吧"
    thai = "สวัสดี"
    docs = [
        (1, "我说" + item + "了"), (2, "x" + item[:7] + "不" + item[8:] + "y"), (3, item[:12]),
        (4, "abc" + thai + "def"), (5, "𠀀𠀁 café"), (6, thai[:-1]),
    ]
    items = [(1, item), (2, thai), (3, "𠀁"), (4, "abc")]
    got = result(dc.find_all(documents(spark, docs), spark.createDataFrame(items, ITEMS)))
    assert got == [(1, 1, 2, 18, 4, 13), (2, 1, 1, 17, 4, 12), (4, 2, 1, 7, 1, 6), (4, 4, 0, 1, 1, 1), (5, 3, 1, 2, 1, 1)]


def test_only_short_items_and_none(spark):
    docs = documents(spark, [(1, "yes it is"), (2, "no"), (3, "")])
    got = result(dc.find_all(docs, spark.createDataFrame([(7, "Yes")], ITEMS)))
    assert got == [(1, 7, 0, 1, 1, 1)]
    assert dc.find_all(docs, spark.createDataFrame([(7, "?")], ITEMS)).count() == 0
