import numpy as np
import pytest

from tallyframe.llm import mixing
from tests.llm.helpers import documents, prose, vocabulary, words_of


def water_fill(sizes, weights, total=1.5, most=2.0):
    """Targets by repeated resharing of what stops."""
    left, open_ = total * sum(sizes), set(range(len(sizes)))
    target = [0.0] * len(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if most * sizes[i] < level * weights[i]}
        if not full:
            for i in open_:
                target[i] = level * weights[i]
            break
        for i in full:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ -= full
    return target


def corpus(seed, n=120):
    rng = np.random.default_rng(seed)
    words = vocabulary(rng, 200)
    names = ["Z", "a", "b", "é", "\U0001f600", "￿", None]
    share = np.array([8, 4, 2, 1, 1, 1, 1.0])
    return [(i, prose(rng, int(rng.integers(1, 400)), words), "en", names[rng.choice(7, p=share / share.sum())]) for i in range(n)]


@pytest.mark.parametrize("seed", [1])
def test_shares_limits_and_repeats(spark, seed):
    rows = corpus(seed)
    got = {r.doc_id: r for r in mixing.mix_counts(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    order = sorted({r[3] for r in rows}, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    sizes = [sum(len(words_of(r[1])) for r in rows if r[3] == s) for s in order]
    target = water_fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(order))])
    for s, n, t in zip(order, sizes, target, strict=True):
        own = [got[r[0]] for r in rows if r[3] == s]
        assert {r.source_size for r in own} == {n}
        assert all(abs(r.target - t) < 1e-6 * max(t, 1) for r in own)
        taken = sum(r.taken for r in own)
        assert abs(taken - t) <= mixing.BLOCK_WORDS and taken <= 2 * n
    for r in rows:
        assert got[r[0]].size == len(words_of(r[1])) and 0 <= got[r[0]].taken <= 2 * got[r[0]].size
    again = {r.doc_id: r for r in mixing.mix_counts(documents(spark, rows, parts=5)).collect()}
    assert got == again


def test_many_shards_deal_the_same_totals(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS_PER_SHARD", 7)
    rows = corpus(3, 60)
    df = documents(spark, rows)
    placed = mixing.number_rows(mixing.measured(df), [mixing.F.col("source").asc_nulls_last(), mixing.F.col("doc_id"), mixing.F.col("tie")], "t")
    targets = mixing.source_targets(placed)
    slots = mixing.draw_slots(spark, targets, slots_per_shard=7).collect()
    quota = {r.source_no: r.quota for r in targets.collect()}
    for s, n in quota.items():
        assert sorted(r["index"] for r in slots if r.source_no == s) == list(range(n))
    per_shard = {k: sum(r.shard == k for r in slots) for k in {r.shard for r in slots}}
    assert set(sorted(per_shard.values())[1:]) == {7}


def test_permutations_are_one_to_one():
    for n in (1, 2, 3, 5, 64, 65, 1000, 4097):
        for key in (1, 99):
            got = mixing.permute(np.arange(n), np.full(n, n), np.full(n, key, dtype=np.uint64))
            assert sorted(got.tolist()) == list(range(n))
    a = mixing.permute(np.arange(1000), np.full(1000, 1000), np.full(1000, 1, dtype=np.uint64))
    assert (a != np.arange(1000)).mean() > 0.9


def test_defined_cases(spark):
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, "one", "en", "b"), (3, "two words", "en", "b"), (4, "x " * 50_000, "en", None),
        (None, "p q", "en", "b"), (5, " \t", None, None),
    ]
    got = mixing.mix_counts(documents(spark, rows).selectExpr("*", "1 as part", "2 as seq", "3 as target", "4 as size")).collect()
    assert sorted((r.doc_id or -1, r.size) for r in got) == [(-1, 2), (1, 0), (2, 0), (3, 1), (3, 2), (4, 50_000), (5, 0)]
    assert all(r.taken <= 2 * r.size for r in got) and sum(r.taken for r in got if r.size == 50_000) > 70_000


@pytest.mark.parametrize("rows", [[], [(1, None, "en", "a")]])
def test_nothing_to_mix(spark, rows):
    got = mixing.mix_counts(documents(spark, rows)).collect()
    assert [(r.target, r.taken) for r in got] == [(0.0, 0)] * len(rows)
    assert mixing.mix_documents(documents(spark, rows)).collect() == []


def test_mixed_documents_hold_the_words_that_are_counted(spark):
    rows = corpus(5, 80) + [(900, " two  spaced\twords ", "en", "a")]
    df = documents(spark, rows).selectExpr("*", "doc_id as part", "lang as uses")
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns
    taken = {r.doc_id: r.taken for r in mixing.mix_counts(df).collect()}
    texts = {r[0]: r[1] for r in rows}
    seen = {}
    for r in mixed.collect():
        assert r.n_chars == len(r.text) and r.part == r.doc_id
        own = words_of(texts[r.doc_id])
        for line in r.text.split("\n") if r.text != texts[r.doc_id] else [r.text]:
            piece = words_of(line)
            assert any(own[i : i + len(piece)] == piece for i in range(len(own)))
        seen[r.doc_id] = seen.get(r.doc_id, 0) + len(words_of(r.text))
    assert {k: seen.get(k, 0) for k in taken} == taken


def test_texts_are_not_stored_and_equal_rows_stay_apart(spark, monkeypatch):
    """Rows alike but for one column, or in every column, keep their own copies; what is put in order holds no text."""
    rows = [(1, "a b c"), (1, "a b c"), (1, "a b c"), (None, "d e"), (None, "d e"), (2, "f g"), (2, "f h"), (3, ""), (4, None)]
    marks = [(None, 5), (5, None), (5, None), (1, 1), (1, 2), (0, 0), (0, 0), (0, 0), (0, 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, x long, y long, tags map<string,long>, part long"
    full = [(i, t, "en", None, None if t is None else len(t), *m, {"k": m[0]}, 9) for (i, t), m in zip(rows, marks, strict=True)]
    stored, plain = [], mixing.number_rows
    monkeypatch.setattr(mixing, "number_rows", lambda df, *rest: stored.append(df) or plain(df, *rest))
    mixed = mixing.mix_documents(spark.createDataFrame(full, schema).repartition(3), block_words=1, total=2.0)
    key = lambda r: tuple((v is not None, v) for v in r)
    got = sorted(((r.doc_id, r.text, r.x, r.y, r.tags["k"]) for r in mixed.collect()), key=key)
    assert got == sorted([(r[0], r[1], *m, m[0]) for r, m in zip(rows, marks, strict=True) if r[1]] * 2, key=key)
    kept = next(df for df in stored if "tie" in df.columns)
    assert not [r for r in kept.collect() if "a b c" in str(r.asDict(recursive=True))]
