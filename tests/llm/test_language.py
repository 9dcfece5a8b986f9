import math
import zlib

import numpy as np
import pytest

from tallyframe.llm import language
from tests.llm.helpers import documents, prose, vocabulary


def corpus(seed, n=240):
    rng = np.random.default_rng(seed)
    letters = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "жзиклмно", "dd": "abéèñürs"}
    words = {k: vocabulary(rng, 80, v) for k, v in letters.items()}
    rows = []
    for i in range(n):
        lang = list(letters)[i % 4]
        text = prose(rng, int(rng.integers(3, 120)), words[lang])
        rows.append((i, text.upper() if i % 11 == 0 else f"12% {text}!! 3.4" if i % 7 == 0 else text, lang))
    return rows


def test_held_out_documents_get_their_language(spark):
    rows = corpus(1)
    got = {r.doc_id: r for r in language.identify(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, _, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= got[i].score <= 1
    held = [r for r in rows if got[r[0]].held_out]
    assert len(held) > 30 and np.mean([got[i].lang_pred == lang for i, _, lang in held]) >= 0.97


def slow_vector(text):
    """The bundled vector of one text, n-gram by n-gram."""
    s = "".join(c if c.isalpha() else " " for c in text.lower())
    s = " " + "".join(w + " " for w in s.split())
    out = np.zeros(language.DIM)
    for k in range(len(s) - 2):
        a, b, c = (language.letter_vectors(np.array([ord(x)]))[0].astype(int) for x in s[k : k + 3])
        out += np.roll(a, 2) * np.roll(b, 1) * c
    return out


@pytest.mark.parametrize("cells", [1 << 21, 200])
def test_bundles_match_a_slow_twin(monkeypatch, cells):
    monkeypatch.setattr(language, "CELLS", cells)
    monkeypatch.setattr(language, "GRAMS_AT_ONCE", 64 if cells == 200 else 8192)
    texts = ["Hello, world", "a", "  ", None, "", "ñandú 12 x", "ab" * 50, "123", "日本語 テキスト", "İstanbul"]
    sums, has = language.bundle(texts)
    for t, s, h in zip(texts, sums, has, strict=True):
        want = slow_vector(t or "")
        assert h == any(c.isalpha() for c in (t or "").lower())
        if h:
            assert (s == want).all(), t
        else:
            assert not s.any()


def test_partitioning_changes_nothing(spark):
    rows = corpus(2, 80)
    a, b = (sorted(tuple(r) for r in language.identify(documents(spark, rows, parts=p)).collect()) for p in (1, 6))
    assert [r[:3] for r in a] == [r[:3] for r in b]
    assert all(math.isclose(x[3], y[3], abs_tol=1e-9) for x, y in zip(a, b, strict=True))


def test_labels_of_other_rows_only_teach(spark):
    """Neither source nor the label of a held-out row changes a prediction."""
    rows = corpus(3, 80)
    out = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    other = [(i, t, None if out[i] else lang, "elsewhere") for i, t, lang in rows]
    a, b = (sorted(tuple(r)[:3] for r in language.identify(documents(spark, x)).collect()) for x in (rows, other))
    assert a == b


def test_defined_cases(spark):
    rows = [
        (1, "abc abd", "x"), (3, None, "x"), (4, "", "x"), (5, "12 34 !?", "x"), (6, "abc", None), (7, "абв", "y"), (7, "абв", "y"),
        (None, "abc", "x"), (9, "абв " * 40_000, "y"), (10, "abc abd", "w"),
    ]
    got = language.identify(documents(spark, rows).selectExpr("*", "1 as score", "2 as lang_pred", "3 as vector")).collect()
    by_id = {r.doc_id: r for r in got if r.doc_id != 7}
    assert len(got) == len(rows)
    assert [by_id[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and [by_id[i].score for i in (3, 4, 5)] == [0.0] * 3
    assert by_id[9].lang_pred == "y" and by_id[None].held_out is False
    # languages that cannot be told apart: the first by code point
    assert by_id[1].lang_pred == by_id[10].lang_pred


def test_nothing_to_learn_from(spark):
    assert language.identify(documents(spark, [])).collect() == []
    got = language.identify(documents(spark, [(1, "abc", None), (2, "", None)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2


def test_filter_keeps_what_has_a_language(spark):
    rows = corpus(4, 120)
    rows += [(500, None, "aa"), (501, "12 34", "aa"), (502, "", None), (503, "東京都" * 200, None), (504, "a", "aa"), (505, "ж", None)]
    df = documents(spark, rows).selectExpr("*", "lang as lang_pred", "1 as score")
    kept = language.keep_identified(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r[0] for r in rows} - {500, 501, 502, 503})
    unlabelled = documents(spark, [(1, "abc", None), (2, "1", None)])
    assert [r.doc_id for r in language.keep_identified(unlabelled).collect()] == [1]
