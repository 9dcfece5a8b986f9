import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyframe.llm.common import (
    number_rows, odd_numbers, ranges, rechunk, running_total, span_hash, text_bytes, window_hash, words,
)
from tallyframe.llm.components import components
from tests.llm.helpers import Union, words_of

TEXTS = [
    "a b", "", None, " lead", "trail ", "x\ty\nz\r\x0b\x0cw", "é ñ o", "one", "\x1c a\x85b", "long" * 300 + " end",
    "q" * 255 + " " + "q" * 256 + " " + "q" * 257,
]


def test_words_are_those_of_the_pattern():
    data, offsets = text_bytes(pa.array(TEXTS))
    starts, ends, first = words(data, offsets)
    got = [
        [data[a:b].tobytes().decode() for a, b in zip(starts[x:y], ends[x:y], strict=True)]
        for x, y in zip(first[:-1], first[1:], strict=True)
    ]
    assert got == [words_of(t) for t in TEXTS]


def test_words_of_nothing():
    for texts in ([], [None], ["", ""]):
        starts, _, first = words(*text_bytes(pa.array(texts, pa.string())))
        assert len(starts) == 0 and first.tolist() == [0] * (len(texts) + 1)


def test_text_bytes_follows_slices():
    column = pa.array(TEXTS).slice(3, 4)
    data, offsets = text_bytes(column)
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == TEXTS[3:7]


def test_hashes_depend_on_the_bytes_alone():
    rng = np.random.default_rng(1)
    spans = sorted({bytes(rng.integers(97, 100, size=rng.integers(0, 40)).astype(np.uint8)) for _ in range(4000)})
    spans += [b"a" * n for n in (250, 256, 257, 300, 1000)]
    seen = {}
    for shuffled in (spans, [spans[i] for i in rng.permutation(len(spans))]):
        ends = np.cumsum([len(s) for s in shuffled])
        data = np.frombuffer(b"".join(shuffled), dtype=np.uint8)
        for s, h in zip(shuffled, span_hash(data, ends - [len(s) for s in shuffled], ends).tolist(), strict=True):
            assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)


def test_window_hash_is_a_function_of_the_window():
    names = np.array([1, 2, 3, 1, 2, 3, 2, 1], dtype=np.uint64)
    h = window_hash(names, 3, 7)
    assert h[0] == h[3] and len(set(h.tolist())) == 5
    assert len(window_hash(names, 9, 7)) == 0
    assert (odd_numbers(50, 3) & np.uint64(1)).all()


def test_ranges():
    assert ranges(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]


def test_rechunk_keeps_rows_in_order():
    batches = [pa.RecordBatch.from_pydict({"x": list(range(k, k + 3))}) for k in range(0, 30, 3)]
    out = list(rechunk(iter(batches), 60))
    assert [v for b in out for v in b.column("x").to_pylist()] == list(range(30)) and 1 < len(out) < 10
    assert list(rechunk(iter([]), 10)) == []


def test_running_total_over_ranges(spark):
    rows = [(i % 3 if i % 7 else None, (i * 37) % 101, i) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, k int, v int").repartition(5)
    placed = number_rows(df, [F.col("g").asc_nulls_last(), F.col("k"), F.col("v")], "test-rows")
    for by in ([], ["g"]):
        got = {(r.g, r.k, r.v): r.before for r in running_total(placed, "v", by=by).collect()}
        total = {}
        for g, k, v in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2])):
            key = g if by else 0
            assert got[g, k, v] == total.get(key, 0)
            total[key] = total.get(key, 0) + v


def test_components_of_chains_stars_and_cycles(spark):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    edges += [tuple(map(int, rng.integers(300, 400, size=2))) for _ in range(60)] + [(7, 7)]
    u = Union(500)
    for a, b in edges:
        u.join(a, b)
    df = spark.createDataFrame([tuple(rng.permutation(e).tolist()) for e in edges], "a long, b long").repartition(4)
    got = {r.node: r.root for r in components(df, "test-components").collect()}
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: u.find(x) for x in linked}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "test-components").count() == 0
