import math

import numpy as np
import pytest

from tallyframe.llm import embeddings
from tests.llm.helpers import Union

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.93):
    n = len(rows)
    u, links = Union(n), [0] * n
    unit = []
    for _, v, label in rows:
        ok = v is not None and label is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, dtype=np.float32).astype(float) if ok else None
        unit.append(x / np.linalg.norm(x) if ok else None)
    for i in range(n):
        for j in range(i + 1, n):
            if unit[i] is None or unit[j] is None or rows[i][2] != rows[j][2] or len(unit[i]) != len(unit[j]):
                continue
            if unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                u.join(i, j)
    root = [u.find(i) for i in range(n)]
    least_id = {}
    for i, r in enumerate(root):
        least_id[r] = min(least_id.get(r, 1 << 60), rows[i][0])
    return sorted((rows[i][0], links[i], least_id[root[i]], rows[i][0] == least_id[root[i]]) for i in range(n))


def clustered(rng, n, dim=8, labels=2):
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] + rng.normal(size=dim) * rng.choice([0.0, 0.15, 0.35, 1.0])
        rows.append((i * 3, [float(np.float32(x)) for x in v], int(rng.integers(labels))))
    return rows


def result(df):
    return sorted(tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect())


@pytest.mark.parametrize("cell_rows", [2048, 16])
def test_links_of_clusters(spark, monkeypatch, cell_rows):
    """With small cells every label has pivots, copied rows and several blocks."""
    monkeypatch.setattr(embeddings, "CELL_ROWS", cell_rows)
    rng = np.random.default_rng(5)
    rows = clustered(rng, 260)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = result(embeddings.near_duplicates(df))
    assert got == brute(rows)
    assert sum(r[1] for r in got) > 500


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, [1.0, 0.0], None),
        (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [None, 1.0], 1),
        (12, [1.0, 0.0, 0.0], 1), (13, [-0.0, 1.0], 3), (14, [0.0, 1.0], 3), (15, [1e30, 0.0], 4), (16, [1e-30, 0.0], 4),
    ]
    assert result(embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_repeated_ids_extra_columns_and_null_ids(spark):
    rows = [(1, [1.0, 0.0], 1, "x"), (1, [1.0, 0.0], 1, "y"), (2, [0.0, 1.0], 1, "x"), (None, [1.0, 0.0], 1, "z")]
    df = spark.createDataFrame(rows, SCHEMA + ", rid string").withColumnRenamed("rid", "copy")
    got = sorted(embeddings.near_duplicates(df).collect(), key=lambda r: (r.vec_id is None, r.vec_id or 0))
    assert [tuple(r) for r in got] == [(1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (None, 2, 1, False)]


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_cells_hold_every_link():
    """Whatever the pivots, a vector's own cell holds all vectors within the radius."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(150, 5)), rng.normal(size=(5, 5)).repeat(20, axis=0) + rng.normal(size=(100, 5)) * 0.2])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for least in (0.5, 0.93):
        radius = math.sqrt(2 - 2 * least) + embeddings.SLACK
        pivots = x[rng.choice(len(x), 12, replace=False)]
        row, cell, own = embeddings.cell_rows(x, pivots, radius)
        inside = {c: set(row[cell == c].tolist()) for c in range(12)}
        home = dict(zip(row[own].tolist(), cell[own].tolist(), strict=True))
        assert len(home) == len(x)
        for i, j in zip(*np.nonzero(x @ x.T >= least), strict=True):
            assert j in inside[home[i]]


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def close_groups(rng, n, groups, dim, spread):
    return unit(rng.normal(size=(groups, dim))[rng.integers(groups, size=n)] + rng.normal(size=(n, dim)) * spread)


def test_each_linked_pair_meets_in_one_cell():
    """Pairs of two cells are compared in one of them, pairs of one cell there."""
    rng = np.random.default_rng(9)
    x = np.concatenate([unit(rng.normal(size=(150, 5))), close_groups(rng, 150, 6, 5, 0.25)])
    for least in (0.5, 0.93):
        radius = math.sqrt(2 - 2 * least) + embeddings.SLACK
        row, cell, own = embeddings.placed_rows(x, x[rng.choice(len(x), 13, replace=False)], radius)
        met = np.zeros((len(x), len(x)), dtype=int)
        for c in range(13):
            mine, copied = row[(cell == c) & own], row[(cell == c) & ~own]
            met[np.ix_(mine, mine)] += 1
            met[np.ix_(mine, copied)] += 1
            met[np.ix_(copied, mine)] += 1
        assert met.max() == 1
        assert (met[x @ x.T >= least] == 1).all()


def test_runs_hold_all_near_pairs_once():
    rng = np.random.default_rng(10)
    radius = math.sqrt(2 - 2 * 0.93) + embeddings.SLACK
    x, y = close_groups(rng, 900, 30, 16, 0.03), close_groups(np.random.default_rng(10), 700, 30, 16, 0.05)
    met = np.zeros((len(x), len(y)), dtype=int)
    for rows, columns in embeddings.near_runs(x, y, radius):
        met[np.ix_(rows, columns)] += 1
    assert met.max() == 1
    near = x @ y.T >= 0.93
    assert near.sum() > 1000 and (met[near] == 1).all()
    # groups lie apart, so most pairs are ruled out by their distances to the references
    assert met.sum() < 0.4 * met.size
    assert list(embeddings.near_runs(x[:0], y, radius)) == []


def test_cells_only_where_they_pay(spark, monkeypatch):
    """Groups that lie apart get several pivots, evenly scattered vectors one cell."""
    # cells a fiftieth of their size, with the charge of a copied row in proportion
    monkeypatch.setattr(embeddings, "CELL_ROWS", 40)
    monkeypatch.setattr(embeddings, "COPY_COST", embeddings.COPY_COST / 50)
    rng = np.random.default_rng(11)
    rows = [(i, [float(v) for v in x], 1, 1, 64) for i, x in enumerate(close_groups(rng, 400, 8, 64, 0.02))]
    rows += [(1000 + i, [float(v) for v in x], 2, 1, 64) for i, x in enumerate(unit(rng.normal(size=(400, 64))))]
    reps = spark.createDataFrame(rows, "rid long, embedding array<double>, label int, weight long, dim int")
    pivots = embeddings.pick_pivots(reps, math.sqrt(2 - 2 * 0.93) + embeddings.SLACK)
    assert len(pivots[1, 64]) > 3
    assert (2, 64) not in pivots or len(pivots[2, 64]) < 3


def test_links_of_a_run_are_spanned_by_few():
    rng = np.random.default_rng(12)
    for share in (0.01, 0.05, 0.5):
        links = rng.random((60, 90)) < share
        u, v = Union(150), Union(150)
        for i, k in zip(*np.nonzero(links), strict=True):
            u.join(int(i), 60 + int(k))
        i, k = embeddings._spanning(links)
        assert len(i) <= 150 and links[i, k].all()
        for a, b in zip(i, k, strict=True):
            v.join(int(a), 60 + int(b))
        assert len({(u.find(n), v.find(n)) for n in range(150)}) == len({u.find(n) for n in range(150)}) == len({v.find(n) for n in range(150)})


def test_links_across_cells(spark, monkeypatch):
    """Copies are free here, so that both labels are cut into cells of several blocks."""
    monkeypatch.setattr(embeddings, "CELL_ROWS", 16)
    monkeypatch.setattr(embeddings, "COPY_COST", 0.0)
    picked, pick = [], embeddings.pick_pivots
    monkeypatch.setattr(embeddings, "pick_pivots", lambda *args: picked.append(pick(*args)) or picked[-1])
    rows = clustered(np.random.default_rng(13), 300)
    assert result(embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute(rows)
    assert len(picked[0]) == 2 and all(len(p) > 1 for p in picked[0].values())
