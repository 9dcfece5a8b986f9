"""Near-duplicate embeddings: an exact metric range join within each label.

Vectors of length one with a cosine of at least ``c`` lie within ``r = sqrt(2 - 2c)`` of each other. Every vector
belongs to the cell of its nearest pivot. By the triangle inequality a vector that may lie within ``r`` of a member
of another cell is at most ``2r`` farther from that cell's pivot than from its own; it, and only it, is copied
there (the distance to the plane between the two pivots must also be at most ``r``). Two linked vectors of different cells
would each be copied to the other's; one of the two cells compares them, so the copies of the other one are left out.
Cells are joined independently, and two copied vectors are never compared.

Equal vectors of a label are one vector with a weight. The own rows of a cell and the rows copied there are cut into
blocks of about ``CELL_ROWS``, and each pair of blocks is a task of its own, so no task depends on the size of a cell. A task
sorts its rows by their nearest of a few references and multiplies only runs of rows whose distances to every
reference differ by ``r`` or less, again by the triangle inequality. It returns counts and a spanning forest of its links,
never the links themselves.

Candidates for pivots are the vectors with the smallest hashes of a large label, put in the order of the farthest from those
before. All vectors are then placed by the first 1, 4, 16, ... of them, and each label takes the number that costs
least in compared pairs and copied rows; if cells do not pay, that is one cell. Pivots have fewer than ``PIVOT_VALUES`` numbers in all, which bounds
what is sent to the tasks. Their choice changes the time, not the result.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite component, and a vector without label,
is linked with nothing; vectors of one label but different lengths are not compared; rows with one ``vec_id`` are
separate vectors; a null ``vec_id`` counts as the largest; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.llm.common import number_rows, prepare, store
from tallyframe.llm.components import components

CELL_ROWS = 2048
# bounds the distances between the pivots of a label, which every task holds
PIVOTS_PER_LABEL = 1024
PIVOT_VALUES = 1 << 22
# references of a task, and rows of a run
REFERENCES = 16
RUN_ROWS = 128
# what a copied row costs, in compared pairs: it is written, shuffled and read again
COPY_COST = 500.0
SLACK = 1e-9


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name each usable vector by a hash of its values."""
    for batch in batches:
        copies, dims = [], []
        for v in batch.column("embedding").to_pylist():
            x = np.array(v if v is not None and None not in v else [], dtype=np.float64)
            fit = len(x) > 0 and np.isfinite(x).all() and (x != 0).any()
            copies.append(xxhash.xxh3_128_digest((x + 0.0).tobytes()) if fit else None)
            dims.append(len(x) if fit else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), pa.array(copies, pa.binary()), pa.array(dims, pa.int32())], names=["rid", "copy", "dim"]
        )


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)
    # scaled first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cell_rows(
    own: np.ndarray, pivots: np.ndarray, radius: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, cell and whether the cell is the row's own, for all cells that a row must be in."""
    far = np.sqrt(np.maximum(2.0 - 2.0 * np.clip(own @ pivots.T, -1.0, 1.0), 0.0))
    home = far.argmin(axis=1)
    near = far[np.arange(len(own)), home]
    between = np.sqrt(np.maximum(2.0 - 2.0 * np.clip(pivots @ pivots.T, -1.0, 1.0), 0.0))[home]
    triangle = far - near[:, None] <= 2.0 * radius + SLACK
    plane = far**2 - near[:, None] ** 2 <= 2.0 * between * radius + SLACK
    copied = triangle & plane
    copied[np.arange(len(own)), home] = True
    row, cell = np.nonzero(copied)
    return row, cell, home[row] == cell


def placed_rows(
    x: np.ndarray, pivots: np.ndarray, radius: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``cell_rows`` without the copies of pairs that the other cell compares."""
    row, cell, own = cell_rows(x, pivots, radius)
    home = np.zeros(len(x), dtype=np.int64)
    home[row[own]] = cell[own]
    home = home[row]
    # of two cells the lower one if their numbers are both odd or both even, else the higher one
    kept = own | ((cell < home) == ((cell + home) % 2 == 0))
    return row[kept], cell[kept], own[kept]


def _unit_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ y.T), 0.0))


def spread_order(x: np.ndarray, n: int) -> np.ndarray:
    """The first row and ``n - 1`` more, each the farthest from those before."""
    order, near = [0], _unit_distance(x, x[:1])[:, 0]
    for _ in range(n - 1):
        near[order[-1]] = -1.0
        order.append(int(near.argmax()))
        near = np.minimum(near, np.where(near < 0, near, _unit_distance(x, x[order[-1]][None, :])[:, 0]))
    return np.array(order)


def near_runs(x: np.ndarray, y: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``x`` and of ``y`` that hold between them all pairs within ``radius``, each pair once."""
    if not len(x) or not len(y):
        return
    refs = x[spread_order(x, min(REFERENCES, len(x)))]
    of_x, of_y = _unit_distance(x, refs), _unit_distance(y, refs)

    def cut(d: np.ndarray) -> list[np.ndarray]:
        """Runs of rows that are nearest to the same reference."""
        nearest = d.argmin(axis=1)
        order = np.lexsort((d.min(axis=1), nearest))
        ends = np.flatnonzero(np.append(nearest[order][1:] != nearest[order][:-1], True)) + 1
        starts = np.append(0, ends[:-1])
        return [order[k : min(k + RUN_ROWS, e)] for b, e in zip(starts, ends, strict=True) for k in range(b, e, RUN_ROWS)]

    # roots of rounded differences near zero are off by up to 1e-7
    reach = radius + 1e-6
    runs = cut(of_y)
    low, high = (np.stack([f(of_y[r], axis=0) for r in runs]) for f in (np.min, np.max))
    for rows in cut(of_x):
        least, most = of_x[rows].min(axis=0), of_x[rows].max(axis=0)
        near = ((low - most <= reach) & (least - high <= reach)).all(axis=1)
        if not near.any():
            continue
        columns = np.concatenate([runs[k] for k in np.flatnonzero(near)])
        d = of_y[columns]
        columns = columns[((d - most <= reach) & (least - d <= reach)).all(axis=1)]
        if len(columns):
            yield rows, columns


def _spanning(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links ``row, column`` that connect what all links connect: at most one for each row and column."""
    rows, columns = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
    root = np.arange(links.shape[0])
    i, k = [], []
    # a column ties the rows it is linked with to the first of them
    for c in columns:
        linked = rows[links[rows, c]]
        i.append(linked[0])
        k.append(c)
        for r in linked[root[linked] != root[linked[0]]]:
            if root[r] != root[linked[0]]:
                root[root == root[r]] = root[linked[0]]
                i.append(r)
                k.append(c)
    return np.array(i, dtype=np.int64), np.array(k, dtype=np.int64)


def _forest(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each vector of the links ``a, b`` to the smallest it can reach over them."""
    root = ids.copy()
    while True:
        was = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        if (root == was).all():
            break
    moved = np.flatnonzero(root != ids)
    return ids[moved], root[moved]


def _join_blocks(min_cosine: float):
    radius = float(np.sqrt(2.0 - 2.0 * min_cosine)) + SLACK

    def join(key: tuple, table: pa.Table) -> pa.Table:
        bi, bj = key[-2].as_py(), key[-1].as_py()
        dim = key[1].as_py()
        table = table.combine_chunks()
        x = np.frombuffer(b"".join(table["vector"].to_pylist()), dtype=np.float64).reshape(-1, dim)
        ids, weight, block = table["rid"].to_numpy(), table["weight"].to_numpy(), table["block"].to_numpy()
        left, right = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
        count = np.zeros(len(ids), dtype=np.int64)
        edges = [], []
        for rows, columns in near_runs(x[left], x[right], radius):
            rows, columns = left[rows], right[columns]
            links = x[rows] @ x[columns].T >= min_cosine
            if bi == bj:
                links &= rows[:, None] != columns[None, :]
            count[rows] += links @ weight[columns]
            if bi != bj:
                count[columns] += links.T @ weight[rows]
            i, k = _spanning(links)
            edges[0].append(rows[i])
            edges[1].append(columns[k])
        a, b = (np.concatenate(e) if e else np.zeros(0, dtype=np.int64) for e in edges)
        a, b = _forest(a, b, ids)
        told = np.flatnonzero(count > 0)
        return pa.table({
            "rid": pa.array(np.concatenate([ids[told], a]), pa.int64()),
            "n_links": pa.array(np.concatenate([count[told], np.zeros(len(a), dtype=np.int64)]), pa.int64()),
            "root": pa.array([None] * len(told) + b.tolist(), pa.int64()),
        })

    return join


def _candidate_pivots(reps: DataFrame) -> dict[tuple, np.ndarray]:
    """Candidates of the large labels, by (label, dim), in the order of their spread."""
    groups = store(reps.groupBy("label", "dim").agg(F.count("*").alias("n")), "embedding-groups")
    total, widest = groups.agg(F.sum("n"), F.max("dim")).first()
    if not total:
        return {}
    most = max(1, PIVOT_VALUES // widest // 2)
    size = max(CELL_ROWS, -(-total // most))
    large = groups.where(F.col("n") > size).select(
        "label", "dim", F.least(F.lit(PIVOTS_PER_LABEL), F.ceil(F.col("n") / F.lit(float(size)))).alias("k")
    )
    by_hash = Window.partitionBy("label", "dim").orderBy(F.xxhash64("rid"), "rid")
    first = reps.select("label", "dim", "rid").join(large, ["label", "dim"]).withColumn(
        "i", F.row_number().over(by_hash)
    ).where(F.col("i") <= PIVOTS_PER_LABEL).where(F.col("i") <= F.col("k"))
    found = first.select("rid").join(reps, "rid").select("label", "dim", "rid", "embedding").toArrow()
    out: dict[tuple, list] = {}
    for r in sorted(found.to_pylist(), key=lambda r: r["rid"]):
        out.setdefault((r["label"], r["dim"]), []).append(r["embedding"])
    vectors = {k: _vectors(pa.array(v), k[1]) for k, v in out.items()}
    return {k: v[spread_order(v, len(v))] for k, v in vectors.items()}


def _by_group(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    groups: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True)):
        groups.setdefault(key, []).append(i)
    for key, at in groups.items():
        yield key, batch.take(pa.array(at))


def numbers_of_pivots(most: int) -> list[int]:
    """The numbers of cells that are tried."""
    out = [1]
    while out[-1] * 4 < most:
        out.append(out[-1] * 4)
    return [*out, most] if most > 1 else out


def pick_pivots(reps: DataFrame, radius: float) -> dict[tuple, np.ndarray]:
    """Pivots of the labels that are joined with less work in several cells than in one."""
    candidates = _candidate_pivots(reps)
    if not candidates:
        return {}
    keys = list(candidates)

    def census(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {k: i for i, k in enumerate(keys)}
        seen: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for key, part in _by_group(batch):
                if key not in number:
                    continue
                x = _vectors(part.column("embedding"), key[1])
                for k in numbers_of_pivots(len(candidates[key])):
                    _, cell, own = placed_rows(x, candidates[key][:k], radius)
                    counts = seen.setdefault((number[key], k), np.zeros((2, k), dtype=np.int64))
                    counts[0] += np.bincount(cell[own], minlength=k)
                    counts[1] += np.bincount(cell[~own], minlength=k)
        for (group, k), (own, copied) in seen.items():
            n = len(own)
            yield pa.RecordBatch.from_pydict({
                "group": pa.array([group] * n, pa.int32()), "k": pa.array([k] * n, pa.int32()),
                "cell": pa.array(np.arange(n), pa.int32()), "own": pa.array(own), "copied": pa.array(copied),
            })

    # one row per label and number of cells comes back
    own, copied = F.col("own").cast("double"), F.col("copied").cast("double")
    cost = reps.select("label", "dim", "embedding").mapInArrow(
        census, "group int, k int, cell int, own long, copied long"
    ).groupBy("group", "k", "cell").agg(F.sum("own").alias("own"), F.sum("copied").alias("copied")).groupBy("group", "k").agg(
        F.sum(own * (own / 2 + copied) + F.lit(COPY_COST) * copied).alias("cost")
    ).toArrow().to_pylist()
    best: dict[int, tuple[float, int]] = {}
    for r in cost:
        best[r["group"]] = min(best.get(r["group"], (np.inf, 0)), (r["cost"], r["k"]))
    return {keys[g]: candidates[keys[g]][:k] for g, (_, k) in best.items() if k > 1}


def _cells(pivots: dict[tuple, np.ndarray], radius: float):
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, part in _by_group(batch):
                x = _vectors(part.column("embedding"), key[1])
                if key in pivots:
                    row, cell, own = placed_rows(x, pivots[key], radius)
                else:
                    row, cell, own = np.arange(len(x)), np.zeros(len(x), dtype=np.int64), np.ones(len(x), dtype=bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("label").take(pa.array(row)), part.column("dim").take(pa.array(row)),
                        pa.array(cell.astype(np.int32)), pa.array(own), part.column("rid").take(pa.array(row)),
                        part.column("weight").take(pa.array(row)), pa.array([x[k].tobytes() for k in row], pa.binary()),
                    ],
                    names=["label", "dim", "cell", "own", "rid", "weight", "vector"],
                )

    return spread


def near_duplicates(vectors: DataFrame, min_cosine: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector of ``vec_id, embedding, label``."""
    prepare(vectors.sparkSession)
    order = [F.col("vec_id").asc_nulls_last(), F.xxhash64("embedding")]
    placed = number_rows(vectors.select("vec_id", "label", "embedding"), order, "embeddings")
    numbered = placed.select(
        (F.shiftleft(F.col("part").cast("long"), 33) + F.col("seq")).alias("rid"), "vec_id", "label", "embedding"
    )
    named = numbered.select("rid", "embedding").mapInArrow(_describe, "rid long, copy binary, dim int")
    slim = store(numbered.select("rid", "vec_id", "label").join(named, "rid"), "embedding-names")
    usable = slim.where(F.col("copy").isNotNull() & F.col("label").isNotNull())
    copies = store(
        usable.groupBy("label", "dim", "copy").agg(F.min("rid").alias("rep"), F.count("*").alias("weight")), "embedding-copies"
    )
    reps = store(
        copies.select(F.col("rep").alias("rid"), "label", "dim", "weight").join(numbered.select("rid", "embedding"), "rid"),
        "embedding-reps",
    )
    radius = float(np.sqrt(2.0 - 2.0 * min_cosine)) + SLACK
    pivots = pick_pivots(reps, radius)
    kind = vectors.schema["label"].dataType.simpleString()
    cells = reps.mapInArrow(
        _cells(pivots, radius), f"label {kind}, dim int, cell int, own boolean, rid long, weight long, vector binary"
    )
    cells = store(cells, "embedding-cells")
    # own rows come first in the numbers of blocks, rows copied to the cell after them
    n_blocks = lambda own: F.ceil(F.count_if(own) / F.lit(float(CELL_ROWS))).cast("int")
    blocks = cells.groupBy("label", "dim", "cell").agg(
        n_blocks(F.col("own")).alias("n_own"), n_blocks(~F.col("own")).alias("n_copied")
    ).where(F.col("n_own") > 0)
    at = F.xxhash64("rid")
    dealt = cells.join(blocks, ["label", "dim", "cell"]).withColumn(
        "block",
        F.when(F.col("own"), F.pmod(at, F.col("n_own"))).otherwise(
            F.col("n_own") + F.pmod(at, F.greatest(F.col("n_copied"), F.lit(1)))
        ).cast("int"),
    ).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("n_own") - 1 + F.when(F.col("own"), F.col("n_copied")).otherwise(0)))
    )
    tasks = dealt.select(
        "label", "dim", "cell", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
        "block", "rid", "weight", "vector",
    )
    met = store(
        tasks.groupBy("label", "dim", "cell", "bi", "bj").applyInArrow(
            _join_blocks(min_cosine), "rid long, n_links long, root long"
        ),
        "embedding-links",
    )
    counts = met.where("root is null").groupBy("rid").agg(F.sum("n_links").alias("n_links"))
    roots = components(
        met.where("root is not null").select(F.col("rid").alias("a"), F.col("root").alias("b")), "embedding-roots"
    )
    of_copy = copies.join(counts, F.col("rep") == F.col("rid"), "left").drop("rid").join(
        roots, F.col("rep") == F.col("node"), "left"
    ).select(
        "label", "dim", "copy", (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("root", "rep").alias("root"),
    )
    found = usable.join(of_copy, ["label", "dim", "copy"]).select("rid", "vec_id", "n_links", "root")
    rest = slim.where(F.col("copy").isNull() | F.col("label").isNull()).select(
        "rid", "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("rid").alias("root")
    )
    every = found.unionByName(rest).alias("v")
    names = slim.select(F.col("rid").alias("root"), F.col("vec_id").alias("component_id"))
    return every.join(names, "root").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
