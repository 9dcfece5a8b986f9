import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import jaccard
from tests.llm.helpers import LOW, Union, documents, prose, vocabulary, words_of


def shingles(text):
    w = words_of((text or "").translate(LOW))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    u = Union(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                u.join(i, j)
    least = {}
    for i, r in enumerate(rows):
        least[u.find(i)] = min(least.get(u.find(i), 1 << 60), r[0])
    return sorted((r[0], len(s), least[u.find(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def near_copies(rng, words, base, n, changes):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(int(rng.integers(0, changes + 1))):
            w[int(rng.integers(len(w)))] = str(rng.choice(words))
        out.append(" ".join(w))
    return out


def corpus(rng, groups=12):
    words = vocabulary(rng, 400)
    texts = [prose(rng, int(rng.integers(1, 300)), words) for _ in range(30)]
    passage = prose(rng, 40, words)
    texts += [f"{prose(rng, 60, words)} {passage} {prose(rng, 60, words)}" for _ in range(15)]
    for _ in range(groups):
        n = int(rng.integers(3, 250))
        texts += near_copies(rng, words, prose(rng, n, words), int(rng.integers(2, 9)), max(1, n // 40))
    texts += near_copies(rng, words, prose(rng, 200, words), 40, 8) + [texts[0]] * 3
    return [(i * 2, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(spark, seed):
    rows = corpus(np.random.default_rng(seed))
    got = jaccard.similar_documents(documents(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_small_blocks_and_buckets(spark, monkeypatch):
    """Entries are spread over many buckets and large entries over many block pairs."""
    monkeypatch.setattr(jaccard, "BLOCK_ELEMENTS", 600)
    monkeypatch.setattr(jaccard, "BUCKET_ENTRIES", 500)
    rows = corpus(np.random.default_rng(3))
    got = jaccard.similar_documents(documents(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_defined_cases(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (7, "a b c d e"),
        (8, "A b\tc d E"), (9, "É b c d e"), (10, "é b c d e"), (11, "a b c d e a b c d e"), (12, "x" * 100_000), (13, "x" * 100_000),
    ]
    got = jaccard.similar_documents(documents(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "p q r s t"), (None, "a b c d e f"), (None, "")]
    got = jaccard.similar_documents(documents(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got) == [
        (-1, 0, -1), (-1, 2, 1), (1, 1, 1), (1, 2, 1), (1, 2, 1),
    ]


def test_empty_table(spark):
    assert jaccard.similar_documents(documents(spark, [])).collect() == []
    assert jaccard.keep_one(documents(spark, [])).collect() == []


def test_keep_one_keeps_the_smallest_and_all_columns(spark):
    rows = [(5, "a b c d e f"), (3, "A b c d e f"), (9, "p q r s t"), (2, ""), (1, None), (7, "")]
    df = documents(spark, rows).selectExpr("*", "doc_id as node", "lang as root")
    got = jaccard.keep_one(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 2, 3, 7, 9]


def test_keep_one_neither_stores_nor_doubts_whole_texts(spark, monkeypatch):
    """Tables on the way hold no text, rows with words that are alike in every column leave one, and few others are looked up."""
    stored, marked = [], []
    plain, mark = jaccard.store, jaccard._with_doubt
    monkeypatch.setattr(jaccard, "store", lambda df, label: stored.append(plain(df, label)) or stored[-1])
    monkeypatch.setattr(jaccard, "_with_doubt", lambda rows, named: marked.append(mark(rows, named)) or marked[-1])
    rows = corpus(np.random.default_rng(8))
    base = len(rows)
    rows += [(rows[0][0], "all alike in these words")] * 3 + [(base + 1, " \t")] * 3 + [(None, "x y z")] * 2 + [(base + 2, None)] * 2
    df = documents(spark, rows).withColumn("tags", F.create_map(F.lit("k"), F.lit(None).cast("long"))).repartition(4)
    got = jaccard.keep_one(df)
    assert got.columns == df.columns
    single = {t: min((i is None, i or 0) for i, u in rows if u == t) for _, t in rows}
    numbered = [(k, t) for k, (_, t) in enumerate(rows)]
    best = {}
    for k, _, root in brute(numbered):
        if rows[k][1] and rows[k][1].strip():
            best.setdefault(root, []).append((*single[rows[k][1]], rows[k][1]))
    want = sorted((i for _, i, _ in (min(v, key=lambda x: x[:2]) for v in best.values())))
    kept = got.collect()
    assert sorted(r.doc_id or 0 for r in kept if r.text and r.text.strip()) == want
    assert sum(r.text == " \t" for r in kept) == 3 and sum(r.text is None for r in kept) == 2
    assert all("text" not in x.schema.simpleString() for x in stored)
    looked = [r for r in marked[0].collect() if r._doubt]
    names = [(r._tie, r._rest) for r in looked]
    copies = {(r._tie, r._rest) for r in stored[-1].collect()}
    assert copies <= set(names) and len(names) < len(rows) / 2 and len(set(names) - copies) <= len(rows) / 20


def test_similar_sets_share_an_entry():
    """The pigeonhole: sets at and just above the threshold, of all sizes, meet in the index."""
    rng = np.random.default_rng(4)
    for _ in range(1500):
        n = int(rng.choice([1, 2, 3, 5, 9, 20, 60, 150, 400]) + rng.integers(0, 5))
        a = np.unique(rng.integers(0, 1 << 63, size=n).astype(np.uint64) * np.uint64(2))
        n = len(a)
        drop = int(rng.integers(0, n // 5 + 1))
        b = a[rng.permutation(n)[: n - drop]]
        add = int(max(0, (n - drop) * 5 // 4 - n))
        b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, size=add).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 80 * (len(a) + len(b) - shared):
            continue
        met = False
        for x, ux in jaccard.spaces_of(len(a)):
            for y, uy in jaccard.spaces_of(len(b)):
                if x == y and not (ux and uy):
                    met |= bool(len(np.intersect1d(jaccard.entries(a, x, ux), jaccard.entries(b, y, uy))))
        assert met
        assert jaccard.may_link(len(a), len(b), jaccard.histogram(a), jaccard.histogram(b))


def test_bands_are_neighbours():
    starts = jaccard.band_starts()
    for n in range(1, 3000):
        band = np.searchsorted(starts, n, side="right")
        assert np.searchsorted(starts, n * 5 // 4, side="right") - band in (0, 1)


def test_sets_that_cannot_pay_index_their_empty_segments():
    """Two such sets that share only empty segments still meet."""
    poor = [np.array([k << 40], dtype=np.uint64) for k in (1, 2)]
    for s in poor:
        for space, upper in jaccard.spaces_of(len(s)):
            assert len(jaccard.entries(s, space, upper))


def test_index_bytes_do_not_grow_with_buckets(monkeypatch):
    """A bucket's row lists the nodes of its own entries, and rows name the same entries however they are cut."""
    import pyarrow as pa

    monkeypatch.setattr(jaccard, "HELD_ENTRIES", 5000)
    rows = corpus(np.random.default_rng(6))
    batch = pa.RecordBatch.from_pydict({"text": pa.array([t for _, t in rows], pa.string())})

    def index(buckets):
        found, size = set(), 0
        for part in jaccard._index(buckets)(iter([batch])):
            for n, p, x, s in zip(*(part.column(c).to_pylist() for c in ("names", "place", "nodes", "sizes")), strict=True):
                names = np.frombuffer(n, dtype="<u8")
                place = np.frombuffer(p, dtype="<u2" if len(p) == 2 * len(names) else "<u4").astype(int)
                nodes, sizes = np.frombuffer(x, dtype="<u8").reshape(-1, 2), np.frombuffer(s, dtype="<u4")
                assert set((place // 2).tolist()) == set(range(len(nodes)))
                found |= {(int(e), *nodes[k // 2].tolist(), int(sizes[k // 2]), k % 2) for e, k in zip(names, place, strict=True)}
                size += len(n) + len(p) + len(x) + len(s)
        return found, size

    few, _ = index(1)
    many, size = index(3000)
    assert few == many
    assert size <= 30 * len(many)
