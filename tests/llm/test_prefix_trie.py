import hashlib
import zlib

import numpy as np
import pytest

from tallyframe.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(first, [])[:h] + seq[h:])
    nodes = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    children, leaves, saved = {}, dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest())
        for p, m in nodes.items()
    )


def result(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in df.select(*columns).collect())


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.mark.parametrize("seed,longest", [(1, 9), (2, 20)])
def test_nodes_match_all_prefixes(spark, seed, longest):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(900, size=120, replace=False).tolist():
        n = int(rng.integers(1, longest))
        # few different turns: long shared prefixes and equal conversations
        rows += [(c, t, "u" if t % 2 else "a", str(rng.choice(["x", "yé", "x" * 7], p=[0.9, 0.07, 0.03]))) for t in range(n)]
    assert result(pt.prefix_trie(table(spark, rows))) == brute(rows)


def test_equal_conversations_in_pieces(spark):
    rows = [(c, t, "u", f"t{t}") for c in range(0, 3000, 37) for t in range(7)]
    assert result(pt.prefix_trie(table(spark, rows), piece=3)) == brute(rows)


def test_defined_cases(spark):
    rows = [
        (None, 0, "u", "lost"), (5, None, "u", "a"), (5, None, "u", "a"), (5, 3, None, None), (5, 1, "", ""), (-7, 0, "u", "é" * 90_000),
        (-250, 0, "u", "n"), (-250, -4, "u", "n"), (100, 0, "a", "x"), (101, 0, "u", "only"), (200, 2, "u", "q"), (200, 1, "v", ""), (299, 9, "u", "q"),
    ]
    df = table(spark, rows).selectExpr("*", "1 as pos", "2 as root", "3 as weight", "4 as `a.b`")
    assert result(pt.prefix_trie(df)) == brute(rows)


def test_turnless_conversations_end_at_the_root(spark):
    """A conversation whose own turns all lie in its head, of a hundred that has no first conversation, has no turn."""
    lone = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1][:5]
    rows = [(c, 0, "u", "x") for c in lone]
    got = result(pt.prefix_trie(table(spark, rows)))
    assert got == brute(rows) and got[0][1] == 0 and len(got) == 1


def test_empty_table(spark):
    assert result(pt.prefix_trie(table(spark, []))) == []
    assert result(pt.prefix_trie(table(spark, [(None, 1, "u", "x")]))) == []
