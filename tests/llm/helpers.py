"""Fixtures and brute-force twins shared by the tests of this folder."""

from __future__ import annotations

import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, schema=DOC_SCHEMA, parts=3):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) rows."""
    full = [
        (r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1]))
        for r in rows
    ]
    return spark.createDataFrame(full, schema).repartition(parts)


def words_of(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary, size=n))


def vocabulary(rng, n, letters="abcdefghij"):
    return np.array(sorted({"".join(rng.choice(list(letters), size=rng.integers(2, 9))) for _ in range(n)}))


class Union:
    """Components by the smallest member."""

    def __init__(self, n):
        self.up = list(range(n))

    def find(self, a):
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
