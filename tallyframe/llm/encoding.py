"""Whole texts to token ids with a byte-level BPE of the tokenizers library.

The library splits a text into pre-tokens and encodes each by itself. A batch is therefore cut where a
pre-token is sure to end, equal pieces are encoded once, and the ids are put together again. Cuts are made
before ASCII white space that follows a non-blank ASCII byte or a Latin letter, and after a Latin letter before
an ASCII byte that is no letter. Pieces are known by a 64-bit hash; the table of known pieces is bounded.
"""

from __future__ import annotations

import json
import os

import numpy as np

from tallyframe.llm.common import BLANK, ranges, span_hash

_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = True
_ASCII_LETTER[97:123] = True
# second bytes of the Latin letters that start with 0xC3: all but the signs of multiplication and division
_C3_LETTER = np.zeros(256, dtype=bool)
_C3_LETTER[0x80:0xC0] = True
_C3_LETTER[[0x97, 0xB7]] = False
_JOINED = 256


class PieceEncoder:
    """Encodes batches of texts; ``special`` keeps the strings of special tokens as such."""

    def __init__(self, path: str, special: bool = True, max_pieces: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = not special
        spec = json.loads(self.model.to_str())
        self.marks = [t["content"].encode() for t in spec["added_tokens"]] if special else []
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values(), default=0) + 1
        self.dtype = "<u2" if self.size <= 1 << 16 else "<u4"
        # a byte-level token has one character per byte
        self.width = np.ones(self.size, dtype=np.int64)
        for token, k in vocabulary.items():
            self.width[k] = len(token)
        self.max_pieces = max_pieces
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.many = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=self.dtype)

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces and the number of each."""
        counts = np.zeros(len(pieces), dtype=np.int64)
        out: list[np.ndarray | None] = [None] * len(pieces)
        # pieces of a blank and letters keep their ends when they stand one after the other
        plain = [k for k, p in enumerate(pieces) if len(p) > 1 and p[0] == 32 and p[1:].isalpha()]
        rest = [k for k, p in enumerate(pieces) if not (len(p) > 1 and p[0] == 32 and p[1:].isalpha())]
        for i in range(0, len(plain), _JOINED):
            group = plain[i : i + _JOINED]
            ids = np.array(
                self.model.encode(b"".join(pieces[k] for k in group).decode(), add_special_tokens=False).ids,
                dtype=self.dtype,
            )
            ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(pieces[k]) for k in group])) + 1
            for k, a, b in zip(group, [0, *ends[:-1]], ends, strict=True):
                out[k] = ids[a:b]
        texts = [pieces[k].decode("utf-8", errors="replace") for k in rest]
        for k, e in zip(rest, self.model.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            out[k] = np.array(e.ids, dtype=self.dtype)
        for k, x in enumerate(out):
            counts[k] = len(x)
        return (np.concatenate(out) if out else np.zeros(0, dtype=self.dtype)).astype(self.dtype), counts

    def _learn(self, data: np.ndarray, names: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        ids, counts = self._encode([data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        known = np.concatenate([self.known, names])
        at = np.concatenate([self.at, len(self.ids) + np.cumsum(counts) - counts])
        many = np.concatenate([self.many, counts])
        order = np.argsort(known, kind="stable")
        self.known, self.at, self.many = known[order], at[order], many[order]
        self.ids = np.concatenate([self.ids, ids])

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, one after the other, and the number of ids of each."""
        n_docs = len(offsets) - 1
        whole = []
        if self.marks:
            raw = data.tobytes()
            for mark in self.marks:
                at = raw.find(mark)
                while at >= 0:
                    whole.append(int(np.searchsorted(offsets, at, side="right")) - 1)
                    at = raw.find(mark, at + 1)
        if not len(data):
            return np.zeros(0, dtype=self.dtype), np.zeros(n_docs, dtype=np.int64)
        letter = _ASCII_LETTER[data]
        letter[1:] |= (data[:-1] == 0xC3) & _C3_LETTER[data[1:]]
        blank = BLANK[data]
        ascii_byte = data < 128
        first = np.zeros(len(data), dtype=bool)
        first[1:] = (blank[1:] & ((ascii_byte[:-1] & ~blank[:-1]) | letter[:-1])) | (
            letter[:-1] & ascii_byte[1:] & ~letter[1:]
        )
        first[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(data))
        names, where, inverse = np.unique(span_hash(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > self.max_pieces:
            self._forget()
        k = np.minimum(np.searchsorted(self.known, names), max(len(self.known) - 1, 0))
        new = self.known[k] != names if len(self.known) else np.ones(len(names), dtype=bool)
        if new.any():
            self._learn(data, names[new], starts[where[new]], ends[where[new]])
            k = np.searchsorted(self.known, names)
        many = self.many[k][inverse]
        ids = self.ids[ranges(self.at[k][inverse], many)]
        totals = np.concatenate([[0], np.cumsum(many)])
        bounds = totals[np.searchsorted(starts, offsets)]
        if not whole:
            return ids, np.diff(bounds)
        parts, counts = [], np.diff(bounds)
        for d in sorted(set(whole)):
            text = data[offsets[d] : offsets[d + 1]].tobytes().decode("utf-8", errors="replace")
            parts.append((d, np.array(self.model.encode(text, add_special_tokens=False).ids, dtype=self.dtype)))
        pieces, last = [], 0
        for d, own in parts:
            pieces += [ids[bounds[last] : bounds[d]], own]
            counts[d] = len(own)
            last = d + 1
        return np.concatenate([*pieces, ids[bounds[last] :]]), counts


_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder(path: str, special: bool = True) -> PieceEncoder:
    """One encoder per worker process, kept between tasks."""
    key = (path, special)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, special)
    return _ENCODERS[key]
