import functools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tallyframe.llm import files, token_counts, token_files
from tallyframe.llm.common import text_bytes
from tallyframe.llm.encoding import PieceEncoder
from tests.llm.helpers import documents, prose, vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "don't  stop\n\n now", " lead", "trail  ", "a b 　 c", "x\u0085 y", "tab\t\tword \r\n z", "1,234.5 (ok)!", "naïve œuvre Ünï",
    "<|endoftext|>", "a <|endoftext|>b", "<|endoftext", "日本語 текст ﷽ 🙂🙂 x", "it'll we've 'sup 's", "é combining", "\x1c x \x1d",
    "α,β.γ", "word,word.word;word", "\n", "   ", "ééé,é é.", "A" * 3000, "²½ x² y½", "a|b|c | d", "", None,
]


@functools.cache
def tokenizer(special):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = not special
    return t


def plain(text, special=True):
    return tokenizer(special).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("special", [True, False])
def test_pieces_encode_like_the_whole_text(special):
    rng = np.random.default_rng(1)
    words = vocabulary(rng, 500, "abcdeéèñßTHE.,;'")
    texts = ODD + [prose(rng, int(rng.integers(1, 400)), words) for _ in range(60)]
    texts += ["".join(rng.choice(list("ab é,.'\n\t1 α|"), size=40)) for _ in range(300)]
    encode = PieceEncoder(PATH, special)
    for _ in range(2):
        ids, counts = encode(*text_bytes(pa.array(texts)))
        cuts = np.append(0, np.cumsum(counts))
        for t, a, b in zip(texts, cuts[:-1], cuts[1:], strict=True):
            assert ids[a:b].tolist() == plain(t, special), repr(t)


def test_known_pieces_stay_bounded():
    rng = np.random.default_rng(2)
    encode = PieceEncoder(PATH, max_pieces=50)
    for _ in range(5):
        text = prose(rng, 300, vocabulary(rng, 400))
        ids, _ = encode(*text_bytes(pa.array([text])))
        assert ids.tolist() == plain(text)
        assert len(encode.known) < 500


def expected(rows, end_id):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = plain(text) + [end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("read_ids", [1 << 22, 16])
def test_files_give_back_every_document(spark, monkeypatch, read_ids):
    monkeypatch.setattr(token_files, "READ_IDS", read_ids)
    rows = [((i * 7) % 101, t) for i, t in enumerate(ODD)] + [(500, "word " * 20_000)]
    made = token_files.write_tokens(documents(spark, rows), PATH, 2)
    got = [tuple(r) for r in token_files.read_tokens(spark, made).orderBy("doc_id").collect()]
    assert got == expected(rows, 2)
    # the files are what they are said to be: flat 16-bit ids and 64-bit offsets over the whole folder
    first = 0
    for part, n_docs, n_tokens, base in made.parts:
        ids = files.read_flat(f"{made.path}/{part:08d}.bin", "<u2")
        offsets = files.read_flat(f"{made.path}/{part:08d}.idx", "<i8")
        assert (len(ids), len(offsets), offsets[0], offsets[-1]) == (n_tokens, n_docs + 1, base, base + n_tokens)
        assert base == first
        first += n_tokens


def test_ties_stay_in_a_fixed_order(spark):
    rows = [(1, "b b"), (1, "a"), (1, "b b"), (0, "z")]
    runs = [
        [tuple(r) for r in token_files.read_tokens(spark, token_files.write_tokens(documents(spark, rows, parts=p), PATH, 2)).orderBy("start").collect()]
        for p in (1, 3)
    ]
    assert runs[0] == runs[1] and [r[0] for r in runs[0]] == [0, 1, 1, 1]


def test_no_documents(spark):
    made = token_files.write_tokens(documents(spark, []), PATH, 2)
    assert token_files.read_tokens(spark, made).collect() == []
    assert token_counts.document_token_counts(documents(spark, []), PATH, 50256).collect() == []


def test_extra_columns_with_the_names_of_the_operator(spark):
    df = documents(spark, [(1, "a b"), (2, None)]).selectExpr("*", "1 as part", "'x' as n_tokens", "0 as start", "5 as file")
    made = token_files.write_tokens(df, PATH, 2)
    assert [r.n_tokens for r in token_files.read_tokens(spark, made).orderBy("doc_id").collect()] == [3, 1]
    assert sorted(map(tuple, token_counts.document_token_counts(df, PATH, 50256).collect())) == [(1, 3), (2, 1)]


def test_null_identifier_comes_first(spark):
    made = token_files.write_tokens(documents(spark, [(3, "a"), (None, "b c"), (1, "d")]), PATH, 2)
    assert [r.doc_id for r in token_files.read_tokens(spark, made).orderBy("start").collect()] == [None, 1, 3]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 1000])
def test_scan_stitches_documents_across_blocks(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    contents = [
        [5, 9, 5, 9, 9, 7, 7, 7, 7, 7, 7, 9, 1], [9], [3, 3], [], [9, 9, 9], rng.choice([1, 2, 9], size=150, p=[0.6, 0.3, 0.1]).tolist(),
    ]
    sizes, want = [], []
    for k, ids in enumerate(contents):
        path = f"{tmp_path}/{k}.bin"
        files.write_flat(path, np.array(ids, dtype="<u2"))
        sizes.append((path, len(ids)))
        n = j = 0
        for x in ids:
            n += 1
            if x == 9:
                want.append((path, j, n, True))
                n, j = 0, j + 1
        if n:
            want.append((path, j, n, False))
    got = token_counts.count_tokens(spark.createDataFrame(sizes, "file string, n_ids long"), 9, "<u2", block)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_document_counts(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(77, "same"), (78, "same"), (78, "same")]
    got = token_counts.document_token_counts(documents(spark, rows), PATH, 50256, block_ids=64).collect()
    assert sorted(map(tuple, got)) == sorted((i, len(plain(t, special=False)) + 1) for i, t in rows)


def test_flat_files_move_into_place_whole(tmp_path):
    for _ in range(2):
        files.write_flat(f"file://{tmp_path}/x/a.bin", np.arange(5, dtype="<u4"))
    assert sorted(p.name for p in (tmp_path / "x").iterdir()) == ["a.bin"]
    assert files.read_flat(f"{tmp_path}/x/a.bin", "<u4", 1, 3).tolist() == [1, 2, 3]
    assert files.read_flat(f"{tmp_path}/x/a.bin", "<u4", 5).tolist() == []
    assert files.flat_size(f"{tmp_path}/x/a.bin", "<u4") == 5
