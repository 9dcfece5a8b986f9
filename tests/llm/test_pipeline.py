import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm import queries
from tests.llm.helpers import documents, prose, vocabulary, words_of
from tests.llm.test_decontaminate import brute as overlaps
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_tokens import expected

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """A small corpus with a benchmark, near copies, overlaps and texts without a language."""
    rng = np.random.default_rng(11)
    words = {"aa": vocabulary(rng, 150, "abcdefgh"), "bb": vocabulary(rng, 150, "ijklmnop")}
    items = [(k, prose(rng, 25, words["aa"])) for k in range(4)]
    rows = []
    for i in range(70):
        lang = "aa" if i % 2 else "bb"
        text = prose(rng, int(rng.integers(5, 120)), words[lang])
        if i % 9 == 0:
            text += " " + items[i % 4][1]
        if i % 10 == 3:
            text = rows[-1][1] + " extra"
        rows.append((i, text, lang, f"s{i % 3}"))
    rows += [(100, None, "aa", "s0"), (101, "12 34 56", "aa", "s1"), (102, "", None, None)]
    path = tmp_path_factory.mktemp("tables")
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO d VALUES (?, ?, ?, ?, ?)", [(*r, None if r[1] is None else len(r[1])) for r in rows])
    con.execute(f"COPY d TO '{path}/documents.parquet' (FORMAT parquet)")
    con.execute("CREATE TABLE b (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO b VALUES (?, ?)", items)
    con.execute(f"COPY b TO '{path}/benchmark.parquet' (FORMAT parquet)")
    return str(path), rows, items


def test_every_stage_against_its_own_input(spark, folder):
    path, rows, items = folder
    docs = queries.table(spark, path, "documents")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language", "near_copies", "contamination", "mix", "token_output"]

    def run(name, before):
        out = corpus_pipeline.store(steps[name](spark, before, path), f"test-{name}")
        if name != "token_output":
            assert out.columns == COLUMNS and out.dtypes == docs.dtypes
        return out

    kept = run("language", docs)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(70))
    assert {r.doc_id: r.text for r in kept.collect()} == {r[0]: r[1] for r in rows[:70]}

    single = run("near_copies", kept)
    want = sorted(i for i, _, root in groups([r[:2] for r in rows[:70]]) if i == root)
    assert sorted(r.doc_id for r in single.collect()) == want and len(want) < 70

    clean = run("contamination", single)
    left = [r for r in rows[:70] if r[0] in set(want)]
    hit = {i for i, *_ in overlaps([r[:2] for r in left], items)}
    assert hit and sorted(r.doc_id for r in clean.collect()) == sorted(set(want) - hit)

    mixed = run("mix", clean)
    size = {r.doc_id: len(words_of(r.text)) for r in clean.collect()}
    taken = {}
    for r in mixed.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(words_of(r.text))
    assert set(taken) <= set(size) and all(n <= 2 * size[i] for i, n in taken.items())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(size.values()), rel=0.05)

    tokens = run("token_output", mixed)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens.collect())
    want = expected([(r.doc_id, r.text) for r in mixed.collect()], 2)
    assert sorted((d, n, c) for _, d, n, c in got) == sorted((d, n, c) for d, _, n, c in want)
    assert [s for s, *_ in got] == np.cumsum([0, *(n for _, _, n, _ in got[:-1])]).tolist()


def test_run_is_the_stages_in_a_row(spark, folder):
    path, rows, _ = folder
    found = corpus_pipeline.run(spark, path)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    got = sorted(map(tuple, found.select("start", "doc_id", "n_tokens").collect()))
    assert [r[0] for r in got] == np.cumsum([0, *(r[2] for r in got[:-1])]).tolist()
    assert [r[1] for r in got] == sorted(r[1] for r in got) and {r[1] for r in got} < {r[0] for r in rows[:70]}


def test_odd_rows_and_columns_pass_every_stage(spark, tmp_path):
    """Null and repeated identifiers, a very long text, and extra columns whose names clash or hold dots and backticks."""
    rng = np.random.default_rng(3)
    words = vocabulary(rng, 200)
    rows = [(i, prose(rng, 40, words), "aa", f"s{i % 2}") for i in range(30)]
    rows += [(None, prose(rng, 40, words), "aa", None), (None, prose(rng, 40, words), None, "s1"), (7, prose(rng, 40, words), "aa", "s0")]
    rows += [(7, rows[7][1], "aa", "s1"), (50, prose(rng, 60_000, words), "aa", "s0"), (51, None, None, None)]
    extra = {"a.b": 1, "_row": 2, "_no": 3, "size": 4, "node": 5, "c`d": 6, "_all": 7, "batch": 8, "A.B.c": 9}
    docs = documents(spark, rows)
    for name, value in extra.items():
        docs = docs.withColumn(name, F.lit(value))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(rng, 25, words))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = queries.table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.store(stage(spark, now, str(tmp_path)), f"odd-{name}")
        assert now.columns == docs.columns, name
        for r in now.collect():
            assert {c: r[c] for c in extra} == extra
        ids = [r.doc_id for r in now.select("doc_id").collect()]
        assert 50 in ids and 51 not in ids and None in ids, name
        if name == "near_copies":
            assert ids.count(7) == 2 and ids.count(None) == 2, "an equal text goes, others of the same identifier stay"
    out = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).collect()
    assert len(out) == now.count()


def test_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered_queries_cover_every_operator(spark):
    import __spark_entry__

    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)
