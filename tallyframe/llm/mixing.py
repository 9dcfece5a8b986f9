"""Mixing sources to target weights, in fixed-length blocks of words.

The documents of a source, in order, make one stream of words that is cut into blocks of ``block_words``. Every
slot of the output draws a source with probability in proportion to the source's quota of blocks, so the counts
of a shard are multinomial. Prefix sums over the shards number the slots of a source; numbers beyond its quota are
dealt on to sources that drew too few. Slot ``j`` of a source is block ``permutation(j mod n)`` of pass ``j div n``;
a permutation per source and pass is a Feistel network, so no list of blocks is shuffled. Slots and blocks meet in
an equi-join on (source, block).

Weights go round over the sources in code-point order, null last. Targets share ``total`` times all words; a target
stops at ``most`` times its source's words and the excess goes to the others by weight.

Defined cases: a null text has no words and is never taken; a null source is a source of its own, the last; equal
rows are separate documents; documents of one identifier stand in the order of their texts; without any word all
targets and counts are 0; further columns are ignored, or kept by ``mix_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyframe.llm.common import U64, col, mix, number_rows, prepare, row_hash, running_total, store, text_bytes, u64, words

WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 32
SLOTS_PER_SHARD = 1 << 16
# cells that the drawing of sources is looked up in
CELLS = 4096


def measured(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id, source, size, tie``: the words of each document and an order among rows of one identifier; ``more`` columns follow."""
    names = [f"_more{k}" for k in range(len(more))]
    inner = docs.select(
        "doc_id", "source", F.coalesce("text", F.lit("")).alias("_text"), F.xxhash64("text").alias("tie"),
        *(c.alias(n) for c, n in zip(more, names, strict=True)),
    )
    fields = inner.schema
    schema = T.StructType([fields["doc_id"], fields["source"], T.StructField("size", T.LongType()), fields["tie"], *(fields[n] for n in names)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, first = words(*text_bytes(batch.column("_text")))
            sizes = pa.array(np.diff(first).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [sizes if f == "size" else batch.column(f) for f in schema.names], names=schema.names
            )

    return inner.mapInArrow(count, schema)


def row_name(docs: DataFrame) -> Column:
    """One value for rows that are equal in every column, fit for joins: identifier and source, and two hashes of 64 bits."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.select("doc_id", "source").schema.fields}
    named = F.struct("doc_id", "source", F.xxhash64("text").alias("text"), row_hash(docs).alias("rest"))
    # all fields may be null, as in a stored table: a join of names that differ in this would deal the texts a second time
    return named.cast(f"struct<doc_id:{kinds['doc_id']},source:{kinds['source']},text:bigint,rest:bigint>")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, total: float = 1.5, most: float = 2.0,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per source: ``source_no, source, weight, source_size, target, n_blocks, quota`` and the place of its quota.

    The level at which targets stop is found by a few aggregates over the table of sources.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = number_rows(per_source, [F.col("source").asc_nulls_last()], "mix-sources")
    ranked = running_total(placed.withColumn("one", F.lit(1).cast("long")), "one", out="source_no").drop("one")
    cycle = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int")
    )
    ranked = store(ranked.withColumn("weight", cycle), "mix-ranked")
    cap = F.col("source_size") * F.lit(float(most))
    budget = (ranked.agg(F.sum("source_size")).first()[0] or 0) * float(total)
    level, stopped = 0.0, -1
    while budget:
        over = cap < F.col("weight") * F.lit(level)
        full, open_weight, n = ranked.agg(
            F.sum(F.when(over, cap).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
            F.count(F.when(over, 1)),
        ).first()
        if n == stopped or not open_weight:
            break
        level, stopped = (budget - full) / open_weight, n
    blocks = F.ceil(F.col("source_size") / F.lit(float(block_words))).cast("long")
    target = F.least(cap, F.col("weight") * F.lit(level))
    per_block = F.col("source_size") / F.col("n_blocks")
    quota = F.when(
        (F.col("n_blocks") > 0) & (F.col("target") > 0),
        F.least(F.floor(F.col("n_blocks") * F.lit(float(most))), F.greatest(F.lit(1), F.round(F.col("target") / per_block))),
    ).otherwise(0).cast("long")
    out = ranked.withColumn("n_blocks", blocks).withColumn("target", target).withColumn("quota", quota)
    return store(running_total(out, "quota", out="low"), "mix-targets")


def _in_interval(points: DataFrame, value: str, intervals: DataFrame, low: str, high: str, end: int) -> DataFrame:
    """Join every point in [0, end) with the one interval that holds it, by equal cells of the axis."""
    width = max(1, -(-end // CELLS))
    cells = intervals.where(F.col(high) > F.col(low)).withColumn(
        "_cell", F.explode(F.sequence(F.expr(f"{low} div {width}"), F.expr(f"({high} - 1) div {width}")))
    )
    met = points.withColumn("_cell", F.expr(f"{value} div {width}")).join(cells, "_cell")
    return met.where((F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))).drop("_cell")


def draw_slots(
    spark: SparkSession, targets: DataFrame, seed: int = 1, slots_per_shard: int = SLOTS_PER_SHARD
) -> DataFrame:
    """``shard, source_no, n_blocks, index``: the slots of every output shard and the number each has in its source."""
    end = targets.agg(F.sum("quota")).first()[0] or 0
    slots = spark.range(0, end, 1, max(spark.sparkContext.defaultParallelism, end // 1_000_000 + 1)).select(
        F.expr(f"id div {int(slots_per_shard)}").alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(end, 1))).alias("u"),
    )
    quotas = targets.select("source_no", "low", (F.col("low") + F.col("quota")).alias("high"))
    drawn = store(
        _in_interval(slots, "u", quotas, "low", "high", end).groupBy("shard", "source_no").agg(F.count("*").alias("n")),
        "mix-draws",
    )
    earlier = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = drawn.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # what a source drew beyond its quota, and what others lack, are two divisions of one axis
    sums = drawn.groupBy("source_no").agg(F.sum("n").alias("drawn"))
    state = targets.select("part", "seq", "source_no", "n_blocks", "quota").join(sums, "source_no", "left").withColumns({
        "extra": F.greatest(F.coalesce("drawn", F.lit(0)) - F.col("quota"), F.lit(0)),
        "lack": F.greatest(F.col("quota") - F.coalesce("drawn", F.lit(0)), F.lit(0)),
    })
    state = running_total(store(state, "mix-state"), "extra", out="extra_from")
    state = store(running_total(state, "lack", out="lack_from"), "mix-balance")
    # a row becomes up to a shard's slots, so the few rows are dealt out before
    spread = max(spark.sparkContext.defaultParallelism, end // 500_000 + 1)
    every = numbered.repartition(spread, "shard", "source_no").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).select(
        "shard", "source_no", (F.col("base") + F.col("i")).alias("index")
    ).join(state.select("source_no", "n_blocks", "quota", "extra_from"), "source_no")
    own = every.where("index < quota").select("shard", "source_no", "n_blocks", "index")
    moved = every.where("index >= quota").select(
        "shard", (F.col("extra_from") + F.col("index") - F.col("quota")).alias("at")
    )
    lacking = state.select(
        "source_no", "n_blocks", "lack_from", (F.col("lack_from") + F.col("lack")).alias("lack_to"),
        (F.col("quota") - F.col("lack")).alias("next"),
    )
    n_extra = state.agg(F.sum("extra")).first()[0] or 0
    dealt = _in_interval(moved, "at", lacking, "lack_from", "lack_to", n_extra).select(
        "shard", "source_no", "n_blocks", (F.col("next") + F.col("at") - F.col("lack_from")).alias("index")
    )
    return own.unionByName(dealt)


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray, rounds: int = 4) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1, row by row: a Feistel network, walked until the value is below n."""
    half = np.maximum((np.ceil(np.log2(np.maximum(n, 2).astype(np.float64))).astype(np.int64) + 1) // 2, 1).astype(U64)
    low = (U64(1) << half) - U64(1)
    value = index.astype(U64)
    todo = np.arange(len(value))
    while len(todo):
        a, b, h, m, k = value[todo] >> half[todo], value[todo] & low[todo], half[todo], low[todo], key[todo]
        for r in range(rounds):
            a, b = b, a ^ (mix(b + k + u64((r + 1) * 0x9E3779B97F4A7C15)) & m)
        value[todo] = (a << h) | b
        todo = todo[value[todo] >= n[todo].astype(U64)]
    return value.astype(np.int64)


def slot_blocks(slots: DataFrame, seed: int = 1) -> DataFrame:
    """``source_no, pass, block, shard`` of every slot."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, n, index = (batch.column(c).to_numpy() for c in ("source_no", "n_blocks", "index"))
            turn = index // n
            key = mix(mix(source.astype(U64) + u64(seed)) + turn.astype(U64))
            yield pa.RecordBatch.from_pydict({
                "source_no": source, "pass": turn, "block": permute(index % n, n, key), "shard": batch.column("shard"),
            })

    return slots.mapInArrow(find, "source_no long, pass long, block long, shard long")


def doc_pieces(placed: DataFrame, targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The blocks of each document: ``part, seq, source_no, block, first_word, n_words``."""
    numbered = running_total(placed.select("part", "seq", "source", "size"), "size", by=["source"], out="start")
    named = numbered.alias("l").join(
        targets.select("source_no", "source").alias("r"), F.col("l.source").eqNullSafe(F.col("r.source"))
    ).select("l.*", "r.source_no")
    cut = named.where("size > 0").withColumn(
        "block", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")))
    )
    first = F.greatest(F.col("block") * block_words, F.col("start"))
    last = F.least((F.col("block") + 1) * block_words, F.col("start") + F.col("size"))
    return cut.select(
        "part", "seq", "source_no", "block", (first - F.col("start")).alias("first_word"), (last - first).alias("n_words")
    )


def mix_counts(docs: DataFrame, seed: int = 1, block_words: int = BLOCK_WORDS, **rules) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: the words that the mix takes of each document, repeats counted."""
    spark = prepare(docs.sparkSession)
    placed = number_rows(
        measured(docs), [F.col("source").asc_nulls_last(), F.col("doc_id"), F.col("tie")], "mix-documents"
    )
    targets = source_targets(placed, block_words=block_words, **rules)
    slots = slot_blocks(draw_slots(spark, targets, seed), seed)
    uses = slots.groupBy("source_no", "block").agg(F.count("*").alias("uses"))
    taken = doc_pieces(placed, targets, block_words).join(uses, ["source_no", "block"]).groupBy("part", "seq").agg(
        F.sum(F.col("uses") * F.col("n_words")).alias("taken")
    )
    named = placed.alias("l").join(
        targets.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source"))
    ).select("l.*", "r.source_size", "r.target")
    return named.join(taken, ["part", "seq"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def _cut(data: bytes, starts: np.ndarray, ends: np.ndarray, pieces: list[dict]) -> str:
    """The taken runs of words of a text, one per line; the whole text if all words are taken."""
    runs: list[list[int]] = []
    for p in sorted(pieces, key=lambda p: p["first_word"]):
        a, n = p["first_word"], p["n_words"]
        if runs and runs[-1][1] == a:
            runs[-1][1] = a + n
        else:
            runs.append([a, a + n])
    if runs == [[0, len(starts)]]:
        return data.decode("utf-8", errors="replace")
    return "\n".join(data[starts[a] : ends[b - 1]].decode("utf-8", errors="replace") for a, b in runs)


def mix_documents(docs: DataFrame, seed: int = 1, block_words: int = BLOCK_WORDS, **rules) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row per document and pass, with the words the pass takes.

    Only sizes and names of the rows are put in order and stored; the texts join the pieces straight from ``docs``, which is read
    twice and must read alike. Rows that are equal in every column are one text there, with the pieces of them all.
    """
    spark = prepare(docs.sparkSession)
    columns = docs.columns
    order = [F.col("source").asc_nulls_last(), F.col("doc_id"), F.col("tie")]
    placed = number_rows(measured(docs, row_name(docs)), order, "mix-documents")
    targets = source_targets(placed, block_words=block_words, **rules)
    slots = slot_blocks(draw_slots(spark, targets, seed), seed)
    pieces = doc_pieces(placed, targets, block_words).join(slots, ["source_no", "block"]).groupBy(
        "part", "seq", "pass"
    ).agg(F.collect_list(F.struct("first_word", "n_words")).alias("pieces"))
    named = placed.where("size > 0").join(pieces, ["part", "seq"]).select(F.col("_more0").alias("_name"), "pieces")
    texts = docs.select(F.struct(*map(col, columns)).alias("_row"), row_name(docs).alias("_name")).dropDuplicates(["_name"])
    kept = texts.join(named, "_name").select("_row", F.col("_row.text").alias("_text"), "pieces")
    schema = T.StructType([kept.schema["_row"], T.StructField("_cut", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("_text"))
            starts, ends, first = words(data, offsets)
            out = []
            for d, pieces in enumerate(batch.column("pieces").to_pylist()):
                own = slice(first[d], first[d + 1])
                out.append(_cut(
                    data[offsets[d] : offsets[d + 1]].tobytes(), starts[own] - offsets[d], ends[own] - offsets[d], pieces
                ))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out, pa.string())], names=["_row", "_cut"])

    new = kept.mapInArrow(cut, schema)
    return new.select(*(
        F.col("_cut").alias(c) if c == "text"
        else F.char_length("_cut").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("_row").getField(c).alias(c)
        for c in columns
    ))
